"""The query list: one entry per operator, each ``(spark, folder) -> DataFrame``.

Every query reads the given tables in full. Gold tables are recomputed from the
entity views here; the batch and incremental runs read them from storage.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veritrail.operators import (
    bitmaps,
    forest,
    gold,
    profiles,
    quality,
    reports,
    risk,
    rollups,
    rules,
    skew,
    timeline,
)
from veritrail.functions import grading as g
from veritrail.operators import silver as s
from veritrail.plans import incremental, landing, medallion
from veritrail.plans.entities import AS_OF, BRONZE, Entities
from veritrail.session import bounded_tasks
from veritrail.sources import schemas
from veritrail.sources.audit import with_audit
from veritrail.sources.readers import read_csv, read_jsonl, read_table
from veritrail.sources.scratch import materialise, new_scratch_dir, shuffles_removed
from veritrail.sources.sinks import layer_counts, write_table
from veritrail.streaming import ingest, live, refine
from veritrail.streaming.manifest import BatchTable

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
CLEANED = ("controls", "criteria", "systems", "assessments", "evidence")


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# --- gold inputs shared by several queries ---------------------------------


def _scorecard(e: Entities) -> DataFrame:
    return gold.system_scorecard(
        e.systems,
        rollups.system_assessment_rollup(e.assessments),
        rollups.system_evidence_rollup(e.evidence),
        AS_OF,
    )


def _pairs(e: Entities) -> DataFrame:
    return rollups.evidence_pairs(e.evidence)


def _observed_gaps(e: Entities) -> DataFrame:
    return gold.evidence_gap_observed(rollups.evidence_rollup(_pairs(e)), AS_OF)


def _matrix_gaps(e: Entities) -> DataFrame:
    return gold.evidence_gap_matrix(
        e.controls, e.systems, rollups.evidence_rollup(_pairs(e)), AS_OF
    )


def _readiness(e: Entities) -> DataFrame:
    return gold.audit_readiness(e.assessments, e.evidence, e.systems, AS_OF)


def _cross_framework(e: Entities) -> DataFrame:
    return gold.cross_framework(
        e.controls, e.control_mapping, e.criteria, rollups.control_rollup(e.assessments), AS_OF
    )


def _stored_pairs(e: Entities) -> DataFrame:
    return materialise(_pairs(e), "evidence-pairs")


def _features(e: Entities) -> DataFrame:
    return risk.risk_features(e.assessments, e.systems, _stored_pairs(e))


#: What the rules, the scorecard and the gaps read of the large entities.
ALERTED = {
    "evidence": (
        "evidence_id", "control_id", "system_id", "status", "upload_timestamp", "is_expired",
        "days_until_expiry", "is_current",
    ),
    "assessments": (
        "assessment_id", "control_id", "system_id", "assessment_date", "implementation_status",
        "compliance_score", "is_overdue", "days_to_remediation",
    ),
}


def _alerts(e: Entities) -> DataFrame:
    """Each entity is cleaned once and what is needed of it is stored; rules and
    gold read that."""
    evidence = materialise(e.evidence.select(*ALERTED["evidence"]), "silver-evidence")
    assessments = materialise(e.assessments.select(*ALERTED["assessments"]), "silver-assessments")
    pairs = materialise(rollups.evidence_pairs(evidence), "evidence-pairs")
    card = gold.system_scorecard(
        e.systems,
        rollups.system_assessment_rollup(assessments),
        rollups.system_evidence_from_pairs(pairs),
        AS_OF,
    )
    gaps = gold.evidence_gap_observed(rollups.evidence_rollup(pairs), AS_OF)
    return rules.all_alerts(evidence, assessments, card, gaps, rules.standard_rules(), AS_OF)


# --- sources and sinks ------------------------------------------------------


@query
def src_csv_infer(spark: SparkSession, folder: str) -> DataFrame:
    path = new_scratch_dir(spark, "assessments-csv")
    landing.land_csv(Entities(spark, folder).bronze("assessments"), path)
    return read_csv(spark, path)


@query
def src_csv_strings(spark: SparkSession, folder: str) -> DataFrame:
    path = new_scratch_dir(spark, "systems-csv")
    landing.land_csv(Entities(spark, folder).bronze("systems"), path)
    return read_csv(spark, path, infer=False)


@query
def src_jsonl(spark: SparkSession, folder: str) -> DataFrame:
    path = new_scratch_dir(spark, "evidence-json")
    landing.land_json(Entities(spark, folder).bronze("evidence"), path)
    return read_jsonl(spark, path).select(*schemas.EVIDENCE_COLUMNS)


@query
def sink_overwrite_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Writes the scorecard over an older version of the same table."""
    path = new_scratch_dir(spark, "scorecard-table")
    name = f"veritrail_{path.rsplit('-', 1)[1]}"
    card = _scorecard(Entities(spark, folder))
    write_table(card.select("system_id"), name, path=path)
    write_table(card, name, path=path, comment="System scorecard", properties={"quality": "gold"})
    return _then_dropped(spark, name, read_table(spark, name))


def _then_dropped(spark: SparkSession, name: str, result: DataFrame) -> DataFrame:
    """``result`` as stored; the table leaves the catalogue, its folder stays."""
    stored = materialise(result, "table-read")
    spark.sql(f"DROP TABLE {name}")
    return stored


@query
def table_description(spark: SparkSession, folder: str) -> DataFrame:
    """Comment, properties and rows of a table, as the catalogue has them."""
    path = new_scratch_dir(spark, "described-table")
    name = f"veritrail_{path.rsplit('-', 1)[1]}"
    properties = {"quality": "silver", "origin": "system inventory"}
    write_table(
        Entities(spark, folder).systems, name, path=path, comment="Systems", properties=properties
    )
    kept = spark.sql(f"SHOW TBLPROPERTIES {name}").where(F.col("key").isin(*properties))
    detail = spark.sql(f"DESCRIBE EXTENDED {name}").where("col_name = 'Comment'")
    told = kept.select("key", "value").union(
        detail.select(F.lit("comment").alias("key"), F.col("data_type").alias("value"))
    )
    rows = read_table(spark, name).agg(F.count(F.lit(1))).scalar()
    return _then_dropped(spark, name, told.withColumn("table_rows", rows))


@query
def dq_violations(spark: SparkSession, folder: str) -> DataFrame:
    """The evidence rows that are not accepted, as rows behind a violation."""
    evidence = Entities(spark, folder).evidence
    return quality.violating_rows(evidence, "status = 'Accepted'").select(
        "evidence_id", "control_id", "status"
    )


@query
def audit_columns(spark: SparkSession, folder: str) -> DataFrame:
    path = new_scratch_dir(spark, "controls-csv")
    landing.land_csv(Entities(spark, folder).bronze("controls"), path)
    loaded = with_audit(read_csv(spark, path), source="catalogue export", file=True)
    return loaded.select(
        "control_id",
        F.col("_source").alias("source"),
        F.col("_source_file").contains(path).alias("has_source_file"),
        F.col("_ingestion_timestamp").isNotNull().alias("has_ingestion_timestamp"),
    )


@query
def layer_row_counts(spark: SparkSession, folder: str) -> DataFrame:
    e = Entities(spark, folder)
    return layer_counts({name: e.bronze(name) for name in BRONZE})


# --- silver -----------------------------------------------------------------


@query
def silver_controls(spark: SparkSession, folder: str) -> DataFrame:
    return Entities(spark, folder).controls


@query
def silver_criteria(spark: SparkSession, folder: str) -> DataFrame:
    return Entities(spark, folder).criteria


@query
def silver_systems(spark: SparkSession, folder: str) -> DataFrame:
    return Entities(spark, folder).systems


@query
def silver_assessments(spark: SparkSession, folder: str) -> DataFrame:
    return Entities(spark, folder).assessments


@query
def silver_evidence(spark: SparkSession, folder: str) -> DataFrame:
    return Entities(spark, folder).evidence


@query
def silver_evidence_incremental(spark: SparkSession, folder: str) -> DataFrame:
    raw = Entities(spark, folder).bronze("evidence")
    return s.silver_evidence(raw, AS_OF, wait_column=refine.WAIT_COLUMN)


# --- data quality -----------------------------------------------------------


def _expectations(name: str) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        cleaned = getattr(Entities(spark, folder), name)
        return quality.expectation_report(cleaned, name, quality.EXPECTATIONS[name])

    return run


for _name in CLEANED:
    QUERIES[f"dq_{_name}"] = _expectations(_name)


@query
def dq_report(spark: SparkSession, folder: str) -> DataFrame:
    e = Entities(spark, folder)
    return quality.full_report({name: getattr(e, name) for name in CLEANED})


# --- rollups and gold -------------------------------------------------------


@query
def system_assessment_rollup(spark: SparkSession, folder: str) -> DataFrame:
    return rollups.system_assessment_rollup(Entities(spark, folder).assessments)


@query
def system_evidence_rollup(spark: SparkSession, folder: str) -> DataFrame:
    return rollups.system_evidence_rollup(Entities(spark, folder).evidence)


@query
def control_rollup(spark: SparkSession, folder: str) -> DataFrame:
    return rollups.control_rollup(Entities(spark, folder).assessments)


@query
def evidence_rollup(spark: SparkSession, folder: str) -> DataFrame:
    return rollups.evidence_rollup(_pairs(Entities(spark, folder)))


@query
def gold_compliance_summary(spark: SparkSession, folder: str) -> DataFrame:
    return gold.compliance_summary(Entities(spark, folder).assessments, AS_OF)


@query
def gold_system_scorecard(spark: SparkSession, folder: str) -> DataFrame:
    return _scorecard(Entities(spark, folder))


@query
def gold_cross_framework(spark: SparkSession, folder: str) -> DataFrame:
    return _cross_framework(Entities(spark, folder))


@query
def gold_expected_evidence(spark: SparkSession, folder: str) -> DataFrame:
    e = Entities(spark, folder)
    return gold.expected_evidence(e.controls, e.systems)


@query
def gold_evidence_gap_observed(spark: SparkSession, folder: str) -> DataFrame:
    return _observed_gaps(Entities(spark, folder))


@query
def gold_evidence_gap_matrix(spark: SparkSession, folder: str) -> DataFrame:
    return _matrix_gaps(Entities(spark, folder))


@query
def gold_missing_by_system(spark: SparkSession, folder: str) -> DataFrame:
    e = Entities(spark, folder)
    return gold.missing_by_system(e.controls, e.systems, rollups.evidence_rollup(_pairs(e)))


@query
def gold_missing_by_control(spark: SparkSession, folder: str) -> DataFrame:
    e = Entities(spark, folder)
    return gold.missing_by_control(e.controls, e.systems, rollups.evidence_rollup(_pairs(e)))


@query
def gold_audit_readiness(spark: SparkSession, folder: str) -> DataFrame:
    return _readiness(Entities(spark, folder))


TIMELINE_DAYS = 90


@query
def readiness_timeline(spark: SparkSession, folder: str) -> DataFrame:
    """Every day of half a year around the reporting day."""
    e = Entities(spark, folder)
    reach = dt.timedelta(days=TIMELINE_DAYS)
    return timeline.readiness_timeline(
        materialise(e.assessments.select(*timeline.READ["assessments"]), "silver-assessments"),
        materialise(e.evidence.select(*timeline.READ["evidence"]), "silver-evidence"),
        e.systems,
        AS_OF - reach,
        AS_OF + reach,
    )


# --- evidence bitmaps ---------------------------------------------------------


def _bitmaps(e: Entities) -> tuple[DataFrame, DataFrame]:
    numbers = materialise(bitmaps.dense_ids(e.systems, "system_id"), "system-numbers")
    return materialise(bitmaps.system_bitmaps(_pairs(e), numbers), "bitmaps"), numbers


@query
def evidence_by_control(spark: SparkSession, folder: str) -> DataFrame:
    e = Entities(spark, folder)
    return bitmaps.control_coverage(e.controls, e.systems, *_bitmaps(e))


@query
def evidence_by_family_unit(spark: SparkSession, folder: str) -> DataFrame:
    e = Entities(spark, folder)
    return bitmaps.family_unit_coverage(e.controls, e.systems, *_bitmaps(e), "business_unit")


#: Family and units of which the missing pairs are listed.
LISTED_FAMILY, LISTED_UNITS = "PR", ("NATION_9", "NATION_15", "NATION_18")


@query
def evidence_missing_pairs(spark: SparkSession, folder: str) -> DataFrame:
    e = Entities(spark, folder)
    controls = e.controls.where(F.col("control_family_code") == LISTED_FAMILY)
    systems = e.systems.where(F.col("business_unit").isin(*LISTED_UNITS))
    return bitmaps.missing_pairs(controls, systems, *_bitmaps(e))


@query
def assessment_vs_peers(spark: SparkSession, folder: str) -> DataFrame:
    """Every assessment beside the average of its family, a join of all rows on
    a key of few values with an aggregate of the same rows."""
    rows = materialise(
        Entities(spark, folder).assessments.select(
            "assessment_id", "control_family_code", "compliance_score"
        ),
        "scored",
    )
    peers = rows.groupBy("control_family_code").agg(
        F.count(F.lit(1)).alias("family_assessments"),
        g.one_decimal(F.avg("compliance_score")).alias("family_score"),
    )
    return skew.skew_join(rows, peers, "control_family_code", "left")


# --- rules and alerts -------------------------------------------------------


@query
def rules_active(spark: SparkSession, folder: str) -> DataFrame:
    return rules.rule_activity(_alerts(Entities(spark, folder)), rules.standard_rules())


#: Rule kept in the stored table but switched off, and one of a reader's own.
SILENT_RULE, OWN_RULE = "stale_assessment", "expired_evidence"


@query
def alerts_from_stored_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Rules are cleared and written anew as a table, one of them changed and one
    switched off; what is loaded from the table raises the alerts."""
    path = new_scratch_dir(spark, "rules-table")
    name = f"veritrail_{path.rsplit('-', 1)[1]}"
    book = rules.RuleBook()
    for r in rules.standard_rules().active():
        code = r.check_code
        if r.rule_name == OWN_RULE:
            code = rules.check(("FAIL", "is_expired"), ("WARN", "days_until_expiry < 60"))
        book.insert(r.rule_name, r.rule_description, code, r.severity, r.rule_name != SILENT_RULE)
    write_table(rules.standard_rules().to_frame(spark), name, path=path)
    write_table(book.to_frame(spark), name, path=path, comment="Compliance rules")
    loaded = rules.RuleBook.from_frame(read_table(spark, name))
    e = Entities(spark, folder)
    alerts = rules.evidence_alerts(e.evidence, loaded, AS_OF).unionByName(
        rules.system_alerts(_scorecard(e), loaded, AS_OF)
    )
    return _then_dropped(spark, name, alerts)


@query
def alerts_expired_evidence(spark: SparkSession, folder: str) -> DataFrame:
    e = Entities(spark, folder)
    return rules.evidence_alerts(e.evidence, rules.standard_rules(), AS_OF)


@query
def alerts_overdue_remediation(spark: SparkSession, folder: str) -> DataFrame:
    e = Entities(spark, folder)
    return rules.assessment_alerts(e.assessments, rules.standard_rules(), AS_OF)


@query
def alerts_stale_assessment(spark: SparkSession, folder: str) -> DataFrame:
    card = _scorecard(Entities(spark, folder))
    return rules.system_alerts(card, rules.standard_rules(), AS_OF, ["stale_assessment"])


@query
def alerts_critical_coverage(spark: SparkSession, folder: str) -> DataFrame:
    card = _scorecard(Entities(spark, folder))
    return rules.system_alerts(card, rules.standard_rules(), AS_OF, ["critical_system_coverage"])


@query
def alerts_evidence_gap(spark: SparkSession, folder: str) -> DataFrame:
    e = Entities(spark, folder)
    return rules.gap_alerts(_observed_gaps(e), rules.standard_rules(), AS_OF)


@query
def alerts_evidence_gap_matrix(spark: SparkSession, folder: str) -> DataFrame:
    """Over the expected pairs: one alert per pair that has evidence, one per
    system for all of its pairs that have none."""
    e = Entities(spark, folder)
    pairs = rollups.evidence_rollup(_stored_pairs(e))
    book = rules.standard_rules()
    held = gold.evidence_gap_matrix(e.controls, e.systems, pairs, AS_OF)
    one = F.lit(1).cast("long").alias("pairs")
    missing = gold.missing_by_system(e.controls, e.systems, pairs)
    return (
        rules.gap_alerts(held, book, AS_OF)
        .select("*", one)
        .unionByName(rules.missing_evidence_alerts(missing, book, AS_OF))
    )


@query
def alerts_systems_single_pass(spark: SparkSession, folder: str) -> DataFrame:
    card = _scorecard(Entities(spark, folder))
    return rules.system_alerts(card, rules.standard_rules(), AS_OF)


@query
def alerts_all(spark: SparkSession, folder: str) -> DataFrame:
    return _alerts(Entities(spark, folder))


# --- reports ----------------------------------------------------------------


@query
def report_executive(spark: SparkSession, folder: str) -> DataFrame:
    return reports.executive_summary(_readiness(Entities(spark, folder)))


@query
def report_alert_summary(spark: SparkSession, folder: str) -> DataFrame:
    return reports.alert_summary(_alerts(Entities(spark, folder)))


@query
def report_scorecard_sorted(spark: SparkSession, folder: str) -> DataFrame:
    return reports.scorecard_worst_first(_scorecard(Entities(spark, folder)))


@query
def report_gap_severity(spark: SparkSession, folder: str) -> DataFrame:
    return reports.gap_severity_histogram(_observed_gaps(Entities(spark, folder)))


@query
def report_gap_severity_matrix(spark: SparkSession, folder: str) -> DataFrame:
    e = Entities(spark, folder)
    return gold.gap_severity_histogram_matrix(
        e.controls, e.systems, rollups.evidence_rollup(_pairs(e))
    )


@query
def report_preview(spark: SparkSession, folder: str) -> DataFrame:
    table = _cross_framework(Entities(spark, folder))
    return reports.preview(table, "nist_control_id", "soc2_tsc_id", "mapping_type")


# --- risk -------------------------------------------------------------------


@query
def risk_features(spark: SparkSession, folder: str) -> DataFrame:
    return _features(Entities(spark, folder))


@query
def risk_features_matrix(spark: SparkSession, folder: str) -> DataFrame:
    e = Entities(spark, folder)
    return risk.risk_features_matrix(e.assessments, e.systems, e.controls, _stored_pairs(e))


@query
def risk_split(spark: SparkSession, folder: str) -> DataFrame:
    rows = Entities(spark, folder).assessments.select("assessment_id")
    return risk.with_split(rows)


TABLES = ("region", "nation", "supplier", "part", "orders", "lineitem")


def _identity(spark: SparkSession, folder: str) -> tuple:
    """What tells tables from others: the application, and number, names, sizes
    and times of their files. Contents are not read."""
    files = spark.read.format("binaryFile").load([f"{folder}/{t}.parquet" for t in TABLES])
    mark = F.xxhash64("path", "length", "modificationTime").cast("decimal(20,0)")
    return (spark.sparkContext.applicationId, folder, *files.agg(F.count("path"), F.sum(mark)).head())


# Places of features, fitted model and predictions by the tables' files: the
# forest is trained once and every model query reads what is stored.
_risk_stores: dict[tuple, dict[str, str]] = {}


def _risk_store(e: Entities) -> dict[str, DataFrame | PipelineModel]:
    spark, key = e.spark, _identity(e.spark, e.sf_dir)
    if key not in _risk_stores:
        root = new_scratch_dir(spark, "risk")
        places = {name: f"{root}/{name}" for name in ("features", "model", "predictions")}
        _features(e).write.option("compression", "zstd").parquet(places["features"])
        features = spark.read.parquet(places["features"])
        train_rows, _ = risk.train_test(features)
        risk.train(train_rows).write().save(places["model"])
        model = PipelineModel.load(places["model"])
        scored = risk.score(model, features, AS_OF)
        scored.write.option("compression", "zstd").parquet(places["predictions"])
        _risk_stores[key] = places
    places = _risk_stores[key]
    return {
        "features": spark.read.parquet(places["features"]),
        "model": PipelineModel.load(places["model"]),
        "predictions": spark.read.parquet(places["predictions"]),
    }


# What a forest predicts has no SQL form. Beside each of these queries is one
# that checks its rows for what holds for any forest, which SQL can state.


@query
def risk_score(spark: SparkSession, folder: str) -> DataFrame:
    return _risk_store(Entities(spark, folder))["predictions"]


@query
def risk_auc(spark: SparkSession, folder: str) -> DataFrame:
    store = _risk_store(Entities(spark, folder))
    _, test_rows = risk.train_test(store["features"])
    auc = risk.area_under_roc(store["model"], test_rows)
    return test_rows.agg(F.count(F.lit(1)).alias("test_rows")).withColumn(
        "area_under_roc", F.lit(auc)
    )


@query
def report_risk_summary(spark: SparkSession, folder: str) -> DataFrame:
    return reports.risk_summary(_risk_store(Entities(spark, folder))["predictions"])


@query
def report_high_risk(spark: SparkSession, folder: str) -> DataFrame:
    e = Entities(spark, folder)
    return reports.high_risk_controls(_risk_store(e)["predictions"], e.systems)


@query
def risk_score_by_trees(spark: SparkSession, folder: str) -> DataFrame:
    """Scores of all assessments from the forest's node table, by joins."""
    store = _risk_store(Entities(spark, folder))
    *before, _, _ = store["model"].stages
    indexed = PipelineModel(before).transform(store["features"])
    return forest.scores(indexed, forest.nodes(store["model"]), risk.FEATURES, ["assessment_id"])


@query
def risk_trees_checks(spark: SparkSession, folder: str) -> DataFrame:
    """One row: the trees walked by joins give the model's scores."""
    walked = QUERIES["risk_score_by_trees"](spark, folder)
    model = _risk_store(Entities(spark, folder))["predictions"]
    # Assessments that repeat an id have their scores in the same order. Both
    # sides are grouped in one shuffle; the other side's nulls are not collected.
    none = F.lit(None).cast("double")
    sides = walked.select("assessment_id", F.col("risk_score").alias("a"), none.alias("b")).union(
        model.select("assessment_id", none, "risk_score")
    )
    both = sides.groupBy("assessment_id").agg(
        *(F.sort_array(F.collect_list(c)).alias(c) for c in ("a", "b"))
    )
    apart = F.exists(F.arrays_zip("a", "b"), lambda s: F.abs(s["a"] - s["b"]) > 1e-9)
    return both.agg(
        F.sum(F.size("a")).cast("long").alias("assessments"),
        F.every(F.coalesce((F.size("a") == F.size("b")) & ~apart, F.lit(False))).alias("equal"),
    )


@query
def risk_score_checks(spark: SparkSession, folder: str) -> DataFrame:
    score = F.col("risk_score")
    level = (
        F.when(score >= 0.7, "High").when(score >= 0.4, "Medium").otherwise("Low")
    )
    return _risk_store(Entities(spark, folder))["predictions"].select(
        *risk.KEY_COLUMNS,
        "prediction_date",
        score.between(0, 1).alias("score_in_range"),
        (F.col("risk_level") == level).alias("level_follows_score"),
        (F.col("predicted_at_risk") == (score > 0.5).cast("double")).alias(
            "prediction_follows_score"
        ),
    )


@query
def risk_auc_checks(spark: SparkSession, folder: str) -> DataFrame:
    store = _risk_store(Entities(spark, folder))
    _, test_rows = risk.train_test(store["features"])
    auc = risk.area_under_roc(store["model"], test_rows)
    # The split follows from the id, so only predictions of test ids have a partner.
    _, predicted = risk.train_test(store["predictions"].select("assessment_id", "risk_score"))
    scored = predicted.join(test_rows.select("assessment_id", risk.LABEL), "assessment_id")
    ranks = risk.area_by_ranks(scored).scalar()
    return test_rows.agg(F.count(F.lit(1)).alias("test_rows")).select(
        "test_rows",
        F.lit(0.5 < auc <= 1.0).alias("better_than_chance"),
        (F.abs(ranks - F.lit(auc)) < 1e-6).alias("equals_area_by_ranks"),
    )


@query
def report_risk_summary_checks(spark: SparkSession, folder: str) -> DataFrame:
    """One row: the report's counts add up and each average lies in its level."""
    report = reports.risk_summary(_risk_store(Entities(spark, folder))["predictions"])
    pct = F.col("avg_risk_pct")
    fits = (
        F.when(F.col("risk_level") == "High", pct >= 70)
        .when(F.col("risk_level") == "Medium", pct.between(40, 70))
        .otherwise((F.col("risk_level") == "Low") & (pct <= 40))
    )
    return report.agg(
        F.sum("control_count").alias("control_count"),
        (F.count(F.lit(1)) == F.count_distinct("risk_level")).alias("levels_are_distinct"),
        F.every(fits).alias("averages_fit_levels"),
    )


@query
def report_high_risk_checks(spark: SparkSession, folder: str) -> DataFrame:
    """One row: the report lists the riskiest High predictions of known systems."""
    e = Entities(spark, folder)
    predictions = _risk_store(e)["predictions"]
    report = materialise(reports.high_risk_controls(predictions, e.systems), "high-risk")
    high = predictions.where("risk_level = 'High'").join(
        e.systems.select("system_id"), "system_id", "left_semi"
    )
    number = high.agg(F.count(F.lit(1))).scalar()
    top = high.orderBy(F.desc("risk_score")).limit(reports.HIGH_RISK_ROWS)
    least = top.agg(F.min(F.round(F.col("risk_score") * 100, 1))).scalar()
    return report.agg(
        (F.count(F.lit(1)) == F.least(number, F.lit(reports.HIGH_RISK_ROWS))).alias("full_list"),
        F.coalesce(F.every(F.col("risk_level") == "High"), F.lit(True)).alias("only_high"),
        F.coalesce(F.abs(F.min("risk_pct") - least) < 0.11, F.lit(True)).alias("riskiest_first"),
    )


# --- data profiles ----------------------------------------------------------


@query
def applicable_controls(spark: SparkSession, folder: str) -> DataFrame:
    e = Entities(spark, folder)
    return profiles.applicable_controls(e.controls, e.systems)


@query
def baseline_controls(spark: SparkSession, folder: str) -> DataFrame:
    return profiles.required_baselines(Entities(spark, folder).controls)


@query
def status_distribution(spark: SparkSession, folder: str) -> DataFrame:
    return profiles.status_distribution(Entities(spark, folder).assessments)


@query
def overall_compliance(spark: SparkSession, folder: str) -> DataFrame:
    return profiles.overall_compliance(Entities(spark, folder).assessments)


@query
def gap_overdue_counts(spark: SparkSession, folder: str) -> DataFrame:
    return profiles.gap_overdue_counts(Entities(spark, folder).assessments, AS_OF)


@query
def evidence_status_distribution(spark: SparkSession, folder: str) -> DataFrame:
    return profiles.evidence_status_distribution(Entities(spark, folder).evidence)


@query
def top_evidence_types(spark: SparkSession, folder: str) -> DataFrame:
    return profiles.top_evidence_types(Entities(spark, folder).evidence)


@query
def evidence_coverage(spark: SparkSession, folder: str) -> DataFrame:
    return profiles.evidence_coverage(Entities(spark, folder).evidence)


@query
def scope_counts(spark: SparkSession, folder: str) -> DataFrame:
    return profiles.scope_counts(Entities(spark, folder).systems)


# --- streaming --------------------------------------------------------------


@query
def stream_csv_ingest(spark: SparkSession, folder: str) -> DataFrame:
    """Two deliveries, one ingestion run after each, one run with nothing new."""
    root = new_scratch_dir(spark, "stream-csv")
    source = f"{root}/landing"
    for part in landing.deliveries(Entities(spark, folder).bronze("assessments"), "assessment_id"):
        landing.land_csv(part, source)
        ingest.ingest_csv(spark, source, root, "assessments")
    ingest.ingest_csv(spark, source, root, "assessments")
    return ingest.without_audit(ingest.bronze_table(spark, root, "assessments"))


@query
def stream_json_ingest(spark: SparkSession, folder: str) -> DataFrame:
    root = new_scratch_dir(spark, "stream-json")
    source = f"{root}/landing"
    for part in landing.deliveries(Entities(spark, folder).bronze("evidence"), "evidence_id"):
        landing.land_json(part, source)
        ingest.ingest_json(spark, source, root, "evidence", schemas.EVIDENCE_SCHEMA)
    ingest.ingest_json(spark, source, root, "evidence", schemas.EVIDENCE_SCHEMA)
    return ingest.without_audit(ingest.bronze_table(spark, root, "evidence"))


def _streamed_silver(spark: SparkSession, folder: str, entity: str, row_id: str) -> DataFrame:
    """Bronze table grows twice; silver follows incrementally."""
    root = new_scratch_dir(spark, f"stream-{entity}")
    for part in landing.deliveries(Entities(spark, folder).bronze(entity), row_id):
        part.write.mode("append").parquet(f"{root}/bronze/{entity}")
        refine.refine(spark, root, entity)
    return refine.silver_table(spark, root, entity, AS_OF)


@query
def stream_bronze_to_silver(spark: SparkSession, folder: str) -> DataFrame:
    return _streamed_silver(spark, folder, "assessments", "assessment_id")


@query
def stream_silver_systems(spark: SparkSession, folder: str) -> DataFrame:
    return _streamed_silver(spark, folder, "systems", "system_id")


@query
def stream_silver_evidence(spark: SparkSession, folder: str) -> DataFrame:
    return _streamed_silver(spark, folder, "evidence", "evidence_id")


# Places of the tables of an incremental run, by the tables' files.
_published: dict[tuple, dict[str, str]] = {}


def _incremental_run(spark: SparkSession, folder: str) -> dict[str, str]:
    key = _identity(spark, folder)
    if key not in _published:
        with shuffles_removed(spark), bounded_tasks(spark):
            _published[key] = _run_incremental(spark, folder)
    return _published[key]


def _published_table(spark: SparkSession, folder: str, layer: str, table: str) -> DataFrame:
    return spark.read.parquet(_incremental_run(spark, folder)[f"{layer}.{table}"])


def _run_incremental(spark: SparkSession, folder: str) -> dict[str, str]:
    """Files land twice, flow through bronze and silver and into the rollups'
    states, from which the business tables are stored. Returns the tables'
    folders and the store; the catalogue entries go."""
    root = new_scratch_dir(spark, "stream-all")
    e = Entities(spark, folder)
    paths = {name: f"{root}/landing/{name}" for name in BRONZE}
    for name in incremental.CATALOGUES:
        landing.land_csv(e.bronze(name), paths[name])
    ids = {"systems": "system_id", "assessments": "assessment_id", "evidence": "evidence_id"}
    parts = {name: landing.deliveries(e.bronze(name), key) for name, key in ids.items()}
    for i in range(2):
        for name in ids:
            if name == "evidence":
                landing.land_json(parts[name][i], paths[name], level=landing.FAST)
            else:
                landing.land_csv(parts[name][i], paths[name])
        # Once bronze has its rows, their text need not lie beside all that follows.
        incremental.advance(
            spark, paths, root, taken=lambda name: landing.empty(spark, paths[name])
        )
        live.update(spark, root)
    run = root.rsplit("-", 1)[1]
    databases = {layer: f"veritrail_{layer}_{run}" for layer in ("bronze", "silver", "gold")}
    layers = medallion.Layers(**databases, location=f"{root}/lake")
    incremental.refresh(spark, paths, root, AS_OF, layers)
    places = {"store": root}
    for layer, database in databases.items():
        for table in spark.catalog.listTables(database):
            detail = spark.sql(f"DESCRIBE EXTENDED {database}.{table.name}").collect()
            places[f"{layer}.{table.name}"] = next(r[1] for r in detail if r[0] == "Location")
        spark.sql(f"DROP DATABASE {database} CASCADE")
    return places


@query
def stream_end_to_end(spark: SparkSession, folder: str) -> DataFrame:
    return _published_table(spark, folder, "gold", "system_compliance_scorecard")


def _stored_gold(table: str) -> Query:
    return lambda spark, folder: _published_table(spark, folder, "gold", table)


for _name in (
    "control_compliance_summary",
    "cross_framework_mapping",
    "evidence_gap_analysis",
    "missing_evidence_by_system",
    "missing_evidence_by_control",
    "audit_readiness_metrics",
):
    QUERIES[f"stream_{_name}"] = _stored_gold(_name)


@query
def stream_silver_controls(spark: SparkSession, folder: str) -> DataFrame:
    stored = _published_table(spark, folder, "silver", "controls")
    return ingest.without_audit(stored)


@query
def live_updates(spark: SparkSession, folder: str) -> DataFrame:
    """What the rollups' states took in: a row per entity with the batches that
    changed them, the rows these held, and the rows counted in the states after
    every batch of silver came a second time."""
    store = _incremental_run(spark, folder)["store"]
    out = []
    for entity in live.ENTITIES:
        state = live.LiveState(spark, store, entity)
        silver = BatchTable(spark, f"{store}/silver/{entity}")
        for (batch,) in state.commits().select("batch").collect():
            state.apply(silver.read(), batch)
        held = state.parts(next(iter(state.states))).agg(F.sum("n")).scalar()
        out.append(
            state.commits().agg(
                F.lit(entity).alias("entity"),
                F.count(F.lit(1)).alias("updates"),
                F.sum("rows").alias("rows_taken"),
                F.min(F.col("rows") > 0).alias("every_update_has_rows"),
            ).withColumn("rows_in_state", held)
        )
    return out[0].unionByName(out[1])


@query
def stream_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Rows and failed expectations per table, from the manifests alone."""
    store = _incremental_run(spark, folder)["store"]
    out = []
    for layer in ("bronze", "silver"):
        for entity in incremental.STREAMED:
            records = BatchTable(spark, f"{store}/{layer}/{entity}").records()
            failed = F.aggregate(F.map_values("measures"), F.lit(0).cast("long"), lambda a, n: a + n)
            out.append(
                records.agg(
                    F.lit(f"{layer}.{entity}").alias("table_name"),
                    F.count_distinct("run").alias("runs"),
                    F.sum("rows").alias("row_count"),
                    F.sum(failed).alias("failures"),
                )
            )
    return reduce(DataFrame.unionByName, out)


@query
def stream_evolving_csv(spark: SparkSession, folder: str) -> DataFrame:
    """Three deliveries by assessor, each with a header of its own: as the first
    file, with columns in reverse, and with one column new and one missing."""
    root = new_scratch_dir(spark, "stream-evolving")
    source = f"{root}/landing"
    rows = Entities(spark, folder).bronze("assessments")
    turn = F.substring_index("assessor", "-", -1).cast("int")
    late = rows.where(turn >= 5).drop("findings").withColumn("round", turn.cast("string"))
    for part in (rows.where(turn <= 2), rows.where(turn.between(3, 4)).select(*rows.columns[::-1]), late):
        landing.land_csv(part, source)
        ingest.ingest_evolving_csv(spark, source, root, "assessments")
    table = ingest.bronze_table(spark, root, "assessments")
    return table.select(*rows.columns, F.to_json("_rescued").alias("rescued"))


#: Expectations on evidence that some rows of the given tables fail.
STRICT = {
    "accepted": "status = 'Accepted'",
    "reviewed": "review_timestamp IS NOT NULL",
    "not_expired": "NOT is_expired",
    "known_type": "evidence_type IN ('Screenshot', 'Audit Log', 'Policy Document')",
}


def _marked_evidence(spark: SparkSession, folder: str) -> DataFrame:
    rows = quality.with_failure_bits(Entities(spark, folder).evidence, "evidence", STRICT)
    return materialise(rows.select("evidence_id", "control_id", quality.BITS), "marked")


@query
def dq_bit_report(spark: SparkSession, folder: str) -> DataFrame:
    return quality.bit_report(_marked_evidence(spark, folder), "evidence", STRICT)


@query
def dq_failing_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Evidence that fails one of two expectations, by a test of its bits."""
    rows = _marked_evidence(spark, folder)
    found = quality.failing(rows, "evidence", "reviewed", "known_type", expectations=STRICT)
    return found.select("evidence_id", "control_id", F.col(quality.BITS).alias("failed_bits"))
