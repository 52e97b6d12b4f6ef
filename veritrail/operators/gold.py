"""Business tables: summary, scorecard, crosswalk, evidence gaps, readiness."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veritrail import vocabulary as v
from veritrail.functions import grading as g
from veritrail.operators import rollups
from veritrail.sources.scratch import materialise


def stamped(df: DataFrame, as_of: dt.date) -> DataFrame:
    return df.withColumn("snapshot_date", F.lit(as_of))


def compliance_summary(assessments: DataFrame, as_of: dt.date) -> DataFrame:
    return family_summary(rollups.family_rollup(assessments), as_of)


def family_summary(family_rollup: DataFrame, as_of: dt.date) -> DataFrame:
    assessable = F.col("total_assessments") - F.col("not_applicable_count")
    summary = family_rollup.withColumns(
        {
            "assessable_controls": assessable,
            "compliance_percentage": g.weighted_percent(
                F.col("implemented_count"), F.col("partial_count"), assessable
            ),
        }
    )
    return stamped(summary, as_of)


SCORECARD_SYSTEM_COLUMNS = (
    "system_id",
    "system_name",
    "business_unit",
    "criticality",
    "data_classification",
    "certification_scope",
    "in_soc2_scope",
    "in_iso_scope",
)


def system_scorecard(
    systems: DataFrame,
    assessment_rollup: DataFrame,
    evidence_rollup: DataFrame,
    as_of: dt.date,
) -> DataFrame:
    """Every system with its assessment and evidence measures.

    The percentage is the rounded average score with 0 for a system that has
    none, so an unassessed system is Non-Compliant. Both rollups leave their
    aggregation partitioned by system, so only the system table moves.
    """

    def measure(name: str):
        return g.zero_if_null(F.col(name)).alias(name)

    card = (
        systems.join(assessment_rollup.drop("last_assessment_date"), "system_id", "left")
        .join(evidence_rollup, "system_id", "left")
        .select(
            *SCORECARD_SYSTEM_COLUMNS,
            measure("total_controls_assessed"),
            measure("implemented_count"),
            measure("partial_count"),
            measure("not_implemented_count"),
            measure("overdue_remediation_count"),
            g.one_decimal(g.zero_if_null(F.col("avg_compliance_score"))).alias(
                "compliance_percentage"
            ),
            measure("controls_with_evidence"),
            measure("total_evidence_count"),
            "days_since_assessment",
            "assessment_overdue",
        )
    )
    graded = card.withColumn(
        "compliance_status", g.compliance_grade(F.col("compliance_percentage"))
    )
    return stamped(graded, as_of)


def cross_framework(
    controls: DataFrame,
    mapping: DataFrame,
    criteria: DataFrame,
    control_rollup: DataFrame,
    as_of: dt.date,
) -> DataFrame:
    """Controls left-joined to their mapped criteria, measures repeated per mapping.

    One control or criterion may own a large share of the mappings. The measures
    are stored first: then both sides of the joins come straight from a shuffle,
    and Spark splits a hot key's rows by their size. Controls without any
    mapping are added from an anti join.
    """
    measured = controls.join(control_rollup, "control_id", "left").select(
        F.col("control_id").alias("nist_control_id"),
        F.col("control_name").alias("nist_control_name"),
        F.col("control_family").alias("nist_family"),
        F.col("control_family_code").alias("nist_family_code"),
        *(f"baseline_{b}" for b in v.BASELINES),
        g.zero_if_null(F.col("systems_assessed")).alias("systems_in_scope"),
        g.one_decimal(g.zero_if_null(F.col("avg_compliance_pct"))).alias("avg_compliance_pct"),
        g.zero_if_null(F.col("total_assessments")).alias("total_assessments"),
    )
    measured = materialise(measured, "control-measures")
    links = mapping.select(
        F.col("source_control_id").alias("nist_control_id"),
        F.col("target_control_id").alias("soc2_tsc_id"),
        "mapping_type",
    )
    targets = criteria.select(
        F.col("tsc_id").alias("soc2_tsc_id"),
        F.col("tsc_name").alias("soc2_tsc_name"),
        F.col("tsc_category").alias("soc2_category"),
    )
    mapped = links.join(targets, "soc2_tsc_id", "left").join(measured, "nist_control_id")
    sources = links.select("nist_control_id").distinct()
    unmapped = measured.join(sources, "nist_control_id", "left_anti")
    rows = mapped.unionByName(unmapped, allowMissingColumns=True)
    return stamped(
        rows.select(
            "nist_control_id",
            "nist_control_name",
            "nist_family",
            "nist_family_code",
            *(f"baseline_{b}" for b in v.BASELINES),
            "soc2_tsc_id",
            "soc2_tsc_name",
            "soc2_category",
            "mapping_type",
            "systems_in_scope",
            "avg_compliance_pct",
            "total_assessments",
            F.when(F.col("soc2_tsc_id").isNotNull(), v.MAPPED)
            .otherwise(v.UNMAPPED)
            .alias("mapping_coverage"),
        ),
        as_of,
    )


def _with_gap_columns(df: DataFrame, as_of: dt.date) -> DataFrame:
    current, days = F.col("current_evidence_count"), F.col("days_until_expiry")
    graded = df.withColumns(
        {
            "has_current_evidence": g.zero_if_null(current) > 0,
            "gap_severity": g.gap_severity(current, days),
            "evidence_status": g.evidence_status(current, days),
        }
    )
    return stamped(graded, as_of)


def evidence_gap_observed(evidence_rollup: DataFrame, as_of: dt.date) -> DataFrame:
    """Gaps among the (control, system) pairs that have any evidence."""
    return _with_gap_columns(evidence_rollup, as_of)


def required(controls: DataFrame) -> DataFrame:
    return controls.where(F.col(f"baseline_{v.EXPECTED_EVIDENCE_BASELINE}")).select(
        "control_id", "control_name", "control_family"
    )


def covered(systems: DataFrame) -> DataFrame:
    return rollups.in_scope(systems).select("system_id", "system_name")


def expected_evidence(controls: DataFrame, systems: DataFrame) -> DataFrame:
    """Who owes evidence for what: every required control for every covered
    system. The two lists say it in controls + systems rows; a pair is expected
    if both of its sides are listed."""
    owed = required(controls).select(
        F.lit("control").alias("side"),
        F.col("control_id").alias("entity_id"),
        F.col("control_name").alias("entity_name"),
        F.col("control_family").alias("control_family"),
    )
    owing = covered(systems).select(
        F.lit("system").alias("side"),
        F.col("system_id").alias("entity_id"),
        F.col("system_name").alias("entity_name"),
        F.lit(None).cast("string").alias("control_family"),
    )
    return owed.unionByName(owing)


def expected_pairs(
    controls: DataFrame, systems: DataFrame, system_ids: Sequence[str]
) -> DataFrame:
    """The expected pairs of the systems named, one row each."""
    named = required(controls).withColumn(
        "system_id", F.explode(F.lit(list(system_ids)).cast("array<string>"))
    )
    return named.join(covered(systems), "system_id").select(
        "control_id", "system_id", "control_name", "control_family", "system_name"
    )


def evidence_gap_matrix(
    controls: DataFrame, systems: DataFrame, evidence_rollup: DataFrame, as_of: dt.date
) -> DataFrame:
    """Gaps of the expected pairs that have any evidence. An expected pair
    without a row here has none, so it is Missing and Critical; how many these
    are, :func:`missing_by_system` and :func:`missing_by_control` say."""
    held = (
        evidence_rollup.join(required(controls), "control_id")
        .join(covered(systems), "system_id")
        .select(
            "control_id",
            "system_id",
            "control_name",
            "control_family",
            "system_name",
            "total_evidence_count",
            "current_evidence_count",
            "days_until_expiry",
            "last_evidence_date",
        )
    )
    return _with_gap_columns(held, as_of)


def _missing(own: DataFrame, key: str, others: DataFrame, held: DataFrame) -> DataFrame:
    """Per row of ``own``: how many of ``others`` it owes, has, and lacks."""
    counted = held.groupBy(key).agg(F.count(F.lit(1)).alias("pairs_with_evidence"))
    expected = others.agg(F.count(F.lit(1))).scalar()
    return (
        own.join(counted, key, "left")
        .withColumn("expected_pairs", expected)
        .withColumn("pairs_with_evidence", F.coalesce("pairs_with_evidence", F.lit(0)))
        .withColumn("missing_pairs", F.col("expected_pairs") - F.col("pairs_with_evidence"))
        .select(key, "expected_pairs", "pairs_with_evidence", "missing_pairs")
    )


def missing_by_system(
    controls: DataFrame, systems: DataFrame, evidence_rollup: DataFrame
) -> DataFrame:
    owed, owing = required(controls), covered(systems)
    held = evidence_rollup.join(owed, "control_id", "left_semi")
    return _missing(owing, "system_id", owed, held)


def missing_by_control(
    controls: DataFrame, systems: DataFrame, evidence_rollup: DataFrame
) -> DataFrame:
    owed, owing = required(controls), covered(systems)
    held = evidence_rollup.join(owing, "system_id", "left_semi")
    return _missing(owed, "control_id", owing, held)


def audit_readiness(
    assessments: DataFrame, evidence: DataFrame, systems: DataFrame, as_of: dt.date
) -> DataFrame:
    """One row of readiness metrics."""
    return readiness(
        rollups.assessment_totals(assessments),
        rollups.evidence_totals(evidence),
        rollups.scope_totals(systems),
        as_of,
    )


def readiness(
    assessment_totals: DataFrame,
    evidence_totals: DataFrame,
    scope_totals: DataFrame,
    as_of: dt.date,
) -> DataFrame:
    """Readiness from the three one-row totals."""
    totals = side_by_side(assessment_totals, evidence_totals, scope_totals)
    return stamped(readiness_scores(totals), as_of)


def side_by_side(
    assessment_totals: DataFrame, evidence_totals: DataFrame, scope_totals: DataFrame
) -> DataFrame:
    """The three one-row totals in one row, as scalar subqueries, which Spark
    runs concurrently."""
    evidence_row = evidence_totals.select(F.struct("*")).scalar()
    scope_row = scope_totals.select(F.struct("*")).scalar()
    totals = assessment_totals.select(
        "*", evidence_row.alias("_evidence"), scope_row.alias("_scope")
    )
    return totals.select(
        "total_assessments",
        "unique_controls_assessed",
        "systems_assessed",
        g.one_decimal(F.col("overall_compliance_pct")).alias("overall_compliance_pct"),
        "implemented_count",
        "partial_count",
        "gap_count",
        "overdue_remediation_count",
        "_evidence.*",
        "_scope.*",
    )


def readiness_scores(totals: DataFrame) -> DataFrame:
    """Coverage, score and status; they build on the rounded percentages."""
    flat = totals.withColumn(
        "evidence_coverage_pct",
        g.percent(F.col("controls_with_current_evidence"), F.col("unique_controls_assessed")),
    )
    weight = v.READINESS_WEIGHTS
    late = F.try_divide(F.col("overdue_remediation_count"), F.col("total_assessments"))
    score = g.one_decimal(
        F.col("overall_compliance_pct") * weight["compliance"]
        + F.col("evidence_coverage_pct") * weight["coverage"]
        + (1 - late) * 100 * weight["on_time"]
    )
    scored = flat.withColumn("audit_readiness_score", score)
    return scored.withColumn(
        "readiness_status", g.readiness_grade(F.col("audit_readiness_score"))
    )


def gap_severity_histogram_matrix(
    controls: DataFrame, systems: DataFrame, evidence_rollup: DataFrame
) -> DataFrame:
    """Severity histogram of the expected matrix without building the matrix.

    Pairs that have evidence are graded one by one; all other expected pairs
    are Critical, and their number is controls x systems minus those.
    """
    required = controls.where(F.col(f"baseline_{v.EXPECTED_EVIDENCE_BASELINE}")).select(
        "control_id"
    )
    covered = rollups.in_scope(systems).select("system_id")
    graded = (
        evidence_rollup.join(required, "control_id")
        .join(covered, "system_id")
        .groupBy(
            g.gap_severity(F.col("current_evidence_count"), F.col("days_until_expiry")).alias(
                "gap_severity"
            )
        )
        .agg(F.count(F.lit(1)).alias("pairs"))
    )
    system_count = covered.agg(F.count(F.lit(1))).scalar()
    graded_count = graded.agg(F.coalesce(F.sum("pairs"), F.lit(0))).scalar()
    ungraded = required.agg(F.count(F.lit(1)).alias("controls")).select(
        F.lit("Critical").alias("gap_severity"),
        (F.col("controls") * system_count - graded_count).alias("pairs"),
    )
    return (
        graded.unionByName(ungraded)
        .groupBy("gap_severity")
        .agg(F.sum("pairs").alias("count"))
        .where(F.col("count") > 0)
    )
