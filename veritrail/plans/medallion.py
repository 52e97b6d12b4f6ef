"""Batch run: landing files -> bronze -> silver -> gold -> alerts -> risk.

Each table is written once and read back by the next step, so every stage
starts from stored columns (pruned scans, pushed-down filters) and a lost
executor costs at most the current stage.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from veritrail.operators import gold, quality, risk, rollups, rules
from veritrail.operators import silver as s
from veritrail.sources import schemas
from veritrail.sources.audit import with_audit
from veritrail.sources.readers import read_csv, read_jsonl, read_table
from veritrail.sources.scratch import materialise
from veritrail.sources.sinks import write_table

# Tags of the two framework catalogues.
SOURCE_TAGS = {"controls": "control-catalogue", "criteria": "criteria-catalogue"}
LANDED_CSV = ("controls", "criteria", "control_mapping", "systems", "assessments")
BRONZE_PROPERTIES = {
    "controls": {"origin": "control catalogue"},
    "criteria": {"origin": "criteria catalogue"},
    "control_mapping": {"origin": "crosswalk"},
    "systems": {"origin": "system inventory"},
    "assessments": {"origin": "assessment export"},
    "evidence": {"origin": "evidence uploads"},
}
COMMENTS = {
    "controls": "Security control catalogue",
    "criteria": "Trust service criteria",
    "control_mapping": "Crosswalk from controls to trust criteria",
    "systems": "System inventory with owners and scope",
    "assessments": "Control assessment results",
    "evidence": "Evidence uploads with their validity period",
    "evidence_pairs": "Evidence rolled up per control and system",
    "control_compliance_summary": "Compliance posture by control family",
    "system_compliance_scorecard": "Compliance posture by system",
    "cross_framework_mapping": "Controls with mapped criteria and compliance",
    "evidence_gap_analysis": "Missing and expiring evidence",
    "missing_evidence_by_system": "Expected evidence that each system lacks",
    "missing_evidence_by_control": "Expected evidence that each control lacks",
    "audit_readiness_metrics": "Audit readiness in one row",
    "compliance_rules": "Compliance rules and their SQL checks",
    "compliance_alerts": "Findings of the active rules",
    "control_risk_predictions": "Predicted risk per assessment",
}


@dataclass(frozen=True)
class Layers:
    """Database names of the layers; ``location`` is an optional shared folder.
    There the tables lie beside the databases, so they outlive these."""

    bronze: str = "veritrail_bronze"
    silver: str = "veritrail_silver"
    gold: str = "veritrail_gold"
    location: str | None = None

    def create(self, spark: SparkSession) -> None:
        for name in (self.bronze, self.silver, self.gold):
            place = f" LOCATION '{self.location}/{name}'" if self.location else ""
            spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{place}")

    def path(self, database: str, table: str) -> str | None:
        return f"{self.location}/tables/{database}/{table}" if self.location else None


def load_bronze(
    spark: SparkSession, landing: Mapping[str, str], layers: Layers
) -> dict[str, dict]:
    """Read the landing files of the six entities into bronze tables.

    All columns stay text and silver parses them. Inference would read every
    file once more and give ids like ``0012`` another form in each file.
    """
    frames = {name: read_csv(spark, landing[name], infer=False) for name in LANDED_CSV}
    frames["evidence"] = read_jsonl(spark, landing["evidence"], schema=schemas.EVIDENCE_SCHEMA)
    return {
        name: write_table(
            with_audit(df, source=SOURCE_TAGS.get(name)),
            f"{layers.bronze}.{name}",
            path=layers.path(layers.bronze, name),
            comment=COMMENTS[name],
            properties={"quality": "bronze", **BRONZE_PROPERTIES[name]},
        )
        for name, df in frames.items()
    }


def store_silver(frames: Mapping[str, DataFrame], layers: Layers) -> dict[str, dict]:
    """Store cleaned entities; expectation failures are observed on the write."""
    return {
        name: write_table(
            df,
            f"{layers.silver}.{name}",
            path=layers.path(layers.silver, name),
            comment=COMMENTS[name],
            properties={"quality": "silver"},
            metrics=quality.write_metrics(name),
        )
        for name, df in frames.items()
    }


def build_silver(spark: SparkSession, layers: Layers, as_of: dt.date) -> dict[str, dict]:
    """Clean every bronze table."""

    def bronze(name: str) -> DataFrame:
        return read_table(spark, f"{layers.bronze}.{name}")

    frames = {
        "controls": s.silver_controls(bronze("controls")),
        "criteria": s.silver_criteria(bronze("criteria")),
        "systems": s.silver_systems(bronze("systems"), as_of),
        "assessments": s.silver_assessments(bronze("assessments"), as_of),
        "evidence": s.silver_evidence(bronze("evidence"), as_of),
    }
    return store_silver(frames, layers)


def write_gold(df: DataFrame, layers: Layers, name: str) -> dict[str, object]:
    return write_table(
        df,
        f"{layers.gold}.{name}",
        path=layers.path(layers.gold, name),
        comment=COMMENTS[name],
        properties={"quality": "gold"},
    )


def build_gold(
    spark: SparkSession, layers: Layers, as_of: dt.date, *, expected: bool = False
) -> dict[str, dict]:
    """The business tables. The (control, system) evidence rollup is stored
    first: gaps, scorecard and risk features all start from it.

    The gap table covers the pairs that have evidence; with ``expected`` those
    of them that are expected, and two more tables count what is missing.
    """
    controls, criteria, systems, assessments, evidence = (
        read_table(spark, f"{layers.silver}.{name}")
        for name in ("controls", "criteria", "systems", "assessments", "evidence")
    )
    mapping = read_table(spark, f"{layers.bronze}.control_mapping")
    written = {}

    def store(name: str, df: DataFrame) -> DataFrame:
        written[name] = write_gold(df, layers, name)
        return read_table(spark, f"{layers.gold}.{name}")

    pairs = store("evidence_pairs", rollups.evidence_pairs(evidence))
    store("control_compliance_summary", gold.compliance_summary(assessments, as_of))
    store(
        "system_compliance_scorecard",
        gold.system_scorecard(
            systems,
            rollups.system_assessment_rollup(assessments),
            rollups.system_evidence_from_pairs(pairs),
            as_of,
        ),
    )
    store(
        "cross_framework_mapping",
        gold.cross_framework(
            controls, mapping, criteria, rollups.control_rollup(assessments), as_of
        ),
    )
    rollup = rollups.evidence_rollup(pairs)
    if expected:
        gaps = gold.evidence_gap_matrix(controls, systems, rollup, as_of)
        store("missing_evidence_by_system", gold.missing_by_system(controls, systems, rollup))
        store("missing_evidence_by_control", gold.missing_by_control(controls, systems, rollup))
    else:
        gaps = gold.evidence_gap_observed(rollup, as_of)
    store("evidence_gap_analysis", gaps)
    store("audit_readiness_metrics", gold.audit_readiness(assessments, evidence, systems, as_of))
    return written


def build_alerts(
    spark: SparkSession, layers: Layers, as_of: dt.date, book: rules.RuleBook | None = None
) -> dict[str, dict]:
    """Store the rules, apply the active ones, store the alerts."""
    table = f"{layers.silver}.compliance_rules"
    stored = write_table(
        (book or rules.standard_rules()).to_frame(spark),
        table,
        path=layers.path(layers.silver, "compliance_rules"),
        comment=COMMENTS["compliance_rules"],
    )
    active = rules.RuleBook.from_frame(read_table(spark, table))
    alerts = rules.all_alerts(
        read_table(spark, f"{layers.silver}.evidence"),
        read_table(spark, f"{layers.silver}.assessments"),
        read_table(spark, f"{layers.gold}.system_compliance_scorecard"),
        read_table(spark, f"{layers.gold}.evidence_gap_analysis"),
        active,
        as_of,
    )
    return {
        "compliance_rules": stored,
        "compliance_alerts": write_gold(alerts, layers, "compliance_alerts"),
    }


def build_risk(spark: SparkSession, layers: Layers, as_of: dt.date) -> dict[str, dict]:
    """Train on four fifths of the assessments and score all of them."""
    features = materialise(
        risk.risk_features(
            read_table(spark, f"{layers.silver}.assessments"),
            read_table(spark, f"{layers.silver}.systems"),
            read_table(spark, f"{layers.gold}.evidence_pairs"),
        ),
        "risk-features",
    )
    train_rows, test_rows = risk.train_test(features)
    model = risk.train(train_rows)
    auc = risk.area_under_roc(model, test_rows)
    name = "control_risk_predictions"
    written = write_gold(risk.score(model, features, as_of), layers, name)
    return {name: {**written, "auc": auc}}


def run_batch(
    spark: SparkSession,
    landing: Mapping[str, str],
    as_of: dt.date,
    layers: Layers | None = None,
) -> dict[str, dict]:
    """All steps in order. Returns the observed metrics per written table,
    keyed ``layer.table``."""
    layers = layers or Layers()
    layers.create(spark)
    steps = (
        ("bronze", load_bronze(spark, landing, layers)),
        ("silver", build_silver(spark, layers, as_of)),
        ("gold", build_gold(spark, layers, as_of)),
        ("alerts", build_alerts(spark, layers, as_of)),
        ("risk", build_risk(spark, layers, as_of)),
    )
    return {f"{step}.{table}": seen for step, tables in steps for table, seen in tables.items()}
