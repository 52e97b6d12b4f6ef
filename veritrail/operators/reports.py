"""Report queries over the gold tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veritrail.functions import grading as g

# Column titles of the executive report.
EXECUTIVE_TITLES = {
    "overall_compliance_pct": "Overall Compliance %",
    "audit_readiness_score": "Audit Readiness Score",
    "readiness_status": "Status",
    "systems_in_scope": "Systems in Scope",
    "unique_controls_assessed": "Controls Assessed",
    "overdue_remediation_count": "Overdue Items",
    "evidence_coverage_pct": "Evidence Coverage %",
}
SEVERITY_ORDER = {"HIGH": 1, "MEDIUM": 2}
RISK_ORDER = {"High": 1, "Medium": 2}
ORDER_OTHERWISE = 3
HIGH_RISK_ROWS = 20
PREVIEW_ROWS = 20


def executive_summary(readiness: DataFrame) -> DataFrame:
    return readiness.select(*(F.col(c).alias(title) for c, title in EXECUTIVE_TITLES.items()))


def alert_summary(alerts: DataFrame) -> DataFrame:
    counts = alerts.groupBy("rule_name", "rule_result", "severity").agg(
        F.count(F.lit(1)).alias("alert_count")
    )
    return counts.orderBy(
        g.lookup(F.col("severity"), SEVERITY_ORDER, ORDER_OTHERWISE),
        F.desc("alert_count"),
        "rule_name",
        "rule_result",
    )


def risk_summary(predictions: DataFrame) -> DataFrame:
    return (
        predictions.groupBy("risk_level")
        .agg(
            F.count(F.lit(1)).alias("control_count"),
            g.one_decimal(F.avg("risk_score") * 100).alias("avg_risk_pct"),
        )
        .orderBy(g.lookup(F.col("risk_level"), RISK_ORDER, ORDER_OTHERWISE))
    )


def high_risk_controls(
    predictions: DataFrame, systems: DataFrame, rows: int = HIGH_RISK_ROWS
) -> DataFrame:
    """The riskiest High predictions; ids break ties so the list is stable."""
    return (
        predictions.where(F.col("risk_level") == "High")
        .join(systems.select("system_id", "system_name"), "system_id")
        .orderBy(F.desc("risk_score"), "control_id", "system_id", "assessment_id")
        .limit(rows)
        .select(
            "control_id",
            "system_id",
            "system_name",
            "control_family_code",
            g.one_decimal(F.col("risk_score") * 100).alias("risk_pct"),
            "risk_level",
        )
    )


def scorecard_worst_first(scorecard: DataFrame) -> DataFrame:
    return scorecard.orderBy("compliance_percentage", "system_id")


def gap_severity_histogram(gaps: DataFrame) -> DataFrame:
    return gaps.groupBy("gap_severity").agg(F.count(F.lit(1)).alias("count"))


def preview(df: DataFrame, *order: str, rows: int = PREVIEW_ROWS) -> DataFrame:
    return df.orderBy(*order).limit(rows)
