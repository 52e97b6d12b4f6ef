"""Grouped and global aggregates.

All of them combine on the map side first, so a key that holds a large share
of the rows reaches the shuffle as one partial row per task. The distinct
counts are exact; Spark shuffles them by (key, value), which also splits a
popular key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veritrail import vocabulary as v
from veritrail.functions import grading as g

STATUS_COUNTS = {
    "implemented_count": v.IMPLEMENTED,
    "partial_count": v.PARTIALLY_IMPLEMENTED,
    "not_implemented_count": v.NOT_IMPLEMENTED,
    "not_applicable_count": v.NOT_APPLICABLE,
}


def tally(condition: Column) -> Column:
    """Rows where ``condition`` is true; NULL over no rows at all."""
    return F.sum(F.coalesce(condition, F.lit(False)).cast("int"))


def status_tallies(*names: str) -> list[Column]:
    status = F.col("implementation_status")
    return [tally(status == STATUS_COUNTS[name]).alias(name) for name in names]


def family_rollup(assessments: DataFrame) -> DataFrame:
    return assessments.groupBy("control_family_code").agg(
        F.count(F.lit(1)).alias("total_assessments"),
        *status_tallies(*STATUS_COUNTS),
        tally(F.col("is_overdue")).alias("overdue_count"),
        F.avg("compliance_score").alias("avg_compliance_score"),
    )


def system_assessment_rollup(assessments: DataFrame) -> DataFrame:
    return assessments.groupBy("system_id").agg(
        F.count(F.lit(1)).alias("total_controls_assessed"),
        *status_tallies("implemented_count", "partial_count", "not_implemented_count"),
        tally(F.col("is_overdue")).alias("overdue_remediation_count"),
        F.avg("compliance_score").alias("avg_compliance_score"),
        F.max("assessment_date").alias("last_assessment_date"),
    )


def accepted_and_current() -> Column:
    return (F.col("status") == v.ACCEPTED) & F.col("is_current")


def system_evidence_rollup(evidence: DataFrame) -> DataFrame:
    return (
        evidence.where(accepted_and_current())
        .groupBy("system_id")
        .agg(
            F.countDistinct("control_id").alias("controls_with_evidence"),
            F.count(F.lit(1)).alias("total_evidence_count"),
        )
    )


def system_evidence_from_pairs(pairs: DataFrame) -> DataFrame:
    """Same result as :func:`system_evidence_rollup`, from the pair rollup."""
    return (
        pairs.where(F.col("current_evidence_count") > 0)
        .groupBy("system_id")
        .agg(
            F.count("control_id").alias("controls_with_evidence"),
            F.sum("current_evidence_count").alias("total_evidence_count"),
        )
    )


def control_rollup(assessments: DataFrame) -> DataFrame:
    return assessments.groupBy("control_id").agg(
        F.avg("compliance_score").alias("avg_compliance_pct"),
        F.countDistinct("system_id").alias("systems_assessed"),
        F.count(F.lit(1)).alias("total_assessments"),
    )


def evidence_pairs(evidence: DataFrame) -> DataFrame:
    """One pass over evidence per (control, system), feeding gaps, scorecard
    and risk features. ``days_until_expiry`` looks at current rows of any
    status while ``current_evidence_count`` needs Accepted ones."""
    current = F.col("is_current")
    return evidence.groupBy("control_id", "system_id").agg(
        F.count(F.lit(1)).alias("total_evidence_count"),
        tally(accepted_and_current()).alias("current_evidence_count"),
        F.max(F.when(current, F.col("days_until_expiry"))).alias("days_until_expiry"),
        F.max("upload_timestamp").alias("last_evidence_date"),
        tally(F.col("status") == v.ACCEPTED).alias("accepted_evidence_count"),
    )


EVIDENCE_ROLLUP_COLUMNS = (
    "control_id",
    "system_id",
    "total_evidence_count",
    "current_evidence_count",
    "days_until_expiry",
    "last_evidence_date",
)


def evidence_rollup(pairs: DataFrame) -> DataFrame:
    return pairs.select(*EVIDENCE_ROLLUP_COLUMNS)


def assessment_totals(assessments: DataFrame) -> DataFrame:
    """One row over all assessments.

    Measures are first added up per system, which also counts the systems; the
    controls are counted by a scan of their ids alone, as a subquery that runs
    beside it. Neither copies a row, as two distinct counts at once would.
    """
    score = F.col("compliance_score")
    status = F.col("implementation_status")
    by_system = assessments.groupBy("system_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(score.cast("double")).alias("score"),
        F.count(score).alias("scored"),
        *status_tallies("implemented_count", "partial_count"),
        tally(status == v.NOT_IMPLEMENTED).alias("gap_count"),
        tally(F.col("is_overdue")).alias("overdue_remediation_count"),
    )
    controls = assessments.select("control_id").distinct().agg(F.count("control_id")).scalar()
    sums = ("implemented_count", "partial_count", "gap_count", "overdue_remediation_count")
    return by_system.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_assessments"),
        F.count("system_id").alias("systems_assessed"),
        F.try_divide(F.sum("score"), F.sum("scored")).alias("overall_compliance_pct"),
        *(F.sum(c).alias(c) for c in sums),
    ).withColumn("unique_controls_assessed", controls)


def evidence_totals(evidence: DataFrame) -> DataFrame:
    status = F.col("status")
    return evidence.agg(
        F.count(F.lit(1)).alias("total_evidence_items"),
        tally(status == v.ACCEPTED).alias("accepted_evidence"),
        tally(status == v.PENDING_REVIEW).alias("pending_review"),
        tally(F.col("is_expired")).alias("expired_evidence"),
        F.countDistinct(F.when(F.col("is_current"), F.col("control_id"))).alias(
            "controls_with_current_evidence"
        ),
    )


def in_scope(systems: DataFrame) -> DataFrame:
    return systems.where(F.col("in_soc2_scope") | F.col("in_iso_scope"))


def scope_totals(systems: DataFrame) -> DataFrame:
    return in_scope(systems).agg(
        F.count(F.lit(1)).alias("systems_in_scope"),
        tally(F.col("assessment_overdue")).alias("systems_assessment_overdue"),
    )
