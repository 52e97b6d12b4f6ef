"""Questions about the operational data itself."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veritrail import vocabulary as v
from veritrail.functions import grading as g
from veritrail.operators import rollups

TOP_EVIDENCE_TYPES = 5


def required_baselines(controls: DataFrame) -> DataFrame:
    """One row per (control, baseline it belongs to)."""
    tiers = F.array(*(F.when(F.col(f"baseline_{b}"), F.lit(b)) for b in v.BASELINES))
    return controls.select(
        "control_id", F.explode(F.array_compact(tiers)).alias("required_baseline")
    )


def applicable_controls(controls: DataFrame, systems: DataFrame) -> DataFrame:
    """The baseline each in-scope system must meet, by its criticality, and the
    number of its controls; :func:`required_baselines` lists these once."""
    needs = rollups.in_scope(systems).select(
        "system_id",
        "criticality",
        g.lookup(
            F.col("criticality"), v.BASELINE_FOR_CRITICALITY, v.BASELINE_OTHERWISE
        ).alias("required_baseline"),
    )
    sizes = (
        required_baselines(controls)
        .groupBy("required_baseline")
        .agg(F.count(F.lit(1)).alias("applicable_controls"))
    )
    return needs.join(sizes, "required_baseline", "left").select(
        "system_id",
        "criticality",
        "required_baseline",
        F.coalesce("applicable_controls", F.lit(0)).alias("applicable_controls"),
    )


def _distribution(df: DataFrame, column: str, count_name: str) -> DataFrame:
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias(count_name))
    total = counts.agg(F.sum(count_name)).scalar()
    return counts.withColumn("share_pct", g.percent(F.col(count_name), total))


def status_distribution(assessments: DataFrame) -> DataFrame:
    return _distribution(assessments, "implementation_status", "assessment_count")


def evidence_status_distribution(evidence: DataFrame) -> DataFrame:
    return _distribution(evidence, "status", "evidence_count")


def overall_compliance(assessments: DataFrame) -> DataFrame:
    """Percentage over everything but Not Applicable; 0 when nothing is left."""
    status = F.col("implementation_status")
    counts = assessments.agg(
        F.count_if(status == v.IMPLEMENTED).alias("implemented_count"),
        F.count_if(status == v.PARTIALLY_IMPLEMENTED).alias("partial_count"),
        F.count_if(~status.eqNullSafe(v.NOT_APPLICABLE)).alias("assessed_count"),
    )
    pct = g.weighted_percent(
        F.col("implemented_count"), F.col("partial_count"), F.col("assessed_count")
    )
    return counts.withColumn("compliance_pct", F.coalesce(pct, F.lit(0.0)))


def gap_overdue_counts(assessments: DataFrame, as_of: dt.date) -> DataFrame:
    """Rows that describe a gap, and rows past their due date whatever their status."""
    return assessments.agg(
        F.count_if(F.col("gap_description") != "").alias("gap_count"),
        F.count_if(F.col("remediation_due_date") < F.lit(as_of)).alias("overdue_by_date_count"),
    )


def top_evidence_types(evidence: DataFrame, rows: int = TOP_EVIDENCE_TYPES) -> DataFrame:
    return (
        evidence.groupBy("evidence_type")
        .agg(F.count(F.lit(1)).alias("evidence_count"))
        .orderBy(F.desc("evidence_count"), "evidence_type")
        .limit(rows)
    )


def evidence_coverage(evidence: DataFrame) -> DataFrame:
    return evidence.agg(
        F.countDistinct("control_id").alias("controls_covered"),
        F.countDistinct("system_id").alias("systems_covered"),
    )


def scope_counts(systems: DataFrame) -> DataFrame:
    return systems.agg(
        F.count_if("in_soc2_scope").alias("soc2_systems"),
        F.count_if("in_iso_scope").alias("iso27001_systems"),
    )
