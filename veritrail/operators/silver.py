"""Cleaning of the bronze entities.

Each time-dependent entity is cleaned in two steps. ``clean_*`` depends on the
row alone, so its result can be stored or streamed for good. ``date_*`` adds
the columns that age (days left, overdue flags) from an explicit ``as_of`` and
is applied whenever the table is read. ``silver_*`` is both in one go.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veritrail import vocabulary as v
from veritrail.functions import cleaning as c
from veritrail.functions import grading as g


def silver_controls(raw: DataFrame) -> DataFrame:
    control_id = c.normalise_id(F.col("control_id"))
    return raw.withColumns(
        {
            "control_id": control_id,
            "control_family_code": c.family_code(control_id),
            "control_number": c.control_number(control_id),
            "is_enhancement": control_id.contains("("),
            **{f"baseline_{b}": c.is_true_text(F.col(f"baseline_{b}")) for b in v.BASELINES},
        }
    )


def silver_criteria(raw: DataFrame) -> DataFrame:
    criterion_id = c.normalise_id(F.col("tsc_id"))
    code = c.category_code(criterion_id)
    return raw.withColumns(
        {
            "tsc_id": criterion_id,
            "category_code": code,
            "category_full": g.lookup(code, v.CRITERION_CATEGORIES, F.col("tsc_category")),
        }
    )


def clean_systems(raw: DataFrame) -> DataFrame:
    scope = c.upper_code(F.col("certification_scope"))
    return raw.withColumns(
        {
            "system_id": F.col("system_id").cast("string"),
            "criticality": c.title_case(F.col("criticality")),
            "data_classification": c.title_case(F.col("data_classification")),
            "certification_scope": scope,
            "last_assessment_date": c.parse_date(F.col("last_assessment_date")),
            "created_date": c.parse_date(F.col("created_date")),
            "in_soc2_scope": scope.isin(*v.SOC2_SCOPES),
            "in_iso_scope": scope.isin(*v.ISO_SCOPES),
        }
    )


def date_systems(cleaned: DataFrame, as_of: dt.date) -> DataFrame:
    days = F.datediff(F.lit(as_of), F.col("last_assessment_date"))
    return cleaned.withColumns(
        {
            "days_since_assessment": days,
            "assessment_overdue": F.coalesce(days > v.ASSESSMENT_VALID_DAYS, F.lit(False)),
        }
    )


def silver_systems(raw: DataFrame, as_of: dt.date) -> DataFrame:
    return date_systems(clean_systems(raw), as_of)


def clean_assessments(raw: DataFrame) -> DataFrame:
    control_id = c.normalise_id(F.col("control_id"))
    status = c.title_case(F.col("implementation_status"))
    return raw.withColumns(
        {
            "assessment_id": F.col("assessment_id").cast("string"),
            "system_id": F.col("system_id").cast("string"),
            "assessment_date": c.parse_date(F.col("assessment_date")),
            "remediation_due_date": c.parse_date(F.col("remediation_due_date")),
            "control_id": control_id,
            "control_family_code": c.family_code(control_id),
            "implementation_status": status,
            "compliance_score": g.lookup(status, v.STATUS_SCORES, v.SCORE_OTHERWISE),
        }
    )


def date_assessments(cleaned: DataFrame, as_of: dt.date) -> DataFrame:
    due = F.col("remediation_due_date")
    is_open = ~F.col("implementation_status").isin(v.IMPLEMENTED, v.NOT_APPLICABLE)
    return cleaned.withColumns(
        {
            "is_overdue": F.coalesce(is_open & (due < F.lit(as_of)), F.lit(False)),
            "days_to_remediation": F.datediff(due, F.lit(as_of)),
        }
    )


def silver_assessments(raw: DataFrame, as_of: dt.date) -> DataFrame:
    return date_assessments(clean_assessments(raw), as_of)


def clean_evidence(raw: DataFrame) -> DataFrame:
    return raw.withColumns(
        {
            "evidence_id": F.col("evidence_id").cast("string"),
            "system_id": F.col("system_id").cast("string"),
            "upload_timestamp": c.parse_timestamp(F.col("upload_timestamp")),
            "review_timestamp": c.parse_timestamp(F.col("review_timestamp")),
            "assessment_period_start": c.parse_date(F.col("assessment_period_start")),
            "assessment_period_end": c.parse_date(F.col("assessment_period_end")),
            "control_id": c.normalise_id(F.col("control_id")),
        }
    )


def date_evidence(
    cleaned: DataFrame, as_of: dt.date, *, wait_column: str = "days_pending_review"
) -> DataFrame:
    """``wait_column`` names the review wait: ``days_pending_review`` in the
    batch tables, ``days_to_review`` in the incremental ones."""
    today = F.lit(as_of)
    start, end = F.col("assessment_period_start"), F.col("assessment_period_end")
    waiting = F.datediff(today, F.to_date("upload_timestamp"))
    return cleaned.withColumns(
        {
            "is_expired": end < today,
            "days_until_expiry": F.datediff(end, today),
            "is_current": today.between(start, end),
            wait_column: F.when(F.col("status") == v.PENDING_REVIEW, waiting),
        }
    )


def silver_evidence(
    raw: DataFrame, as_of: dt.date, *, wait_column: str = "days_pending_review"
) -> DataFrame:
    return date_evidence(clean_evidence(raw), as_of, wait_column=wait_column)
