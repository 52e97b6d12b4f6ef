"""Column lists of the six input entities (fixed values)."""

from __future__ import annotations

from pyspark.sql.types import StringType, StructField, StructType

CONTROL_COLUMNS = (
    "control_id",
    "control_family",
    "control_name",
    "control_description",
    "baseline_low",
    "baseline_moderate",
    "baseline_high",
)
CRITERION_COLUMNS = ("tsc_id", "tsc_category", "tsc_name", "tsc_description", "points_of_focus")
MAPPING_COLUMNS = (
    "mapping_id",
    "source_framework",
    "source_control_id",
    "target_framework",
    "target_control_id",
    "mapping_type",
    "mapping_notes",
)
SYSTEM_COLUMNS = (
    "system_id",
    "system_name",
    "system_owner",
    "owner_email",
    "business_unit",
    "data_classification",
    "environment",
    "hosting_type",
    "criticality",
    "certification_scope",
    "last_assessment_date",
    "created_date",
    "description",
)
ASSESSMENT_COLUMNS = (
    "assessment_id",
    "control_id",
    "control_family",
    "system_id",
    "system_name",
    "assessment_date",
    "assessment_type",
    "assessor",
    "implementation_status",
    "effectiveness_rating",
    "gap_description",
    "remediation_plan",
    "remediation_due_date",
    "remediation_owner",
    "findings",
)
EVIDENCE_COLUMNS = (
    "evidence_id",
    "control_id",
    "system_id",
    "system_name",
    "evidence_type",
    "evidence_description",
    "evidence_path",
    "uploaded_by",
    "upload_timestamp",
    "assessment_period_start",
    "assessment_period_end",
    "status",
    "reviewer",
    "review_timestamp",
    "review_notes",
)
EVIDENCE_REQUIRED = ("evidence_id", "control_id", "system_id")

ENTITY_COLUMNS = {
    "controls": CONTROL_COLUMNS,
    "criteria": CRITERION_COLUMNS,
    "control_mapping": MAPPING_COLUMNS,
    "systems": SYSTEM_COLUMNS,
    "assessments": ASSESSMENT_COLUMNS,
    "evidence": EVIDENCE_COLUMNS,
}


def text_schema(columns, required=()) -> StructType:
    """All-text schema. File sources relax ``required`` to nullable; the
    expectations on the cleaned table are what check it."""
    return StructType([StructField(c, StringType(), c not in required) for c in columns])


EVIDENCE_SCHEMA = text_schema(EVIDENCE_COLUMNS, EVIDENCE_REQUIRED)
