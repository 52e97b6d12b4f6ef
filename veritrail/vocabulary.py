"""Names, thresholds and patterns shared by every layer.

Everything in this module is a fixed value: results depend on these exact
words, numbers and patterns, so they are stated once, in plain form.
"""

from __future__ import annotations

# Implementation status of a control on a system, with the score it earns.
IMPLEMENTED = "Implemented"
PARTIALLY_IMPLEMENTED = "Partially Implemented"
NOT_IMPLEMENTED = "Not Implemented"
NOT_APPLICABLE = "Not Applicable"
STATUSES = (IMPLEMENTED, PARTIALLY_IMPLEMENTED, NOT_IMPLEMENTED, NOT_APPLICABLE)
GAP_STATUSES = (NOT_IMPLEMENTED, PARTIALLY_IMPLEMENTED)
STATUS_SCORES = {IMPLEMENTED: 100, PARTIALLY_IMPLEMENTED: 50, NOT_APPLICABLE: None}
SCORE_OTHERWISE = 0
PARTIAL_CREDIT = 0.5

# Evidence status.
ACCEPTED = "Accepted"
PENDING_REVIEW = "Pending Review"
REJECTED = "Rejected"
EXPIRED = "Expired"

# System attributes.
CRITICALITIES = ("Critical", "High", "Medium", "Low")
CLASSIFICATIONS = ("Public", "Internal", "Confidential", "Restricted")
SOC2_SCOPES = ("SOC2", "BOTH")
ISO_SCOPES = ("ISO27001", "BOTH")

# Control baselines, and the baseline a system of each criticality must meet.
BASELINES = ("low", "moderate", "high")
BASELINE_FOR_CRITICALITY = {"Critical": "high", "High": "moderate"}
BASELINE_OTHERWISE = "low"
EXPECTED_EVIDENCE_BASELINE = "moderate"

# Trust criterion category code -> label.
CRITERION_CATEGORIES = {
    "CC": "Common Criteria",
    "A": "Availability",
    "C": "Confidentiality",
    "PI": "Processing Integrity",
    "P": "Privacy",
}

# Identifier patterns and text formats.
FAMILY_PATTERN = "^([A-Z]+)-"
NUMBER_PATTERN = "^[A-Z]+-([0-9]+)"
CATEGORY_PATTERN = "^([A-Z]+)"
CONTROL_ID_PATTERN = "^[A-Z]{2}-[0-9]+"
DATE_FORMAT = "yyyy-MM-dd"

# Day limits.
ASSESSMENT_VALID_DAYS = 365
ASSESSMENT_STALE_WARN_DAYS = 270
EXPIRES_SOON_DAYS = 30
EXPIRES_LATER_DAYS = 90
REMEDIATION_CRITICAL_DAYS = -30
REMEDIATION_WARN_DAYS = 14

# Score ladders: (lowest value that earns the grade, grade), best first.
COMPLIANCE_GRADES = ((90, "Compliant"), (70, "Partially Compliant"))
COMPLIANCE_GRADE_OTHERWISE = "Non-Compliant"
READINESS_GRADES = ((85, "Ready"), (70, "On Track"), (50, "At Risk"))
READINESS_GRADE_OTHERWISE = "Critical"
RISK_GRADES = ((0.7, "High"), (0.4, "Medium"))
RISK_GRADE_OTHERWISE = "Low"

# Weights of the audit readiness score.
READINESS_WEIGHTS = {"compliance": 0.5, "coverage": 0.3, "on_time": 0.2}

# Ordinal encodings of the risk model.
GAP_SEVERITY_SCORES = {"Critical": 4, "High": 3, "Medium": 2, "Low": 1}
CRITICALITY_SCORES = {"Critical": 4, "High": 3, "Medium": 2}
CRITICALITY_SCORE_OTHERWISE = 1

# Crosswalk labels.
MAPPED = "Mapped"
UNMAPPED = "Gap - No SOC2 Mapping"
