from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tests.conftest import by, day, rows
from tests.test_silver import frame
from veritrail.operators import gold, profiles, reports, rollups
from veritrail.operators import silver as s
from veritrail.plans.entities import AS_OF, Entities

SMALL = "/root/testdata/sf0.001"


def assessments(spark, as_of, records):
    base = {"assessment_date": day(-1), "control_id": "AC-1", "system_id": "1"}
    full = [{**base, "assessment_id": str(i), **r} for i, r in enumerate(records)]
    return s.silver_assessments(frame(spark, "assessments", full), as_of)


def evidence(spark, as_of, records):
    base = {
        "control_id": "AC-1",
        "system_id": "1",
        "status": "Accepted",
        "upload_timestamp": "2024-01-01T00:00:00",
        "assessment_period_start": day(-10),
        "assessment_period_end": day(100),
    }
    full = [{**base, "evidence_id": str(i), **r} for i, r in enumerate(records)]
    return s.silver_evidence(frame(spark, "evidence", full), as_of)


def systems(spark, as_of, records):
    base = {"certification_scope": "SOC2", "criticality": "High"}
    return s.silver_systems(frame(spark, "systems", [{**base, **r} for r in records]), as_of)


def statuses(**counts):
    names = {
        "impl": "Implemented",
        "part": "Partially Implemented",
        "none": "Not Implemented",
        "na": "Not Applicable",
    }
    return [
        {"implementation_status": names[k]} for k, count in counts.items() for _ in range(count)
    ]


def test_family_with_only_not_applicable_has_no_percentage(spark, as_of):
    df = assessments(
        spark,
        as_of,
        [{**r, "control_id": "ZZ-1"} for r in statuses(na=2)] + statuses(impl=2, part=1, none=1),
    )
    got = by(gold.compliance_summary(df, as_of), "control_family_code")
    assert got["ZZ"]["assessable_controls"] == 0
    assert got["ZZ"]["compliance_percentage"] is None
    assert got["ZZ"]["avg_compliance_score"] is None
    assert got["AC"]["compliance_percentage"] == 62.5
    assert got["AC"]["snapshot_date"] == as_of


@pytest.mark.parametrize(
    ("average", "percentage", "grade"),
    [
        (69.94, 69.9, "Non-Compliant"),
        (69.95, 70.0, "Partially Compliant"),
        (89.95, 90.0, "Compliant"),
        (None, 0.0, "Non-Compliant"),
    ],
)
def test_scorecard_grades_the_rounded_percentage(spark, as_of, average, percentage, grade):
    rollup = rollups.system_assessment_rollup(assessments(spark, as_of, statuses(impl=1)))
    rollup = rollup.withColumn("avg_compliance_score", F.lit(average).cast("double"))
    card = gold.system_scorecard(
        systems(spark, as_of, [{"system_id": "1"}]),
        rollup,
        rollups.system_evidence_rollup(evidence(spark, as_of, [])),
        as_of,
    ).head()
    assert (card.compliance_percentage, card.compliance_status) == (percentage, grade)


def test_unassessed_system_is_listed_with_zeros(spark, as_of):
    card = gold.system_scorecard(
        systems(spark, as_of, [{"system_id": "1"}, {"system_id": "2"}]),
        rollups.system_assessment_rollup(assessments(spark, as_of, statuses(impl=3, none=1))),
        rollups.system_evidence_rollup(evidence(spark, as_of, [{}, {}, {"status": "Rejected"}])),
        as_of,
    )
    got = by(card, "system_id")
    assert got["1"]["compliance_percentage"] == 75.0
    assert (got["1"]["controls_with_evidence"], got["1"]["total_evidence_count"]) == (1, 2)
    assert got["2"]["total_controls_assessed"] == 0 and got["2"]["total_evidence_count"] == 0


def test_gap_severity_limits(spark, as_of):
    def one(control, **changes):
        return {"control_id": control, **changes}

    df = evidence(
        spark,
        as_of,
        [
            one("AA-29", assessment_period_end=day(29)),
            one("AA-30", assessment_period_end=day(30)),
            one("AA-89", assessment_period_end=day(89)),
            one("AA-90", assessment_period_end=day(90)),
            one("AA-0", assessment_period_end=day(-1)),
            one("AA-1", status="Rejected", assessment_period_end=day(200)),
            # Accepted evidence ends soon, a rejected one later: days follow the latter.
            one("AA-2", assessment_period_end=day(5)),
            one("AA-2", status="Rejected", assessment_period_end=day(95)),
        ],
    )
    got = by(
        gold.evidence_gap_observed(rollups.evidence_rollup(rollups.evidence_pairs(df)), as_of),
        "control_id",
    )
    grades = {k: (r["gap_severity"], r["evidence_status"]) for k, r in got.items()}
    assert grades == {
        "AA-29": ("High", "Expiring Soon"),
        "AA-30": ("Medium", "Current"),
        "AA-89": ("Medium", "Current"),
        "AA-90": ("Low", "Current"),
        "AA-0": ("Critical", "Missing"),
        "AA-1": ("Critical", "Missing"),
        "AA-2": ("Low", "Current"),
    }


def test_matrix_lists_pairs_without_evidence(spark, as_of):
    controls = s.silver_controls(
        frame(
            spark,
            "controls",
            [
                {"control_id": "AC-1", "baseline_moderate": "TRUE"},
                {"control_id": "AC-2", "baseline_moderate": "TRUE"},
                {"control_id": "AC-3", "baseline_moderate": "FALSE"},
                {"control_id": "AC-4"},
            ],
        )
    )
    inventory = systems(
        spark,
        as_of,
        [
            {"system_id": "1"},
            {"system_id": "2", "certification_scope": "both"},
            {"system_id": "3", "certification_scope": "None"},
            {"system_id": "4", "certification_scope": None},
        ],
    )
    pairs = rollups.evidence_rollup(rollups.evidence_pairs(evidence(spark, as_of, [{}])))
    got = {
        (r["control_id"], r["system_id"]): r
        for r in rows(gold.evidence_gap_matrix(controls, inventory, pairs, as_of))
    }
    assert set(got) == {("AC-1", "1")} and got["AC-1", "1"]["gap_severity"] == "Low"
    lists = {(r["side"], r["entity_id"]) for r in rows(gold.expected_evidence(controls, inventory))}
    assert lists == {("control", "AC-1"), ("control", "AC-2"), ("system", "1"), ("system", "2")}
    named = rows(gold.expected_pairs(controls, inventory, ["2", "4"]))
    assert {(r["control_id"], r["system_id"]) for r in named} == {("AC-1", "2"), ("AC-2", "2")}
    missing = by(gold.missing_by_system(controls, inventory, pairs), "system_id")
    assert {k: (r["expected_pairs"], r["missing_pairs"]) for k, r in missing.items()} == {
        "1": (2, 1), "2": (2, 2),
    }
    missing = by(gold.missing_by_control(controls, inventory, pairs), "control_id")
    assert {k: r["missing_pairs"] for k, r in missing.items()} == {"AC-1": 1, "AC-2": 2}
    histogram = gold.gap_severity_histogram_matrix(controls, inventory, pairs)
    assert {r["gap_severity"]: r["count"] for r in rows(histogram)} == {"Low": 1, "Critical": 3}


def test_crosswalk_fans_out_and_keeps_unmapped(spark, as_of):
    controls = s.silver_controls(
        frame(spark, "controls", [{"control_id": c} for c in ("AC-1", "AC-2", "AC-3")])
    )
    criteria = s.silver_criteria(
        frame(spark, "criteria", [{"tsc_id": "CC1.1", "tsc_name": "one"}])
    )

    def link(i, source, target):
        return {"mapping_id": i, "source_control_id": source, "target_control_id": target}

    mapping = frame(
        spark,
        "control_mapping",
        [
            link("1", "AC-1", "CC1.1"),
            link("2", "AC-1", "CC9.9"),
            link("3", "AC-2", None),
            link("4", "XX-1", "CC1.1"),
            link("5", " ac-3", "CC1.1"),
        ],
    )
    rollup = rollups.control_rollup(assessments(spark, as_of, statuses(impl=1, none=1)))
    got = rows(gold.cross_framework(controls, mapping, criteria, rollup, as_of))
    seen = {
        (
            r["nist_control_id"],
            r["soc2_tsc_id"],
            r["soc2_tsc_name"],
            r["mapping_coverage"],
            r["avg_compliance_pct"],
        )
        for r in got
    }
    gap = "Gap - No SOC2 Mapping"
    assert len(got) == 4
    assert seen == {
        ("AC-1", "CC1.1", "one", "Mapped", 50.0),
        ("AC-1", "CC9.9", None, "Mapped", 50.0),
        ("AC-2", None, None, gap, 0.0),
        ("AC-3", None, None, gap, 0.0),
    }


def test_readiness_without_any_assessment(spark, as_of):
    row = gold.audit_readiness(
        assessments(spark, as_of, []),
        evidence(spark, as_of, [{}]),
        systems(spark, as_of, [{"system_id": "1"}]),
        as_of,
    ).head()
    assert row.total_assessments == 0 and row.evidence_coverage_pct is None
    assert row.audit_readiness_score is None and row.readiness_status == "Critical"


def test_readiness_coverage_may_exceed_hundred(spark, as_of):
    row = gold.audit_readiness(
        assessments(spark, as_of, statuses(impl=4)),
        evidence(spark, as_of, [{"control_id": c, "status": "Rejected"} for c in ("A-1", "B-1")]),
        systems(spark, as_of, [{"system_id": "1"}, {"system_id": "2", "last_assessment_date": day(
            -366)}]),
        as_of,
    ).head()
    assert row.evidence_coverage_pct == 200.0
    assert row.audit_readiness_score == 50 + 60 + 20
    assert row.readiness_status == "Ready"
    assert (row.systems_in_scope, row.systems_assessment_overdue) == (2, 1)


def test_evidence_rollup_from_pairs_equals_direct(spark):
    e = Entities(spark, SMALL)
    direct = rollups.system_evidence_rollup(e.evidence)
    derived = rollups.system_evidence_from_pairs(rollups.evidence_pairs(e.evidence))
    assert direct.exceptAll(derived).isEmpty() and derived.exceptAll(direct).isEmpty()


def test_summary_invariants(spark):
    e = Entities(spark, SMALL)
    for r in rows(gold.compliance_summary(e.assessments, AS_OF)):
        parts = ("implemented_count", "partial_count", "not_implemented_count",
                 "not_applicable_count")
        assert sum(r[p] for p in parts) == r["total_assessments"]
        assert abs(r["compliance_percentage"] - r["avg_compliance_score"]) <= 0.1


def test_matrix_size(spark):
    e = Entities(spark, SMALL)
    pairs = rollups.evidence_rollup(rollups.evidence_pairs(e.evidence))
    moderate = e.controls.where("baseline_moderate").count()
    expected = moderate * rollups.in_scope(e.systems).count()
    held = gold.evidence_gap_matrix(e.controls, e.systems, pairs, AS_OF).count()
    for table in (gold.missing_by_system, gold.missing_by_control):
        got = table(e.controls, e.systems, pairs)
        sums = got.selectExpr("sum(expected_pairs)", "sum(missing_pairs)").head()
        assert tuple(sums) == (expected, expected - held)


def test_overall_compliance_is_zero_when_nothing_is_assessable(spark, as_of):
    got = profiles.overall_compliance(assessments(spark, as_of, statuses(na=2))).head()
    assert (got.assessed_count, got.compliance_pct) == (0, 0.0)


def test_overdue_by_date_ignores_status(spark, as_of):
    df = assessments(
        spark,
        as_of,
        [
            {"implementation_status": "Implemented", "remediation_due_date": day(-1)},
            {"implementation_status": "Not Implemented", "remediation_due_date": day(0),
             "gap_description": "open"},
            {"implementation_status": "Not Implemented", "gap_description": ""},
        ],
    )
    got = profiles.gap_overdue_counts(df, as_of).head()
    assert (got.gap_count, got.overdue_by_date_count) == (1, 1)


def test_applicable_controls_follow_criticality(spark, as_of):
    controls = s.silver_controls(
        frame(
            spark,
            "controls",
            [
                {"control_id": "AA-1", "baseline_low": "TRUE", "baseline_moderate": "TRUE",
                 "baseline_high": "TRUE"},
                {"control_id": "AA-2", "baseline_moderate": "TRUE", "baseline_high": "TRUE"},
                {"control_id": "AA-3", "baseline_high": "TRUE"},
            ],
        )
    )
    inventory = systems(
        spark,
        as_of,
        [
            {"system_id": "c", "criticality": "critical"},
            {"system_id": "h", "criticality": "high"},
            {"system_id": "l", "criticality": "unheard of"},
            {"system_id": "out", "criticality": "critical", "certification_scope": "None"},
        ],
    )
    got = sorted(
        (r["system_id"], r["required_baseline"], r["applicable_controls"])
        for r in rows(profiles.applicable_controls(controls, inventory))
    )
    assert got == [("c", "high", 3), ("h", "moderate", 2), ("l", "low", 1)]
    listed = rows(profiles.required_baselines(controls))
    assert sorted(r["control_id"] for r in listed if r["required_baseline"] == "moderate") == [
        "AA-1", "AA-2",
    ]


def test_reports_are_ordered(spark):
    alerts = spark.createDataFrame(
        [("a", "WARN", "MEDIUM")] * 5 + [("b", "FAIL", "HIGH")] + [("c", "FAIL", "LOW")] * 9,
        "rule_name string, rule_result string, severity string",
    )
    assert [r["severity"] for r in rows(reports.alert_summary(alerts))] == ["HIGH", "MEDIUM", "LOW"]
    card = spark.createDataFrame(
        [("2", 50.0), ("1", 50.0), ("3", 10.0)], "system_id string, compliance_percentage double"
    )
    assert [r["system_id"] for r in rows(reports.scorecard_worst_first(card))] == ["3", "1", "2"]
