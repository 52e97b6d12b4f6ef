from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tests.conftest import by, day, rows
from veritrail.functions import cleaning as c
from veritrail.operators import quality
from veritrail.operators import silver as s
from veritrail.sources import schemas


def frame(spark, entity, records):
    columns = schemas.ENTITY_COLUMNS[entity]
    schema = schemas.text_schema(columns)
    return spark.createDataFrame([tuple(r.get(x) for x in columns) for r in records], schema)


@pytest.mark.parametrize(
    "text",
    ["2024-06-30", "2024-6-30", "2024-02-30", " 2024-06-30", "2024-06-30 ", "2024-06-30T", "2024",
     "2024-06", "", "x", None, "2024-06-30 10:00:00", "0000-01-01", "0001-01-01", "9999-12-31",
     "20240630", "+12001-06-30"],
)
def test_date_parsing_equals_the_format_parser(spark, text):
    df = spark.createDataFrame([(text,)], "t string").select(
        c.parse_date(F.col("t")).cast("string").alias("got"),
        F.try_to_date("t", "yyyy-MM-dd").cast("string").alias("want"),
    )
    row = df.head()
    assert row.got == row.want


def test_date_parsing_accepts_typed_columns(spark):
    df = spark.sql("SELECT DATE '2024-06-30' d, TIMESTAMP '2024-06-30 10:00:00' t")
    row = df.select(c.parse_date(F.col("d")).alias("d"), c.parse_date(F.col("t")).alias("t")).head()
    assert str(row.d) == str(row.t) == "2024-06-30"


def test_controls(spark):
    raw = frame(
        spark,
        "controls",
        [
            {"control_id": " ac-2 ", "control_name": "a", "baseline_low": "TRUE",
             "baseline_moderate": "FALSE"},
            {"control_id": "AC-2(1)", "control_name": "b"},
            {"control_id": "ZZZ", "control_name": "c"},
            {"control_id": None, "control_name": "d"},
        ],
    )
    got = by(s.silver_controls(raw), "control_name")
    assert got["a"]["control_id"] == "AC-2"
    assert (got["a"]["control_family_code"], got["a"]["control_number"]) == ("AC", 2)
    assert (got["a"]["baseline_low"], got["a"]["baseline_moderate"]) == (True, False)
    assert got["a"]["baseline_high"] is None
    assert not got["a"]["is_enhancement"] and got["b"]["is_enhancement"]
    assert (got["c"]["control_family_code"], got["c"]["control_number"]) == ("", None)
    assert got["d"]["control_family_code"] is None


def test_baselines_already_typed_by_inference(spark):
    raw = frame(spark, "controls", [{"control_id": "AC-1", "baseline_low": "TRUE"}]).withColumn(
        "baseline_low", F.lit(True)
    )
    assert s.silver_controls(raw).head().baseline_low is True


def test_criteria_categories(spark):
    ids = ["cc1.1", "A1.2", "C1.1", "PI1.1", "p2.0", "X9"]
    raw = frame(spark, "criteria", [{"tsc_id": i, "tsc_category": "raw"} for i in ids])
    got = {r["tsc_id"]: (r["category_code"], r["category_full"]) for r in rows(
        s.silver_criteria(raw))}
    assert got == {
        "CC1.1": ("CC", "Common Criteria"),
        "A1.2": ("A", "Availability"),
        "C1.1": ("C", "Confidentiality"),
        "PI1.1": ("PI", "Processing Integrity"),
        "P2.0": ("P", "Privacy"),
        "X9": ("X", "raw"),
    }


def test_systems(spark, as_of):
    raw = frame(
        spark,
        "systems",
        [
            {"system_id": "1", "certification_scope": " both", "criticality": " cRITICAL ",
             "last_assessment_date": day(-365)},
            {"system_id": "2", "certification_scope": "SOC2", "last_assessment_date": day(-366)},
            {"system_id": "3", "certification_scope": "ISO27001"},
            {"system_id": "4", "certification_scope": "None", "last_assessment_date": "bad"},
            {"system_id": "5"},
        ],
    )
    got = by(s.silver_systems(raw, as_of), "system_id")
    assert got["1"]["criticality"] == "Critical" and got["1"]["certification_scope"] == "BOTH"
    assert (got["1"]["days_since_assessment"], got["1"]["assessment_overdue"]) == (365, False)
    assert (got["2"]["days_since_assessment"], got["2"]["assessment_overdue"]) == (366, True)
    assert (got["3"]["days_since_assessment"], got["3"]["assessment_overdue"]) == (None, False)
    assert got["4"]["certification_scope"] == "NONE" and got["4"]["last_assessment_date"] is None
    scopes = {k: (r["in_soc2_scope"], r["in_iso_scope"]) for k, r in got.items()}
    assert scopes == {
        "1": (True, True), "2": (True, False), "3": (False, True), "4": (False, False),
        "5": (None, None),
    }


def test_assessments(spark, as_of):
    def row(i, status, due=None):
        return {
            "assessment_id": i,
            "control_id": " ac-1",
            "implementation_status": status,
            "remediation_due_date": due,
            "assessment_date": day(0),
        }

    raw = frame(
        spark,
        "assessments",
        [
            row("impl", " implemented", day(-5)),
            row("na", "NOT APPLICABLE", day(-5)),
            row("part", "partially implemented", day(-1)),
            row("today", "Not Implemented", day(0)),
            row("late", "Not Implemented", day(-31)),
            row("odd", "Planned", day(-1)),
            row("null", None, day(-1)),
            row("bad", "Not Implemented", "31/12/2023"),
        ],
    )
    got = by(s.silver_assessments(raw, as_of), "assessment_id")
    overdue = {k for k, r in got.items() if r["is_overdue"]}
    assert overdue == {"part", "late", "odd"}
    scores = {k: r["compliance_score"] for k, r in got.items()}
    assert scores == {
        "impl": 100, "na": None, "part": 50, "today": 0, "late": 0, "odd": 0, "null": 0, "bad": 0,
    }
    assert got["late"]["days_to_remediation"] == -31
    assert got["today"]["days_to_remediation"] == 0
    assert got["bad"]["days_to_remediation"] is None
    assert got["impl"]["control_id"] == "AC-1" and got["impl"]["control_family_code"] == "AC"


def test_evidence(spark, as_of):
    def row(i, start, end, status="Accepted", uploaded="2024-06-20T23:30:00"):
        return {
            "evidence_id": i,
            "control_id": "ac-1 ",
            "assessment_period_start": start,
            "assessment_period_end": end,
            "status": status,
            "upload_timestamp": uploaded,
        }

    raw = frame(
        spark,
        "evidence",
        [
            row("ends", day(-10), day(0)),
            row("starts", day(0), day(10)),
            row("over", day(-10), day(-1)),
            row("future", day(1), day(5)),
            row("reversed", day(5), day(-5)),
            row("bad", "soon", day(5), "Pending Review"),
            row("noupload", day(-1), day(1), "Pending Review", "yesterday"),
        ],
    )
    got = by(s.silver_evidence(raw, as_of), "evidence_id")
    current = {k: r["is_current"] for k, r in got.items()}
    assert current == {
        "ends": True, "starts": True, "over": False, "future": False, "reversed": False,
        "bad": None, "noupload": True,
    }
    assert {k for k, r in got.items() if r["is_expired"]} == {"over", "reversed"}
    assert got["ends"]["days_until_expiry"] == 0 and got["over"]["days_until_expiry"] == -1
    assert got["bad"]["days_pending_review"] == 10 and got["ends"]["days_pending_review"] is None
    assert got["noupload"]["days_pending_review"] is None
    renamed = s.silver_evidence(raw, as_of, wait_column="days_to_review")
    assert by(renamed, "evidence_id")["bad"]["days_to_review"] == 10
    assert "days_pending_review" not in renamed.columns


def test_expectations_count_unknown_as_failed_but_not_as_violation(spark, as_of):
    raw = frame(
        spark,
        "assessments",
        [
            {"assessment_id": "1", "implementation_status": "implemented",
             "assessment_date": day(0)},
            {"assessment_id": None, "implementation_status": "planned", "assessment_date": "x"},
            {"assessment_id": "3", "implementation_status": None, "assessment_date": day(0)},
        ],
    )
    cleaned = s.silver_assessments(raw, as_of)
    got = by(
        quality.expectation_report(cleaned, "assessments", quality.EXPECTATIONS["assessments"]),
        "expectation",
    )
    counts = {k: (r["passed"], r["failed"], r["violations"]) for k, r in got.items()}
    assert counts == {
        "valid_assessment_id": (2, 1, 1),
        "valid_status": (1, 2, 1),
        "valid_assessment_date": (2, 1, 1),
    }
    bad = quality.violating_rows(cleaned, quality.EXPECTATIONS["assessments"]["valid_status"])
    assert [r["implementation_status"] for r in rows(bad)] == ["Planned"]


def test_control_id_expectation(spark):
    raw = frame(spark, "controls", [{"control_id": x} for x in ("ac-1", "A-1", "ACX-1", None)])
    report = quality.expectation_report(
        s.silver_controls(raw), "controls", quality.EXPECTATIONS["controls"]
    )
    got = by(report, "expectation")
    assert got["valid_control_id"]["violations"] == 3
    assert got["has_description"]["failed"] == 4


def test_evidence_period_expectation_ignores_missing_dates(spark, as_of):
    raw = frame(
        spark,
        "evidence",
        [
            {"evidence_id": "1", "assessment_period_start": day(1), "assessment_period_end": day(0)},
            {"evidence_id": "2", "assessment_period_start": day(1)},
        ],
    )
    got = by(
        quality.expectation_report(
            s.silver_evidence(raw, as_of), "evidence", quality.EXPECTATIONS["evidence"]
        ),
        "expectation",
    )
    assert (got["valid_dates"]["failed"], got["valid_dates"]["violations"]) == (2, 1)
