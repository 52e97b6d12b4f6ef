from __future__ import annotations

import pytest

from tests.conftest import rows
from veritrail.operators import rules


def outcome(spark, name, **values):
    """Result of one standard rule on one row of the given columns."""
    (rule,) = rules.standard_rules().named(name)
    types = {int: "int", bool: "boolean", float: "double", str: "string"}
    kinds = {"days_until_expiry": "int", "days_to_remediation": "int",
             "days_since_assessment": "int"}
    schema = ", ".join(
        f"{k} {kinds.get(k) or types.get(type(x), 'boolean')}" for k, x in values.items()
    )
    df = spark.createDataFrame([tuple(values.values())], schema)
    return df.selectExpr(f"{rule.check_code} AS r").head().r


@pytest.mark.parametrize(
    ("expired", "days", "result"),
    [(True, -1, "FAIL"), (False, 29, "WARN"), (False, 30, "PASS"), (None, None, "PASS")],
)
def test_expired_evidence(spark, expired, days, result):
    got = outcome(spark, "expired_evidence", is_expired=expired, days_until_expiry=days)
    assert got == result


@pytest.mark.parametrize(
    ("overdue", "days", "result"),
    [
        (True, -31, "CRITICAL"),
        (True, -30, "FAIL"),
        (False, 13, "WARN"),
        (False, 14, "PASS"),
        (False, -5, "WARN"),  # past due but already implemented
        (False, None, "PASS"),
    ],
)
def test_overdue_remediation(spark, overdue, days, result):
    got = outcome(spark, "overdue_remediation", is_overdue=overdue, days_to_remediation=days)
    assert got == result


@pytest.mark.parametrize(
    ("days", "result"),
    [(366, "FAIL"), (365, "WARN"), (271, "WARN"), (270, "PASS"), (None, "PASS")],
)
def test_stale_assessment(spark, days, result):
    assert outcome(spark, "stale_assessment", days_since_assessment=days) == result


@pytest.mark.parametrize(
    ("criticality", "percentage", "result"),
    [
        ("Critical", 89.9, "FAIL"),
        ("Critical", 90.0, "WARN"),
        ("Critical", 95.0, "PASS"),
        ("High", 79.9, "WARN"),
        ("High", 80.0, "PASS"),
        ("Low", 0.0, "PASS"),
    ],
)
def test_critical_coverage(spark, criticality, percentage, result):
    got = outcome(
        spark,
        "critical_system_coverage",
        criticality=criticality,
        compliance_percentage=percentage,
    )
    assert got == result


@pytest.fixture
def card(spark):
    return spark.createDataFrame(
        [
            ("both", "Critical", 10.0, 400),
            ("stale", "Low", 99.0, 300),
            ("fine", "Low", 99.0, 10),
        ],
        "system_id string, criticality string, compliance_percentage double, "
        "days_since_assessment int",
    )


def test_two_rules_on_one_entity_in_one_pass(card, as_of):
    got = rows(rules.system_alerts(card, rules.standard_rules(), as_of))
    seen = {(r["entity_id"], r["rule_name"], r["rule_result"], r["severity"]) for r in got}
    assert seen == {
        ("both", "critical_system_coverage", "FAIL", "HIGH"),
        ("both", "stale_assessment", "FAIL", "MEDIUM"),
        ("stale", "stale_assessment", "WARN", "MEDIUM"),
    }
    assert all(r["control_id"] is None and r["alert_date"] == as_of for r in got)


def test_inactive_rules_raise_nothing(card, as_of):
    book = rules.RuleBook().insert("stale_assessment", "off", "'FAIL'", "LOW", is_active=False)
    alerts = rules.system_alerts(card, book, as_of)
    assert tuple(alerts.columns) == rules.ALERT_COLUMNS and alerts.isEmpty()


def test_rule_table_round_trip(spark):
    book = rules.standard_rules().insert(
        "quoted", "it's text", "CASE WHEN a = 'x' THEN 'FAIL' ELSE 'PASS' END", "LOW", False
    )
    frame = book.to_frame(spark)
    assert [r["rule_id"] for r in rows(frame.orderBy("rule_id"))] == [1, 2, 3, 4, 5, 6]
    loaded = rules.RuleBook.from_frame(frame)
    assert loaded.active() == rules.standard_rules().active()


def test_all_alerts_is_the_sum_of_its_parts(spark, as_of):
    from veritrail.plans.entities import AS_OF
    from veritrail.plans.queries import QUERIES

    small = "/root/testdata/sf0.001"
    parts = ("alerts_expired_evidence", "alerts_overdue_remediation",
             "alerts_stale_assessment", "alerts_critical_coverage", "alerts_evidence_gap")
    total = sum(QUERIES[p](spark, small).count() for p in parts)
    alerts = QUERIES["alerts_all"](spark, small)
    assert alerts.count() == total
    assert alerts.where(f"alert_date = DATE '{AS_OF}'").count() == total
