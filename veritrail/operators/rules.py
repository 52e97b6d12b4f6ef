"""Compliance rules kept as data and applied as SQL expressions.

A rule's check is an SQL expression that yields PASS or the kind of finding.
Rules live in a table like any other; :class:`RuleBook` is the working copy
whose texts become part of the query plan. Check texts are trusted code.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from veritrail import vocabulary as v

PASS = "PASS"

RULE_SCHEMA = StructType(
    [
        StructField("rule_id", LongType(), False),
        StructField("rule_name", StringType(), False),
        StructField("rule_description", StringType()),
        StructField("check_code", StringType(), False),
        StructField("severity", StringType()),
        StructField("is_active", BooleanType(), False),
    ]
)

ALERT_COLUMNS = (
    "entity_type",
    "entity_id",
    "control_id",
    "system_id",
    "rule_name",
    "rule_result",
    "severity",
    "alert_date",
)


@dataclass(frozen=True)
class Rule:
    rule_id: int
    rule_name: str
    rule_description: str
    check_code: str
    severity: str
    is_active: bool = True


def check(*findings: tuple[str, str]) -> str:
    """SQL text giving the first finding whose condition holds, else PASS."""
    branches = " ".join(f"WHEN {condition} THEN '{result}'" for result, condition in findings)
    return f"CASE {branches} ELSE '{PASS}' END"


class RuleBook:
    """Ordered rules with ids assigned on insertion."""

    def __init__(self, rules: Iterable[Rule] = ()):
        self._rules = list(rules)

    def insert(
        self, name: str, description: str, code: str, severity: str, is_active: bool = True
    ) -> RuleBook:
        next_id = max((r.rule_id for r in self._rules), default=0) + 1
        self._rules.append(Rule(next_id, name, description, code, severity, is_active))
        return self

    def active(self) -> list[Rule]:
        return sorted((r for r in self._rules if r.is_active), key=lambda r: r.rule_id)

    def named(self, *names: str) -> list[Rule]:
        """The active rules among ``names``, in the order asked for."""
        by_name = {r.rule_name: r for r in self.active()}
        return [by_name[name] for name in names if name in by_name]

    def to_frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(
            [
                (r.rule_id, r.rule_name, r.rule_description, r.check_code, r.severity, r.is_active)
                for r in self._rules
            ],
            RULE_SCHEMA,
        )

    @classmethod
    def from_frame(cls, rules: DataFrame) -> RuleBook:
        """Active rules of a rule table. Their texts become query plans, so
        they have to reach the driver; a rule table is a hand-written list."""
        rows = rules.where("is_active").orderBy("rule_id").select(*RULE_SCHEMA.names).collect()
        return cls(Rule(*row) for row in rows)


def standard_rules() -> RuleBook:
    # Rule names, findings and limits.
    return (
        RuleBook()
        .insert(
            "expired_evidence",
            "Flags evidence past its end and evidence with under a month left",
            check(("FAIL", "is_expired"), ("WARN", f"days_until_expiry < {v.EXPIRES_SOON_DAYS}")),
            "HIGH",
        )
        .insert(
            "overdue_remediation",
            "Flags open fixes past their due day and those due in two weeks",
            check(
                (
                    "CRITICAL",
                    f"is_overdue AND days_to_remediation < {v.REMEDIATION_CRITICAL_DAYS}",
                ),
                ("FAIL", "is_overdue"),
                ("WARN", f"days_to_remediation < {v.REMEDIATION_WARN_DAYS}"),
            ),
            "HIGH",
        )
        .insert(
            "stale_assessment",
            "Flags systems whose last assessment lies three quarters of a year back",
            check(
                ("FAIL", f"days_since_assessment > {v.ASSESSMENT_VALID_DAYS}"),
                ("WARN", f"days_since_assessment > {v.ASSESSMENT_STALE_WARN_DAYS}"),
            ),
            "MEDIUM",
        )
        .insert(
            "critical_system_coverage",
            "Flags important systems that score below their target",
            check(
                ("FAIL", "criticality = 'Critical' AND compliance_percentage < 90"),
                ("WARN", "criticality = 'Critical' AND compliance_percentage < 95"),
                ("WARN", "criticality = 'High' AND compliance_percentage < 80"),
            ),
            "HIGH",
        )
        .insert(
            "evidence_gap",
            "Flags controls whose evidence is missing or about to lapse",
            check(("FAIL", "gap_severity = 'Critical'"), ("WARN", "gap_severity = 'High'")),
            "HIGH",
        )
    )


def raise_alerts(
    df: DataFrame,
    rules: Sequence[Rule],
    *,
    entity_type: str,
    entity_id: str,
    control_id: str | None,
    as_of: dt.date,
) -> DataFrame:
    """One alert row per (row, rule) whose check is not PASS.

    All rules of an entity are evaluated in one scan; a row yields as many
    candidates as there are rules.
    """
    control = F.col(control_id) if control_id else F.lit(None).cast("string")
    outcomes = [
        F.struct(
            F.lit(r.rule_name).alias("rule_name"),
            F.expr(r.check_code).alias("rule_result"),
            F.lit(r.severity).alias("severity"),
        )
        for r in rules
    ]
    columns = (
        F.lit(entity_type).alias("entity_type"),
        F.col(entity_id).cast("string").alias("entity_id"),
        control.alias("control_id"),
        F.col("system_id"),
    )
    if len(outcomes) == 1:
        judged = df.select(*columns, outcomes[0].alias("_outcome")).select("*", "_outcome.*")
    else:
        kinds = "array<struct<rule_name:string,rule_result:string,severity:string>>"
        judged = df.select(*columns, F.inline(F.array(*outcomes).cast(kinds)))
    flagged = judged.where(F.col("rule_result") != PASS)
    return flagged.withColumn("alert_date", F.lit(as_of)).select(*ALERT_COLUMNS)


def evidence_alerts(evidence: DataFrame, book: RuleBook, as_of: dt.date) -> DataFrame:
    return raise_alerts(
        evidence,
        book.named("expired_evidence"),
        entity_type="evidence",
        entity_id="evidence_id",
        control_id="control_id",
        as_of=as_of,
    )


def assessment_alerts(assessments: DataFrame, book: RuleBook, as_of: dt.date) -> DataFrame:
    return raise_alerts(
        assessments,
        book.named("overdue_remediation"),
        entity_type="assessment",
        entity_id="assessment_id",
        control_id="control_id",
        as_of=as_of,
    )


SYSTEM_RULES = ("critical_system_coverage", "stale_assessment")


def system_alerts(
    scorecard: DataFrame, book: RuleBook, as_of: dt.date, names: Sequence[str] = SYSTEM_RULES
) -> DataFrame:
    return raise_alerts(
        scorecard,
        book.named(*names),
        entity_type="system",
        entity_id="system_id",
        control_id=None,
        as_of=as_of,
    )


def gap_alerts(gaps: DataFrame, book: RuleBook, as_of: dt.date) -> DataFrame:
    return raise_alerts(
        gaps,
        book.named("evidence_gap"),
        entity_type="evidence_gap",
        entity_id="control_id",
        control_id="control_id",
        as_of=as_of,
    )


def missing_evidence_alerts(missing: DataFrame, book: RuleBook, as_of: dt.date) -> DataFrame:
    """One alert per system that lacks expected evidence, with the number of
    controls it is lacking for: each such pair is a Critical gap."""
    lacking = missing.where(F.col("missing_pairs") > 0).withColumn(
        "gap_severity", F.lit("Critical")
    )
    alerts = raise_alerts(
        lacking,
        book.named("evidence_gap"),
        entity_type="system_evidence_gap",
        entity_id="system_id",
        control_id=None,
        as_of=as_of,
    )
    return alerts.join(lacking.select("system_id", "missing_pairs"), "system_id").select(
        *ALERT_COLUMNS, F.col("missing_pairs").alias("pairs")
    )


def all_alerts(
    evidence: DataFrame,
    assessments: DataFrame,
    scorecard: DataFrame,
    gaps: DataFrame,
    book: RuleBook,
    as_of: dt.date,
) -> DataFrame:
    """Alerts of every entity, duplicates kept."""
    parts = [
        evidence_alerts(evidence, book, as_of),
        assessment_alerts(assessments, book, as_of),
        system_alerts(scorecard, book, as_of),
        gap_alerts(gaps, book, as_of),
    ]
    return reduce(DataFrame.unionByName, parts)


def rule_activity(alerts: DataFrame, book: RuleBook) -> DataFrame:
    """Active rules in id order with the number of alerts each one raised."""
    raised = alerts.groupBy("rule_name").agg(F.count(F.lit(1)).alias("alert_count"))
    active = book.to_frame(alerts.sparkSession).where("is_active")
    return (
        active.join(raised, "rule_name", "left")
        .select(
            "rule_id",
            "rule_name",
            "rule_description",
            "severity",
            F.coalesce("alert_count", F.lit(0)).alias("alert_count"),
        )
        .orderBy("rule_id")
    )
