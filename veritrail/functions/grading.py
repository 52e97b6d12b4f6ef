"""Grades and scores built from ordered lists instead of hand-written chains."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from veritrail import vocabulary as v


def first_match(branches: Iterable[tuple[Column, object]], otherwise: object) -> Column:
    """Value of the first branch whose condition is true, else ``otherwise``."""
    head, *tail = branches
    chain = reduce(lambda acc, b: acc.when(*b), tail, F.when(*head))
    return chain.otherwise(otherwise)


def lookup(c: Column, table: Mapping[str, object], otherwise: object) -> Column:
    return first_match(((c == key, value) for key, value in table.items()), otherwise)


def at_least(c: Column, ladder: Iterable[tuple[float, str]], otherwise: str) -> Column:
    return first_match(((c >= floor, grade) for floor, grade in ladder), otherwise)


def one_decimal(c: Column) -> Column:
    return F.round(c, 1)


def percent(part: Column, whole: Column) -> Column:
    """``part / whole * 100`` to one decimal; NULL when ``whole`` is 0."""
    return one_decimal(F.try_divide(part, whole) * 100)


def zero_if_null(c: Column) -> Column:
    return F.coalesce(c, F.lit(0))


def weighted_percent(implemented: Column, partial: Column, assessable: Column) -> Column:
    """Share of assessable controls in place, a partial one counting half."""
    return percent(implemented + partial * v.PARTIAL_CREDIT, assessable)


def compliance_grade(pct: Column) -> Column:
    return at_least(pct, v.COMPLIANCE_GRADES, v.COMPLIANCE_GRADE_OTHERWISE)


def readiness_grade(score: Column) -> Column:
    return at_least(score, v.READINESS_GRADES, v.READINESS_GRADE_OTHERWISE)


def risk_grade(score: Column) -> Column:
    return at_least(score, v.RISK_GRADES, v.RISK_GRADE_OTHERWISE)


def gap_severity(current_count: Column, days_left: Column) -> Column:
    """Worst first: nothing current, then how soon the best evidence ends."""
    return first_match(
        (
            (zero_if_null(current_count) == 0, "Critical"),
            (days_left < v.EXPIRES_SOON_DAYS, "High"),
            (days_left < v.EXPIRES_LATER_DAYS, "Medium"),
        ),
        "Low",
    )


def evidence_status(current_count: Column, days_left: Column) -> Column:
    return first_match(
        (
            (zero_if_null(current_count) == 0, "Missing"),
            (days_left < v.EXPIRES_SOON_DAYS, "Expiring Soon"),
        ),
        "Current",
    )
