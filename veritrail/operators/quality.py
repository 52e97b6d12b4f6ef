"""Data-quality expectations: named SQL predicates, counted, never dropping rows."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veritrail import vocabulary as v


def _any_of(column: str, values) -> str:
    return f"{column} IN ({', '.join(repr(x) for x in values)})"


# Expectation names and what they require, per cleaned table.
EXPECTATIONS: dict[str, dict[str, str]] = {
    "controls": {
        "valid_control_id": f"control_id IS NOT NULL AND control_id RLIKE '{v.CONTROL_ID_PATTERN}'",
        "has_description": "control_description IS NOT NULL",
    },
    "criteria": {"valid_tsc_id": "tsc_id IS NOT NULL"},
    "systems": {
        "valid_system_id": "system_id IS NOT NULL",
        "valid_classification": _any_of("data_classification", v.CLASSIFICATIONS),
        "valid_criticality": _any_of("criticality", v.CRITICALITIES),
    },
    "assessments": {
        "valid_assessment_id": "assessment_id IS NOT NULL",
        "valid_status": _any_of("implementation_status", v.STATUSES),
        "valid_assessment_date": "assessment_date IS NOT NULL",
    },
    "evidence": {
        "valid_evidence_id": "evidence_id IS NOT NULL",
        "has_control_reference": "control_id IS NOT NULL",
        "valid_dates": "assessment_period_start <= assessment_period_end",
    },
}


def expectation_metrics(expectations: Mapping[str, str]) -> dict[str, dict[str, Column]]:
    """Aggregates per expectation.

    ``passed`` and ``failed`` add up to the row count, an unknown (NULL)
    outcome counting as failed. ``violations`` counts only rows that are
    definitely wrong, as ``WHERE NOT predicate`` would.
    """
    out = {}
    for name, predicate in expectations.items():
        holds = F.expr(predicate)
        known = F.coalesce(holds, F.lit(False))
        out[name] = {
            "passed": F.count_if(known),
            "failed": F.count_if(~known),
            "violations": F.count_if(~holds),
        }
    return out


def expectation_report(df: DataFrame, table: str, expectations: Mapping[str, str]) -> DataFrame:
    """One row per expectation from a single pass over ``df``."""
    rows = [
        F.struct(
            F.lit(table).alias("table_name"),
            F.lit(name).alias("expectation"),
            *(metric.alias(kind) for kind, metric in metrics.items()),
        )
        for name, metrics in expectation_metrics(expectations).items()
    ]
    return df.agg(F.array(*rows).alias("report")).select(F.inline("report"))


def full_report(tables: Mapping[str, DataFrame]) -> DataFrame:
    reports = [expectation_report(df, name, EXPECTATIONS[name]) for name, df in tables.items()]
    return reduce(DataFrame.unionByName, reports)


def write_metrics(table: str) -> list[Column]:
    """Failed-row counters to observe while the table is being written."""
    return [
        metrics["failed"].alias(f"failed_{name}")
        for name, metrics in expectation_metrics(EXPECTATIONS[table]).items()
    ]


def violating_rows(df: DataFrame, predicate: str) -> DataFrame:
    """The rows behind a ``violations`` count."""
    return df.filter(f"NOT ({predicate})")


# One bit per expectation, in the order of their names in EXPECTATIONS; a set
# bit is a failure, unknown outcomes included. A long has room for 63.
BITS = "_failed"


def failure_bits(expectations: Mapping[str, str]) -> Column:
    """The expectations that a row fails, as bits of a long."""
    marks = (
        F.when(F.coalesce(F.expr(p), F.lit(False)), 0).otherwise(1 << i).cast("long")
        for i, p in enumerate(expectations.values())
    )
    return reduce(Column.bitwiseOR, marks)


def mask(expectations: Mapping[str, str], *names: str) -> int:
    """The bits of ``names``, of all expectations if none is named."""
    order = list(expectations)
    return sum(1 << order.index(n) for n in (names or order))


def with_failure_bits(
    df: DataFrame, table: str, expectations: Mapping[str, str] | None = None
) -> DataFrame:
    return df.withColumn(BITS, failure_bits(expectations or EXPECTATIONS[table]))


def _bit(number: int) -> Column:
    return F.col(BITS).bitwiseAND(F.lit(1 << number).cast("long")) != 0


def bit_metrics(table: str, expectations: Mapping[str, str] | None = None) -> list[Column]:
    """Failed-row counters from the bits, to observe during a write."""
    names = expectations or EXPECTATIONS[table]
    return [F.count_if(_bit(i)).alias(f"failed_{name}") for i, name in enumerate(names)]


def failing(
    df: DataFrame, table: str, *names: str, expectations: Mapping[str, str] | None = None
) -> DataFrame:
    """Rows with bits that fail any of the expectations ``names``: one test of
    the stored bits, whatever the expectations are."""
    chosen = mask(expectations or EXPECTATIONS[table], *names)
    return df.where(F.col(BITS).bitwiseAND(F.lit(chosen).cast("long")) != 0)


def bit_report(
    df: DataFrame, table: str, expectations: Mapping[str, str] | None = None
) -> DataFrame:
    """(table_name, expectation, passed, failed) from stored bits, in one scan."""
    rows = [
        F.struct(
            F.lit(table).alias("table_name"),
            F.lit(name).alias("expectation"),
            F.count_if(~_bit(i)).alias("passed"),
            F.count_if(_bit(i)).alias("failed"),
        )
        for i, name in enumerate(expectations or EXPECTATIONS[table])
    ]
    return df.agg(F.array(*rows).alias("report")).select(F.inline("report"))
