"""Streamed cleaning: bronze table -> silver table, row by row.

Only the part of silver that depends on the row alone is streamed. Columns
that age are added when the table is read, so they never freeze at the day a
row happened to arrive.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from veritrail.operators import quality
from veritrail.operators import silver as s
from veritrail.streaming import ingest
from veritrail.streaming.manifest import BatchTable

# Review wait is called days_to_review in the incremental tables.
WAIT_COLUMN = "days_to_review"

CLEANERS = {
    "systems": s.clean_systems,
    "assessments": s.clean_assessments,
    "evidence": s.clean_evidence,
}
DATERS = {
    "systems": s.date_systems,
    "assessments": s.date_assessments,
    "evidence": lambda df, as_of: s.date_evidence(df, as_of, wait_column=WAIT_COLUMN),
}


def start_refine(
    spark: SparkSession, store: str, entity: str, *, near: Sequence[str] = ()
) -> ingest.Run:
    raw = ingest.table_stream(spark, f"{store}/bronze/{entity}")
    cleaned = quality.with_failure_bits(CLEANERS[entity](raw), entity)
    return ingest.start_append(
        cleaned,
        f"{store}/silver/{entity}",
        f"{store}/checkpoints/silver_{entity}",
        measures=quality.bit_metrics(entity),
        near=near,
    )


def refine(spark: SparkSession, store: str, entity: str) -> ingest.Run:
    """Clean the bronze rows that are new and append them to silver. No row is
    dropped: what it fails is marked in its bits and counted in the manifest."""
    return start_refine(spark, store, entity).wait()


def failed_expectations(run: ingest.Run, entity: str) -> dict[str, int]:
    """Failures per expectation over all rows that the run stored, from the
    manifest alone."""
    _, measures = run.counted()
    return {k: n for k, n in measures.items() if k.startswith("failed_")}


def failing_rows(
    spark: SparkSession, store: str, entity: str, *names: str, run: str | None = None
) -> DataFrame:
    """Stored silver rows, of all runs or one, that fail any of the expectations
    ``names`` (none named: any at all)."""
    stored = BatchTable(spark, f"{store}/silver/{entity}").read(run)
    return quality.failing(stored, entity, *names)


def silver_table(spark: SparkSession, store: str, entity: str, as_of: dt.date) -> DataFrame:
    """Snapshot of the streamed silver table with its day columns at ``as_of``."""
    stored = BatchTable(spark, f"{store}/silver/{entity}").read().drop(quality.BITS)
    return DATERS[entity](stored, as_of)
