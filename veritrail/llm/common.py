"""Helpers shared by the training-data operators."""

from __future__ import annotations

import itertools
import os
from collections.abc import Callable, Iterator, Sequence
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names like ``names`` that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


#: Rows of an Arrow batch. Batches of whole texts live in memory outside the
#: heap, which tasks do not give back; Spark's default of 10,000 rows of some
#: kB each costs an executor hundreds of MB.
BATCH_ROWS = 1_000
_BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def importable(df: DataFrame) -> DataFrame:
    """``df``, whose Python workers find this package where the driver does,
    also if the session was started from another folder, and get batches of
    BATCH_ROWS rows unless the session asks for fewer."""
    settings = df.sparkSession.conf
    if int(settings.get(_BATCH_SETTING)) > BATCH_ROWS:
        settings.set(_BATCH_SETTING, str(BATCH_ROWS))
    root = str(Path(__file__).resolve().parents[2])
    known = df.sparkSession.sparkContext.environment
    paths = [p for p in known.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        known["PYTHONPATH"] = os.pathsep.join([*paths, root])
    return df


def arrow_rows(df: DataFrame, work: Callable, schema: str) -> DataFrame:
    """``mapInArrow`` over ``df``. ``work`` is a factory, called once per task;
    its step maps a record batch to column dictionaries and is called with None
    at the end, so that a step which holds rows back can give them out."""
    out = df.sparkSession.createDataFrame([], schema).schema
    names = out.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = work()
        arrow = _arrow_schema(out)
        for batch in itertools.chain(batches, [None]):
            for columns in step(batch):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns[n], type=arrow.field(n).type) for n in names], schema=arrow
                )

    return importable(df).mapInArrow(run, out)


def _arrow_schema(schema) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def grouped_arrow(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], work: Callable, schema: str
) -> DataFrame:
    """Run ``work`` on each group of integer ``keys``, many groups per call.

    Rows are dealt by the keys and sorted within the partition, so groups are
    runs of rows. ``work(table, starts)`` gets whole groups only; a group cut
    by a batch boundary waits for its rest. Groups must be bounded in size.
    """
    placed = df.repartition(*keys).sortWithinPartitions(*keys, *order)
    out = df.sparkSession.createDataFrame([], schema).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = _arrow_schema(out)
        held: list[pa.RecordBatch] = []
        last = None

        def emit(parts: list[pa.RecordBatch]):
            rows = pa.Table.from_batches(parts).combine_chunks()
            starts = np.append(_starts(rows, keys), rows.num_rows)
            columns = work(rows, starts)
            return pa.RecordBatch.from_arrays(
                [pa.array(columns[f.name], type=f.type) for f in arrow], schema=arrow
            )

        for batch in batches:
            if not batch.num_rows:
                continue
            first = tuple(batch.column(k)[0].as_py() for k in keys)
            end = tuple(batch.column(k)[batch.num_rows - 1].as_py() for k in keys)
            if first == end:
                if held and last != first:
                    yield emit(held)
                    held = []
                held.append(batch)
            else:
                cut = int(_starts(pa.Table.from_batches([batch]), keys)[-1])
                yield emit([*held, batch.slice(0, cut)])
                held = [batch.slice(cut)]
            last = end
        if held:
            yield emit(held)

    return importable(placed).mapInArrow(run, out)


def _starts(rows: pa.Table, keys: Sequence[str]) -> np.ndarray:
    """Row numbers at which the key changes, 0 included."""
    new = np.zeros(rows.num_rows, bool)
    new[0] = True
    for key in keys:
        values = rows.column(key).to_numpy()
        new[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(new)


def lists(values: np.ndarray, offsets: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values))


def block_pairs(members: DataFrame, key: str, member: str, size: int) -> DataFrame:
    """Deal each group of ``key`` into pairs of blocks of about ``size`` members.

    Every two members of a group meet in exactly one (key, left, right). A group
    of g rows gives g * ceil(g / size) rows, in tasks of at most two blocks, so
    no group is ever held whole. Groups of one member are left out.
    """
    sizes = members.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    dealt = members.join(sizes, key).withColumn(
        "_of", F.ceil(F.col("_n") / size).cast("long")
    )
    own = F.pmod(F.xxhash64(F.lit(17), member), F.col("_of"))
    return (
        dealt.withColumn("_own", own)
        .withColumn("_other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_of") - 1)))
        .withColumn("left", F.least("_own", "_other"))
        .withColumn("right", F.greatest("_own", "_other"))
        .drop("_n", "_of", "_other")
    )
