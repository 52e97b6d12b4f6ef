"""Table sinks and load counts."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def describe_table(
    spark: SparkSession,
    name: str,
    comment: str | None = None,
    properties: Mapping[str, str] | None = None,
) -> None:
    if comment is not None:
        spark.sql(f"COMMENT ON TABLE {name} IS {_quoted(comment)}")
    if properties:
        pairs = ", ".join(f"{_quoted(k)} = {_quoted(val)}" for k, val in properties.items())
        spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({pairs})")


def write_table(
    df: DataFrame,
    name: str,
    *,
    path: str | None = None,
    comment: str | None = None,
    properties: Mapping[str, str] | None = None,
    metrics: Sequence[Column] = (),
) -> dict[str, object]:
    """Replace table ``name`` with ``df`` and return what the write observed.

    Every write goes to a fresh folder below ``path`` (or the table's place in
    its database), and only a complete one becomes the table: a write that dies
    leaves the old table as it was. Old folders stay for the store's clean-up,
    so readers that started before the switch finish on them.

    Row count and any extra aggregate ``metrics`` are collected while the rows
    are written, so no second job reads the plan again just to count it.
    """
    seen = Observation()
    spark = df.sparkSession
    version = f"{path or _table_place(spark, name)}/version-{uuid.uuid4().hex}"
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"), *metrics)
    counted.write.option("compression", "zstd").parquet(version)
    _switch(spark, name, version, df.schema)
    describe_table(spark, name, comment, properties)
    return seen.get


def _table_place(spark: SparkSession, name: str) -> str:
    database, _, table = name.rpartition(".")
    rows = spark.sql(f"DESCRIBE DATABASE {database or spark.catalog.currentDatabase()}").collect()
    place = next(r[1] for r in rows if r[0] == "Location")
    return f"{place.rstrip('/')}/{table}"


def _plain(schema: StructType) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in schema]


def _switch(spark: SparkSession, name: str, version: str, schema: StructType) -> None:
    """Point the table at the folder; one of other columns is defined anew."""
    if spark.catalog.tableExists(name):
        if _plain(spark.table(name).schema) == _plain(schema):
            spark.sql(f"ALTER TABLE {name} SET LOCATION {_quoted(version)}")
            spark.catalog.refreshTable(name)
            return
        spark.sql(f"DROP TABLE {name}")
    spark.catalog.createTable(name, path=version, source="parquet", schema=schema)


def layer_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per table: one partial count per input, one row each."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)
