"""Batch readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_csv(
    spark: SparkSession,
    path: str,
    *,
    infer: bool = True,
    schema: StructType | None = None,
) -> DataFrame:
    """CSV with a header line.

    ``infer=True`` types the columns by reading every row once more before the
    real scan. That second pass is fine for catalogues; give ``schema`` for
    files where one extra full read is not affordable.
    """
    reader = spark.read.option("header", True)
    if schema is not None:
        return reader.schema(schema).csv(path)
    return reader.option("inferSchema", infer).csv(path)


def read_jsonl(spark: SparkSession, path: str, *, schema: StructType | None = None) -> DataFrame:
    """One JSON object per line, so a file can be split between tasks."""
    reader = spark.read.option("multiLine", False)
    return (reader.schema(schema) if schema is not None else reader).json(path)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)

