"""Landing files: writes entity rows the way an export would deliver them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


# Landed text takes a tenth of its size as gzip. Such a file is read by one task,
# so a file ends after this many rows. CSV is written at the fastest level; JSON
# repeats its names in every line, and gzip's usual level takes a third off, but for
# text that goes as soon as it is taken in that costs more time than it is worth.
FILE_ROWS = 500_000
FAST, USUAL = "BEST_SPEED", "SIX"


def _writer(df: DataFrame, mode: str, level: str):
    return (
        df.write.mode(mode)
        .option("compression", "gzip")
        .option("zlib.compress.level", level)
        .option("maxRecordsPerFile", FILE_ROWS)
    )


def land_csv(df: DataFrame, path: str, *, mode: str = "append") -> str:
    """CSV with header; leading blanks are data here, so they are kept."""
    writer = _writer(df, mode, FAST).option("header", True)
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return path


def land_json(df: DataFrame, path: str, *, mode: str = "append", level: str = USUAL) -> str:
    _writer(df, mode, level).json(path)
    return path


def empty(spark: SparkSession, path: str) -> None:
    """Put one empty file in the place of all files at ``path``. For a delivery that
    was taken in as a whole, while nothing new lands."""
    spark.createDataFrame([], "value string").coalesce(1).write.mode("overwrite").text(path)


def deliveries(df: DataFrame, row_id: str, count: int = 2) -> list[DataFrame]:
    """The rows of ``df`` dealt out over ``count`` deliveries by a hash of the id."""
    turn = F.pmod(F.xxhash64(row_id), F.lit(count))
    return [df.where(turn == i) for i in range(count)]
