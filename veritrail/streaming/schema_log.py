"""Versioned schemas of landed CSV files.

The log of an entity holds versions of its column list. Every file is read by
its own header: columns of the current version go where the version has them,
missing ones are null, and values of columns that it does not know are kept in a
map by column name. A column of the map can be promoted: that is a new version,
for the files to come; rows stored before read as they did.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veritrail.sources.audit import with_audit
from veritrail.sources.readers import read_csv
from veritrail.sources.schemas import text_schema

RESCUED = "_rescued"
VERSION = "_schema_version"
LOGGED = "version long, columns array<string>"


class SchemaLog:
    def __init__(self, spark: SparkSession, location: str):
        self.spark, self.location = spark, location

    def versions(self) -> DataFrame:
        try:
            return self.spark.read.schema(LOGGED).json(f"{self.location}/version-*")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], LOGGED)

    def prepare(self) -> None:
        """An empty log, where there is none yet."""
        first = f"{self.location}/version-none"
        self.spark.createDataFrame([], LOGGED).write.mode("ignore").json(first)

    def current(self) -> tuple[int, list[str]] | None:
        last = self.versions().where("columns is not null").orderBy(F.desc("version")).head()
        return (last.version, list(last.columns)) if last else None

    def add(self, columns: Sequence[str]) -> int:
        """A version with these columns; the same one again if nothing changes."""
        last = self.current()
        if last and last[1] == list(columns):
            return last[0]
        number = last[0] + 1 if last else 0
        frame = self.spark.createDataFrame([(number, list(columns))], LOGGED)
        frame.coalesce(1).write.mode("overwrite").json(f"{self.location}/version-{number}")
        return number

    def promote(self, *columns: str) -> int:
        """Columns that later files bring get a place of their own."""
        _, known = self.current()
        return self.add([*known, *(c for c in columns if c not in known)])


def header_lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(path, header): the first line of every file, itself null if empty."""
    lines = spark.read.text(list(paths)).select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"),
        "value",
    )
    return lines.where("block = 0").groupBy("path").agg(F.min_by("value", "at").alias("header"))


def resolved(files: DataFrame, header: Sequence[str], version: int, columns: Sequence[str]):
    """Rows of files with one header, in the columns of a version."""
    audit = [c for c in files.columns if c not in header]
    known = [
        (F.col(f"`{c}`") if c in header else F.lit(None).cast("string")).alias(c) for c in columns
    ]
    pairs = [x for c in header if c not in columns for x in (F.lit(c), F.col(f"`{c}`"))]
    none = F.lit(None).cast("map<string,string>")
    rescued = F.map_filter(F.create_map(*pairs), lambda _, x: x.isNotNull()) if pairs else none
    return files.select(
        *known,
        *audit,
        (F.when(F.size(rescued) > 0, rescued) if pairs else none).alias(RESCUED),
        F.lit(version).cast("long").alias(VERSION),
    )


def read_files(spark: SparkSession, paths: Sequence[str], log: SchemaLog) -> DataFrame:
    """The rows of CSV files, each read by its own header. Files with the same
    header are read together, so the plan grows with the number of headers."""
    found = header_lines(spark, paths).where("trim(header) <> ''")
    groups = found.groupBy("header").agg(F.collect_list("path").alias("paths")).collect()
    headers = [read_csv(spark, g.paths[0], infer=False).columns for g in groups]
    if log.current() is None:
        log.add(headers[0])
    version, columns = log.current()
    parts = [
        resolved(
            with_audit(read_csv(spark, g.paths, schema=text_schema(h)), file=True), h, version, columns
        )
        for g, h in zip(groups, headers)
    ]
    return reduce(DataFrame.unionByName, parts)
