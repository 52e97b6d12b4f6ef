"""Incremental file ingestion.

Every run processes what is new since the checkpoint and stops. Checkpoints,
schemas and tables live under one shared store folder, so a rerun after a lost
executor or driver continues where the last committed batch ended.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from veritrail.sources.audit import with_audit
from veritrail.sources.readers import read_csv
from veritrail.sources.schemas import text_schema
from veritrail.streaming.manifest import BatchTable
from veritrail.streaming.schema_log import SchemaLog, read_files


# A run works through its backlog in batches of this many files, so a restart
# repeats at most one batch.
FILES_PER_BATCH = 10_000


def remembered_schema(spark: SparkSession, path: str, location: str) -> StructType:
    """Schema of the CSV files at ``path``: read once, then always the same.

    The first call takes the column names from a file header (all columns
    text, so no data row is read) and stores them at ``location``; later calls
    return the stored schema.
    """
    stored = _stored_schema(spark, location)
    if stored is None:
        stored = text_schema(read_csv(spark, path, infer=False).columns)
        line = spark.createDataFrame([(stored.json(),)], "value string")
        line.coalesce(1).write.mode("overwrite").text(location)
    return stored


def _stored_schema(spark: SparkSession, location: str) -> StructType | None:
    """The stored schema; None if there is none, or only the folder of a write
    that died, which the next write replaces."""
    try:
        row = spark.read.text(location, wholetext=True).head()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return StructType.fromJson(json.loads(row[0])) if row else None


def _file_stream(spark: SparkSession, schema: StructType, files_per_batch: int):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)


def csv_stream(
    spark: SparkSession, path: str, schema: StructType, *, files_per_batch: int = FILES_PER_BATCH
) -> DataFrame:
    """New CSV files only. A file whose header disagrees with the schema stops
    the stream instead of putting values into the wrong columns."""
    reader = _file_stream(spark, schema, files_per_batch)
    return with_audit(
        reader.option("header", True).option("enforceSchema", False).csv(path), file=True
    )


def _clean_source(clean: bool) -> str:
    """With ``clean``, Spark deletes the files of a committed batch when the next
    one begins: what has been taken in need not lie in the landing folder too."""
    return "delete" if clean else "off"


def json_stream(
    spark: SparkSession,
    path: str,
    schema: StructType,
    *,
    files_per_batch: int = FILES_PER_BATCH,
    clean: bool = False,
) -> DataFrame:
    reader = _file_stream(spark, schema, files_per_batch)
    reader = reader.option("cleanSource", _clean_source(clean))
    return with_audit(reader.option("multiLine", False).json(path), file=True)


def table_stream(
    spark: SparkSession,
    path: str,
    *,
    files: str | None = None,
    schema: StructType | None = None,
    files_per_batch: int = FILES_PER_BATCH,
) -> DataFrame:
    """Rows added to a Parquet table folder since the last run, at any depth.
    ``files`` is a file-name pattern that picks one table out of a shared folder."""
    if schema is None:
        schema = spark.read.option("recursiveFileLookup", True).parquet(path).schema
    reader = _file_stream(spark, schema, files_per_batch).option("recursiveFileLookup", True)
    if files:
        reader = reader.option("pathGlobFilter", files)
    return reader.parquet(path)


@dataclass(frozen=True)
class Run:
    """A run that appends to ``table``; what it did is in the table's manifest."""

    query: StreamingQuery
    table: BatchTable
    run_id: str

    def wait(self, timeout: int | None = None) -> Run:
        """Until the backlog is done. After ``timeout`` seconds it is stopped;
        the batches committed so far stay and the next run goes on there."""
        if timeout is None:
            self.query.awaitTermination()
        elif not self.query.awaitTermination(timeout):
            self.query.stop()
            raise TimeoutError(f"ingestion into {self.table.root} did not finish in {timeout} s")
        return self

    def rows(self) -> DataFrame | None:
        """The rows that this run stored; None if there are none."""
        return self.table.read(self.run_id)

    def counted(self) -> tuple[int, dict[str, int]]:
        return self.table.counted(self.run_id)


def start_append(
    stream: DataFrame,
    target: str,
    checkpoint: str,
    *,
    measures: Sequence[Column] = (),
    prepare: Callable[[DataFrame], DataFrame] | None = None,
    near: Sequence[str] = (),
) -> Run:
    """Start appending everything available now to the table at ``target``.
    ``prepare`` turns a batch into the rows to store; ``measures`` are counted
    over these and kept in the manifest; ``near`` sorts the rows of a file."""
    table, run_id = BatchTable(stream.sparkSession, target, near), uuid.uuid4().hex
    table.prepare()

    def store(batch: DataFrame, number: int) -> None:
        table.write(prepare(batch) if prepare else batch, number, run_id, measures)

    query = (
        stream.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    return Run(query, table, run_id)


def append_available(
    stream: DataFrame, target: str, checkpoint: str, *, timeout: int | None = None, **options
) -> Run:
    return start_append(stream, target, checkpoint, **options).wait(timeout)


def rows_read(run: Run) -> int:
    return run.counted()[0]


def ingest_csv(
    spark: SparkSession, landing: str, store: str, entity: str, **options
) -> Run:
    """Landing CSV files -> bronze table of ``entity``."""
    return start_csv(spark, landing, store, entity, **options).wait()


def start_csv(spark: SparkSession, landing: str, store: str, entity: str, **options) -> Run:
    schema = remembered_schema(spark, landing, f"{store}/schemas/{entity}")
    stream = csv_stream(spark, landing, schema, **options)
    return start_append(
        stream, f"{store}/bronze/{entity}", f"{store}/checkpoints/bronze_{entity}"
    )


def ingest_json(
    spark: SparkSession, landing: str, store: str, entity: str, schema: StructType, **options
) -> Run:
    """Landing JSON-lines files -> bronze table of ``entity``."""
    return start_json(spark, landing, store, entity, schema, **options).wait()


def start_json(
    spark: SparkSession,
    landing: str,
    store: str,
    entity: str,
    schema: StructType,
    *,
    near: Sequence[str] = (),
    **options,
) -> Run:
    stream = json_stream(spark, landing, schema, **options)
    return start_append(
        stream, f"{store}/bronze/{entity}", f"{store}/checkpoints/bronze_{entity}", near=near
    )


_FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"


def start_evolving_csv(
    spark: SparkSession,
    landing: str,
    store: str,
    entity: str,
    *,
    files_per_batch: int = FILES_PER_BATCH,
    clean: bool = False,
    near: Sequence[str] = (),
) -> Run:
    """Like :func:`start_csv`, but every file is read by its own header against
    the entity's schema log, so a file with moved, new or missing columns does
    not stop the stream."""
    log = SchemaLog(spark, f"{store}/schema_log/{entity}")
    log.prepare()
    # Only the files' names are read here.
    names = (
        spark.readStream.format("binaryFile")
        .schema(_FILE_SCHEMA)
        .option("pathGlobFilter", "*.{csv,csv.gz}")
        .option("maxFilesPerTrigger", files_per_batch)
        .option("cleanSource", _clean_source(clean))
        .load(landing)
        .select("path")
    )
    return start_append(
        names,
        f"{store}/bronze/{entity}",
        f"{store}/checkpoints/bronze_{entity}",
        prepare=lambda batch: read_files(spark, [r[0] for r in batch.collect()], log),
        near=near,
    )


def ingest_evolving_csv(
    spark: SparkSession, landing: str, store: str, entity: str, **options
) -> Run:
    return start_evolving_csv(spark, landing, store, entity, **options).wait()


def bronze_table(
    spark: SparkSession, store: str, entity: str, *, evolving: bool = False
) -> DataFrame:
    """The stored batches. With ``evolving`` columns that a later schema version
    added are there too, null in the rows from before."""
    table = BatchTable(spark, f"{store}/bronze/{entity}")
    return table.read(merge_schema=evolving)


def without_audit(df: DataFrame) -> DataFrame:
    audit: Sequence[str] = [c for c in df.columns if c.startswith("_")]
    return df.drop(*audit)
