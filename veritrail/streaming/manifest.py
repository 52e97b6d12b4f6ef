"""Tables written batch by batch, with a manifest.

A micro-batch goes to a folder of its own, named after the batch id. While it is
written its rows and failures are observed, and a manifest record with these
counts then makes the batch part of the table. Readers follow the manifest, so

* a repeated batch is skipped if its record is there,
* a write that died, or died before its record, is written over,
* counting reads the records only, and a run's rows only the run's folders.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# Stored batches are kept, so they are packed closer than Parquet's usual level does.
PACKED = {"compression": "zstd", "parquet.compression.codec.zstd.level": "9"}
RECORD = "batch long, run string, rows long, measures map<string,long>"


class BatchTable:
    """The table below ``root``. The rows of a stored file are sorted by ``near``,
    as far as a batch has these columns: what repeats with a key is then packed to
    a fraction. Sorting stays within a task, so nothing is shuffled for it."""

    def __init__(self, spark: SparkSession, root: str, near: Sequence[str] = ()):
        self.spark, self.root, self.near = spark, root, near

    def records(self) -> DataFrame:
        """(batch, run, rows, measures), one row per batch of the table. Folders
        that begin with an underscore are no data to Spark's readers."""
        try:
            return self.spark.read.schema(RECORD).json(f"{self.root}/_manifest/*")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], RECORD)

    def prepare(self) -> None:
        """An empty manifest, where there is none yet."""
        first = f"{self.root}/_manifest/none"
        self.spark.createDataFrame([], RECORD).write.mode("ignore").json(first)

    def write(
        self, rows: DataFrame, batch: int, run: str = "", measures: Sequence[Column] = ()
    ) -> bool:
        """Store a batch; False if the table has it already."""
        if self.records().where(F.col("batch") == batch).take(1):
            return False
        seen, near = Observation(), [c for c in self.near if c in rows.columns]
        placed = rows.sortWithinPartitions(*near) if near else rows
        counted = placed.observe(seen, F.count(F.lit(1)).alias("rows"), *measures)
        counted.write.mode("overwrite").options(**PACKED).parquet(self._folder(batch))
        found = {k: int(n or 0) for k, n in seen.get.items()}
        record = (batch, run, found.pop("rows"), found)
        self.spark.createDataFrame([record], RECORD).coalesce(1).write.mode("overwrite").json(
            f"{self.root}/_manifest/batch-{batch}"
        )
        return True

    def _folder(self, batch: int) -> str:
        return f"{self.root}/batch-{batch}"

    def read(self, run: str | None = None, *, merge_schema: bool = False) -> DataFrame | None:
        """The table's rows, or those of a run; None if it has no batches."""
        records = self.records() if run is None else self.records().where(F.col("run") == run)
        batches = [r[0] for r in records.select("batch").orderBy("batch").collect()]
        reader = self.spark.read.option("mergeSchema", merge_schema)
        return reader.parquet(*map(self._folder, batches)) if batches else None

    def counted(self, run: str | None = None) -> tuple[int, dict[str, int]]:
        """Rows and measures, summed over the table's records or a run's."""
        records = self.records() if run is None else self.records().where(F.col("run") == run)
        rows = records.agg(F.coalesce(F.sum("rows"), F.lit(0))).head()[0]
        sums = (
            records.select(F.explode("measures").alias("name", "n"))
            .groupBy("name")
            .agg(F.sum("n").alias("n"))
        )
        return rows, {r.name: r.n for r in sums.collect()}
