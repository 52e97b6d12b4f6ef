"""Shared scratch storage for intermediate tables.

The cluster names a shared folder in ``spark.checkpoint.dir``; everything
temporary goes there, so any executor (or its replacement) can read it. A local
session without that setting, as in tests, gets a folder below its warehouse; on
a cluster the setting has to be there, for no other folder is known to be shared.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_REMOVE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def scratch_root(spark: SparkSession) -> str:
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    return root.rstrip("/")


def new_scratch_dir(spark: SparkSession, label: str) -> str:
    """A path below the scratch root that nothing else uses."""
    return f"{scratch_root(spark)}/veritrail/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as Parquet in shared storage and read it back.

    Used where several jobs need the same frame: lineage ends at files that
    outlive any executor, and later scans still prune columns.
    """
    path = new_scratch_dir(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Inside, Spark removes the shuffle files of a job when it ends. Otherwise they
    lie on the executors' disks until the driver happens to collect garbage, which
    over a run of many writes is the sum of all its shuffles."""
    before = spark.conf.get(_REMOVE_SHUFFLES)
    spark.conf.set(_REMOVE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(_REMOVE_SHUFFLES, before)
