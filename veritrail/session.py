"""Session settings the jobs are written for."""

from __future__ import annotations

import re
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Let AQE size the shuffles and split skewed partitions; dates are UTC days.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


def build_session(app: str, master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


# Compressed text and columns grow about tenfold in a task's memory.
TASK_BYTES = 32 << 20
SIZES = ("spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes")
SPREAD = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
SHUFFLED = "spark.sql.shuffle.partitions"
# So many at least; what is too small is put together again.
LEAST_SPREAD = 64


def _bytes(size: str) -> int:
    number, unit = re.fullmatch(r"(\d+)([a-z]*)", size.strip().lower()).groups()
    return int(number) << 10 * "bkmgtp".index(unit[:1] or "b")


@contextmanager
def bounded_tasks(spark: SparkSession) -> Iterator[None]:
    """Inside, a task takes at most ``TASK_BYTES`` of the files or shuffles it reads, as
    far as these can be split, so that it sorts and groups its rows in memory however
    large the tables are. A session that asks for less keeps what it asks for."""
    conf = spark.conf
    before = {key: conf.get(key, None) for key in (*SIZES, SPREAD)}
    spread = int(before[SPREAD] or conf.get(SHUFFLED))
    after = {key: str(min(_bytes(conf.get(key)), TASK_BYTES)) for key in SIZES}
    for key, value in {**after, SPREAD: str(max(spread, LEAST_SPREAD))}.items():
        conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            conf.unset(key) if value is None else conf.set(key, value)
