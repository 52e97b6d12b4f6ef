"""Joins on keys of which a few hold a large share of the rows.

A sketch finds the heavy keys of the large side; they are counted exactly. Rows
of the other keys join as usual. Rows of heavy keys either meet a broadcast of
their matches, if these are counted to be small, or are salted: dealt out by a
hash over many tasks, with a copy of the matches for each salt. Null keys match
nothing, so they take no part in any shuffle. No row is left out on any way.

Unlike the splitting of skewed partitions that Spark does by itself, this also
works where a side comes from an aggregation on the key.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veritrail.sources.scratch import materialise

#: Keys that the sketch keeps track of; every key with over one in that many
#: rows is among them.
TRACKED = 1_000
#: A key is heavy if it holds more than this share of the rows.
HEAVY_SHARE = 0.02
#: Matches of heavy keys up to this counted size are broadcast.
BROADCAST_BYTES = 16 << 20
ROWS_PER_SALT = 200_000


def _hash(on: Sequence[str]) -> Column:
    return F.xxhash64(*on)


def _known(on: Sequence[str]) -> Column:
    return reduce(Column.__and__, (F.col(c).isNotNull() for c in on))


def heavy_keys(df: DataFrame, on: Sequence[str], share: float = HEAVY_SHARE) -> DataFrame:
    """(key hash, rows) of the keys that hold more than ``share`` of the rows.
    The sketch's candidates, at most TRACKED, are counted exactly."""
    rows = df.where(_known(on)).select(_hash(on).alias("_key"))
    most = min(TRACKED, int(2 / share))
    top = rows.agg(
        F.expr(f"approx_top_k(_key, {most}, {TRACKED})").alias("_top"),
        F.count(F.lit(1)).alias("_all"),
    ).head()
    # The sketch's counts are never too small.
    found = [r[0] for r in top["_top"] or [] if r[1] > share * top["_all"]]
    candidates = df.sparkSession.createDataFrame([(k,) for k in found], "_key long")
    return (
        rows.join(F.broadcast(candidates), "_key")
        .groupBy("_key")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .where(F.col("_rows") > share * top["_all"])
    )


def skew_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    *,
    share: float = HEAVY_SHARE,
    broadcast_bytes: int = BROADCAST_BYTES,
    rows_per_salt: int = ROWS_PER_SALT,
) -> DataFrame:
    """``left.join(right, on, how)`` for ``inner`` and ``left``, where keys of
    ``left`` may be heavy. Both sides are read several times: give stored tables
    where they are dear to compute."""
    if how not in ("inner", "left"):
        raise ValueError(f"skew_join does not do {how} joins")
    on = [on] if isinstance(on, str) else list(on)
    columns = left.join(right, on, how).columns
    heavy = materialise(heavy_keys(left, on, share), "heavy-keys")
    if not heavy.take(1):
        return left.join(right, on, how).select(columns)
    # At most 1 / share rows.
    keys = F.broadcast(heavy)
    left_rows = left.where(_known(on)).withColumn("_key", _hash(on))
    right_rows = right.where(_known(on)).withColumn("_key", _hash(on))
    light = left_rows.join(keys, "_key", "left_anti").drop("_key")
    light = light.join(right_rows.join(keys, "_key", "left_anti").drop("_key"), on, how)
    matches = materialise(right_rows.join(keys, "_key").drop("_key"), "heavy-matches")
    size = matches.agg(F.coalesce(F.sum(F.length(F.to_json(F.struct("*"))) + 64), F.lit(0))).head()[0]
    hot = left_rows.join(keys, "_key").drop("_key")
    if size <= broadcast_bytes:
        joined = hot.drop("_rows").join(F.broadcast(matches.drop("_rows")), on, how)
    else:
        salts = F.ceil(F.col("_rows") / rows_per_salt).cast("int")
        dealt = hot.withColumn("_salt", F.pmod(F.xxhash64(*left.columns), salts).cast("int"))
        copies = matches.withColumn("_salt", F.explode(F.sequence(F.lit(0), salts - 1)))
        joined = dealt.drop("_rows").join(copies.drop("_rows"), [*on, "_salt"], how).drop("_salt")
    out = light.select(columns).unionByName(joined.select(columns))
    if how == "left":
        alone = left.where(~_known(on))
        out = out.unionByName(alone, allowMissingColumns=True)
    return out.select(columns)
