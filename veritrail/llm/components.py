"""Connected components of an edge list, kept distributed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veritrail.sources.scratch import materialise


def _digest(edges: DataFrame):
    return edges.agg(
        F.count(F.lit(1)), F.coalesce(F.sum(F.xxhash64("big", "small") % 1_000_003), F.lit(0))
    ).head()


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node moves to the node's smallest neighbour."""
    both = edges.select(F.col("big").alias("u"), F.col("small").alias("v")).union(
        edges.select(F.col("small").alias("u"), F.col("big").alias("v"))
    )
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    least = materialise(least, "least")
    moved = both.where("v > u").join(least, "u")
    return moved.select(F.col("v").alias("big"), F.col("m").alias("small")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours move to the smallest of them."""
    least = materialise(edges.groupBy("big").agg(F.min("small").alias("m")), "least")
    moved = edges.join(least, "big")
    return (
        moved.where("small <> m")
        .select(F.col("small").alias("big"), F.col("m").alias("small"))
        .union(least.select("big", F.col("m").alias("small")))
        .distinct()
    )


def components(edges: DataFrame, left: str, right: str) -> DataFrame:
    """(node, component) for every node that has an edge; component is the
    smallest node it can reach.

    Alternates the two star steps until every component is one star. Minima
    are combined before the shuffle and stored, so each join is one of two
    tables straight from their shuffles and Spark can split a hub's rows. Each
    round is written to shared storage, which
    cuts the lineage. Self loops and repeated edges are harmless; an edge with
    a null end is ignored.
    """
    a, b = F.col(left).cast("long"), F.col(right).cast("long")
    edges = (
        edges.select(F.greatest(a, b).alias("big"), F.least(a, b).alias("small"))
        .where("big is not null and small is not null and big <> small")
        .where(a.isNotNull() & b.isNotNull())
        .distinct()
    )
    edges = materialise(edges, "edges")
    seen = _digest(edges)
    while seen[0]:
        edges = materialise(_small_star(_large_star(edges)), "stars")
        now = _digest(edges)
        if now == seen:
            break
        seen = now
    return edges.select(F.col("big").alias("node"), F.col("small").alias("component")).union(
        edges.select(F.col("small").alias("node"), F.col("small").alias("component")).distinct()
    )
