"""A fitted forest as a table of nodes, and scoring by joins.

The nodes come from the model as Spark ML stores it. A row starts at the root of
every tree; each join with the nodes moves it to the child that its features
choose, until it stands on a leaf in all trees. A leaf's class shares are the
tree's vote. Nodes are bounded by the number of trees and their depth, so they
are broadcast. Rows that no split tells apart stand on the same leaves: they walk
once, as a cell between the thresholds of the forest, and take the cell's score by
a join. Cells follow the splits of the forest, not the rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veritrail.sources.scratch import materialise, new_scratch_dir


def nodes(model: PipelineModel) -> DataFrame:
    """(tree, node, feature, threshold, categories, left, right, share): splits
    on a number have a threshold, splits on categories those that go left;
    leaves have the share of the second class and no feature."""
    spark = SparkSession.active()
    place = new_scratch_dir(spark, "forest")
    model.stages[-1].write().save(place)
    stored = spark.read.parquet(f"{place}/data").select("treeID", "nodeData.*")
    is_leaf = F.col("leftChild") < 0
    values = F.col("split.leftCategoriesOrThreshold")
    numeric = F.col("split.numCategories") < 0
    total = F.aggregate("impurityStats", F.lit(0.0), lambda a, x: a + x)
    return stored.select(
        F.col("treeID").alias("tree"),
        F.col("id").alias("node"),
        F.when(~is_leaf, F.col("split.featureIndex")).alias("feature"),
        F.when(~is_leaf & numeric, values[0]).alias("threshold"),
        F.when(~is_leaf & ~numeric, values).alias("categories"),
        F.when(~is_leaf, F.col("leftChild")).alias("left"),
        F.when(~is_leaf, F.col("rightChild")).alias("right"),
        F.when(is_leaf, F.col("impurityStats")[1] / total).alias("share"),
    )


def _next(x: Column) -> Column:
    value = F.get(x, F.col("feature"))
    goes_left = F.when(
        F.col("threshold").isNotNull(), value <= F.col("threshold")
    ).otherwise(F.array_contains("categories", value))
    return F.when(goes_left, F.col("left")).otherwise(F.col("right"))


def scores(
    features: DataFrame, tree_nodes: DataFrame, inputs: Sequence[str], keep: Sequence[str]
) -> DataFrame:
    """(keep, risk_score): the mean share of the second class over all trees.
    ``features`` holds the model's inputs as numbers."""
    placed = materialise(tree_nodes, "forest-nodes")
    trees = placed.agg(F.max("tree")).head()[0] + 1
    x = [_cell(F.col(c).cast("double"), t) for c, t in zip(inputs, _thresholds(placed, len(inputs)))]
    rows = materialise(features.select(*keep, F.array(*x).alias("_x")), "forest-rows")
    cells = materialise(rows.select("_x").distinct(), "forest-cells")
    at = cells.withColumn(
        "tree", F.explode(F.sequence(F.lit(0), F.lit(trees - 1)))
    ).withColumn("node", F.lit(0))
    found = F.broadcast(placed)
    for _ in range(_depth(placed)):
        moved = at.join(found, ["tree", "node"])
        stay = F.col("feature").isNull()
        at = moved.select(
            *at.columns[:-1], F.when(stay, F.col("node")).otherwise(_next(F.col("_x"))).alias("node")
        )
    leaves = at.join(found, ["tree", "node"])
    scored = leaves.groupBy("_x").agg((F.sum("share") / trees).alias("risk_score"))
    return rows.join(materialise(scored, "cell-scores"), "_x").select(*keep, "risk_score")


def _thresholds(placed: DataFrame, inputs: int) -> list[list[float]]:
    """Per feature the thresholds of its splits, ascending; a forest has fewer
    per feature than bins. None for a feature that is split on categories."""
    found = placed.where("threshold is not null").groupBy("feature")
    by = dict(found.agg(F.sort_array(F.collect_set("threshold")).alias("t")).collect())
    return [by.get(i, []) for i in range(inputs)]


def _cell(value: Column, thresholds: Sequence[float]) -> Column:
    """What stands for all values that every split sends the same way: the least
    threshold they do not exceed, else infinity, as for null, which goes right
    everywhere. A feature without thresholds stands for itself."""
    if not thresholds:
        return F.coalesce(value, F.lit(float("nan")))
    return reduce(
        lambda above, t: F.when(value <= t, F.lit(t)).otherwise(above),
        reversed(thresholds),
        F.lit(float("inf")),
    )


def _depth(placed: DataFrame) -> int:
    """Moves from the root to the deepest leaf: levels of the node table."""
    level, depth = placed.where("node = 0"), 0
    while True:
        children = level.select("tree", F.explode(F.array("left", "right")).alias("node"))
        level = materialise(children.where("node is not null").join(placed, ["tree", "node"]), "level")
        if not level.take(1):
            return depth
        depth += 1
