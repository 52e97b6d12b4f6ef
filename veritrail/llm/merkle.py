"""Merkle manifest of a dataset, with proofs by pointer jumping.

Every row is a leaf, a digest over its columns. The leaves of a source, in
order, are the lowest level of its tree; runs of FANOUT consecutive nodes become
their digest until one is left, the subroot. The subroots, ordered by source,
are the leaves of a top tree, whose last node is the root.

Ranks come from a range partitioning: a row's place in its partition plus the
rows of the same tree in partitions before it. A tree is folded DEEP levels at a
time in blocks of FANOUT ** DEEP neighbours, which also tell each node its
siblings. Every inner node then holds the segment of siblings towards an
ancestor; joining the nodes with themselves doubles the distance and joins the
segments, so the number of joins is the logarithm of the height. Leaves take the
finished segment of their parent last, for they are most of the nodes. An
ancestor at distance d has at most FANOUT ** d nodes that jump to it; the far
ancestors are few and are broadcast while their counted size allows it.

Defined results: a null value is ``-`` in a digest; a null order or source sorts
first and null sources are one tree; rows that are equal in order value are
ordered by digest, and equal rows are leaves of their own; a tree of one leaf
has that leaf as subroot, with an empty segment; one source alone has its
subroot as root; an empty table gives an empty result. Internal names cannot
clash, as only named columns are read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veritrail.sources.scratch import materialise

FANOUT = 3
#: Levels folded in one pass over a tree.
DEEP = 4
#: Counted size up to which the ancestors of a round are broadcast.
BROADCAST_BYTES = 16 << 20
#: Tree of the subroots; sources are numbered from 0.
TOP = -1

_PATH = "array<struct<at:int,siblings:binary>>"


def digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def leaf(*values: Column) -> Column:
    """Digest of a row: each value with its UTF-8 length before it."""
    texts = [v.cast("string") for v in values]
    parts = [
        F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-"))
        for t in texts
    ]
    return digest(F.concat(*parts))


def proof_text(path: Column) -> Column:
    """All siblings as hex text, from the leaf's own level up, left to right."""
    raw = F.transform(path, lambda step: F.lower(F.hex(step["siblings"])))
    return F.array_join(raw, "")


def folded(leaf: Column, path: Column) -> Column:
    """The root that ``leaf`` leads to with the siblings of ``path``."""

    def up(node, step):
        hexed = F.lower(F.hex(step["siblings"]))
        before = step["at"] * 64
        return digest(
            F.concat(F.substring(hexed, F.lit(1), before), node, hexed.substr(before + 1, F.lit(2**20)))
        )

    return F.aggregate(path, leaf, up)


def _ranked(nodes: DataFrame, tree: str | None, order: Sequence[Column]) -> DataFrame:
    """``nodes`` with ``rank`` from 0 and ``size`` among the rows of their
    tree; no tree: among all. ``nodes`` must be a stored table."""
    spark = nodes.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    trees = F.col(tree) if tree else F.lit(TOP)
    nodes = nodes.select("*", trees.alias("_tree"), F.monotonically_increasing_id().alias("_nth"))
    # The number of the row in the stored table tells equal rows apart.
    by = [F.col("_tree").asc_nulls_first(), *order, F.col("_nth").asc()]
    placed = materialise(
        nodes.repartitionByRange(parts, *by)
        .sortWithinPartitions(*by)
        .drop("_nth")
        .withColumn("_at", F.monotonically_increasing_id()),
        "placed",
    ).withColumn("_part", F.shiftright("_at", 33))
    before = Window.partitionBy("_tree").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = (
        placed.groupBy("_tree", "_part")
        .agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
        .select(
            F.col("_tree").alias("_t"),
            F.col("_part").alias("_p"),
            "_first",
            F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
            F.sum("_n").over(Window.partitionBy("_tree")).alias("size"),
        )
    )
    same = F.col("_tree").eqNullSafe(F.col("_t")) & (F.col("_part") == F.col("_p"))
    return placed.join(runs, same).select(
        *(c for c in placed.columns if c not in ("_tree", "_at", "_part")),
        (F.col("_before") + F.col("_at") - F.col("_first")).alias("rank"),
        "size",
    )


def _runs(nodes: Column) -> Column:
    """Digests of each FANOUT neighbours of an array of hex digests."""
    last = F.floor((F.size(nodes) - 1) / FANOUT).cast("int")
    return F.transform(
        F.sequence(F.lit(0), last),
        lambda i: digest(F.array_join(F.slice(nodes, i * FANOUT + 1, FANOUT), "")),
    )


def _steps(nodes: Column, level: int, first: Column) -> Column:
    """(level, rank, at, siblings) of each node of a level within a block."""

    def step(_, i):
        run = F.slice(nodes, F.floor(i / FANOUT).cast("int") * FANOUT + 1, FANOUT)
        others = F.filter(run, lambda _x, k: k != i % FANOUT)
        return F.struct(
            F.lit(level).alias("level"),
            (first + i).alias("rank"),
            (i % FANOUT).cast("int").alias("at"),
            F.unhex(F.array_join(others, "")).alias("siblings"),
        )

    return F.transform(nodes, step)


def build(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Trees over ``nodes`` (tree, rank, size, node: hex digest).

    Gives the steps (tree, level, rank, at, siblings) of all nodes below the
    last one of their tree, and that last one (tree, height, node).
    """
    nodes = nodes.select("tree", "rank", "size", "node")
    largest = nodes.agg(F.max("size")).head()[0] or 0
    block = FANOUT**DEEP
    steps, tops, level = None, nodes.where("size = 1").select("tree", F.lit(0).alias("height"), "node"), 0
    work, size = nodes.where("size > 1"), largest
    while size > 1:
        own = F.floor(F.col("rank") / block)
        grouped = (
            work.groupBy("tree", own.alias("block"))
            .agg(
                F.sort_array(F.collect_list(F.struct("rank", "node")))["node"].alias("n0"),
                F.first("size").alias("size"),
            )
        )
        for k in range(1, DEEP + 1):
            # A level is above another one only while that has several nodes.
            more = F.col("size") > FANOUT ** (k - 1)
            grouped = grouped.withColumn(f"n{k}", F.when(more, _runs(F.col(f"n{k - 1}"))))
        folded_here = materialise(grouped, "folded")
        parts = [
            F.when(
                F.col(f"n{k}").isNotNull() & (F.col("size") > FANOUT**k),
                _steps(F.col(f"n{k}"), level + k, F.col("block") * FANOUT ** (DEEP - k)),
            )
            for k in range(DEEP)
        ]
        none = F.array().cast("array<struct<level:int,rank:bigint,at:int,siblings:binary>>")
        found = folded_here.select(
            "tree", F.inline(F.concat(*(F.coalesce(p, none) for p in parts)))
        )
        steps = found if steps is None else steps.union(found)
        for k in range(1, DEEP + 1):
            done = (F.col("size") <= FANOUT**k) & (F.col("size") > FANOUT ** (k - 1))
            tops = tops.union(
                folded_here.where(done).select(
                    "tree", F.lit(level + k).alias("height"), F.col(f"n{k}")[0].alias("node")
                )
            )
        work = folded_here.where(F.col("size") > block).select(
            "tree",
            F.col("block").alias("rank"),
            F.ceil(F.col("size") / block).alias("size"),
            F.col(f"n{DEEP}")[0].alias("node"),
        )
        level, size = level + DEEP, -(-size // block)
    if steps is None:
        steps = nodes.sparkSession.createDataFrame(
            [], "tree long, level int, rank long, at int, siblings binary"
        )
    return steps, tops


def _pointed(steps: DataFrame, trees: DataFrame) -> DataFrame:
    """Steps as nodes that point to their parent, null at the root."""
    known = steps.join(trees.select("tree", "height", "above"), "tree")
    inside = F.col("level") + 1 < F.col("height")
    up = F.when(
        inside,
        F.struct("tree", (F.col("level") + 1).alias("level"), F.floor(F.col("rank") / FANOUT).alias("rank")),
    ).when(
        F.col("above").isNotNull(),
        F.struct(F.lit(TOP).cast("long").alias("tree"), F.lit(0).alias("level"), F.col("above").alias("rank")),
    )
    return known.select(
        "tree", "level", "rank",
        F.array(F.struct("at", "siblings")).cast(_PATH).alias("path"),
        up["tree"].alias("to_tree"), up["level"].alias("to_level"), up["rank"].alias("to_rank"),
    )


def _targets(nodes: DataFrame) -> DataFrame:
    return nodes.select(
        F.col("tree").alias("to_tree"),
        F.col("level").alias("to_level"),
        F.col("rank").alias("to_rank"),
        F.col("path").alias("_path"),
        F.struct("to_tree", "to_level", "to_rank").alias("_to"),
    )


def _jump(nodes: DataFrame, targets: DataFrame) -> DataFrame:
    """``nodes`` moved to where the node they point to points."""
    kept = [c for c in nodes.columns if not c.startswith("to_") and c != "path"]
    moved = nodes.join(targets, ["to_tree", "to_level", "to_rank"], "left")
    return moved.select(
        *kept,
        F.concat("path", F.coalesce("_path", F.array().cast(_PATH))).alias("path"),
        *(F.col("_to")[c].alias(c) for c in ("to_tree", "to_level", "to_rank")),
    )


def paths_to_root(nodes: DataFrame) -> DataFrame:
    """``nodes`` with the whole path to the root, by doubling."""
    nodes, distance = materialise(nodes, "pointers"), 1
    while nodes.where("to_tree is not null").take(1):
        far = nodes.where((F.col("level") >= distance) | (F.col("tree") == TOP))
        bytes_each = 100 + 72 * distance
        small = far.count() * bytes_each <= BROADCAST_BYTES
        targets = _targets(far)
        nodes = materialise(_jump(nodes, F.broadcast(targets) if small else targets), "pointers")
        distance *= 2
    return nodes


def manifest(
    docs: DataFrame,
    columns: Sequence[str],
    source: str = "source",
    order: str = "doc_id",
    keep: Sequence[str] = (),
) -> DataFrame:
    """One row per row of ``docs``: ``source``, ``order``, the columns ``keep``,
    ``leaf``, ``subroot``, ``root`` and the proof ``path``, an array of the
    node's place in its run and the run's other digests per level."""
    kept = list(dict.fromkeys([source, order, *keep]))
    names = {c: f"c{i}" for i, c in enumerate(kept)}
    leaves = materialise(
        docs.select(
            *(F.col(f"`{c}`").alias(n) for c, n in names.items()),
            leaf(*(F.col(f"`{c}`") for c in columns)).alias("node"),
        ),
        "leaves",
    )
    group, by = names[source], names[order]
    ranked = materialise(
        _ranked(leaves, group, [F.col(by).asc_nulls_first(), F.col("node").asc()]), "ranked"
    )
    # Sources in order; their number is their tree and their rank at the top.
    sources = materialise(ranked.where("rank = 0").select(group, "size"), "sources")
    numbered = materialise(
        _ranked(sources.select(group), None, [F.col(group).asc_nulls_first()]).select(
            F.col(group).alias("_source"), F.col("rank").alias("tree"), F.col("size").alias("trees")
        ),
        "numbered",
    )
    leaves = materialise(
        ranked.join(numbered, F.col(group).eqNullSafe(F.col("_source"))).drop("_source", "trees"),
        "leaves",
    )
    steps, tops = build(leaves)
    tops = materialise(tops, "subroots")
    top_nodes = tops.join(numbered, "tree").select(
        F.lit(TOP).cast("long").alias("tree"), F.col("tree").alias("rank"),
        F.col("trees").alias("size"), "node",
    )
    top_steps, root = build(materialise(top_nodes, "top"))
    # One row; none if there are no documents.
    height, last = (root.select("height", "node").head() or (0, None))
    trees = tops.select(
        "tree", "height", F.col("node").alias("subroot"), F.lit(last).cast("string").alias("root"),
        F.when(F.lit(height > 0), F.col("tree")).alias("above"),
    )
    roots = trees.select("tree", "height", "above").union(
        tops.sparkSession.createDataFrame(
            [(TOP, height, None)], "tree long, height int, above long"
        )
    )
    all_steps = materialise(_pointed(steps.union(top_steps), roots), "steps")
    inner = paths_to_root(all_steps.where(f"level > 0 or tree = {TOP}"))
    # A lone leaf has no step: it is its source's leaf at the top.
    first = all_steps.where(f"level = 0 and tree <> {TOP}").union(
        trees.where("height = 0").select(
            "tree", F.lit(0).alias("level"), F.lit(0).cast("long").alias("rank"),
            F.array().cast(_PATH).alias("path"),
            F.when(F.col("above").isNotNull(), F.lit(TOP).cast("long")),
            F.when(F.col("above").isNotNull(), F.lit(0)), "above",
        )
    )
    proofs = _jump(first, _targets(inner)).select("tree", "rank", "path")
    return (
        leaves.join(proofs, ["tree", "rank"])
        .join(trees.select("tree", "subroot", "root"), "tree")
        .select(
            *(F.col(n).alias(c) for c, n in names.items()),
            F.col("node").alias("leaf"), "subroot", "root", "path",
        )
    )
