"""Hard negatives by threshold joins in the manner of L2AP.

All rows are dealt in blocks, anchors too, and every block of anchors meets
every block of rows: a stated query set against all rows. A pair of blocks is
joined above a score threshold per anchor. The rows of the block are indexed by
dimension, the ones with most weight first; a row's last dimensions stay out of
the index where the norm of that suffix times the anchors' cannot reach the
lowest threshold. Partial scores are summed dimension by dimension; a pair ends
as soon as its partial score plus the product of the remaining norms stays under
the anchor's threshold, and what the index left out is added for the survivors.

Anchors first look for their positives, then for negatives in a window of scores
under each positive. Thresholds start high and are lowered for the anchors and
windows that are not filled; what lies above a threshold is complete, so the
answer is exact. A block gives at most the best rows per anchor or window.

Scores are inner products of whole numbers, ``floor(scale * x)``.

Defined results: rows with a null id, label, vector, component or a component
that is not finite take no part, nor do empty vectors and those whose scaled
norm is 2**26 or more, as double precision holds sums of products exactly only
below 2**53; vectors of different lengths have no score and never pair; equal rows count once; rows that share an
id are not others to one another, but count as rows of their own elsewhere; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veritrail.llm.common import importable
from veritrail.sources.scratch import materialise

POSITIVES, NEGATIVES = 5, 3
#: Negatives' scores lie between these hundredths of the positive's.
LOWEST, HIGHEST = 50, 95
SCALE = 256
#: Components in a block of rows or anchors; vectors under 64 count as 64.
BLOCK = 4096 * 64
#: Anchors whose scores with a block are in memory at once.
TOGETHER = 256
#: Dimensions summed between two prunings.
STRIDE = 16
#: Thresholds for positives, as shares of the anchor's norm times the largest
#: norm; the last has no threshold.
STEPS = (0.8, 0.6, 0.4, 0.2, None)
#: Shares of a window that are searched, from its top.
SHARES = (0.125, 0.25, 0.5, 1.0)
#: Most tasks that the pairs of blocks of a round are dealt to.
MOST_TASKS = 20_000


def prepared(
    vectors: DataFrame, anchor: Column, vec_id: str, embedding: str, label: str, scale: int
) -> DataFrame:
    """(row, vec_id, label, v, dims, norm, anchor) of the rows that take part."""
    double = F.col(embedding).cast("array<double>")
    bad = F.exists(double, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
    some = (
        F.col(vec_id).isNotNull() & F.col(label).isNotNull()
        & F.coalesce(F.size(embedding) > 0, F.lit(False)) & F.coalesce(~bad, F.lit(False))
    )
    return (
        vectors.where(some)
        .select(
            F.col(vec_id).cast("long").alias("vec_id"),
            F.col(label).alias("label"),
            F.transform(double, lambda x: F.floor(x * scale).cast("double")).alias("v"),
            F.coalesce(anchor, F.lit(False)).alias("anchor"),
        )
        .withColumn("norm", norm)
        .where(F.col("norm") < 2.0**26)
        .withColumn("v", F.col("v").cast("array<long>"))
        .distinct()
        .select(
            F.monotonically_increasing_id().alias("row"), "*", F.size("v").alias("dims")
        )
    )


class Index:
    """Postings of a block's rows by dimension, without what a threshold covers.

    Rows are sorted by the number of their dimensions in the index, most first,
    so the postings of a dimension are the first ``listed`` rows.
    """

    def __init__(self, rows: np.ndarray, norms: np.ndarray, least: float):
        """``norms``: the largest norm of any anchor from each dimension on, in
        the order of ``weight_order``; ``least``: the lowest threshold."""
        d = rows.shape[1]
        self.rest = suffix_norms(rows)
        covered = _upper(self.rest * norms) < least
        # Suffix norms fall, so the first covered dimension starts the suffix.
        cut = np.where(covered.any(axis=1), covered.argmax(axis=1), d)
        self.order = np.argsort(-cut, kind="stable")
        self.cut, self.rest, self.rows = cut[self.order], self.rest[self.order], rows[self.order]
        self.listed = np.searchsorted(-self.cut, -np.arange(d), "left")
        self.indexed = np.where(np.arange(d) < self.cut[:, None], self.rows, 0)


def _upper(bound: np.ndarray) -> np.ndarray:
    """A bound in floating point, raised by more than its rounding errors."""
    return bound * (1 + 1e-9) + 0.25


def suffix_norms(rows: np.ndarray) -> np.ndarray:
    """Norm of each row from each dimension on, and 0 at the end."""
    squares = np.square(rows)[:, ::-1].cumsum(axis=1)[:, ::-1]
    return np.sqrt(np.pad(squares, ((0, 0), (0, 1))))


def above(anchors: np.ndarray, rows: np.ndarray, least: np.ndarray):
    """(anchor, row, score) of all pairs whose score reaches the anchor's
    threshold, -inf for none; whole numbers as doubles."""
    by_weight = np.argsort(-np.square(rows).sum(axis=0), kind="stable")
    anchors, rows = anchors[:, by_weight], rows[:, by_weight]
    rest = suffix_norms(anchors)
    index = Index(rows, rest.max(axis=0), least.min())
    for at in range(0, len(anchors), TOGETHER):
        own = slice(at, at + TOGETHER)
        i, j, score = _joined(anchors[own], rest[own], index, least[own])
        yield i + at, index.order[j], score


def _joined(anchors, rest, index: Index, least):
    d = anchors.shape[1]
    live_a, live_r = np.arange(len(anchors)), np.arange(len(index.rows))
    sums = np.zeros((len(live_a), len(live_r)), anchors.dtype)
    for first in range(0, d, STRIDE):
        last = min(first + STRIDE, d)
        # Live rows keep their order, so those in the postings come first.
        n = int(np.searchsorted(live_r, index.listed[first]))
        sums[:, :n] += anchors[live_a, first:last] @ index.indexed[live_r[:n], first:last].T
        # The index has summed a row up to its cut.
        done = np.minimum(index.cut[live_r], last)
        bound = rest[live_a][:, done] * index.rest[live_r, done]
        alive = sums + _upper(bound) >= least[live_a, None]
        keep_a, keep_r = alive.any(axis=1), alive.any(axis=0)
        live_a, live_r = live_a[keep_a], live_r[keep_r]
        sums, alive = sums[keep_a][:, keep_r], alive[keep_a][:, keep_r]
        if not len(live_a):
            break
        if alive.mean() < 0.02:
            break
    if not len(live_a):
        none = np.zeros(0, np.int64)
        return none, none, none
    a, r = np.nonzero(alive)
    i, j, score = live_a[a], live_r[r], sums[a, r]
    summed = np.minimum(index.cut[j], last)
    for at in range(0, len(i), 100_000):
        own = slice(at, at + 100_000)
        left = np.arange(d) >= summed[own, None]
        score[own] += (anchors[i[own]] * index.rows[j[own]] * left).sum(axis=1)
    score = score.astype(np.int64)
    reached = score >= least[i]
    return i[reached], j[reached], score[reached]


def _dealt(anchors: DataFrame, rows: DataFrame, keys: list[str]):
    """Both sides with the pair of blocks (left, right) they meet in, within
    groups of equal ``keys``, and the number of pairs of blocks."""
    blocks = F.ceil(F.count(F.lit(1)) * F.greatest(F.first("dims"), F.lit(64)) / BLOCK)
    sizes = materialise(
        rows.groupBy(*keys)
        .agg(blocks.alias("_rights"))
        .join(anchors.groupBy(*keys).agg(blocks.alias("_lefts")), keys),
        "blocks",
    )
    pairs = sizes.agg(F.sum(F.col("_rights") * F.col("_lefts"))).head()[0] or 0

    def side(frame: DataFrame, own: str, parts: str, other: str, others: str) -> DataFrame:
        return (
            frame.join(sizes, keys)
            .withColumn(own, F.pmod(F.xxhash64("row"), F.col(parts)))
            .withColumn(other, F.explode(F.sequence(F.lit(0).cast("long"), F.col(others) - 1)))
            .drop("_lefts", "_rights")
        )

    lefts = side(anchors, "_left", "_lefts", "_right", "_rights")
    rights = side(rows, "_right", "_rights", "_left", "_lefts")
    return lefts, rights, pairs


def _matrix(table: pa.Table) -> np.ndarray:
    column = table.column("v").combine_chunks()
    return column.flatten().to_numpy().astype(float).reshape(len(column), -1)


def _best(score: np.ndarray, vec_id: np.ndarray, most: int) -> np.ndarray:
    return np.lexsort((vec_id, -score))[:most]


def _threshold_join(anchors, rows, keys, same_label: bool, most: int) -> DataFrame:
    """(row, slot, vec_id, score): per anchor ``row`` and window ``slot`` the
    ``most`` best rows of a block with scores from the window's ``lows`` to its
    ``highs``, of the anchor's label or of another one."""
    lefts, rights, pairs = _dealt(anchors, rows, keys)
    schema = "row long, slot int, vec_id long, score long"
    tile = [*keys, "_left", "_right"]
    parts = max(1, min(pairs, MOST_TASKS))

    def join(left: pa.Table, right: pa.Table) -> pa.Table:
        out = {"row": [], "slot": [], "vec_id": [], "score": []}
        if left.num_rows and right.num_rows:
            lows, highs = left.column("lows").to_pylist(), left.column("highs").to_pylist()
            least = np.array([min(-np.inf if x is None else x for x in w) for w in lows])
            ids, own_ids = right.column("vec_id").to_numpy(), left.column("vec_id").to_numpy()
            # Labels of any type as numbers.
            codes = pa.concat_arrays(
                [left.column("label").combine_chunks(), right.column("label").combine_chunks()]
            ).dictionary_encode().indices.to_numpy()
            own_label, label = codes[: left.num_rows], codes[left.num_rows :]
            number = left.column("row").to_numpy()
            for i, j, score in above(_matrix(left), _matrix(right), least):
                fits = (own_label[i] == label[j]) == same_label
                fits &= own_ids[i] != ids[j]
                i, j, score = i[fits], j[fits], score[fits]
                order = np.argsort(i, kind="stable")
                i, j, score = i[order], j[order], score[order]
                who, starts = np.unique(i, return_index=True)
                for a, s, e in zip(who.tolist(), starts, [*starts[1:], len(i)]):
                    for slot, (low, high) in enumerate(zip(lows[a], highs[a])):
                        inside = np.ones(e - s, bool)
                        if low is not None:
                            inside &= score[s:e] >= low
                        if high is not None:
                            inside &= score[s:e] <= high
                        at = np.flatnonzero(inside) + s
                        at = at[_best(score[at], ids[j[at]], most)]
                        out["row"] += [int(number[a])] * len(at)
                        out["slot"] += [slot] * len(at)
                        out["vec_id"] += ids[j[at]].tolist()
                        out["score"] += score[at].tolist()
        types = {"row": pa.int64(), "slot": pa.int32(), "vec_id": pa.int64(), "score": pa.int64()}
        return pa.table({k: pa.array(v, types[k]) for k, v in out.items()})

    def grouped(frame: DataFrame, *names: str):
        # New columns: both sides may come from one frame.
        columns = (F.col(c).alias(c) for c in dict.fromkeys([*tile, *names]))
        return frame.select(*columns).repartition(parts, *tile).groupBy(*tile)

    left = grouped(importable(lefts), "row", "vec_id", "label", "v", "lows", "highs")
    right = grouped(rights, "row", "vec_id", "label", "v")
    return left.cogroup(right).applyInArrow(join, schema)


def _first(hits: DataFrame, most: int) -> DataFrame:
    best = Window.partitionBy("row", "slot").orderBy(F.desc("score"), "vec_id")
    return hits.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= most)


def positives(anchors: DataFrame, rows: DataFrame, most: int = POSITIVES) -> DataFrame:
    """(row, vec_id, score, rank): the best other rows of an anchor's label."""
    top = rows.agg(F.max("norm")).head()[0] or 0.0
    todo, found = anchors, []
    for share in STEPS:
        low = F.lit(None).cast("long") if share is None else F.ceil(F.col("norm") * top * share)
        asked = todo.withColumn("lows", F.array(low)).withColumn(
            "highs", F.array(F.lit(None).cast("long"))
        )
        hits = _first(_threshold_join(asked, rows, ["dims", "label"], True, most), most)
        hits = materialise(hits.select("row", "vec_id", "score", "rank"), "positives")
        full = hits.where(F.col("rank") == most).select("row")
        found.append(hits if share is None else hits.join(full, "row", "left_semi"))
        todo = materialise(todo.join(full, "row", "left_anti"), "unfilled")
        if not todo.take(1):
            break
    out = found[0]
    for more in found[1:]:
        out = out.union(more)
    return materialise(out, "positives")


def negatives(
    anchors: DataFrame, rows: DataFrame, windows: DataFrame, most: int = NEGATIVES
) -> DataFrame:
    """(row, positive, vec_id, score, rank): per window (row, positive, low,
    high) the best rows of another label with a score in it."""
    todo, found = materialise(windows, "windows"), []
    for share in SHARES:
        reach = F.col("high") - F.floor((F.col("high") - F.col("low")) * share)
        # At most as many windows as positives; their order numbers the slots.
        listed = todo.groupBy("row").agg(
            F.sort_array(F.collect_list(F.struct("positive", "high", reach.alias("low")))).alias("w")
        )
        listed = materialise(listed, "windows")
        asked = anchors.join(listed, "row").select(
            *anchors.columns, F.col("w")["low"].alias("lows"), F.col("w")["high"].alias("highs")
        )
        hits = _first(_threshold_join(asked, rows, ["dims"], False, most), most)
        named = hits.join(
            listed.select("row", F.posexplode("w").alias("slot", "w")), ["row", "slot"]
        )
        hits = materialise(
            named.select("row", F.col("w")["positive"].alias("positive"), "vec_id", "score", "rank"),
            "negatives",
        )
        window = ["row", "positive"]
        full = hits.where(F.col("rank") == most).select(*window)
        found.append(hits if share == 1.0 else hits.join(full, window, "left_semi"))
        todo = materialise(todo.join(full, window, "left_anti"), "unfilled")
        if not todo.take(1):
            break
    out = found[0]
    for more in found[1:]:
        out = out.union(more)
    return out


def mine(
    vectors: DataFrame,
    anchor: Column,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    label: str = "label",
    scale: int = SCALE,
    n_positives: int = POSITIVES,
    n_negatives: int = NEGATIVES,
    lowest: int = LOWEST,
    highest: int = HIGHEST,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score) of the rows where ``anchor`` holds."""
    rows = materialise(prepared(vectors, anchor, vec_id, embedding, label, scale), "vectors")
    anchors = rows.where("anchor")
    near = positives(anchors, rows, n_positives)
    # Whole numbers: the least not under, the greatest not over the share. The
    # window of a negative score is empty.
    windows = (
        near.where("score >= 0")
        .select(
            "row",
            F.struct("rank", "vec_id", "score").alias("positive"),
            F.expr(f"(score * {lowest} + 99) div 100").alias("low"),
            F.expr(f"score * {highest} div 100").alias("high"),
        )
        .where("low <= high")
    )
    return (
        negatives(anchors, rows, windows, n_negatives)
        .join(anchors.select("row", F.col("vec_id").alias("anchor_id")), "row")
        .select(
            "anchor_id",
            F.col("positive")["vec_id"].alias("positive_id"),
            "rank",
            F.col("vec_id").alias("negative_id"),
            F.col("positive")["score"].alias("positive_score"),
            F.col("score").alias("negative_score"),
        )
    )
