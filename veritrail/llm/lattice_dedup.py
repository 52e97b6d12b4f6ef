"""Embedding near-duplicates by lattice hashing.

Each table projects unit vectors on LATTICES times 8 random orthonormal
directions and decodes every 8 numbers to the nearest point of the E8 lattice;
the points are the vector's cell. A vector is filed under its own cell and
looks into the PROBES neighbouring cells nearest to it. Vectors that meet in a
cell, at least one of them at home there, are compared by cosine.

Equal vectors of a label are one class; only classes are indexed. The members
of a cell are dealt in pairs of blocks. A block counts each member's links and
gives a spanning forest, never its pairs. A pair is counted in the first table
and cell where it meets, which both vectors' cells tell.

Recall for pairs at cosine 0.93 in 64 dimensions is over 0.99 (README); a
larger SCALE or more LATTICES make smaller cells for larger tables, more PROBES
or TABLES win back recall. Every vector is indexed and no cell is capped.

Defined results: vectors that are null, empty, zero or hold null or non-finite
components, and vectors without label, link with nothing, nor do vectors of
different lengths; a null vec_id links with nothing and is kept; rows that
repeat a vec_id are linked through it and each count; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veritrail.llm.common import arrow_rows, block_pairs, grouped_arrow
from veritrail.llm.components import components
from veritrail.llm.minhash import stars
from veritrail.sources.scratch import materialise

COSINE = 0.93
TABLES = 5
LATTICES = 2
PROBES = 6
#: Side of a cell: higher is smaller. Times the root of a 64th of the dimension.
SCALE = 3.0
BLOCK = 512
#: Neighbours of a lattice point that a probe may move to.
NEAREST = 6

_MIX = np.uint64(0x9E3779B97F4A7C15)


def shortest_vectors() -> np.ndarray:
    """The 240 shortest vectors of E8: two entries of +-1, or all +-1/2 with
    an even number of minus signs."""
    found = []
    for (a, b), (s, t) in itertools.product(
        itertools.combinations(range(8), 2), itertools.product((1, -1), repeat=2)
    ):
        v = np.zeros(8)
        v[a], v[b] = s, t
        found.append(v)
    for signs in itertools.product((0.5, -0.5), repeat=8):
        if sum(s < 0 for s in signs) % 2 == 0:
            found.append(np.array(signs))
    return np.array(found)


def nearest_d8(x: np.ndarray) -> np.ndarray:
    """Nearest points with whole entries and an even sum: if rounding gives an
    odd sum, the entry rounded farthest goes the other way."""
    point = np.rint(x)
    off = x - point
    odd = np.flatnonzero(point.sum(axis=1) % 2)
    worst = np.abs(off[odd]).argmax(axis=1)
    point[odd, worst] += np.where(off[odd, worst] >= 0, 1, -1)
    return point


def nearest_e8(x: np.ndarray) -> np.ndarray:
    """E8 is D8 and D8 moved by one half everywhere."""
    whole, half = nearest_d8(x), nearest_d8(x - 0.5) + 0.5
    nearer = ((x - whole) ** 2).sum(axis=1) <= ((x - half) ** 2).sum(axis=1)
    return np.where(nearer[:, None], whole, half)


class Lattices:
    """Cells of unit vectors of one dimension."""

    def __init__(self, dimension: int, tables: int, lattices: int, probes: int, scale: float):
        random = np.random.default_rng(20_240 + dimension)
        self.wide = max(dimension, 8)
        self.lattices, self.probes = lattices, probes
        self.scale = scale * np.sqrt(self.wide) / 8
        self.directions = [
            [np.linalg.qr(random.normal(size=(self.wide, 8)))[0] for _ in range(lattices)]
            for _ in range(tables)
        ]
        self.moves = shortest_vectors()

    def _options(self, y: np.ndarray):
        """The nearest point and NEAREST neighbours of it, with what each adds
        to the squared distance."""
        home = nearest_e8(y)
        added = 2 - 2 * (y - home) @ self.moves.T
        near = np.argpartition(added, NEAREST, axis=1)[:, :NEAREST]
        points = np.concatenate([home[:, None], home[:, None] + self.moves[near]], axis=1)
        cost = np.concatenate([np.zeros((len(y), 1)), np.take_along_axis(added, near, 1)], axis=1)
        return points, cost

    def cells(self, units: np.ndarray) -> np.ndarray:
        """(vector, table, 1 + probes) cell codes, the home cell first."""
        if units.shape[1] < self.wide:
            units = np.pad(units, ((0, 0), (0, self.wide - units.shape[1])))
        return np.stack([self._table(units, t) for t in range(len(self.directions))], axis=1)

    def _table(self, units: np.ndarray, table: int) -> np.ndarray:
        n = len(units)
        code = np.full((n, 1), table + 1, np.uint64)
        cost = np.zeros((n, 1))
        for directions in self.directions[table]:
            points, added = self._options(units @ directions * self.scale)
            own = np.zeros(points.shape[:2], np.uint64)
            for k in range(8):
                own = (own ^ (2 * points[:, :, k]).astype(np.int64).view(np.uint64)) * _MIX
                own ^= own >> np.uint64(31)
            cost = (cost[:, :, None] + added[:, None, :]).reshape(n, -1)
            code = ((code * _MIX)[:, :, None] ^ own[:, None, :]).reshape(n, -1)
            code = (code ^ (code >> np.uint64(29))) * _MIX
            # The cheapest combinations so far; the home cell costs nothing.
            best = np.argsort(cost, axis=1, kind="stable")[:, : self.probes + 1]
            cost = np.take_along_axis(cost, best, 1)
            code = np.take_along_axis(code, best, 1)
        return code.view(np.int64)


def usable(vector: Column) -> Column:
    """A vector that has a cosine with others."""
    double = vector.cast("array<double>")
    bad = F.exists(double, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    some = F.exists(double, lambda x: x != 0)
    return F.coalesce(F.size(vector) > 0, F.lit(False)) & F.when(bad, False).otherwise(some)


def unit_rows(column: pa.Array) -> list[np.ndarray]:
    """Unit vectors in double precision; scaled first, so that squares neither
    overflow nor vanish."""
    out = []
    for v in column:
        x = v.values.to_numpy(zero_copy_only=False).astype(float)
        x = x / np.abs(x).max()
        out.append(x / np.sqrt(x @ x))
    return out


def _filed(classes: DataFrame, settings: tuple) -> DataFrame:
    """(node, sub, units, cells) of every class."""

    def work():
        by_size: dict[int, Lattices] = {}

        def step(batch):
            if batch is None or not batch.num_rows:
                return []
            rows = unit_rows(batch.column(2))
            cells: list = [None] * len(rows)
            sizes = np.array([len(r) for r in rows])
            for size in np.unique(sizes).tolist():
                own = np.flatnonzero(sizes == size)
                lattice = by_size.setdefault(size, Lattices(size, *settings))
                found = lattice.cells(np.stack([rows[i] for i in own]))
                for i, c in zip(own.tolist(), found):
                    cells[i] = c.ravel()
            return [
                {
                    "node": batch.column(0).to_pylist(),
                    "sub": batch.column(1).to_pylist(),
                    "units": rows,
                    "cells": cells,
                }
            ]

        return step

    frame = classes.select("node", "sub", "embedding")
    return arrow_rows(frame, work, "node long, sub long, units array<double>, cells array<long>")


def _met_before(home, cells, i, j, table, cell) -> np.ndarray:
    """Whether the pairs (i, j) meet before this cell, by table, then cell."""
    before = np.zeros(len(i), bool)
    for t in range(int(table) + 1):
        same = home[i, t] == home[j, t]
        to_i = (cells[j, t, 1:] == home[i, t][:, None]).any(axis=1)
        to_j = (cells[i, t, 1:] == home[j, t][:, None]).any(axis=1)
        if t < table:
            before |= same | to_i | to_j
        else:
            before |= ~same & to_i & (home[i, t] < cell) | ~same & to_j & (home[j, t] < cell)
    return before


def cell_links(filed: DataFrame, classes: DataFrame, tables: int, probes: int, cosine: float):
    """(node, sub, links, first): for every block pair and member with links
    there, their number and the first member it is connected to."""
    slot = F.col("at")
    entries = filed.select(
        "node", "sub", F.posexplode("cells").alias("at", "cell")
    ).select(
        "node",
        "sub",
        F.xxhash64("cell", F.floor(slot / (probes + 1))).alias("bucket"),
        "cell",
        F.floor(slot / (probes + 1)).cast("int").alias("slot"),
        (slot % (probes + 1) == 0).alias("home"),
    )
    entries = entries.join(classes.select("node", "sub", "label"), ["node", "sub"]).withColumn(
        "bucket", F.xxhash64("bucket", "label")
    )
    homes = entries.groupBy("bucket").agg(F.max("home").alias("any_home")).where("any_home")
    dealt = block_pairs(
        entries.join(homes.select("bucket"), "bucket", "left_semi"), "bucket", "sub", BLOCK
    )
    dealt = dealt.join(
        filed.join(classes.select("node", "sub", "copies"), ["node", "sub"]), ["node", "sub"]
    ).select(
        "bucket", "left", "right", "_own", "node", "sub", "label", "cell", "slot", "home",
        "copies", "units", "cells",
    )

    def group(rows, own, left, right, s, e, out):
        units = rows["units"][s:e]
        size = min(len(u) for u in units)
        if size != max(len(u) for u in units):
            return
        v = np.stack(units)
        cells = np.stack(rows["cells"][s:e]).reshape(e - s, tables, probes + 1)
        home_here = rows["home"][s:e]
        linked = v @ v.T >= cosine
        linked &= home_here[:, None] | home_here[None, :]
        if left == right:
            np.fill_diagonal(linked, False)
        else:
            across = (own == left)[:, None] & (own == right)[None, :]
            linked &= across | across.T
        i, j = np.nonzero(np.triu(linked))
        for at in range(0, len(i), 200_000):
            a, b = i[at : at + 200_000], j[at : at + 200_000]
            before = _met_before(
                cells[:, :, 0], cells, a, b, rows["slot"][s], rows["cell"][s]
            )
            linked[a[before], b[before]] = linked[b[before], a[before]] = False
        moved, first = stars(linked)
        heads = np.arange(e - s)
        heads[moved] = first
        counts = linked @ rows["copies"][s:e]
        for k in np.flatnonzero(counts).tolist():
            out["node"].append(int(rows["node"][s + k]))
            out["sub"].append(int(rows["sub"][s + k]))
            out["links"].append(int(counts[k]))
            out["first"].append(int(rows["node"][s + heads[k]]))

    def compare(table: pa.Table, starts: np.ndarray):
        rows = {
            c: table.column(c).to_numpy()
            for c in ("node", "sub", "slot", "cell", "home", "copies", "left", "right", "_own")
        }
        for c in ("units", "cells"):
            column = table.column(c).combine_chunks()
            at, values = column.offsets.to_numpy(), column.values.to_numpy()
            rows[c] = [values[a:b] for a, b in zip(at[:-1], at[1:])]
        out = {"node": [], "sub": [], "links": [], "first": []}
        for s, e in zip(starts[:-1].tolist(), starts[1:].tolist()):
            if e - s > 1:
                group(rows, rows["_own"][s:e], rows["left"][s], rows["right"][s], s, e, out)
        return out

    return grouped_arrow(
        dealt, ["bucket", "left", "right"], [], compare,
        "node long, sub long, links long, first long",
    )


def near_duplicates(
    vectors: DataFrame,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    label: str = "label",
    cosine: float = COSINE,
    tables: int = TABLES,
    lattices: int = LATTICES,
    probes: int = PROBES,
    scale: float = SCALE,
) -> DataFrame:
    """(vec_id, n_links, component_id, kept), one row per row of ``vectors``."""
    rows = vectors.select(
        F.col(vec_id).cast("long").alias("vec_id"),
        F.col(embedding).alias("embedding"),
        F.col(label).alias("label"),
    )
    linkable = (
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & usable(F.col("embedding"))
    )
    rows = materialise(rows.withColumn("linkable", linkable), "vectors")
    own = rows.where("linkable")
    classes = materialise(
        own.groupBy("label", "embedding")
        .agg(F.min("vec_id").alias("node"), F.count(F.lit(1)).alias("copies"))
        .withColumn("sub", F.xxhash64("label", "embedding")),
        "classes",
    )
    filed = materialise(_filed(classes, (tables, lattices, probes, scale)), "cells")
    links = materialise(cell_links(filed, classes, tables, probes, cosine), "links")
    # Rows that repeat a vec_id with other vectors tie their classes together.
    repeated = (
        own.groupBy("vec_id")
        .agg(F.min("embedding").alias("a"), F.max("embedding").alias("b"),
             F.min("label").alias("c"), F.max("label").alias("d"))
        .where("a <> b or c <> d")
        .select("vec_id")
    )
    ties = (
        own.join(repeated, "vec_id", "left_semi")
        .join(classes, ["label", "embedding"])
        .select(F.col("vec_id").alias("a"), F.col("node").alias("b"))
    )
    edges = links.select(F.col("node").alias("a"), F.col("first").alias("b")).union(ties)
    found = components(edges, "a", "b")
    counted = links.groupBy("node", "sub").agg(F.sum("links").alias("links"))
    grouped = (
        classes.join(counted, ["node", "sub"], "left")
        .join(found, "node", "left")
        .select(
            "label",
            "embedding",
            F.lit(True).alias("linkable"),
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component", "node").alias("component"),
        )
    )
    return rows.join(grouped, ["label", "embedding", "linkable"], "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        F.coalesce("component", "vec_id").alias("component_id"),
        F.coalesce(F.col("vec_id") == F.coalesce("component", "vec_id"), F.lit(True)).alias("kept"),
    )
