"""Near-duplicates, nearest neighbours and components against brute force."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest

from veritrail.llm import common, components, lattice_dedup, minhash, nn_descent


class Groups:
    def __init__(self, items):
        self.parent = {i: i for i in items}

    def find(self, i):
        while self.parent[i] != i:
            i = self.parent[i]
        return i

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.parent[max(a, b)] = min(a, b)


def test_components_reach_the_smallest_node(spark):
    pick = random.Random(1)
    edges = [(pick.randint(0, 300), pick.randint(0, 300)) for _ in range(220)]
    edges += [(1000 + i, 1001 + i) for i in range(40)] + [(2000, 2000 + i) for i in range(90)]
    edges += [(5, None), (None, 6), (7, 7)]
    groups = Groups({n for e in edges for n in e if n is not None})
    for a, b in edges:
        if a is not None and b is not None:
            groups.join(a, b)
    frame = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.component for r in components.components(frame, "a", "b").collect()}
    linked = {n for a, b in edges if None not in (a, b) and a != b for n in (a, b)}
    assert got == {n: groups.find(n) for n in linked}
    assert components.components(frame.where("false"), "a", "b").collect() == []


def test_block_pairs_meet_every_two_members_once(spark):
    rows = [(k, i) for k, n in ((1, 1), (2, 2), (3, 50)) for i in range(n)]
    frame = spark.createDataFrame(rows, "key long, node long")
    dealt = common.block_pairs(frame, "key", "node", 8).collect()
    met = {}
    for r in dealt:
        met.setdefault((r.key, r.left, r.right), []).append((r["_own"], r.node))
    seen = []
    for (key, left, right), members in met.items():
        seen += [
            (key, a, b)
            for own_a, a in members
            for own_b, b in members
            if a < b and (left == right or own_a != own_b)
        ]
    want = [(k, a, b) for k, n in ((2, 2), (3, 50)) for b in range(n) for a in range(b)]
    assert sorted(seen) == sorted(want) and len(seen) == len(set(seen))


# MinHash


def shingles(text, size):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1)))


def brute_groups(texts, size):
    sets = [shingles(t, size) for t in texts]
    groups = Groups(range(len(texts)))
    for b in range(len(sets)):
        for a in range(b):
            if sets[a] and sets[b]:
                common_size = len(sets[a] & sets[b])
                if 100 * common_size >= 80 * (len(sets[a]) + len(sets[b]) - common_size):
                    groups.join(a, b)
    return sets, groups


def corpus(seed=3):
    pick = random.Random(seed)
    words = [f"w{i}" for i in range(4000)]
    texts = [None, "", " \t\n", "one", "ONE", "one two", "É é", "é é"]
    for _ in range(25):
        base = pick.choices(words, k=pick.randint(3, 150))
        texts.append(" ".join(base))
        for _ in range(pick.choice((0, 1, 1, 6))):
            copy = list(base)
            for _ in range(pick.randint(0, 4)):
                copy[pick.randrange(len(copy))] = pick.choice(words)
            texts.append(" ".join(copy).upper() if pick.random() < 0.2 else "  ".join(copy))
    texts += [texts[10]] * 30 + ["long " + " ".join(words)] * 2
    return texts


def documents(spark, texts):
    return spark.createDataFrame(
        [(i, t, "c", "n") for i, t in enumerate(texts)],
        "doc_id long, text string, component_id string, node string",
    )


@pytest.mark.parametrize("blocks", [(1024, 128), (4, 3)])
def test_groups_match_brute_force(spark, monkeypatch, blocks):
    monkeypatch.setattr(minhash, "KEY_BLOCK", blocks[0])
    monkeypatch.setattr(minhash, "SET_BLOCK", blocks[1])
    texts = corpus()
    sets, groups = brute_groups(texts, 4)
    got = {r.doc_id: r for r in minhash.near_duplicates(documents(spark, texts), shingle=4).collect()}
    assert len(got) == len(texts)
    for i, own in enumerate(sets):
        assert (got[i].n_shingles, got[i].component_id) == (len(own), groups.find(i))
        assert got[i].kept == (groups.find(i) == i)


def test_repeated_and_null_ids(spark):
    long, other = " ".join(f"a{i}" for i in range(60)), " ".join(f"b{i}" for i in range(60))
    rows = [(1, long), (5, long), (5, other), (9, other), (9, other), (None, long), (7, "x y")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(
        (r.doc_id or 0, r.component_id or 0, r.kept)
        for r in minhash.near_duplicates(frame).collect()
    )
    assert got == [
        (0, 0, True), (1, 1, True), (5, 1, False), (5, 1, False), (7, 7, True),
        (9, 1, False), (9, 1, False),
    ]
    assert minhash.near_duplicates(frame.where("false")).collect() == []


def test_chunk_keys_find_all_signatures_within_the_distance():
    """The pigeonhole guarantee, for errors laid out as badly as can be."""
    random_ = np.random.default_rng(5)
    for _ in range(300):
        a = random_.integers(0, 256, minhash.SYMBOLS).astype(np.uint8)
        b = a.copy()
        for place in random_.choice(minhash.SYMBOLS, minhash.DISTANCE, replace=False):
            b[place] += np.uint8(random_.integers(1, 256))
        keys = minhash.chunk_keys(np.stack([a, b]), minhash.CHUNKS, minhash.DISTANCE // minhash.CHUNKS)
        assert set(keys[0]) & set(keys[1])


def test_signatures_estimate_similarity():
    random_ = np.random.default_rng(6)
    sets = random_.integers(0, 2**63, 3000).astype(np.uint64)
    a, b = np.unique(sets[:2000]), np.unique(sets[500:2500])
    signed = minhash.signatures([a, b], 2000)
    assert (signed[0] == signed[1]).mean() == pytest.approx(0.6, abs=0.05)


def test_intersections_and_stars_match_sets():
    random_ = np.random.default_rng(7)
    sets = [np.unique(random_.integers(0, 9000, n)).astype(np.uint64) for n in (1, 50, 7000, 900)]
    got = minhash.intersections(sets)
    assert got.tolist() == [[len(np.intersect1d(a, b)) for b in sets] for a in sets]
    linked = np.zeros((6, 6), bool)
    linked[0, 3] = linked[3, 0] = linked[3, 5] = linked[5, 3] = linked[1, 2] = linked[2, 1] = True
    moved, first = minhash.stars(linked)
    assert dict(zip(moved.tolist(), first.tolist())) == {3: 0, 5: 0, 2: 1}


# Vectors


def cosine(a, b):
    a, b = np.array(a, float), np.array(b, float)
    a, b = a / np.abs(a).max(), b / np.abs(b).max()
    return float(a @ b / np.sqrt((a @ a) * (b @ b)))


def usable(v):
    return bool(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)


def vectors(seed=8, dimension=16):
    random_ = np.random.default_rng(seed)
    rows = []
    for label in (0, 1):
        for _ in range(30):
            base = random_.normal(size=dimension)
            for _ in range(random_.integers(1, 6)):
                rows.append(((base + random_.normal(size=dimension) * 0.12).tolist(), label))
    rows += [(rows[3][0], 0)] * 12 + [(rows[3][0], 1), (rows[3][0], None)]
    rows += [(None, 0), ([], 0), ([0.0] * dimension, 0), ([float("nan")] * dimension, 0)]
    rows += [([None, 1.0], 0), ([float("inf"), 1.0], 0), ([1.0, 0.0], 0), ([2.0, 0.0], 0)]
    rows += [((np.array(rows[5][0]) * 1e200).tolist(), 0), ((np.array(rows[5][0]) * 1e-200).tolist(), 0)]
    return [(i, v, label, "x") for i, (v, label) in enumerate(rows)]


VECTOR_SCHEMA = "vec_id long, embedding array<double>, label int, node string"


def test_e8_points_are_the_nearest():
    random_ = np.random.default_rng(9)
    moves = np.concatenate([np.zeros((1, 8)), lattice_dedup.shortest_vectors()])
    x = random_.normal(size=(300, 8)) * 2
    points = lattice_dedup.nearest_e8(x)
    doubled = 2 * points
    assert np.allclose(doubled, np.rint(doubled)) and np.all(points.sum(axis=1) % 2 == 0)
    assert np.all((doubled % 2 == doubled[:, :1] % 2).all(axis=1))
    own = ((x - points) ** 2).sum(axis=1)
    # The shortest vectors are those that border a cell, so no neighbour is nearer.
    others = ((x[:, None] - (points[:, None] + moves)) ** 2).sum(axis=2)
    assert np.all(own <= others.min(axis=1) + 1e-9) and len(moves) == 241


@pytest.mark.parametrize("block", [512, 3])
def test_vector_links_match_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(lattice_dedup, "BLOCK", block)
    rows = vectors()
    groups, links = Groups(range(len(rows))), [0] * len(rows)
    for i, v, label, _ in rows:
        for j, w, other, _ in rows:
            if i != j and label is not None and label == other and usable(v) and usable(w):
                if len(v) == len(w) and cosine(v, w) >= 0.93:
                    links[i] += 1
                    groups.join(i, j)
    frame = spark.createDataFrame(rows, VECTOR_SCHEMA)
    got = {r.vec_id: r for r in lattice_dedup.near_duplicates(frame).collect()}
    assert len(got) == len(rows)
    for i in range(len(rows)):
        want = (links[i], groups.find(i), groups.find(i) == i)
        assert (got[i].n_links, got[i].component_id, got[i].kept) == want, i
    assert lattice_dedup.near_duplicates(frame.where("false")).collect() == []


def test_lattice_recall_at_the_threshold():
    random_ = np.random.default_rng(10)
    a = random_.normal(size=(3000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = random_.normal(size=a.shape)
    b -= (a * b).sum(axis=1, keepdims=True) * a
    b = 0.931 * a + np.sqrt(1 - 0.931**2) * b / np.linalg.norm(b, axis=1, keepdims=True)
    own = lattice_dedup.Lattices(
        64, lattice_dedup.TABLES, lattice_dedup.LATTICES, lattice_dedup.PROBES, lattice_dedup.SCALE
    )
    x, y = own.cells(a), own.cells(b)
    met = ((x[:, :, :1] == y) | (y[:, :, :1] == x)).any(axis=(1, 2))
    assert met.mean() > 0.99


def test_repeated_vector_ids(spark):
    a, b = [1.0, 0.0, 0.0], [0.0, 1.0, 0.0]
    rows = [(1, a, 0, ""), (4, a, 0, ""), (4, b, 0, ""), (8, b, 0, ""), (None, a, 0, "")]
    frame = spark.createDataFrame(rows, VECTOR_SCHEMA)
    got = sorted(
        (r.vec_id or 0, r.n_links, r.component_id or 0)
        for r in lattice_dedup.near_duplicates(frame).collect()
    )
    assert got == [(0, 0, 0), (1, 1, 1), (4, 1, 1), (4, 1, 1), (8, 1, 1)]


def exact_neighbours(rows, query, k):
    v = dict((r[0], r[1]) for r in rows)[query]
    scored = [
        (-cosine(v, w), i)
        for i, w, *_ in rows
        if i != query and usable(w) and len(w) == len(v)
    ]
    return [(i, -s) for s, i in sorted(scored)[:k]]


def test_neighbours_match_brute_force(spark):
    rows = vectors(11)
    frame = spark.createDataFrame(rows, VECTOR_SCHEMA)
    got = {}
    for r in nn_descent.nearest(frame, every=7).collect():
        got.setdefault(r.query_id, {})[r["rank"]] = (r.vec_id, r.score)
    queries = [i for i, v, *_ in rows if i % 7 == 0 and usable(v) and len(v) == 16]
    assert sorted(got) == queries
    hits = 0
    for q in queries:
        want = exact_neighbours(rows, q, 5)
        assert sorted(got[q]) == [1, 2, 3, 4, 5]
        own = [got[q][n] for n in range(1, 6)]
        hits += len({i for i, _ in own} & {i for i, _ in want})
        for i, score in own:
            assert score == pytest.approx(cosine(rows[q][1], rows[i][1]), abs=1e-12)
    assert hits / 5 / len(queries) >= 0.97


def test_few_and_no_candidates(spark):
    rows = [(0, [1.0, 0.0], 0, ""), (3, [1.0, 1.0], 0, ""), (2, [1.0, 1.0], 0, ""), (5, None, 0, "")]
    frame = spark.createDataFrame(rows, VECTOR_SCHEMA)
    got = sorted(tuple(r)[:3] for r in nn_descent.nearest(frame, every=1).collect())
    assert got == [(0, 1, 2), (0, 2, 3), (2, 1, 3), (2, 2, 0), (3, 1, 2), (3, 2, 0)]
    assert nn_descent.nearest(frame.where("false"), every=1).collect() == []
    assert nn_descent.nearest(frame.where("vec_id = 0"), every=1).collect() == []


@pytest.mark.parametrize("rare", [False, True])
def test_every_length_is_indexed(spark, monkeypatch, rare):
    """Lengths with pivots, large and small ones without, a single vector."""
    if rare:
        pick = nn_descent._pivots
        only = lambda *a: [s for s in pick(*a) if len(s[1]) == 4 * 16]
        monkeypatch.setattr(nn_descent, "_pivots", only)
    numbers = np.random.default_rng(12)
    sizes = [16] * 300 + [8] * 100 + [5] * 200 + [3] * 2 + [1] * 2 + [2]
    rows = [(10 * i, numbers.normal(size=n).tolist()) for i, n in enumerate(sizes)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got: dict = {}
    for r in nn_descent.nearest(frame, every=50).collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    hits, wanted = 0, 0
    for i, v in rows:
        if i % 50:
            continue
        unit = np.array(v) / np.linalg.norm(v)
        near = sorted(
            (-float(unit @ (np.array(w) / np.linalg.norm(w))), j)
            for j, w in rows
            if j != i and len(w) == len(v)
        )[:5]
        own = got.get(i, [])
        assert len(own) == len(near)
        for (j, score), (best, _) in zip(own, near):
            assert len(rows[j // 10][1]) == len(v) and score <= -best + 1e-9
        hits += len({j for j, _ in own} & {j for _, j in near})
        wanted += len(near)
    assert hits >= 0.97 * wanted, (hits, wanted, sorted((len(rows[i // 10][1]), len({j for j, _ in got.get(i, [])})) for i in range(0, 6050, 50)))



def test_large_buckets_are_split_by_nearness(spark):
    random_ = np.random.default_rng(12)
    centres = random_.normal(size=(40, 16)) * 4
    rows = [(i, nn_descent._code(centres[i % 40] + random_.normal(size=16) * 0.1)) for i in range(4000)]
    rows += [(4000 + i, rows[0][1]) for i in range(400)]
    nodes = spark.createDataFrame(rows, "node long, code binary")
    dealt = nodes.selectExpr("7L AS bucket", "node")
    blocks: dict = {}
    for r in nn_descent.small_buckets(dealt, nodes).collect():
        blocks.setdefault((r.bucket, r.block), []).append(r.node)
    assert sorted(n for b in blocks.values() for n in b) == list(range(4400))
    assert max(map(len, blocks.values())) <= 2 * nn_descent.BLOCK
    # Blocks cut at random would hold nodes of nearly all 40 centres.
    mixed = [len({n % 40 for n in b if n < 4000}) for b in blocks.values()]
    assert sorted(mixed)[len(mixed) * 9 // 10] <= 3


def test_descent_goes_on_until_the_graph_is_right(spark, monkeypatch):
    # From blocks this small, three rounds reach 0.954.
    monkeypatch.setattr(nn_descent, "PER_PIVOT", 8)
    monkeypatch.setattr(nn_descent, "BLOCK", 8)
    random_ = np.random.default_rng(13)
    x = random_.uniform(-1, 1, size=(3000, 24))
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<double>")
    index = nn_descent.build(frame, neighbours=20, reverse=20)
    near: dict = {}
    for r in index.links.collect():
        near.setdefault(r.v, set()).add(r.member)
    sims = x / np.linalg.norm(x, axis=1, keepdims=True)
    sims = sims @ sims.T
    np.fill_diagonal(sims, -2)
    best = np.argsort(-sims, axis=1)[:, :5]
    assert np.mean([j in near[i] for i in range(3000) for j in best[i]]) >= 0.975


def test_neighbours_among_vectors_that_differ_by_little(spark):
    random_ = np.random.default_rng(14)
    base = random_.normal(size=64)
    x = base / np.linalg.norm(base) + random_.normal(size=(1500, 64)) * 1e-4
    rows = [(i, v, 0, "") for i, v in enumerate(x.tolist())]
    frame = spark.createDataFrame(rows, VECTOR_SCHEMA)
    got: dict = {}
    for r in nn_descent.nearest(frame, every=30).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    unit = (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.longdouble)
    hits = 0
    for q in range(0, 1500, 30):
        far = ((unit - unit[q]) ** 2).sum(axis=1)
        far[q] = 9
        hits += len(got[q] & set(np.argsort(far)[:5].tolist()))
    assert hits / 5 / 50 >= 0.9


@pytest.mark.parametrize("distinct", [4096, 4097, 8193])
def test_intersections_count_the_last_shingle(distinct):
    whole = np.arange(distinct, dtype=np.uint64)
    sets = [whole, whole[-5:], whole[: distinct // 2]]
    want = [[len(set(a.tolist()) & set(b.tolist())) for b in sets] for a in sets]
    assert minhash.intersections(sets).tolist() == want


def _shuffles(frame):
    return frame._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_rounds_of_the_graph_and_the_search_need_few_shuffles(spark):
    """Each keeps threads and plans in the driver; with many of them it ran out of memory."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        edges = spark.createDataFrame([(1, 2, 0.5), (2, 3, 0.4)], "src long, dst long, sim double")
        links = nn_descent.both_ways(edges, 4)
        again = nn_descent.both_ways(edges.where("src = 1"), 4, links)
        nodes = spark.createDataFrame([(1, b"1234")], "node long, code binary")
        stored = spark.createDataFrame(links.collect(), links.schema)
        assert _shuffles(nn_descent.both_ways(edges, 4, stored)) <= 2
        assert _shuffles(nn_descent.descend(edges, stored, nodes, 4)) <= 6
        state = spark.createDataFrame([(1, 2, 0.5, False, True)], nn_descent._STATE)
        asked = spark.createDataFrame([(1, b"1234")], "query_id long, code binary")
        index = nn_descent.Index(nodes, None, stored, None, None)
        found = state.select("query_id", "node")
        assert _shuffles(nn_descent._look(state, found, asked, index, 4, 2)) <= 4
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    got = {(r.v, r.member): (r.fresh, r.moved) for r in links.collect()}
    assert got == {k: (True, True) for k in [(1, 2), (2, 1), (2, 3), (3, 2)]}
    assert {(r.v, r.member): (r.fresh, r.moved) for r in again.collect()} == {
        (1, 2): (False, False), (2, 1): (False, False)
    }
