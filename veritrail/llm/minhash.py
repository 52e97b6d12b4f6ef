"""MinHash near-duplicates by a multi-index Hamming join.

A document is its set of distinct word shingles. SYMBOLS min-hashes, cut to b
bits each, make its signature; of two sets with Jaccard similarity s about a
share 1 - s of the symbols differ. Signatures are split into CHUNKS chunks. Two
signatures that differ in at most DISTANCE symbols agree, by the pigeonhole
principle, in some chunk up to DISTANCE // CHUNKS errors, so joining on every
chunk with that many symbols left out finds all such pairs.

1. Documents with equal sets are one class; only representatives go on.
2. Representatives that share a chunk key are dealt in pairs of blocks, which
   test the signature distance. A block gives a spanning forest of its close
   pairs, never the pairs; their components are families.
3. The full sets of each family are dealt in pairs of blocks and confirmed
   exactly; again a block gives a forest. Components of the confirmed links are
   the groups.

Nothing is capped: a hot key or family of g members costs g / block copies of
each, in tasks of two blocks. Every confirmed link is exact, and every link is
found whose signatures are within the distance: 99.7 % of those at similarity
0.8 and 99.99 % at 0.85.

Defined results: null and empty texts, and texts without words, have an empty
set and link with nothing; with fewer words than a shingle the whole sequence
is the one shingle; rows that repeat a doc_id are joined through it; null ids
link with nothing; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veritrail.llm.common import arrow_rows, block_pairs, grouped_arrow, lists
from veritrail.llm.components import components
from veritrail.sources.scratch import materialise

SHINGLE = 5
SIMILARITY = (80, 100)
SYMBOLS = 40
CHUNKS = 8
DISTANCE = 15
#: Members of a block; a task compares two.
KEY_BLOCK = 1024
SET_BLOCK = 128
WORDS_AT_ONCE = 400_000

_MIX = np.uint64(0xBF58476D1CE4E5B9)
_MIX2 = np.uint64(0x94D049BB133111EB)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _MIX
    h = (h ^ (h >> np.uint64(27))) * _MIX2
    return h ^ (h >> np.uint64(31))


def words_of(text: str) -> list[bytes]:
    """ASCII letters in lower case, cut at ASCII white space."""
    return text.encode("utf-8", "surrogatepass").lower().split()


def shingle_set(words: list[bytes], size: int) -> np.ndarray:
    """Sorted hashes of the distinct shingles."""
    if not words:
        return np.empty(0, np.uint64)
    own = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    size = min(size, len(own))
    n = len(own) - size + 1
    hashes = _mixed(own[:n] + np.uint64(size))
    for i in range(1, size):
        hashes = _mixed(hashes * np.uint64(3) + own[i : i + n])
    return np.unique(hashes)


def _seeds(symbols: int) -> tuple[np.ndarray, np.ndarray]:
    at = np.arange(1, 2 * symbols + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    mixed = _mixed(at)
    return mixed[:symbols] | np.uint64(1), mixed[symbols:]


def signatures(sets: list[np.ndarray], symbols: int) -> np.ndarray:
    """(set, symbol) b-bit min-hashes, b = 8; the sets are not empty."""
    starts = np.cumsum([0, *(len(s) for s in sets[:-1])])
    hashes = np.concatenate(sets)
    out = np.empty((len(sets), symbols), np.uint8)
    for k, (by, plus) in enumerate(zip(*_seeds(symbols))):
        # The product's high bits decide the least; its mix gives the symbol.
        least = np.minimum.reduceat(hashes * by + plus, starts)
        out[:, k] = _mixed(least) >> np.uint64(56)
    return out


def chunk_keys(signature: np.ndarray, chunks: int, errors: int) -> np.ndarray:
    """(signature, key): every chunk with every choice of ``errors`` symbols
    left out. Two signatures share a key if a chunk differs there only."""
    keys = []
    for c, chunk in enumerate(np.array_split(np.arange(signature.shape[1]), chunks)):
        for n, left in enumerate(combinations(range(len(chunk)), min(errors, len(chunk)))):
            kept = np.delete(chunk, left)
            key = np.full(len(signature), c * 4096 + n + 1, np.uint64)
            for symbol in kept:
                key = _mixed(key * np.uint64(257) + signature[:, symbol])
            keys.append(key.view(np.int64))
    return np.stack(keys, axis=1)


def profiles(
    docs: DataFrame, shingle: int, symbols: int, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(doc_id, n_shingles, digest, signature); the last two null for empty sets."""

    def portion(ids, sets):
        full = [i for i, s in enumerate(sets) if len(s)]
        own = signatures([sets[i] for i in full], symbols) if full else ()
        digest, signed = [None] * len(sets), [None] * len(sets)
        for i, row in zip(full, own):
            digest[i] = xxhash.xxh3_128_digest(sets[i].tobytes())
            signed[i] = row.tobytes()
        return {
            "doc_id": ids, "n_shingles": [len(s) for s in sets], "digest": digest,
            "signature": signed,
        }

    def work():
        def step(batch):
            if batch is None:
                return
            ids, sets, n = [], [], 0
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids.append(i)
                sets.append(shingle_set(words_of(t.as_py() or ""), shingle))
                n += len(sets[-1])
                if n >= WORDS_AT_ONCE:
                    yield portion(ids, sets)
                    ids, sets, n = [], [], 0
            if ids:
                yield portion(ids, sets)

        return step

    frame = docs.select(F.col(doc_id).cast("long"), F.col(text).cast("string"))
    schema = "doc_id long, n_shingles long, digest binary, signature binary"
    return arrow_rows(frame, work, schema)


def _pairs_of(own: np.ndarray, left: int, right: int) -> np.ndarray:
    """Which members a block pair compares: all of one block, or left with right."""
    if left == right:
        return ~np.eye(len(own), dtype=bool)
    across = (own == left)[:, None] & (own == right)[None, :]
    return across | across.T


def stars(linked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Members and the first member they are connected to, by the symmetric
    relation ``linked``; members on their own are left out."""
    first = np.full(len(linked), -1)
    for i in np.flatnonzero(linked.any(axis=1)).tolist():
        if first[i] >= 0:
            continue
        first[i] = i
        front = np.array([i])
        while len(front):
            front = np.flatnonzero(linked[front].any(axis=0) & (first < 0))
            first[front] = i
    moved = np.flatnonzero((first >= 0) & (first != np.arange(len(first))))
    return moved, first[moved]


def differences(signature: np.ndarray) -> np.ndarray:
    """(i, j): the number of symbols in which two signatures differ."""
    out = np.zeros((len(signature), len(signature)), np.uint8)
    for symbol in np.ascontiguousarray(signature.T):
        out += symbol[:, None] != symbol[None, :]
    return out


def candidate_links(members: DataFrame, chunks: int, distance: int, symbols: int) -> DataFrame:
    """(a, b): a spanning forest, block pair by block pair, of the members
    (node, signature) within ``distance``."""
    errors = distance // chunks

    def work():
        def step(batch):
            if batch is None or not batch.num_rows:
                return []
            signed = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint8)
            keys = chunk_keys(signed.reshape(batch.num_rows, symbols), chunks, errors)
            nodes = np.repeat(batch.column(0).to_numpy(), keys.shape[1])
            return [{"key": keys.ravel(), "node": nodes}]

        return step

    keys = arrow_rows(members.select("node", "signature"), work, "key long, node long")
    dealt = block_pairs(keys, "key", "node", KEY_BLOCK).join(members, "node")
    dealt = dealt.select("key", "left", "right", "_own", "node", "signature")

    def compare(rows: pa.Table, starts: np.ndarray):
        ids, own = rows.column("node").to_numpy(), rows.column("_own").to_numpy()
        left, right = rows.column("left").to_numpy(), rows.column("right").to_numpy()
        signed = np.frombuffer(b"".join(rows.column("signature").to_pylist()), np.uint8)
        signed = signed.reshape(len(ids), symbols)
        a, b = [], []
        for s, e in zip(starts[:-1].tolist(), starts[1:].tolist()):
            if e - s == 1:
                continue
            linked = differences(signed[s:e]) <= distance
            linked &= _pairs_of(own[s:e], left[s], right[s])
            moved, first = stars(linked)
            a += ids[s:e][moved].tolist()
            b += ids[s:e][first].tolist()
        return {"a": a, "b": b}

    return grouped_arrow(dealt, ["key", "left", "right"], [], compare, "a long, b long").distinct()


def intersections(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all pairs of sets. Products of 0/1 rows,
    some thousand shingles at a time, so memory does not follow the texts."""
    n = len(sets)
    if n == 2:
        common = len(np.intersect1d(*sets, assume_unique=True))
        return np.array([[len(sets[0]), common], [common, len(sets[1])]])
    row = np.repeat(np.arange(n), [len(s) for s in sets])
    _, column = np.unique(np.concatenate(sets), return_inverse=True)
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    total = np.zeros((n, n), np.float64)
    width = 4096
    edges = np.searchsorted(column, np.arange(0, int(column[-1]) + 1 + width, width))
    for c, (s, e) in enumerate(zip(edges[:-1], edges[1:])):
        if s == e:
            continue
        part = np.zeros((n, width), np.float32)
        part[row[s:e], column[s:e] - c * width] = 1
        total += part @ part.T
    return total.astype(np.int64)


def confirmed_links(sets: DataFrame, similarity: tuple[int, int]) -> DataFrame:
    """(a, b): a spanning forest, block pair by block pair, of the members
    (family, node, shingles) whose sets are similar enough."""
    least, of = similarity
    dealt = block_pairs(sets, "family", "node", SET_BLOCK)
    dealt = dealt.select("family", "left", "right", "_own", "node", "shingles")

    def compare(rows: pa.Table, starts: np.ndarray):
        ids, own = rows.column("node").to_numpy(), rows.column("_own").to_numpy()
        left, right = rows.column("left").to_numpy(), rows.column("right").to_numpy()
        column = rows.column("shingles").combine_chunks()
        at = column.offsets.to_numpy()
        values = column.values.to_numpy()
        a, b = [], []
        for s, e in zip(starts[:-1].tolist(), starts[1:].tolist()):
            members = [values[at[i] : at[i + 1]] for i in range(s, e)]
            size = np.array([len(m) for m in members])
            if e - s == 1 or not size.all():
                continue
            common = intersections(members)
            linked = of * common >= least * (size[:, None] + size[None, :] - common)
            linked &= _pairs_of(own[s:e], left[s], right[s])
            moved, first = stars(linked)
            a += ids[s:e][moved].tolist()
            b += ids[s:e][first].tolist()
        return {"a": a, "b": b}

    return grouped_arrow(dealt, ["family", "left", "right"], [], compare, "a long, b long")


def shingle_sets(docs: DataFrame, shingle: int) -> DataFrame:
    """(family, node, shingles) for rows of (family, node, text)."""

    def work():
        def step(batch):
            if batch is None:
                return
            families, nodes = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            held, first, n = [], 0, 0
            for i, t in enumerate(batch.column(2), 1):
                held.append(shingle_set(words_of(t.as_py() or ""), shingle).view(np.int64))
                n += len(held[-1])
                if n >= WORDS_AT_ONCE or i == batch.num_rows:
                    yield {
                        "family": families[first:i],
                        "node": nodes[first:i],
                        "shingles": lists(
                            np.concatenate(held), np.cumsum([0, *map(len, held)])
                        ),
                    }
                    held, first, n = [], i, 0

        return step

    frame = docs.select("family", "node", "text")
    return arrow_rows(frame, work, "family long, node long, shingles array<long>")


def near_duplicates(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE,
    similarity: tuple[int, int] = SIMILARITY,
    symbols: int = SYMBOLS,
    chunks: int = CHUNKS,
    distance: int = DISTANCE,
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), one row per row of ``docs``."""
    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    rows = materialise(profiles(source, shingle, symbols), "profiles")
    known = rows.where("digest is not null and doc_id is not null")
    classes = materialise(
        known.groupBy("digest").agg(
            F.min("doc_id").alias("node"), F.min("signature").alias("signature")
        ),
        "classes",
    )
    close = candidate_links(classes.select("node", "signature"), chunks, distance, symbols)
    families = materialise(
        components(close, "a", "b").withColumnRenamed("component", "family"), "families"
    )
    texts = (
        source.join(families, F.col("doc_id") == F.col("node"))
        .select("family", "node", "text", F.xxhash64("text").alias("_text"))
        .dropDuplicates(["family", "node", "_text"])
    )
    sets = materialise(shingle_sets(texts, shingle), "sets")
    links = confirmed_links(sets, similarity)
    # A doc_id that rows repeat with other texts ties the classes of these.
    repeated = (
        known.groupBy("doc_id")
        .agg(F.min("digest").alias("least"), F.max("digest").alias("most"))
        .where("least <> most")
        .select("doc_id")
    )
    ties = (
        known.join(repeated, "doc_id", "left_semi")
        .join(classes, "digest")
        .select(F.col("doc_id").alias("a"), F.col("node").alias("b"))
    )
    found = components(links.union(ties), "a", "b")
    grouped = classes.join(found, "node", "left").select(
        "digest", F.coalesce("component", "node").alias("component")
    )
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return (
        rows.join(grouped, "digest", "left")
        .withColumn("component_id", own)
        .select(
            "doc_id",
            "n_shingles",
            "component_id",
            F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"),
        )
    )
