"""Best-fit packing by minimum bin slack.

Bins of ``capacity`` tokens are filled one after another. Each starts with the
longest piece left; a subset-sum program over bitsets finds the combination of
lengths left that fills it best, and that combination is removed. Only lengths
matter to it, so it runs on the histogram of lengths, which has at most
``capacity`` rows whatever the size of the corpus. A combination is used as
often as its lengths last, so each use exhausts a length and there are at most
``capacity`` different combinations. Pieces then find their place by their rank
among the pieces of their length, which Spark counts in salted groups.

Defined results: a null text is empty, its document is the closing id alone; a
document longer than the capacity is cut into full pieces and a rest; repeated
rows are documents of their own; null doc_id stays null; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from veritrail.llm.common import arrow_rows, importable
from veritrail.llm.word_encoder import WordEncoder, single_threaded
from veritrail.sources.scratch import materialise

CAPACITY = 4096
CLOSING_ID = 1
#: Pieces of one length that are ranked together in a task.
RANKED_TOGETHER = 1_000

#: Words that a worker keeps; here it has no second Python process beside it.
CACHED_WORDS = 300_000

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"

_workers: dict[str, WordEncoder] = {}


def _worker(path: str) -> WordEncoder:
    if path not in _workers:
        single_threaded()
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        # Strings of special tokens in a text are ordinary text.
        tokenizer.encode_special_tokens = True
        _workers[path] = WordEncoder(tokenizer, False, CACHED_WORDS)
    return _workers[path]


def packed_ids(text: str, words: WordEncoder) -> bytes:
    """A document's ids; white space belongs to no match, so words are cut at it."""
    parts = text.replace("\n", " ").split(" ")
    return words.encode(parts) + CLOSING_ID.to_bytes(4, "little")


def pieces(
    docs: DataFrame,
    path: str,
    capacity: int = CAPACITY,
    doc_id: str = "doc_id",
    text: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece; with ``with_ids`` also its ids as packed bytes."""
    names = [c.split()[0] for c in PIECES.split(", ")]

    def work():
        words = _worker(path)

        def step(batch):
            if batch is None or not batch.num_rows:
                return []
            rows = []
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = packed_ids(t.as_py() or "", words)
                for n, at in enumerate(range(0, len(ids), 4 * capacity)):
                    own = ids[at : at + 4 * capacity]
                    rows.append((i, n, at // 4, len(own) // 4, zlib.crc32(own), own))
            columns = dict(zip([*names, "ids"], zip(*rows)))
            return [{k: list(v) for k, v in columns.items() if k != "ids" or with_ids}]

        return step

    frame = docs.select(F.col(doc_id).cast("long"), F.col(text).cast("string"))
    return arrow_rows(frame, work, PIECES + ", ids binary" * with_ids)


def fullest(counts: dict[int, int], lengths: list[int], room: int) -> list[int]:
    """Lengths of the combination that fills ``room`` best; ``lengths`` are
    those of ``counts``, longest first. Bit s of a set: a sum of s can be made."""
    reach, steps = 1, []
    mask = (1 << (room + 1)) - 1
    for length in lengths:
        if length > room:
            continue
        left, share = min(counts[length], room // length), 1
        while left:
            # Copies in powers of two reach every number of them.
            take = min(share, left)
            steps.append((length, take, reach))
            reach |= (reach << (length * take)) & mask
            left, share = left - take, share * 2
        if reach >> room & 1:
            break
    total, chosen = reach.bit_length() - 1, []
    for length, take, before in reversed(steps):
        if not before >> total & 1:
            total -= length * take
            chosen += [length] * take
    return chosen


def combinations(histogram: dict[int, int], capacity: int) -> list[tuple[list[int], int]]:
    """(lengths, times) of every combination, in the order of the bins."""
    counts = dict(histogram)
    lengths = sorted(counts, reverse=True)
    found = []
    while lengths:
        longest = lengths[0]
        counts[longest] -= 1
        chosen = [longest, *fullest(counts, lengths, capacity - longest)]
        counts[longest] += 1
        used = {n: chosen.count(n) for n in chosen}
        times = min(counts[n] // k for n, k in used.items())
        for n, k in used.items():
            counts[n] -= k * times
        lengths = [n for n in lengths if counts[n]]
        found.append((sorted(chosen, reverse=True), times))
    return found


def places(found: list[tuple[list[int], int]]) -> dict[str, np.ndarray]:
    """Runs of ranks: pieces of ``length`` with rank from ``first`` on, ``each``
    to a sequence, go to sequences from ``sequence`` on at ``offset``."""
    runs, used, sequence = [], {}, 0
    for lengths, times in found:
        offset = 0
        for n in dict.fromkeys(lengths):
            each = lengths.count(n)
            runs.append((n, used.get(n, 0), each, sequence, offset))
            used[n] = used.get(n, 0) + each * times
            offset += n * each
        sequence += times
    runs.sort()
    names = ("length", "first", "each", "sequence", "offset")
    return {k: np.array(v, np.int64) for k, v in zip(names, zip(*runs))} if runs else {}


def ranked(parts: DataFrame) -> DataFrame:
    """``parts``, a stored table, with its rank, from 0, among the pieces of its
    length. Hot lengths are salted by the number of the row, so that equal rows
    part too; salts are as many as the pieces need."""
    counted = parts.groupBy("length").agg(F.count(F.lit(1)).alias("_n"))
    numbered = parts.withColumn("_nth", F.monotonically_increasing_id())
    salted = numbered.join(F.broadcast(counted), "length").withColumn(
        "_salt", F.pmod(F.xxhash64("_nth"), F.ceil(F.col("_n") / RANKED_TOGETHER))
    )
    before = (
        Window.partitionBy("length")
        .orderBy("_salt")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    salts = (
        salted.groupBy("length", "_salt")
        .agg(F.count(F.lit(1)).alias("_m"))
        .select(
            "length",
            "_salt",
            F.coalesce(F.sum("_m").over(before), F.lit(0)).alias("_before"),
        )
    )
    own = Window.partitionBy("length", "_salt").orderBy("_nth")
    return (
        salted.withColumn("_row", F.row_number().over(own))
        .join(salts, ["length", "_salt"])
        .withColumn("rank", F.col("_before") + F.col("_row") - 1)
        .select(*parts.columns, "rank")
    )


def pack(parts: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``parts``, a stored table, with the sequence_id and offset that each piece
    is packed at."""
    # At most ``capacity`` rows: lengths lie between 1 and the capacity.
    histogram = {r[0]: r[1] for r in parts.groupBy("length").count().collect()}
    runs = places(combinations(histogram, capacity))
    kept = parts.columns
    schema = parts.selectExpr("*", "0L AS sequence_id", "0L AS offset").schema

    def place(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            length = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy()
            order = runs["length"] * 2**40 + runs["first"]
            at = np.searchsorted(order, length * 2**40 + rank, "right") - 1
            nth = rank - runs["first"][at]
            sequence = runs["sequence"][at] + nth // runs["each"][at]
            offset = runs["offset"][at] + nth % runs["each"][at] * length
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), pa.array(sequence), pa.array(offset)],
                names=[*kept, "sequence_id", "offset"],
            )

    return importable(ranked(parts)).mapInArrow(place, schema)


def pack_documents(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    return pack(materialise(pieces(docs, path, capacity), "pieces"), capacity)
