"""Packing balanced by attention cost.

A piece of n tokens costs ``LINEAR * n + QUADRATIC * n * n``: projections grow
with its length, attention with the square. Pieces, longest first, go to the
sequence of least cost that still has room for them. If none has, the piece is
cut: it fills the room of the cheapest sequence that is not full, and its rest
waits among the pieces of the rest's length. There are just as many sequences as
tokens fill: whole ones, and one for each power of two in what is left over, so
that no sequence needs padding.

Only lengths and the sequences' state matter, so sequences of equal state are
one class and pieces of one length are dealt to a class in one step; the work
depends on the capacity, not on the size of the corpus. A piece finds its steps
by its rank among the pieces of its length: its place in the task that encoded
it, after the pieces of that length in the tasks before.

Defined results: a null text is empty, its document is the closing id alone; a
longer document than the capacity is cut into whole sequences and a rest;
repeated rows are documents of their own; null doc_id stays null; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from veritrail.llm.byte_bpe import words_of
from veritrail.llm.common import arrow_rows, importable
from veritrail.llm.word_encoder import WordEncoder, single_threaded
from veritrail.sources.scratch import materialise

CAPACITY = 1024
CLOSING_ID = 0
#: Per token and per pair of tokens, for a model of width 1,024: six
#: multiplications of a width in projections to one in attention.
LINEAR, QUADRATIC = 6 * 1024, 1

#: Words that a worker keeps; here it has no second Python process beside it.
CACHED_WORDS = 300_000

_ENCODED = (
    "doc_id long, tokens long, task int, whole_before long, rest int, rest_before long, ids binary"
)
PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long"
)

#: White space other than space and line feed.
_RARE = [c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \n"]

_workers: dict[str, WordEncoder] = {}


def _worker(path: str) -> WordEncoder:
    if path not in _workers:
        single_threaded()
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        # Strings of special tokens in a text are ordinary text.
        tokenizer.encode_special_tokens = True
        _workers[path] = WordEncoder(tokenizer, True, CACHED_WORDS)
    return _workers[path]


def cut(text: str) -> list[str]:
    """``words_of``, without its regular expression where no white space can
    stand beside a space, as in most texts."""
    wide = "  " in text or " \n" in text or "\n " in text
    return words_of(text) if wide or any(c in text for c in _RARE) else text.split(" ")


def document_ids(text: str, words: WordEncoder) -> np.ndarray:
    first, *rest = cut(text)
    closing = CLOSING_ID.to_bytes(4, "little")
    return np.frombuffer(words.start(first) + words.encode(rest) + closing, "<u4")


def encode(
    docs: DataFrame, path: str, capacity: int = CAPACITY, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per document: its ids, packed in 2 bytes each where the
    vocabulary allows it, and how many whole pieces and rests of its rest's
    length its task has met before it."""

    def work():
        words = _worker(path)
        kind = "<u2" if words.tokenizer.get_vocab_size() <= 2**16 else "<u4"
        task = TaskContext.get().partitionId()
        met = np.zeros(capacity + 1, np.int64)

        def step(batch):
            if batch is None or not batch.num_rows:
                return []
            out = {c.split()[0]: [] for c in _ENCODED.split(", ")}
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = document_ids(t.as_py() or "", words)
                whole, rest = divmod(len(ids), capacity)
                row = (i, len(ids), task, met[capacity], rest, met[rest], ids.astype(kind).tobytes())
                for values, value in zip(out.values(), row):
                    values.append(value)
                met[capacity] += whole
                if rest:
                    met[rest] += 1
            return [out]

        return step

    frame = docs.select(F.col(doc_id).cast("long"), F.col(text).cast("string"))
    return arrow_rows(frame, work, _ENCODED)


def balance(
    histogram: dict[int, int], capacity: int, linear: int = LINEAR, quadratic: int = QUADRATIC
) -> dict[str, np.ndarray]:
    """Steps of the assignment, sorted by length, then rank: pieces of
    ``length`` from rank ``first`` on put ``take`` tokens at ``offset`` of the
    sequences from ``sequence`` on, one each. What a step leaves of its pieces
    are pieces of the rest's length from rank ``rest_first`` on."""
    left = np.zeros(capacity + 1, np.int64)
    for length, n in histogram.items():
        left[length] = n
    whole, over = divmod(int(left @ np.arange(capacity + 1)), capacity)
    powers = [1 << bit for bit in reversed(range(capacity.bit_length())) if over >> bit & 1]
    # Classes of sequences. A step splits at most one class, when a length ends.
    names = ("room", "cost", "offset", "first", "number")
    of = {n: np.zeros(capacity + len(powers) + 2, np.int64) for n in names}
    live = 0

    def put(at: int, *values: int) -> None:
        for n, value in zip(names, values):
            of[n][at] = value

    for room, first, number in [(capacity, 0, whole)] * bool(whole) + [
        (power, whole + n, 1) for n, power in enumerate(powers)
    ]:
        put(live, room, 0, 0, first, number)
        live += 1
    steps, ranked = [], np.zeros(capacity + 1, np.int64)
    for length in range(capacity, 0, -1):
        while left[length]:
            cost = of["cost"][:live]
            fits = of["room"][:live] >= length
            # Cheapest first, the first sequence among equals.
            ties = np.flatnonzero(fits & (cost == cost[fits].min()) if fits.any() else cost == cost.min())
            at = ties[of["first"][ties].argmin()] if len(ties) > 1 else ties[0]
            room, paid, offset, first, number = (int(of[n][at]) for n in names)
            take, times = min(length, room), min(int(left[length]), number)
            rest = length - take
            rest_first = int(ranked[rest] + left[rest]) if rest else 0
            steps.append((length, int(ranked[length]), take, first, offset, rest_first))
            ranked[length] += times
            left[length] -= times
            if rest:
                left[rest] += times
            if number > times:
                put(live, room, paid, offset, first + times, number - times)
                live += 1
            if room > take:
                more = linear * take + quadratic * take * take
                put(at, room - take, paid + more, offset + take, first, times)
            else:
                live -= 1
                put(at, *(int(of[n][live]) for n in names))
    steps.sort()
    names = ("length", "first", "take", "sequence", "offset", "rest_first")
    columns = zip(*steps) if steps else [[]] * len(names)
    return {n: np.array(c, np.int64) for n, c in zip(names, columns)}


def _ranks(encoded: DataFrame, capacity: int) -> tuple[DataFrame, dict[int, int]]:
    """(task, length, before): pieces of a length in the tasks before, and the
    number of pieces of each length, at most ``capacity`` rows."""
    wholes = encoded.groupBy("task").agg(
        F.lit(capacity).alias("length"),
        F.sum(F.floor(F.col("tokens") / capacity)).alias("n"),
    )
    rests = encoded.where("rest > 0").groupBy("task", F.col("rest").alias("length")).agg(
        F.count(F.lit(1)).alias("n")
    )
    counted = materialise(rests.unionByName(wholes.where("n > 0").select("task", "length", "n")), "lengths")
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    before = counted.select(
        "task", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")
    )
    histogram = {r.length: r.n for r in counted.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    return materialise(before, "ranks"), histogram


def _followed(steps: dict, row, start, length, rank) -> list[tuple]:
    """(row, start, take, sequence, offset) of all parts of the pieces."""
    order = steps["length"] * 2**42 + steps["first"]
    found = []
    while len(row):
        at = np.searchsorted(order, length * 2**42 + rank, "right") - 1
        nth = rank - steps["first"][at]
        take = steps["take"][at]
        found.append((row, start, take, steps["sequence"][at] + nth, steps["offset"][at]))
        more = length > take
        row, start = row[more], (start + take)[more]
        rank = (steps["rest_first"][at] + nth)[more]
        length = (length - take)[more]
    return found


def pack_documents(
    docs: DataFrame,
    path: str,
    capacity: int = CAPACITY,
    linear: int = LINEAR,
    quadratic: int = QUADRATIC,
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: where it begins in its document, and the sequence and
    offset it is packed at; with ``with_ids`` also its ids as an array."""
    encoded = materialise(encode(docs, path, capacity), "encoded")
    before, histogram = _ranks(encoded, capacity)
    steps = balance(histogram, capacity, linear, quadratic)
    wholes = before.where(F.col("length") == capacity)
    ranked = (
        encoded.join(
            before.where(F.col("length") < capacity).withColumnsRenamed(
                {"length": "rest", "before": "rests_earlier"}
            ),
            ["task", "rest"],
            "left",
        )
        .join(wholes.select("task", F.col("before").alias("wholes_earlier")), "task", "left")
        .select(
            "doc_id", "tokens", "rest", "ids",
            (F.col("whole_before") + F.coalesce("wholes_earlier", F.lit(0))).alias("whole_rank"),
            (F.col("rest_before") + F.coalesce("rests_earlier", F.lit(0))).alias("rest_rank"),
        )
    )

    def work():
        def step(batch):
            if batch is None or not batch.num_rows:
                return []
            tokens = batch.column("tokens").to_numpy()
            rest = batch.column("rest").to_numpy().astype(np.int64)
            whole = tokens // capacity
            own = np.repeat(np.arange(len(tokens)), whole)
            nth = np.arange(len(own)) - np.repeat(np.cumsum(whole) - whole, whole)
            some = np.flatnonzero(rest)
            row = np.concatenate([own, some])
            start = np.concatenate([nth * capacity, (whole * capacity)[some]])
            length = np.concatenate([np.full(len(own), capacity), rest[some]])
            rank = np.concatenate([
                batch.column("whole_rank").to_numpy()[own] + nth,
                batch.column("rest_rank").to_numpy()[some],
            ])
            parts = _followed(steps, row, start, length, rank)
            row, start, take, sequence, offset = (np.concatenate(c) for c in zip(*parts))
            raw = [v.as_buffer() for v in batch.column("ids")]
            size = [len(raw[i]) // int(n) for i, n in enumerate(tokens)]
            crc, ids = [], []
            for r, s, n in zip(row.tolist(), start.tolist(), take.tolist()):
                own = np.frombuffer(raw[r], f"<u{size[r]}", n, s * size[r]).astype("<u4")
                crc.append(zlib.crc32(own.tobytes()))
                if with_ids:
                    ids.append(own.astype(np.int32))
            out = {
                "doc_id": batch.column("doc_id").take(pa.array(row)),
                "start": start, "length": take, "ids_crc32": crc, "doc_tokens": tokens[row],
                "sequence_id": sequence, "offset": offset, "ids": ids,
            }
            return [out]

        return step

    return arrow_rows(importable(ranked), work, PIECES + ", ids array<int>" * with_ids)
