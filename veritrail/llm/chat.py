"""Chat formatting in budgeted windows.

Every turn is in one window of its conversation; windows hold whole turns. A
window opens with the conversation's system turn and a limited history of the
turns before it; both are repeats and carry no loss. System turn, history and
own turns together stay within the budget: turns are added while they leave
room for the repeats, and the history is what the budget then has left. A
window of one long turn has less history, or none, and no system turn where
this does not fit. Windows start anew every CHUNK turns, so that a long
conversation is spread. Assistant turns carry loss in the one window they belong to.

Template of a turn::

    <|role|>          first occurrence        <|~role|>    a repeat
    text</turn>

Inside roles and texts a backslash precedes every backslash and ``<`` (in roles
also ``|``, ``~`` and line feed), so no text can form a control string and
reading back restores it exactly.

Defined results: null text or role reads as empty; rows are ordered by turn
(null first), then role, then text, so ties and repeated rows each count; rows
of null conv_id are one conversation; a turn longer than the budget has a
window of its own, without repeats; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from veritrail.llm.common import arrow_rows
from veritrail.llm.merkle import _ranked
from veritrail.sources.scratch import materialise

BUDGET = 1024
HISTORY = 256
#: Turns, by number, between which the prefix sums are taken apart, and turns
#: after which windows start anew.
CHUNK = 1024
#: Tokens counted for a turn's marks.
MARKS = 4

WINDOW_SCHEMA = (
    "conv_key string, conv_id long, window long, formatted string,"
    " loss_start array<int>, loss_end array<int>"
)
DIGEST_SCHEMA = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string,"
    " formatted_chars long"
)
_TURN = re.compile(r"<\|(~?)((?:[^\\|]|\\.)*)\|>\n((?:[^\\<]|\\.)*)</turn>\n", re.S)


def escape(text: str, marks: str = "\\<") -> str:
    return re.sub("([" + re.escape(marks) + "])", r"\\\1", text)


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S)


def placed_turns(turns: DataFrame, budget: int, history: int) -> DataFrame:
    """Every turn of every window: (conv_key, conv_id, window, part, idx, role,
    text, repeat). ``part`` 0 is a retained system turn, 1 all others."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = turns.select(
        F.coalesce(F.col("conv_id").cast("string"), F.lit("null")).alias("conv_key"),
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        text.alias("text"),
    ).withColumns(
        {
            "tokens": F.regexp_count("text", F.lit(r"[\p{L}\p{N}]+|[^\s\p{L}\p{N}]")) + MARKS,
            "chunk": F.coalesce(F.floor(F.col("turn") / CHUNK), F.lit(-(2**62)).cast("long")),
        }
    )
    rows = _dealt(rows)
    within = Window.partitionBy("conv_key", "chunk", "sub").orderBy(
        F.col("turn").asc_nulls_first(), "role", "text"
    )
    upto = within.rowsBetween(Window.unboundedPreceding, 0)
    before = (
        Window.partitionBy("conv_key")
        .orderBy("chunk", "sub")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    zero = F.lit(0).cast("long")
    chunks = (
        rows.groupBy("conv_key", "chunk", "sub")
        .agg(F.sum("tokens").alias("_t"), F.count(F.lit(1)).alias("_c"))
        .select(
            "conv_key",
            "chunk",
            "sub",
            F.coalesce(F.sum("_t").over(before), zero).alias("t0"),
            F.coalesce(F.sum("_c").over(before), zero).alias("c0"),
        )
    )
    rows = (
        rows.withColumn("run", F.sum("tokens").over(upto))
        .withColumn("rn", F.row_number().over(within))
        .join(chunks, ["conv_key", "chunk", "sub"])
        .withColumn("start", F.col("t0") + F.col("run") - F.col("tokens"))
        .withColumn("idx", F.col("c0") + F.col("rn") - 1)
    )
    systems = (
        rows.where("role = 'system'")
        .groupBy("conv_key")
        .agg(F.min_by(F.struct("idx", "role", "text", "tokens"), "idx").alias("sys"))
    )
    rows = rows.join(systems, "conv_key", "left").select(
        "conv_key", "conv_id", "role", "text", "tokens", "start", "idx", "sys"
    )
    rows = materialise(_windowed(rows, budget, history), "chat-turns")
    windows = (
        rows.groupBy("conv_key", "window")
        .agg(
            F.min("start").alias("first"),
            F.sum("tokens").alias("own"),
            F.first("conv_id").alias("conv_id"),
            F.first("sys").alias("sys"),
        )
        .withColumn("repeats", F.coalesce(F.col("window") > F.col("sys.idx"), F.lit(False)))
        .withColumn("room", F.lit(budget) - F.col("own"))
        .withColumn("repeats", F.col("repeats") & (F.col("sys.tokens") <= F.col("room")))
        .withColumn(
            "room",
            F.least(
                F.lit(history),
                F.col("room") - F.when(F.col("repeats"), F.col("sys.tokens")).otherwise(zero),
            ),
        )
    )
    here = ["conv_key", "conv_id", "window", "part", "idx", "role", "text", "repeat"]
    own = rows.withColumn("part", F.lit(1)).withColumn("repeat", F.lit(False))
    # A turn starts at most ``history`` tokens before a window that repeats it.
    reach = F.lit(max(1, history))
    after = F.floor(F.col("first") / reach)
    again = (
        rows.drop("window", "tokens", "conv_id")
        .withColumn("near", F.floor(F.col("start") / reach))
        .join(
            windows.where("room > 0")
            .select("conv_key", "conv_id", "window", "first", "room", F.explode(F.array(after, after - 1)).alias("near")),
            ["conv_key", "near"],
        )
        .where((F.col("idx") < F.col("window")) & (F.col("first") - F.col("start") <= F.col("room")))
        .where(F.col("sys.idx").isNull() | (F.col("sys.idx") != F.col("idx")))
        .withColumn("part", F.lit(1))
        .withColumn("repeat", F.lit(True))
    )
    kept = (
        windows.where("repeats")
        .select(
            "conv_key",
            "conv_id",
            "window",
            F.lit(0).alias("part"),
            F.col("sys.idx").alias("idx"),
            F.col("sys.role").alias("role"),
            F.col("sys.text").alias("text"),
            F.lit(True).alias("repeat"),
        )
    )
    return own.select(here).union(again.select(here)).union(kept.select(here))


def _dealt(rows: DataFrame) -> DataFrame:
    """``rows`` with ``sub``, the part of their chunk. Turn numbers that are null
    or repeat, or conversations that share a null id, may put very many rows in
    a chunk; such chunks are cut by the rows' rank in it."""
    large = rows.groupBy("conv_key", "chunk").agg(F.count(F.lit(1)).alias("_c"))
    large = materialise(large.where(F.col("_c") > 2 * CHUNK).drop("_c"), "large-chunks")
    zero = F.lit(0).cast("long")
    if not large.take(1):
        return rows.withColumn("sub", zero)
    key = ["conv_key", "chunk"]
    whole = rows.join(large, key, "left_anti").withColumn("sub", zero)
    cut = materialise(
        rows.join(large, key, "left_semi").withColumn("_of", F.concat_ws(":", *key)), "large-turns"
    )
    order = [F.col("turn").asc_nulls_first(), F.col("role").asc(), F.col("text").asc()]
    ranked = _ranked(cut, "_of", order).withColumn("sub", F.floor(F.col("rank") / CHUNK))
    return materialise(whole.unionByName(ranked.select(whole.columns)), "dealt-turns")


def _windowed(rows: DataFrame, budget: int, history: int) -> DataFrame:
    """``rows`` with ``window``, the idx of the first turn of their window. Holds
    one window's tokens."""
    names = [c for c in rows.columns if c != "sys"]
    flat = rows.select(
        *names,
        F.col("sys.idx").alias("sys_idx"),
        F.col("sys.role").alias("sys_role"),
        F.col("sys.text").alias("sys_text"),
        F.col("sys.tokens").cast("long").alias("sys_tokens"),
        F.floor(F.col("idx") / CHUNK).alias("part"),
    )
    placed = flat.repartition("conv_key", "part").sortWithinPartitions("conv_key", "part", "idx")
    schema = placed.withColumn("window", F.col("idx")).schema
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema)

    def work():
        held: dict = {"key": None}

        def step(batch):
            if batch is None or not batch.num_rows:
                return []
            columns = batch.to_pydict()
            starts = []
            for key, part, idx, tokens, sys_idx, sys_tokens in zip(
                *(columns[c] for c in ("conv_key", "part", "idx", "tokens", "sys_idx", "sys_tokens"))
            ):
                if (key, part) != held["key"] or held["own"] + tokens > held["room"]:
                    system = sys_tokens if sys_idx is not None and idx > sys_idx else 0
                    kept = min(history, max(0, budget - system) // 4)
                    held.update(key=(key, part), first=idx, own=0, room=budget - system - kept)
                held["own"] += tokens
                starts.append(held["first"])
            return [{**columns, "window": starts}]

        return step

    system = F.struct(
        F.col("sys_idx").alias("idx"), F.col("sys_role").alias("role"),
        F.col("sys_text").alias("text"), F.col("sys_tokens").alias("tokens"),
    )
    sys = F.when(F.col("sys_idx").isNotNull(), system).alias("sys")
    return arrow_rows(placed, work, schema).select(*names, sys, "window")


_WINDOW = ("conv_key", "conv_id", "window", "formatted", "loss_start", "loss_end")
_DIGEST = (
    "conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars",
)


def _columns(names, rows):
    """The rows as one set of columns, or none."""
    return [dict(zip(names, map(list, zip(*rows))))] if rows else []


def _renderer():
    """Turns sorted by window to one row per window; holds one window."""
    held: dict = {"key": None, "rows": []}

    def render(key, rows):
        parts, starts, ends, at = [], [], [], 0
        for role, text, repeat in rows:
            head = f"<|{'~' if repeat else ''}{escape(role, chr(92) + '<|~' + chr(10))}|>\n"
            body = escape(text)
            if role == "assistant" and not repeat:
                starts.append(at + len(head))
                ends.append(at + len(head) + len(body))
            parts += [head, body, "</turn>\n"]
            at += len(head) + len(body) + 8
        return (*key, "".join(parts), starts, ends)

    def step(batch):
        done = []
        if batch is None:
            done = [render(held["key"], held["rows"])] if held["rows"] else []
        else:
            for r in batch.to_pylist():
                key = (r["conv_key"], r["conv_id"], r["window"])
                if key != held["key"]:
                    if held["rows"]:
                        done.append(render(held["key"], held["rows"]))
                    held.update(key=key, rows=[])
                held["rows"].append((r["role"], r["text"], r["repeat"]))
        return _columns(_WINDOW, done)

    return step


def format_chats(turns: DataFrame, budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """One row per window with its text and the [start, end) code points of the
    loss mask. Windows are dealt one by one, so a long conversation is spread."""
    placed = placed_turns(turns, budget, history)
    by_window = placed.repartition("conv_key", "window").sortWithinPartitions(
        "conv_key", "window", "part", F.desc("repeat"), "idx"
    )
    return arrow_rows(by_window, _renderer, WINDOW_SCHEMA)


def parse_window(formatted: str) -> list[tuple[str, str, bool, int, int]]:
    """(role, text, repeat, body start, body end) of each turn of a window."""
    turns, at = [], 0
    while at < len(formatted):
        m = _TURN.match(formatted, at)
        if not m:
            raise ValueError(f"not a turn at {at}")
        turns.append(
            (unescape(m[2]), unescape(m[3]), m[1] == "~", m.start(3), m.end(3))
        )
        at = m.end()
    return turns


def _reader():
    """Windows sorted by conversation to one digest row each, as a stream."""
    now: dict = {"key": None}

    def result():
        return (
            now["conv_id"], now["n"], now["turns"].hexdigest(), now["chars"],
            now["loss"].hexdigest(), now["size"],
        )

    def step(batch):
        if batch is None:
            return _columns(_DIGEST, [result()] if now["key"] is not None else [])
        done = []
        for r in batch.to_pylist():
            if r["conv_key"] != now["key"]:
                if now["key"] is not None:
                    done.append(result())
                now.update(
                    key=r["conv_key"], conv_id=r["conv_id"], n=0, chars=0, size=0,
                    turns=hashlib.sha256(), loss=hashlib.sha256(),
                )
            now["size"] += len(r["formatted"])
            for role, text, repeat, _, _ in parse_window(r["formatted"]):
                if not repeat:
                    now["n"] += 1
                    now["turns"].update(f"{role}\n{text}\n".encode())
            for a, b in zip(r["loss_start"], r["loss_end"]):
                text = unescape(r["formatted"][a:b])
                now["chars"] += len(text)
                now["loss"].update(text.encode())
        return _columns(_DIGEST, done)

    return step


def read_back(windows: DataFrame) -> DataFrame:
    """Digest of each conversation, from its windows alone. A digest over a
    whole conversation is sequential; it runs as a stream over sorted windows,
    one window in memory."""
    ordered = windows.repartition("conv_key").sortWithinPartitions("conv_key", "window")
    return arrow_rows(ordered, _reader, DIGEST_SCHEMA)
