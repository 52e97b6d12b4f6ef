"""Byte-level BPE encoding and decoding with the tokenizers library.

Encoding works on Arrow batches; texts are cut at single spaces between
non-spaces, where no match of the split pattern can cross, and each distinct
word of a task is encoded once. Decoding reverses the byte table; bytes are
joined before they are read as UTF-8, so characters that tokens split come back
whole.

Defined results: a null text encodes as empty; ids of an empty text are an
empty list; repeated rows each give a row; an empty table gives an empty
result; all other columns pass through, except that ``ids`` (and the offset
columns) replace columns of that name.
"""

from __future__ import annotations

import base64
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veritrail.llm.common import importable
from veritrail.llm.word_encoder import WordEncoder, byte_chars, single_threaded

#: White space next to the space that a text would be cut at.
_WIDE = re.compile(r"\s | \s")
_CUT = re.compile(r"(?<=\S) (?=\S)")

_workers: dict[tuple[str, str], tuple[WordEncoder, list[bytes]]] = {}


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x.strip())}


def build_tokenizer(ranks: dict[bytes, int], pattern: str):
    """A tokenizers.Tokenizer with the merges that a rank file implies: two
    neighbours merge if their bytes are a token, lowest rank first."""
    single_threaded()
    from tokenizers import Regex, Tokenizer, models, pre_tokenizers

    chars = byte_chars()
    text = {token: "".join(chars[b] for b in token) for token in ranks}
    merges = [
        (text[token[:i]], text[token[i:]])
        for token in sorted(ranks, key=ranks.get)
        for i in range(1, len(token))
        if token[:i] in ranks and token[i:] in ranks
    ]
    model = models.BPE(
        vocab={text[t]: n for t, n in ranks.items()}, merges=merges, ignore_merges=True
    )
    tokenizer = Tokenizer(model)
    tokenizer.pre_tokenizer = pre_tokenizers.Sequence(
        [
            pre_tokenizers.Split(Regex(pattern), "isolated"),
            pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
        ]
    )
    return tokenizer


def _worker(path: str, pattern: str) -> tuple[WordEncoder, list[bytes]]:
    if (path, pattern) not in _workers:
        words = WordEncoder(build_tokenizer(read_ranks(path), pattern), True)
        _workers[path, pattern] = words, token_bytes(path)
    return _workers[path, pattern]


def token_bytes(path: str) -> list[bytes]:
    """The bytes of every id; ids that the file leaves free have none."""
    ranks = read_ranks(path)
    tokens = [b""] * (max(ranks.values()) + 1)
    for token, n in ranks.items():
        tokens[n] = token
    return tokens


def words_of(text: str) -> list[str]:
    """The text cut at single spaces; joined by them, the words are the text."""
    return _CUT.split(text) if _WIDE.search(text) else text.split(" ")


def encode_text(text: str, words: WordEncoder) -> np.ndarray:
    first, *rest = words_of(text)
    return np.frombuffer(words.start(first) + words.encode(rest), "<u4")


def offsets_of(text: str, ids: np.ndarray, token_bytes: np.ndarray) -> tuple[np.ndarray, ...]:
    """Characters [start, end) that each token's bytes lie in. Tokens that
    share a split character both cover it."""
    ends = np.cumsum(token_bytes[ids])
    raw = np.frombuffer(text.encode(), np.uint8)
    char = np.cumsum((raw & 0xC0) != 0x80) - 1
    return char[ends - token_bytes[ids]], char[ends - 1] + 1


def encode(
    df: DataFrame,
    path: str,
    pattern: str,
    text: str = "text",
    offsets: bool = False,
    keep: list[str] | None = None,
) -> DataFrame:
    """``df`` (or its columns ``keep``) with ``ids`` (and ``starts``, ``ends``:
    characters of each token)."""
    new = ["ids", "starts", "ends"] if offsets else ["ids"]
    kept = [c for c in (df.columns if keep is None else keep) if c not in new]
    source = "_encoded_text"
    frame = df.select(*(f"`{c}`" for c in kept), F.col(text).cast("string").alias(source))
    schema = df.select(
        *(f"`{c}`" for c in kept), *(F.lit(None).cast("array<int>").alias(c) for c in new)
    ).schema

    def run(batches):
        words, tokens = _worker(path, pattern)
        sizes = np.array([len(t) for t in tokens])
        for batch in batches:
            if not batch.num_rows:
                continue
            found = [[] for _ in new]
            for value in batch.column(source):
                value = value.as_py() or ""
                ids = encode_text(value, words)
                found[0].append(ids.astype(np.int32))
                if offsets:
                    for into, at in zip(found[1:], offsets_of(value, ids, sizes)):
                        into.append(at.astype(np.int32))
            columns = [batch.column(c) for c in kept]
            for values in found:
                at = np.cumsum([0, *map(len, values)]).astype(np.int32)
                columns.append(pa.ListArray.from_arrays(at, np.concatenate(values)))
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, *new])

    return importable(frame).mapInArrow(run, schema)


def decode(df: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """``df`` with ``decoded``, the bytes that its ids stand for. Null ids give
    null; an id outside the vocabulary is an error."""
    frame = df.drop("decoded")
    schema = frame.withColumn("decoded", F.lit(None).cast("binary")).schema

    def run(batches):
        tokens = token_bytes(path)
        for batch in batches:
            done = [
                b"".join(map(tokens.__getitem__, v.values.to_numpy().tolist()))
                if v.is_valid
                else None
                for v in batch.column(ids)
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(done, pa.binary())], names=schema.names
            )

    return importable(frame).mapInArrow(run, schema)
