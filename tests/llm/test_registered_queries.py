"""Rows of registered queries, recomputed in plain Python from the given tables."""

from __future__ import annotations

import hashlib
import math
import re
import struct
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from veritrail.llm import language_id, queries

FOLDER = "/root/testdata/sf0.001"


def table(spark, name):
    return spark.read.parquet(f"{FOLDER}/{name}.parquet")


# Language


def log_add(a, b):
    high, low = max(a, b), min(a, b)
    return high if low == -math.inf else high + math.log1p(math.exp(low - high))


class PlainModel:
    """Piece probabilities and the sum over all segmentations, word by word."""

    def __init__(self):
        pieces = language_id.read_pieces(queries.language_pieces())
        self.size = len(pieces)
        self.bytes = {int(p[3:5], 16): i for i, p in enumerate(pieces) if re.fullmatch("<0x..>", p)}
        self.index = {p: i for i, p in enumerate(pieces) if not re.fullmatch("<0x..>", p)}
        self.longest = max(map(len, self.index))

    def arcs(self, word):
        """(start, end, pieces) of everything that a segmentation may use."""
        text, out = "▁" + word, []
        for i in range(len(text)):
            for j in range(i + 1, min(len(text), i + self.longest) + 1):
                if text[i:j] in self.index:
                    out.append((i, j, [self.index[text[i:j]]]))
            if text[i] not in self.index:
                out.append((i, i + 1, [self.bytes[b] for b in text[i].encode()]))
        return out, len(text)

    def forward(self, arcs, n, logs):
        sums = [0.0] + [-math.inf] * n
        for i, j, own in sorted(arcs, key=lambda a: a[0]):
            sums[j] = log_add(sums[j], sums[i] + sum(logs[p] for p in own))
        return sums

    def round(self, words, logs):
        """The next probabilities from the expected uses in ``words``."""
        used = [language_id.PRIOR] * self.size
        for word, count in words.items():
            arcs, n = self.arcs(word)
            ahead = self.forward(arcs, n, logs)
            turned = [(n - j, n - i, own) for i, j, own in arcs]
            back = self.forward(turned, n, logs)[::-1]
            for i, j, own in arcs:
                share = math.exp(ahead[i] + sum(logs[p] for p in own) + back[j] - ahead[n])
                for p in own:
                    used[p] += count * share
        total = sum(used)
        return [math.log(u / total) for u in used]


def plain_words(text):
    return re.findall(r"[^\W\d_]+", (text or "").lower())


def test_languages_of_the_query_equal_plain_python(spark):
    docs = table(spark, "documents").select("doc_id", "text", "lang").collect()
    apart = {d.doc_id: zlib.crc32(str(d.doc_id).encode()) % 3 == 1 for d in docs}
    plain = PlainModel()
    learned: dict = {}
    for d in docs:
        if d.lang is not None and not apart[d.doc_id]:
            for w in plain_words(d.text):
                counts = learned.setdefault(d.lang, {})
                counts[w] = counts.get(w, 0) + 1
    models = {}
    for lang, words in learned.items():
        logs = [math.log(1 / plain.size)] * plain.size
        for _ in range(language_id.ROUNDS):
            logs = plain.round(words, logs)
        models[lang] = logs
    seen: dict = {}

    def likelihood(word, lang):
        if (word, lang) not in seen:
            arcs, n = plain.arcs(word)
            seen[word, lang] = plain.forward(arcs, n, models[lang])[n]
        return seen[word, lang]

    got = {r.doc_id: r for r in queries.QUERIES["op1_language_id"](spark, FOLDER).collect()}
    assert len(got) == len(docs)
    for d in docs[::4]:
        r, words = got[d.doc_id], plain_words(d.text)[:4000]
        assert r.held_out == apart[d.doc_id]
        if not any(c.isalpha() for w in words for c in w):
            assert (r.lang_pred, r.score) == ("und", 0.0)
            continue
        if len(plain_words(d.text)) > 4000:
            continue
        totals = {lang: sum(likelihood(w, lang) for w in words) for lang in models}
        best = max(sorted(totals), key=totals.get)
        assert r.lang_pred == best
        want = 1 / sum(math.exp(t - totals[best]) for t in totals.values())
        assert r.score == pytest.approx(want, abs=1e-6)


def test_held_out_rows_do_not_reach_the_models(spark, tmp_path):
    docs = table(spark, "documents")
    apart = language_id.held_out(F.col("doc_id"))
    odd = docs.withColumns(
        {
            "lang": F.when(apart, "zz").otherwise(F.col("lang")),
            "text": F.when(apart, F.reverse("text")).otherwise(F.col("text")),
        }
    )
    odd.write.parquet(f"{tmp_path}/documents.parquet")

    def rows(folder):
        found = queries.QUERIES["op1_language_id"](spark, folder).where("not held_out").collect()
        return {r.doc_id: (r.lang_pred, round(r.score, 9)) for r in found}

    assert rows(str(tmp_path)) == rows(FOLDER)


# Packing


def test_best_fit_packing_fills_every_sequence_as_well_as_any(spark):
    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    got = queries.QUERIES["op6_best_fit_packing"](spark, FOLDER).collect()
    by_doc: dict = {}
    sequences: dict = {}
    for r in got:
        by_doc.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append(r)
    docs = table(spark, "documents").select("doc_id", "text").collect()
    assert set(by_doc) == {d.doc_id for d in docs}
    for d in docs:
        ids = tokenizer.encode(d.text or "", add_special_tokens=False).ids + [1]
        pieces = sorted(by_doc[d.doc_id], key=lambda r: r.piece)
        assert [(r.piece, r.start, r.length) for r in pieces] == [
            (n, at, min(4096, len(ids) - at)) for n, at in enumerate(range(0, len(ids), 4096))
        ]
        for r in pieces:
            own = ids[r.start : r.start + r.length]
            assert r.ids_crc32 == zlib.crc32(struct.pack(f"<{len(own)}I", *own))
    left = sorted(r.length for r in got)
    for s in sorted(sequences):
        at = 0
        for r in sorted(sequences[s], key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        reach = 1
        room = 4096 - left[-1]
        for n in left[:-1]:
            reach |= (reach << n) & ((1 << (room + 1)) - 1)
        assert at == left[-1] + reach.bit_length() - 1 <= 4096
        for r in sequences[s]:
            left.remove(r.length)
    assert left == []


# Neighbours


def test_nearest_neighbours_of_the_query(spark):
    rows = table(spark, "embeddings").select("vec_id", "embedding").collect()
    ids = np.array([r.vec_id for r in rows])
    v = np.array([r.embedding for r in rows], float)
    v /= np.linalg.norm(v, axis=1)[:, None]
    got: dict = {}
    for r in queries.QUERIES["op7_nearest_neighbours"](spark, FOLDER).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert set(got) == {i for i in ids.tolist() if i % 50 == 0}
    place = {i: n for n, i in enumerate(ids.tolist())}
    hits = 0
    for q, found in got.items():
        sims = v @ v[place[q]]
        order = [i for i in np.lexsort((ids, -sims)) if ids[i] != q][:5]
        found.sort()
        assert [k for k, *_ in found] == [1, 2, 3, 4, 5]
        for _, i, score in found:
            assert score == pytest.approx(sims[place[i]], abs=1e-12)
        assert found == sorted(found, key=lambda x: (-x[2], x[1]))
        hits += len({i for _, i, _ in found} & set(ids[order].tolist()))
    assert hits >= 0.95 * 5 * len(got)


# Conversations


def test_digests_of_the_conversations(spark):
    turns = table(spark, "conversations").select("conv_id", "turn", "role", "text").collect()
    rows = [(t.conv_id, t.turn, t.role, t.text or "") for t in turns]
    rows += [(-7, 0, "user", queries.CONTROL_TEXT), (-7, 1, "assistant", queries.CONTROL_TEXT)]
    got = {r.conv_id: r for r in queries.QUERIES["op10_chat_formatting"](spark, FOLDER).collect()}
    assert set(got) == {r[0] for r in rows}
    for conv, r in got.items():
        own = sorted(x for x in rows if x[0] == conv)
        text = "".join(f"{role}\n{said}\n" for _, _, role, said in own)
        loss = "".join(said for _, _, role, said in own if role == "assistant")
        assert (r.n_turns, r.turns_sha256) == (len(own), hashlib.sha256(text.encode()).hexdigest())
        assert (r.loss_chars, r.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert r.formatted_chars > len(text)
