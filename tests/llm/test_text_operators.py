"""Licence scan, language identification, byte-level BPE, packing."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import string
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from veritrail.llm import byte_bpe, language_id, license_scan, packing
from veritrail.llm.word_encoder import WordEncoder

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string, lang string, score string, ids string, length string"

_ALPHABET = [
    *" \t\n\r'.,stredmABCdéñß1293–…中文日本語\x1c\x85　😀éΣςİ",
    *("  ", "   ", " \n", "\n\n", "'s", "'ll", "foo", "Bar", "\x01", "<|endoftext|>", "###"),
]


def noise(n: int, seed: int = 1) -> list[str]:
    pick = random.Random(seed)
    return ["".join(pick.choices(_ALPHABET, k=pick.randint(0, 50))) for _ in range(n)]


def frame(spark, texts, lang=None):
    rows = [(i, t, lang[i] if lang else None, "x", "y", "z") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


# Licence scan


@pytest.fixture(scope="module")
def automaton():
    return license_scan.Automaton()


def base_places(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    found = [
        (i, label)
        for label, phrase in license_scan.BASE_PHRASES
        for i in range(len(words))
        if words[i : i + len(phrase.split())] == phrase.split()
    ]
    at = [i for i, _ in found]
    labels = ",".join(sorted({label for _, label in found}))
    return len(words), len(found), min(at, default=None), max(at, default=None), labels


def licence_texts(n=400):
    pick = random.Random(2)
    words = "gnu General public license, apache cc by. mit the this é x licensed under 2 0".split()
    return [" ".join(pick.choices(words, k=pick.randint(0, 40))) for _ in range(n)]


def test_base_places_match_a_plain_search(automaton):
    for text in licence_texts() + noise(200):
        assert license_scan.scan_text(text, automaton)[:5] == base_places(text)


def test_matching_statistics_match_all_runs(automaton):
    runs = {
        tuple(t.words[i:j])
        for t in automaton.templates
        for i in range(len(t.words))
        for j in range(i + 1, len(t.words) + 1)
    }
    for text in licence_texts(60):
        ids = [automaton.ids[w] for w in license_scan.words_of(text) if w in automaton.ids]
        want = [
            next((e - s for s in range(e) if tuple(ids[s:e]) in runs), 0)
            for e in range(1, len(ids) + 1)
        ]
        assert [n for _, n in automaton.stream(ids)] == want


def test_best_chain_matches_all_subsets():
    pick = random.Random(3)
    for _ in range(200):
        matches = [
            (pick.randint(0, 20), pick.randint(0, 12), pick.randint(1, 5)) for _ in range(6)
        ]
        matches = [(a, b, min(n, 16 - b)) for a, b, n in matches]
        best = 0
        for k in range(1, 7):
            for some in itertools.combinations(sorted(matches), k):
                if all(
                    a[0] + a[2] <= b[0] and a[1] + a[2] <= b[1] for a, b in itertools.pairwise(some)
                ):
                    best = max(best, sum(m[2] for m in some))
        assert max(c for c, _, _ in license_scan.chain(matches, 16)) == best


def test_templates_are_found_through_edits(automaton):
    grant = dict(license_scan.TEMPLATES)["mit-grant"]
    edited = "Foo. " + grant.replace("free of charge", "free and open") + " bar"
    *_, labels, score, spans = license_scan.scan_text(edited, automaton)
    assert labels == "mit-grant" and 0.8 <= score < 1
    assert [s["label"] for s in spans] == ["mit-grant"] and spans[0]["first"] == 1
    line = "Licensed under CC BY-NC 4.0."
    assert license_scan.scan_text(line, automaton)[5] == "cc-by,cc-by-nc"
    assert license_scan.scan_text("nothing of the kind in here", automaton)[5:] == ("", 0.0, [])


def test_scan_keeps_every_row(spark):
    texts = [None, "", "...", "MIT License", "MIT License", "mit license " * 20_000]
    got = {r.doc_id: r for r in license_scan.scan(frame(spark, texts)).collect()}
    assert [got[i].n_base for i in range(6)] == [0, 0, 0, 1, 1, 20_000]
    assert got[0].first_word is None and got[5].last_word == 39_998
    assert license_scan.scan(frame(spark, [])).collect() == []


# Language identification


def all_segmentations(word, single, model):
    """Sum over the segmentations of a word, by recursion."""
    if not word:
        return 1.0
    total = 0.0
    for k in range(1, len(word) + 1):
        if word[:k] in single:
            total += model[single[word[:k]]] * all_segmentations(word[k:], single, model)
    if word[0] not in single:
        raw = np.prod([model[single[f"<0x{b:02X}>"]] for b in word[0].encode()])
        total += raw * all_segmentations(word[1:], single, model)
    return total


TINY = [*(f"<0x{b:02X}>" for b in range(256)), "▁", "a", "b", "c", "ab", "▁a", "abc", "bc", "▁ab"]


def test_forward_sum_is_over_all_segmentations():
    pieces = language_id.Pieces(TINY)
    random_model = np.random.default_rng(4).random((len(TINY) + 1, 3))
    random_model[-1] = 0
    index = {p: i for i, p in enumerate(TINY)}
    words = ["", "a", "abc", "cab", "abab", "zé", "aébc", "cabcabcab", "aaaaaaaaaaaa"]
    logs = language_id.log_likelihoods(words, pieces, random_model)
    for word, row in zip(words, logs):
        for k in range(3):
            want = all_segmentations("▁" + word, index, random_model[:, k])
            assert row[k] == pytest.approx(np.log(want))


def test_expected_counts_cover_the_words():
    pieces = language_id.Pieces(TINY)
    model = language_id._distribution(np.ones(len(TINY) + 1))
    words, counts = ["abc", "zé", "cab"], np.array([2.0, 1.0, 3.0])
    used = language_id.expected_counts(words, counts, pieces, model)
    letters = np.array([1 if p.startswith("<0x") else len(p) for p in TINY])
    # é is two bytes; every word has its start mark.
    assert (used * letters).sum() == pytest.approx(2 * 4 + 1 * (1 + 1 + 2) + 3 * 4)


def test_a_round_of_fitting_raises_the_likelihood():
    pieces = language_id.Pieces(TINY)
    words, counts = ["ab", "abc", "abab", "c"], np.array([5.0, 3.0, 2.0, 1.0])
    model = language_id._distribution(np.ones(len(TINY) + 1))
    before = -np.inf
    for _ in range(4):
        logs = language_id.log_likelihoods(words, pieces, model[:, None])[:, 0]
        assert (counts @ logs) >= before - 1e-9
        before = counts @ logs
        used = language_id.expected_counts(words, counts, pieces, model)
        model = language_id._distribution(np.append(used + 1e-9, 0))


def test_languages_are_told_apart(spark):
    folder = "/root/testdata/sf0.01/documents.parquet"
    docs = spark.read.parquet(folder)
    apart = language_id.held_out(docs.doc_id)
    models = language_id.fit(docs.where(~apart).select("doc_id", "lang", "text"), PIECES, rows=60)
    held = docs.where(apart).withColumnRenamed("lang", "score")
    got = language_id.predict(held, models, PIECES).collect()
    truth = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    right = sum(r.lang_pred == truth[r.doc_id] for r in got)
    assert len(got) > 200 and right / len(got) > 0.97
    assert all(0 <= r.score <= 1 for r in got)


def test_language_of_odd_texts(spark):
    docs = frame(spark, ["abc " * 40, "xyz " * 40] * 3, ["aa", "bb"] * 3)
    models = language_id.fit(docs.select("doc_id", "lang", "text"), PIECES)
    texts = [None, "", "12 ++ ²", "abc", "abc", "A" * 5000, "中文 字", "xyź"]
    got = {r.doc_id: r for r in language_id.predict(frame(spark, texts), models, PIECES).collect()}
    assert [got[i].lang_pred for i in range(5)] == ["und", "und", "und", "aa", "aa"]
    assert got[0].score == 0.0 and got[5].lang_pred in ("aa", "bb")
    assert got[0].length == "z"
    assert language_id.predict(frame(spark, []), models, PIECES).collect() == []
    empty = language_id.fit(docs.where("false").select("doc_id", "lang", "text"), PIECES)
    got = language_id.predict(frame(spark, ["abc"]), empty, PIECES).collect()
    assert [(r.lang_pred, r.score) for r in got] == [("und", 0.0)]


# Byte-level BPE


def test_ids_equal_the_rank_library():
    words, tokens = byte_bpe._worker(RANKS, public_tokenizers.PATTERN)
    library = tiktoken.Encoding(
        "own",
        pat_str=public_tokenizers.PATTERN,
        mergeable_ranks=byte_bpe.read_ranks(RANKS),
        special_tokens={},
    )
    for text in noise(4000) + ["Hello, World! It's 2024.\n\nBye now"]:
        ids = byte_bpe.encode_text(text, words)
        assert ids.tolist() == library.encode_ordinary(text)
        assert b"".join(tokens[i] for i in ids) == text.encode()


def test_offsets_cover_split_characters():
    words, tokens = byte_bpe._worker(RANKS, public_tokenizers.PATTERN)
    sizes = np.array([len(t) for t in tokens])
    for text in noise(300) + ["a中b😀"]:
        ids = byte_bpe.encode_text(text, words)
        starts, ends = byte_bpe.offsets_of(text, ids, sizes)
        at = 0
        for i, s, e in zip(ids, starts, ends):
            raw = text.encode()[at : at + len(tokens[i])]
            assert raw in text[s:e].encode() and e > s
            at += len(raw)


def test_encode_and_decode_frames(spark):
    texts = [None, "", "a b", "a b", "word " * 30_000, *noise(50)]
    ids = byte_bpe.encode(frame(spark, texts), RANKS, public_tokenizers.PATTERN, offsets=True)
    back = byte_bpe.decode(ids, RANKS)
    got = {r.doc_id: r for r in back.collect()}
    assert len(got) == len(texts) and got[0].ids == [] and got[0].score == "x"
    assert len(got[4].ids) == len(got[4].starts) == len(got[4].ends)
    for i, text in enumerate(texts):
        assert bytes(got[i].decoded).decode() == (text or "")
    assert byte_bpe.encode(frame(spark, []), RANKS, public_tokenizers.PATTERN).collect() == []


# Packing


def test_word_ids_equal_the_whole_tokenizer():
    words = packing._worker(WORD_BPE)
    library = Tokenizer.from_file(WORD_BPE)
    library.encode_special_tokens = True
    for text in noise(3000, 5):
        own = np.frombuffer(packing.packed_ids(text, words), "<u4").tolist()
        assert own == [*library.encode(text, add_special_tokens=False).ids, packing.CLOSING_ID]


def test_fullest_combination_matches_all_subsets():
    pick = random.Random(6)
    for _ in range(150):
        counts = {pick.randint(1, 30): pick.randint(1, 3) for _ in range(4)}
        room = pick.randint(0, 60)
        chosen = packing.fullest(counts, sorted(counts, reverse=True), room)
        assert all(chosen.count(n) <= counts[n] for n in chosen)
        best = max(
            s
            for some in itertools.product(*(range(c + 1) for c in counts.values()))
            if (s := sum(n * k for n, k in zip(counts, some))) <= room
        )
        assert sum(chosen) == best


def test_combinations_equal_one_bin_at_a_time():
    """Using a combination as often as it lasts packs what filling every bin
    anew packs."""
    pick = random.Random(7)
    for _ in range(30):
        counts = {pick.randint(1, 20): pick.randint(1, 9) for _ in range(5)}
        found = packing.combinations(counts, 24)
        used = {}
        for lengths, times in found:
            assert sum(lengths) <= 24
            for n in lengths:
                used[n] = used.get(n, 0) + times
        assert used == counts
        left, bins = dict(counts), 0
        while left:
            longest = max(left)
            left[longest] -= 1
            for n in packing.fullest(left, sorted(left, reverse=True), 24 - longest):
                left[n] -= 1
            left = {n: k for n, k in left.items() if k}
            bins += 1
        assert sum(times for _, times in found) == bins


def test_packed_documents(spark):
    texts = [None, "", "a b c", "a b c", "word " * 9000, *noise(300, 8)]
    got = packing.pack_documents(frame(spark, texts), WORD_BPE, 64).collect()
    words = packing._worker(WORD_BPE)
    by_doc, by_sequence = {}, {}
    for r in got:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    for i, text in enumerate(texts):
        ids = packing.packed_ids(text or "", words)
        parts = sorted(by_doc[i], key=lambda r: r.piece)
        assert [p.piece for p in parts] == list(range(-(-len(ids) // 256)))
        for p in parts:
            own = ids[4 * p.start : 4 * (p.start + p.length)]
            assert p.ids_crc32 == zlib.crc32(own) and p.start == 64 * p.piece
        assert sum(p.length for p in parts) * 4 == len(ids)
    for rows in by_sequence.values():
        at = 0
        for r in sorted(rows, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 64
    total = sum(r.length for r in got)
    assert len(by_sequence) <= total / 64 * 1.02 + 1
    assert packing.pack_documents(frame(spark, []), WORD_BPE).collect() == []


def test_hot_lengths_are_ranked_in_salts(spark, monkeypatch):
    monkeypatch.setattr(packing, "RANKED_TOGETHER", 7)
    parts = spark.createDataFrame(
        [(i, 0, 0, 3 if i % 3 else 5, i) for i in range(200)], packing.PIECES
    )
    got = packing.ranked(parts).collect()
    for length in (3, 5):
        ranks = sorted(r["rank"] for r in got if r.length == length)
        assert ranks == list(range(len(ranks)))


def test_queries_agree_with_the_libraries(spark):
    from veritrail.llm.queries import QUERIES

    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    ids = {r.doc_id: r for r in QUERIES["op5_byte_bpe"](spark, folder).collect()}
    library = tiktoken.Encoding(
        "own",
        pat_str=public_tokenizers.PATTERN,
        mergeable_ranks=byte_bpe.read_ranks(RANKS),
        special_tokens={},
    )
    places = {r.doc_id: r for r in QUERIES["op2_license_scans"](spark, folder).collect()}
    assert len(ids) == len(places) == len(docs)
    for d in docs:
        want = library.encode_ordinary(d.text or "")
        row = ids[d.doc_id]
        assert row.n_tokens == len(want)
        digest = hashlib.sha256(" ".join(map(str, want)).encode()).hexdigest()
        assert row.ids_sha256 == digest
        assert row.decoded_sha256 == hashlib.sha256((d.text or "").encode()).hexdigest()
        p = places[d.doc_id]
        assert (p.n_words, p.n_base, p.first_word, p.last_word, p.base_labels) == base_places(
            d.text
        )


@pytest.mark.parametrize("length", [18, 23, 24, 60, 256])
def test_counts_of_long_words_outside_the_vocabulary_are_finite(length):
    pieces = language_id._vocabulary(PIECES)
    model = language_id._distribution(np.ones(pieces.size + 1))
    word = "𐎀" * length
    used = language_id.expected_counts([word, "plain"], np.array([2.0, 1.0]), pieces, model)
    assert np.isfinite(used).all()
    spelled = [pieces.byte[b] for b in "𐎀".encode()]
    assert used[spelled].sum() == pytest.approx(2 * 4 * length, rel=1e-6)
    logs = language_id.log_likelihoods([word], pieces, np.stack([model, model**3], axis=1))
    assert np.isfinite(logs).all() and logs[0, 1] < logs[0, 0] < -500


def test_a_long_word_spoils_no_model(spark):
    texts = ["the cat sat on the mat " + "ᚠ" * 30, "le chat est sur la table", "𐎀" * 300]
    docs = frame(spark, texts, ["en", "fr", "xx"])
    models = language_id.fit(docs.select("doc_id", "lang", "text"), PIECES)
    assert sorted(models) == ["en", "fr", "xx"]
    assert all(np.isfinite(m).all() for m in models.values())
    got = {r.doc_id: r for r in language_id.predict(docs, models, PIECES).collect()}
    assert [got[i].lang_pred for i in sorted(got)] == ["en", "fr", "xx"]
    assert all(0.5 <= r.score <= 1 for r in got.values())


def test_marks_after_letters_skip_the_whole_tokenizer(monkeypatch):
    """Letters with any ASCII marks behind them go straight to the model, also
    after a line feed; ids stay the whole tokenizer's."""
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    words = WordEncoder(tokenizer, True)
    pick = random.Random(7)
    marks = [m for m in string.punctuation if m not in "'_"]
    some = ["$$$", ".%%%", *("".join(pick.choices(marks, k=n)) for n in (1, 2, 4))]
    letters = ["".join(pick.choices("abcDEéß", k=6)) for _ in range(200)]
    texts = [x + pick.choice(some) for x in letters] + [f"{x}.\n{x}," for x in letters]
    want = [tokenizer.encode(" " + t, add_special_tokens=False).ids for t in texts]
    asked, whole = [], words.whole
    monkeypatch.setattr(words, "whole", lambda t: asked.append(t) or whole(t))
    got = [np.frombuffer(words.encode([t]), "<u4").tolist() for t in texts]
    assert got == want and set(asked) <= {*some, "\n"}
    for odd in ("a's", "a'", "a_", "a_b", "a$b", "a$中"):
        assert words.encode([odd]) == whole(" " + odd)
