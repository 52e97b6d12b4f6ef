"""The pipeline's stages on small tables against brute force, and the SQL of
the queries that have one."""

from __future__ import annotations

import duckdb
import numpy as np
import public_tokenizers
import pytest

import corpus_pipeline
from tests.llm.test_pair_operators import brute_groups
from tests.llm.test_span_operators import plain_spans
from veritrail.llm import packing, queries

FOLDER = "/root/testdata/sf0.001"
TABLES = ("documents", "embeddings", "pages", "benchmark", "labels", "conversations")


@pytest.fixture(scope="module")
def stages(spark):
    """The input and the rows after each stage."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    odd = [(900, None), (901, ""), (902, "12 34"), (903, "a@b.example " + "word " * 300), (903, "zz")]
    extra = spark.createDataFrame(
        [(i, t, None, None, None) for i, t in odd], docs.schema
    )
    frame, seen = docs.union(extra), []
    seen.append(frame.collect())
    for _, stage in corpus_pipeline.STAGES:
        frame = stage(spark, frame, FOLDER).cache()
        assert frame.columns[0] == "doc_id"
        seen.append(frame.collect())
    return seen


def test_stages_keep_the_columns(stages):
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language_id", "minhash_near_dedup", "personal_data", "best_fit_packing",
    ]
    for rows in stages[1:4]:
        assert tuple(rows[0].__fields__) == corpus_pipeline.COLUMNS


def test_only_texts_without_a_language_go(stages):
    gone = {r.doc_id for r in stages[0]} - {r.doc_id for r in stages[1]}
    assert {900, 901, 902} <= gone
    assert all(not r.lang for r in stages[0] if r.doc_id in gone)


def test_one_document_of_each_group_stays(stages):
    rows = sorted(stages[1], key=lambda r: r.doc_id)
    ids = [r.doc_id for r in rows]
    _, groups = brute_groups([r.text for r in rows], 5)
    want = sorted(ids[i] for i in {groups.find(i) for i in range(len(rows))})
    assert sorted(r.doc_id for r in stages[2]) == want


def test_rows_that_share_an_id_or_have_none_count_by_their_texts(spark):
    words = [f"w{i}" for i in range(40)]
    one, two = " ".join(words), " ".join(reversed(words))
    rows = [(1, one), (1, two), (1, one), (None, two), (None, "only here"), (None, "only here"),
            (2, one + " more"), (3, None), (3, None), (0, " ")]
    frame = spark.createDataFrame(
        [(i, t, "en", None, 5) for i, t in rows], "doc_id long, text string, lang string, "
        "source string, n_chars long",
    )
    got = corpus_pipeline.drop_near_duplicates(spark, frame, FOLDER).collect()
    want = [(1, one), (1, two), (None, "only here"), (3, None), (3, None), (0, " ")]
    assert sorted(((r.doc_id, r.text) for r in got), key=repr) == sorted(want, key=repr)


def by_id(rows):
    """The texts of each id; different texts may share one."""
    out: dict = {}
    for r in rows:
        out.setdefault(r.doc_id, []).append(r.text or "")
    return {i: sorted(texts) for i, texts in out.items()}


def test_personal_data_goes_and_the_rest_stays(stages):
    before, after = by_id(stages[2]), by_id(stages[3])
    assert sorted(r.doc_id for r in stages[3]) == sorted(r.doc_id for r in stages[2])
    assert len(before[903]) == 2
    for r in stages[3]:
        assert plain_spans(r.text) == [] and r.n_chars == len(r.text)
    for i, texts in before.items():
        untouched = [t for t in texts if not plain_spans(t)]
        assert all(t in after[i] for t in untouched)


def test_every_token_is_packed_once(stages):
    words = packing._worker(public_tokenizers.path("word_bpe_49k.json"))
    tokens = {
        i: sum(len(packing.packed_ids(t, words)) // 4 for t in texts)
        for i, texts in by_id(stages[3]).items()
    }
    packed: dict = {}
    for r in stages[4]:
        packed[r.doc_id] = packed.get(r.doc_id, 0) + r.length
    assert packed == tokens


def test_empty_tables(spark):
    empty = spark.read.parquet(f"{FOLDER}/documents.parquet").where("false")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, FOLDER).collect() == []


@pytest.mark.parametrize("key", sorted(queries.STATEMENTS))
def test_query_matches_sql(spark, key):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    result = con.execute(queries.STATEMENTS[key])
    names = [d[0] for d in result.description]
    want = sorted((tuple(r) for r in result.fetchall()), key=repr)
    got = queries.QUERIES[key](spark, FOLDER).select(*names).collect()
    assert sorted((tuple(r) for r in got), key=repr) == want


def test_all_operators_are_registered():
    import __spark_entry__

    keys = list(__spark_entry__.queries())
    for n in range(1, 14):
        assert sum(k.startswith(f"op{n}_") for k in keys) == 1
    assert "pipeline" in keys


def test_chat_and_personal_data_queries_agree_with_brute_force(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").collect()
    got = {r.doc_id: r for r in queries.QUERIES["op9_personal_data"](spark, FOLDER).collect()}
    assert len(got) == len(docs)
    for d in docs:
        spans = plain_spans(d.text)
        text = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        own = [s for s in got[d.doc_id].spans.split(",") if s and not s.startswith("term:")]
        assert ",".join(own) == text
        assert got[d.doc_id].n_email == sum(k == "email" for k, *_ in spans)
    chats = queries.QUERIES["op10_chat_formatting"](spark, FOLDER).collect()
    table = spark.read.parquet(f"{FOLDER}/conversations.parquet")
    assert {r.conv_id for r in chats} == {r.conv_id for r in table.collect()} | {-7}
    assert sum(r.n_turns for r in chats) == table.count() + 2


def test_packing_uses_few_sequences(spark):
    got = queries.QUERIES["op6_best_fit_packing"](spark, FOLDER).collect()
    tokens = np.array([r.length for r in got])
    assert len({r.sequence_id for r in got}) <= -(-tokens.sum() // packing.CAPACITY) + 1
