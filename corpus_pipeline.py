"""Corpus preparation: language, near-duplicates, personal data, packing.

``run`` takes the ``documents`` table through the stages in order; each is
written as Parquet in the cluster's shared folder and read again by the next,
so a lost executor costs its tasks only.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veritrail.llm import language_id, minhash, packing, pii
from veritrail.llm.common import table
from veritrail.llm.queries import language_models, language_pieces
from veritrail.sources.scratch import materialise

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Posterior of the predicted language below which a document is rejected.
LEAST_SCORE = 0.5
#: Counted size up to which the ids to drop are broadcast.
BROADCAST_BYTES = 16 << 20


def keep_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a letter and those of no clear language. Models
    are learned from the labelled documents that are not held out."""
    models = language_models(docs)
    scored = language_id.predict(docs.select(*COLUMNS), models, language_pieces())
    known = F.col("lang_pred") != language_id.UNKNOWN
    return scored.where(known & (F.col("score") >= LEAST_SCORE)).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group of similar texts: that of the smallest doc_id,
    one without an id only if none has one. Every row counts by its own text, so
    different texts under one id all stay, and copies without an id go."""
    rows = docs.select(*COLUMNS, F.monotonically_increasing_id().alias("_row"))
    rows = materialise(rows, "numbered")
    groups = materialise(minhash.near_duplicates(rows, doc_id="_row"), "groups")
    copies = groups.where("doc_id <> component_id").select(
        F.col("doc_id").alias("_row"), "component_id"
    )
    heads = copies.select(F.col("component_id").alias("_row"), "component_id").distinct()
    members = materialise(
        copies.union(heads).join(rows.select("_row", "doc_id"), "_row"), "group-members"
    )
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_row")
    first = materialise(
        members.groupBy("component_id").agg(F.min(order)["_row"].alias("_first")), "kept-rows"
    )
    gone = materialise(
        members.join(first, "component_id").where("_row <> _first").select("_row"), "gone-rows"
    )
    small = gone.count() * 8 <= BROADCAST_BYTES
    return rows.join(F.broadcast(gone) if small else gone, "_row", "left_anti").select(*COLUMNS)


def sanitise_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data and the terms that disclose it. All documents
    stay and n_chars follows the new text; null texts stay as they are."""
    clean = pii.sanitise(pii.annotate(docs.select(*COLUMNS)))
    return clean.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), "n_chars")).select(*COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece of every document in the training sequences."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language_id", keep_known_language),
    ("minhash_near_dedup", drop_near_duplicates),
    ("personal_data", sanitise_personal_data),
    ("best_fit_packing", pack_sequences),
]

#: Language likelihoods and tokens have no SQL form; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return docs
