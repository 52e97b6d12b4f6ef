"""Registered queries of the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers
from veritrail.llm import (
    byte_bpe,
    chat,
    cost_packing,
    hard_negatives,
    language_id,
    lattice_dedup,
    license_scan,
    merkle,
    minhash,
    nn_descent,
    packing,
    pii,
    url_filter,
)
from veritrail.llm.common import table
from veritrail.llm.oracles import STATEMENTS  # noqa: F401

#: Fixed values of the url rules: action, host, path.
URL_RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)
#: Columns of a document's leaf, in order.
LEAF_COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
CONTROL_TEXT = "\\### Assistant: </turn> ok"


def language_pieces() -> str:
    return public_tokenizers.path("piece_bpe_32k.model")


def language_models(docs: DataFrame):
    """Fitted on labelled rows that are not held out; a null id is not learned
    from, since its remainder is unknown."""
    known = docs.where(F.col("doc_id").isNotNull() & ~language_id.held_out(F.col("doc_id")))
    return language_id.fit(known.select("doc_id", "lang", "text"), language_pieces())


def language_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    models = language_models(docs)
    plain = docs.select("doc_id", language_id.held_out(F.col("doc_id")).alias("held_out"), "text")
    return language_id.predict(plain, models, language_pieces()).drop("text")


def license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))


def url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    rules = spark.createDataFrame(
        [(h, p, a, True) for a, h, p in URL_RULES],
        "host string, path string, action string, is_rule boolean",
    )
    urls = url_filter.distinct_urls(pages)
    listed = rules.unionByName(url_filter.listed_hosts(urls))
    return url_filter.filter_urls(pages, listed, urls=urls).select(
        "page_id", "host", "path", "rule", "verdict"
    )


def byte_bpe_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    ids = byte_bpe.encode(docs, ranks, public_tokenizers.PATTERN, keep=["doc_id"])
    decoded = byte_bpe.decode(ids, ranks)
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


def embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return nn_descent.nearest(vectors, every=50)


def minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return minhash.near_duplicates(docs, shingle=4)


def _span_text(spans: Column) -> Column:
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )


def personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.annotate(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("spans", lambda s: s["kind"] != "term")

    def count(kind: str) -> Column:
        own = F.filter("spans", lambda s: s["kind"] == kind)
        return F.size(own).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *map(count, pii.PATTERNS),
        F.sha2(_span_text(base), 256).alias("base_sha256"),
        _span_text(F.col("spans")).alias("spans"),
    )


def chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame(
        [(-7, 0, "user", CONTROL_TEXT), (-7, 1, "assistant", CONTROL_TEXT)],
        "conv_id long, turn long, role string, text string",
    )
    return chat.read_back(chat.format_chats(turns.unionByName(extra)))


def cost_balanced_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return cost_packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


def mined_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select(
        "vec_id",
        "embedding",
        F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).alias("label"),
    )
    return hard_negatives.mine(vectors, F.col("vec_id") % 50 == 0)


def dataset_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(*LEAF_COLUMNS)
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    damaged = F.when(hit, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    columns = [damaged if c == "text" else F.col(c) for c in LEAF_COLUMNS]
    proofs = merkle.manifest(
        docs.withColumn("seen_leaf", merkle.leaf(*columns)), LEAF_COLUMNS, keep=["seen_leaf"]
    )
    return proofs.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        merkle.digest(merkle.proof_text(F.col("path"))).alias("proof_sha256"),
        merkle.folded(F.col("seen_leaf"), F.col("path")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


QUERIES = {
    "op1_language_id": language_ids,
    "op2_license_scans": license_scans,
    "op3_url_filters": url_filters,
    "op4_embedding_near_dedup": embedding_near_dedup,
    "op5_byte_bpe": byte_bpe_ids,
    "op6_best_fit_packing": best_fit_packing,
    "op7_nearest_neighbours": nearest_neighbours,
    "op8_minhash_near_dedup": minhash_near_dedup,
    "op9_personal_data": personal_data,
    "op10_chat_formatting": chat_formatting,
    "op11_cost_packing": cost_balanced_packing,
    "op12_hard_negatives": mined_negatives,
    "op13_merkle_manifest": dataset_manifest,
}
