"""URL filter: a blocked Bloom filter in front of an exact hash join.

Listed entries are canonical (host, path) pairs that cover a host with all its
subdomains and every path that starts with the entry's. Each distinct url is
turned into the keys that could list it: host suffixes at label borders with
path prefixes of the lengths that occur in the list. The filter lets through
keys that may be listed; the join on the key itself removes false positives.
Pages meet the few urls that something was decided for. Urls without host or
path cannot be listed; they are spread over all tasks of that join, and rows of
a url that many pages share are split by Spark, for both sides are stored.

Defined results: a null url, or one without ``://``, has empty host and path
and no rule, and is allowed; an empty list allows everything; an entry without
host or path lists nothing; of equally long entries the one with the longer
host wins, then block; every input row gives one row, repeated rows included;
other columns pass through whatever their names, but host, path, rule and
verdict are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veritrail.llm.common import fresh
from veritrail.sources.scratch import materialise

#: Bits of filter for each listed key, and the words of 64 bits in a block.
BITS_PER_KEY = 16
WORDS = 8
#: A side of a join is broadcast only if its counted size is below this.
BROADCAST_BYTES = 32 << 20


def split_url(url: Column) -> tuple[Column, Column]:
    """Host in lower case (A-Z only) and path, empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"\A([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"\A[^/?#]*([^?#]*)", 1)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    none = F.lit("")
    return F.coalesce(F.translate(host, upper, lower), none), F.coalesce(path, none)


def _bit(word: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(word), "key"), F.lit(64)).cast("int")


def _mask(word: int) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), _bit(word))


def _block(blocks: int) -> Column:
    return F.pmod(F.xxhash64(F.lit("block"), "key"), F.lit(blocks).cast("long"))


def build_filter(keys: DataFrame, blocks: int) -> DataFrame:
    """One row per block in use, with a bit for each key in each of its words."""
    return keys.groupBy(_block(blocks).alias("block")).agg(
        *(F.bit_or(_mask(i)).alias(f"w{i}") for i in range(WORDS))
    )


def may_contain(candidates: DataFrame, bloom: DataFrame, blocks: int) -> DataFrame:
    """The candidates whose bits are all set; none of the listed is lost."""
    small = blocks * 8 * (WORDS + 1) <= BROADCAST_BYTES
    hits = candidates.withColumn("block", _block(blocks)).join(
        F.broadcast(bloom) if small else bloom, "block"
    )
    for i in range(WORDS):
        hits = hits.where(F.col(f"w{i}").bitwiseAND(_mask(i)) != 0)
    return hits.select(candidates.columns)


def candidate_keys(urls: DataFrame, path_lengths: list[int]) -> DataFrame:
    """(host, path, key) for every entry that could list a url."""
    labels = F.split("host", r"\.", -1)
    count = F.size(labels)
    suffixes = F.transform(
        F.sequence(F.lit(1), count), lambda i: F.array_join(F.slice(labels, i, count), ".")
    )
    lengths = F.array(*(F.lit(n) for n in path_lengths))
    prefixes = F.transform(
        F.filter(lengths, lambda n: n <= F.length("path")),
        lambda n: F.substring(F.col("path"), F.lit(1), n),
    )
    return (
        urls.where("host <> '' and path <> ''")
        .withColumn("_suffix", F.explode(suffixes))
        .withColumn("_prefix", F.explode(prefixes))
        .select("host", "path", F.concat("_suffix", "_prefix").alias("key"))
    )


def distinct_urls(pages: DataFrame, url: str = "url") -> DataFrame:
    """(host, path) of the different urls that could be listed, stored."""
    host, path = split_url(F.col(f"`{url}`"))
    urls = pages.select(host.alias("host"), path.alias("path"))
    return materialise(urls.where("host <> '' and path <> ''").distinct(), "urls")


def decided_urls(urls: DataFrame, listed: DataFrame) -> DataFrame:
    """(host, path, key, hit) of the urls that an entry lists, with the entry
    that decides, stored."""
    entries = materialise(
        listed.where("host <> '' and path <> ''")
        .withColumn("key", F.concat("host", "path"))
        .groupBy("key")
        .agg(
            F.max_by(
                F.struct("is_rule", "action"),
                F.struct("is_rule", F.length("host"), F.col("action") == "block"),
            ).alias("hit"),
            F.max(F.length("path")).alias("path_length"),
            F.max(F.length("host")).alias("host_length"),
        ),
        "url-entries",
    )
    size = entries.agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.octet_length("key") + 64), F.lit(0))
    ).head()
    # Bounded by the longest path of the list, not by its entries.
    lengths = sorted(r[0] for r in entries.select("path_length").distinct().collect())
    blocks = max(1, -(-size[0] * BITS_PER_KEY // (64 * WORDS)))
    candidates = candidate_keys(urls, lengths or [0])
    passed = may_contain(candidates, build_filter(entries, blocks), blocks)
    exact = passed.join(F.broadcast(entries) if size[1] <= BROADCAST_BYTES else entries, "key")
    best = F.max_by(
        F.struct("key", "hit"), F.struct("hit.is_rule", F.length("key"), "host_length")
    )
    decided = exact.groupBy("host", "path").agg(best.alias("best")).select("host", "path", "best.*")
    return materialise(decided, "decided-urls")


def filter_urls(
    pages: DataFrame, listed: DataFrame, url: str = "url", urls: DataFrame | None = None
) -> DataFrame:
    """``pages`` with host, path, rule and verdict.

    ``listed`` has host, path, action (allow or block) and is_rule. The longest
    rule decides; without one, any other listed entry blocks. ``urls`` are the
    :func:`distinct_urls` of the pages, if they are known already.
    """
    urls = distinct_urls(pages, url) if urls is None else urls
    host, path = split_url(F.col(f"`{url}`"))
    h, p, on, key, hit = fresh(pages, "_host", "_path", "_on", "_key", "_hit")
    decided = decided_urls(urls, listed).select(
        F.col("host").alias(on), F.col("path").alias(p), F.col("key").alias(key), F.col("hit").alias(hit)
    )
    # No host has a slash: what cannot be listed matches nothing, wherever it goes.
    alone = F.concat(F.lit("/"), F.monotonically_increasing_id().cast("string"))
    known = (F.col(h) != "") & (F.col(p) != "")
    rows = pages.withColumns({h: host, p: path}).withColumn(on, F.when(known, F.col(h)).otherwise(alone))
    ruled = F.col(hit)["is_rule"]
    verdict = F.when(ruled, F.col(hit)["action"]).otherwise(
        F.when(F.col(key).isNotNull(), "block").otherwise("allow")
    )
    replaced = ("host", "path", "rule", "verdict")
    return rows.join(decided, [on, p], "left").select(
        *(F.col(f"`{c}`") for c in pages.columns if c not in replaced),
        F.col(h).alias("host"),
        F.col(p).alias("path"),
        F.when(ruled, F.col(key)).alias("rule"),
        verdict.alias("verdict"),
    )


#: Words of which a label of a listed host is made, with hyphens between.
LISTED_WORDS = (
    "ads", "adult", "bets", "casino", "malware", "phishing", "pills", "porn", "spam", "warez",
)


def listed_hosts(urls: DataFrame) -> DataFrame:
    """Block list of the registered query: every host of ``urls`` one of whose
    labels has a listed word, in canonical form."""
    words = "|".join(LISTED_WORDS)
    return (
        urls.select("host")
        .where(F.col("host").rlike(rf"(^|[.-])({words})([.-]|$)"))
        .distinct()
        .select(
            "host",
            F.lit("/").alias("path"),
            F.lit("block").alias("action"),
            F.lit(False).alias("is_rule"),
        )
    )
