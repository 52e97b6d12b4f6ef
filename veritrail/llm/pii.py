"""Personal data: information-theoretic sanitisation, in DataFrame functions.

Fixed patterns find the protected entities (email, ip, card, phone). The words
of a document are counted together with its entities over the corpus. A word t
discloses an entity e by its pointwise mutual information in proportion to the
entity's own information:

    pmi(e, t) = log(N n(e,t) / (n(e) n(t)))        strength = pmi / log(N / n(e))

with N documents, n(e) and n(t) those that hold the entity or the word and
n(e,t) those that hold both, wherever in the text they stand. Every row is a
document in all four counts. Strength is 1 when the word never occurs without
the entity. Words from GENERALISE on are spans of kind ``term`` in every
document that has them, with the entity or without; from REMOVE on they are cut
out, below that replaced by a general word, as the entities are by their kind.

Two things keep chance out. A word needs SUPPORT different texts with the
entity, however often one is copied. And n(e,t) * pmi must reach EVIDENCE *
log(N): the odds that a word's documents fall among the entity's by luck are
then below N ** -EVIDENCE, also for an entity that a third of all documents
hold. Near copies are different texts: remove them first.

A word is a run of letters and digits with a letter in it, of two characters or
more; runs inside an email address are part of the address.

Positions are code points, ends exclusive. Defined results: a null text has no
spans; spans of a kind never overlap; a failing match is dropped and its text
not tried again; repeated rows each get the same spans; ids are not read; an
empty table gives an empty result; other columns pass through whatever their
names, but ``spans`` and ``_removed`` are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veritrail.llm.common import fresh
from veritrail.sources.scratch import materialise

# Fixed patterns, written so that they never go back over what they have read:
# a run of name characters or digits is tried from its start only.
_NAME = "[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": rf"(?:(?<!{_NAME})|\G){_NAME}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Texts without this have no span of the kind.
_HINTS = {
    "email": lambda t: F.contains(t, F.lit("@")),
    "ip": lambda t: t.rlike(r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]"),
    "card": lambda t: t.rlike(r"[0-9](?:[\x20-]?+[0-9]){12}"),
    "phone": lambda t: F.contains(t, F.lit("+")),
}
_PART = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
#: Digits of a card and of a phone number.
CARD_DIGITS = (13, 19)
PHONE_DIGITS = (9, 15)

SUPPORT = 3
EVIDENCE = 2.0
GENERALISE = 0.8
REMOVE = 1.0
BROADCAST_BYTES = 16 << 20
_SPAN = "struct<kind:string,start:bigint,end:bigint,value:string>"
_BLOCK = 256
_ALNUM = r"\p{L}\p{N}"
_WORD = rf"[{_ALNUM}]{{2,}}+"


def bound(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once, also where lambdas use it."""
    return F.transform(F.array(value), use)[0]


def in_blocks(values: Column) -> Column:
    """An array cut into arrays of _BLOCK."""
    last = F.floor((F.size(values) - 1) / _BLOCK).cast("int")
    return F.when(F.size(values) > 0, F.transform(
        F.sequence(F.lit(0), last), lambda b: F.slice(values, b * _BLOCK + 1, _BLOCK)
    )).otherwise(F.array(F.slice(values, 1, 0)))


def running_sums(values: Column) -> Column:
    """Running totals of an array of long. Arrays grow by copying, so they are
    built a block at a time."""
    return bound(values, lambda v: _running_sums(in_blocks(v)))


def _running_sums(blocks: Column) -> Column:
    none = F.array().cast("array<bigint>")
    zero = F.lit(0).cast("bigint")

    def block(total: Column, own: Column) -> Column:
        return F.aggregate(
            own,
            F.struct(total.alias("total"), none.alias("done")),
            lambda a, v: F.struct(
                (a["total"] + v).alias("total"),
                F.concat(a["done"], F.array(a["total"] + v)).alias("done"),
            ),
        )

    return F.aggregate(
        blocks,
        F.struct(zero.alias("total"), F.array().cast("array<array<bigint>>").alias("done")),
        lambda a, own: F.struct(
            (a["total"] + F.aggregate(own, zero, lambda s, v: s + v)).alias("total"),
            F.concat(a["done"], F.array(block(a["total"], own)["done"])).alias("done"),
        ),
        lambda a: F.flatten(a["done"]),
    )


def located(text: Column, pattern: Column, kind: str) -> Column:
    """Every match as a span: what lies between the matches gives their places."""
    gaps = F.split(text, pattern, -1)
    matches = F.regexp_extract_all(text, pattern, F.lit(0))
    lengths = F.zip_with(
        F.slice(gaps, 1, F.size(matches)),
        matches,
        lambda gap, m: (F.length(gap) + F.length(m)).cast("bigint"),
    )
    return F.zip_with(
        running_sums(lengths),
        matches,
        lambda end, m: F.struct(
            F.lit(kind).alias("kind"),
            (end - F.length(m)).alias("start"),
            end.alias("end"),
            m.alias("value"),
        ),
    )


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """The checksum of a card number, from the right: every second doubled."""

    def add(total: Column, i: Column) -> Column:
        d = F.substr(digits, F.length(digits) - i + 1, F.lit(1)).cast("int")
        twice = 2 * d - F.when(d > 4, 9).otherwise(0)
        return total + F.when(i % 2 == 0, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        return value.rlike(rf"\A{_PART}(?:\.{_PART}){{3}}\z")
    digits = _digits(value)
    if kind == "card":
        sized = F.length(digits).between(*CARD_DIGITS)
        return F.when(sized, _luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(digits).between(*PHONE_DIGITS)
    return F.lit(True)


def base_spans(text: Column, kind: str) -> Column:
    """The spans of a kind, in order; none where the text has none."""
    spans = F.filter(
        located(text, F.lit(PATTERNS[kind]), kind), lambda s: _valid(kind, s["value"])
    )
    return F.when(_HINTS[kind](text), spans).otherwise(F.array()).cast(f"array<{_SPAN}>")


def with_base_spans(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``spans`` of the fixed kinds, by kind, then place."""
    source = F.coalesce(F.col(text).cast("string"), F.lit(""))
    return docs.withColumn("spans", F.concat(*(base_spans(source, kind) for kind in PATTERNS)))


def words(text: Column) -> Column:
    """The different words of a text, in lower case."""
    plain = F.when(
        F.contains(text, F.lit("@")), F.regexp_replace(text, PATTERNS["email"], " ")
    ).otherwise(text)
    found = F.array_distinct(F.regexp_extract_all(F.lower(plain), F.lit(_WORD), F.lit(0)))
    return F.filter(found, lambda w: w.rlike(r"\p{L}"))


def _texts(docs: DataFrame, text: str) -> DataFrame:
    """(text, key) of every row that has a text."""
    source = F.col(f"`{text}`").cast("string")
    rows = docs.select(source.alias("text")).where("text is not null")
    return rows.withColumn("key", F.xxhash64("text"))


def entities(docs: DataFrame, text: str = "text") -> DataFrame:
    """(key, entity, copies): the entities of every different text, and the
    number of rows with that text."""
    found = with_base_spans(_texts(docs, text)).where(F.size("spans") > 0)
    named = F.transform(
        "spans", lambda s: F.concat_ws(":", s["kind"], F.lower(s["value"]))
    )
    return (
        found.select("key", F.explode(F.array_distinct(named)).alias("entity"))
        .groupBy("key", "entity")
        .agg(F.count(F.lit(1)).alias("copies"))
    )


def _joined(rows: DataFrame, small: DataFrame, on: str, how: str, width: int) -> DataFrame:
    """A join whose right side is broadcast if its counted size allows it."""
    fits = small.count() * width <= BROADCAST_BYTES
    return rows.join(F.broadcast(small) if fits else small, on, how)


def disclosing_terms(
    docs: DataFrame,
    found: DataFrame,
    text: str = "text",
    support: int = SUPPORT,
    generalise: float = GENERALISE,
    evidence: float | None = EVIDENCE,
) -> DataFrame:
    """(entity, term, strength) of the words that reveal an entity.

    Only entities with support are looked at, and only words with support in
    their documents are counted over the corpus.
    """
    rows = _texts(docs, text)
    total = F.lit(float(docs.count()))
    known = (
        found.groupBy("entity")
        .agg(F.sum("copies").alias("n_e"), F.count(F.lit(1)).alias("texts"))
        .where(F.col("texts") >= support)
        .drop("texts")
    )
    held = materialise(found.join(known, "entity"), "held-entities")

    def pmi(n_t: str) -> Column:
        return F.log(total * F.col("n_et") / F.col("n_e") / F.col(n_t))

    def strength(n_t: str) -> Column:
        return pmi(n_t) / F.nullif(F.log(total / F.col("n_e")), F.lit(0.0))

    def strong(n_t: str) -> Column:
        enough = strength(n_t) >= generalise
        if evidence is not None:
            enough &= F.col("n_et") * pmi(n_t) >= evidence * F.log(total)
        return enough

    copies = materialise(held.groupBy("key").agg(F.max("copies").alias("copies")), "held-texts")
    spoken = (
        _joined(rows, copies.select("key"), "key", "left_semi", 16)
        .select("key", F.explode(words(F.col("text"))).alias("term"))
        .distinct()
    )
    spoken = materialise(spoken, "held-words")
    # A word stands in at least the documents that hold some entity. What is
    # too weak even if there are no others needs no count over the corpus.
    nearby = (
        spoken.join(copies, "key")
        .groupBy("term")
        .agg(F.sum("copies").alias("n_near"), F.count(F.lit(1)).alias("texts"))
        .where(F.col("texts") >= support)
        .drop("texts")
    )
    reach = F.col("n_e") * F.pow(total / F.col("n_e"), F.lit(1.0 - generalise))
    together = (
        spoken.join(materialise(nearby, "near-words"), "term")
        .join(held, "key")
        .where(F.col("n_near") <= reach * (1 + 1e-9))
        .groupBy("entity", "term", "n_e", "n_near")
        .agg(F.sum("copies").alias("n_et"), F.count(F.lit(1)).alias("texts"))
        .where((F.col("texts") >= support) & strong("n_near"))
    )
    together = materialise(together.select("entity", "term", "n_e", "n_et"), "near-terms")
    terms = materialise(together.select("term").distinct(), "candidates")
    if not terms.take(1):
        return together.select("entity", "term", F.lit(1.0).alias("strength"))
    size = terms.agg(F.sum(F.octet_length("term") + 32)).head()[0]
    per_term = (
        rows.select(F.explode(words(F.col("text"))).alias("term"))
        .join(F.broadcast(terms) if size <= BROADCAST_BYTES else terms, "term", "left_semi")
        .groupBy("term")
        .agg(F.count(F.lit(1)).alias("n_t"))
    )
    scored = together.join(per_term, "term").where(strong("n_t"))
    return scored.select("entity", "term", strength("n_t").alias("strength"))


def document_terms(
    docs: DataFrame, terms: DataFrame, text: str = "text", remove: float = REMOVE
) -> DataFrame:
    """(key, terms, removed): words to sanitise in every text that has some. A
    word that is to be cut out for one entity is cut out for all."""
    cut = F.max(F.col("strength") >= remove - 1e-9)
    judged = materialise(terms.groupBy("term").agg(cut.alias("cut")), "judged-terms")
    found = _texts(docs, text).select("key", F.explode(words(F.col("text"))).alias("term"))
    return (
        _joined(found, judged, "term", "inner", 96)
        .groupBy("key")
        .agg(
            F.collect_set("term").alias("terms"),
            F.collect_set(F.when(F.col("cut"), F.col("term"))).alias("removed"),
        )
    )


def annotate(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``spans`` (kind, start, end, value): the fixed kinds, then
    the disclosing terms; and ``_removed``, the terms to cut out."""
    found = materialise(entities(docs, text), "entities")
    terms = materialise(disclosing_terms(docs, found, text), "terms")
    rows = docs.drop("spans", "_removed")
    key, own = fresh(docs, "_key", "_terms")
    none = F.lit(None).cast("array<string>")
    if terms.take(1):
        marked = document_terms(docs, terms, text).select(
            F.col("key").alias(key), F.col("terms").alias(own), F.col("removed").alias("_removed")
        )
        marked = materialise(marked, "document-terms")
        size = marked.agg(
            F.coalesce(F.sum(F.octet_length(F.array_join(own, " ")) * 2 + 96), F.lit(0))
        ).head()[0]
        small = size <= BROADCAST_BYTES
        rows = rows.withColumn(key, F.xxhash64(F.col(f"`{text}`").cast("string"))).join(
            F.broadcast(marked) if small else marked, key, "left"
        )
    else:
        rows = rows.withColumn(key, F.lit(0)).withColumn(own, none).withColumn("_removed", none)
    pattern = F.concat(
        F.lit(rf"(?iu)(?<![{_ALNUM}])(?:"),
        F.array_join(own, "|"),
        F.lit(rf")(?![{_ALNUM}])"),
    )
    term_spans = F.when(
        F.size(own) > 0, located(F.col(f"`{text}`").cast("string"), pattern, "term")
    ).otherwise(F.array())
    return (
        with_base_spans(rows, f"`{text}`")
        .withColumn("spans", F.concat("spans", term_spans.cast(f"array<{_SPAN}>")))
        .drop(key, own)
    )


def _replaced(part: Column, at: Column, spans: Column, shown) -> Column:
    """``part``, which begins at code point ``at``, with its spans replaced; of
    overlapping ones the first names the whole stretch."""

    def step(a: Column, s: Column) -> Column:
        new = s["start"] >= a["at"]
        kept = F.substring(part, a["at"] - at + 1, s["start"] - a["at"])
        return F.struct(
            F.greatest(a["at"], s["end"]).alias("at"),
            F.when(new, F.concat(a["parts"], F.array(kept, shown(s))))
            .otherwise(a["parts"])
            .alias("parts"),
        )

    start = F.struct(at.alias("at"), F.array().cast("array<string>").alias("parts"))
    return F.aggregate(spans, start, step, lambda a: F.array_join(a["parts"], ""))


def sanitise(annotated: DataFrame, text: str = "text") -> DataFrame:
    """Replaces the spans in ``text``. Spans are taken a block at a time, each
    on its own stretch of the text: arrays grow by copying and a place in a
    string is found by reading up to it."""
    source = F.col(f"`{text}`")
    removed = F.coalesce(F.col("_removed"), F.array().cast("array<string>"))

    def shown(s: Column) -> Column:
        cut = (s["kind"] == "term") & F.array_contains(removed, F.lower(s["value"]))
        return F.when(cut, F.lit("")).otherwise(F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")))

    ordered = F.sort_array(
        F.transform("spans", lambda s: F.struct(s["start"], s["end"], s["kind"], s["value"]))
    )

    def step(a: Column, block: Column) -> Column:
        ends = F.array_max(F.transform(block, lambda s: s["end"]))
        end = F.greatest(a["at"], ends)
        long = end - a["at"]
        part = F.substring(a["rest"], F.lit(1), long)
        return F.struct(
            end.alias("at"),
            F.substring(a["rest"], long + 1, F.length(a["rest"])).alias("rest"),
            F.concat(a["done"], F.array(_replaced(part, a["at"], block, shown))).alias("done"),
        )

    start = F.struct(
        F.lit(0).cast("bigint").alias("at"),
        source.cast("string").alias("rest"),
        F.array().cast("array<string>").alias("done"),
    )
    replaced = bound(
        ordered,
        lambda spans: F.aggregate(
            in_blocks(spans), start, step, lambda a: F.concat(F.array_join(a["done"], ""), a["rest"])
        ),
    )
    return annotated.withColumn(
        text, F.when(F.size("spans") > 0, replaced).otherwise(source)
    ).drop("spans", "_removed")
