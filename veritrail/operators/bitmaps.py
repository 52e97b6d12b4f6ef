"""Who has evidence for what, as bitmaps.

Systems are numbered without gaps in the order of their ids. A control's systems
are then bits in words of 64, one row per control and word that has any: a row
has at least one pair behind it, so bitmaps are never larger than the pairs, also
where a control has few of many systems, and aggregates keep a number instead of
a block of bytes per group. Distinct counts are bit counts and merge by OR, so a
family's covered systems come from its controls' bitmaps without a second look at
the pairs. What is missing is AND NOT against the systems that owe evidence,
counted or listed for the controls and unit asked for; expected pairs are never
built as a whole.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veritrail.operators import gold
from veritrail.sources.scratch import materialise


def dense_ids(df: DataFrame, key: str) -> DataFrame:
    """(key, number): the distinct keys numbered from 1 in their order, by range
    partitions and the rows in the partitions before."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = materialise(df.select(key).where(F.col(key).isNotNull()).distinct(), "keys")
    placed = materialise(
        keys.repartitionByRange(parts, key)
        .sortWithinPartitions(key)
        .withColumn("_at", F.monotonically_increasing_id()),
        "placed-keys",
    ).withColumn("_part", F.shiftright("_at", 33))
    # At most a row per partition.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy("_part")
        .agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
        .select("_part", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    )
    number = F.col("_before") + F.col("_at") - F.col("_first") + 1
    return placed.join(F.broadcast(starts), "_part").select(key, number.alias("number"))


#: Where a system's bit is: a block of Spark's bitmap functions, a word in it.
PLACE = ("block", "word")
WORD_BITS = 64


def _placed(rows: DataFrame) -> DataFrame:
    """Rows with their number's block, word and the word with its bit."""
    at = F.bitmap_bit_position("number")
    return rows.withColumns(
        {
            "block": F.bitmap_bucket_number("number"),
            "word": (F.floor(at / WORD_BITS)).cast("int"),
            "bit": F.call_function("shiftleft", F.lit(1).cast("long"), (at % WORD_BITS).cast("int")),
        }
    )


def system_bitmaps(pairs: DataFrame, numbers: DataFrame) -> DataFrame:
    """(control_id, block, word, held, current): bits of the systems with any
    evidence for the control, and with accepted evidence that is current."""
    numbered = _placed(pairs.join(numbers, "system_id"))
    current = F.when(F.col("current_evidence_count") > 0, F.col("bit")).otherwise(0)
    return numbered.groupBy("control_id", *PLACE).agg(
        F.bit_or("bit").alias("held"), F.bit_or(current).alias("current")
    )


def unit_bitmaps(systems: DataFrame, numbers: DataFrame, unit: Sequence[str]) -> DataFrame:
    """(unit columns, block, word, members): bits of each unit's systems."""
    numbered = _placed(systems.join(numbers, "system_id"))
    return numbered.groupBy(*unit, *PLACE).agg(F.bit_or("bit").alias("members"))


def merged(bitmaps: DataFrame, by: Sequence[str], *bits: str) -> DataFrame:
    """Bitmaps of groups of rows: OR over the group, word by word."""
    return bitmaps.groupBy(*by, *PLACE).agg(*(F.bit_or(b).alias(b) for b in bits))


def _common(rows: DataFrame, by: Sequence[str], left: str, right: str, name: str) -> DataFrame:
    """(by, name): the number of bits that two bitmaps of a row share, summed
    over the words."""
    shared = F.bit_count(F.col(left).bitwiseAND(F.col(right))).cast("long")
    return rows.groupBy(*by).agg(F.sum(shared).alias(name))


def control_coverage(controls: DataFrame, systems: DataFrame, bitmaps: DataFrame, numbers) -> DataFrame:
    """Per control: systems with evidence, with current evidence, and the
    systems in scope that owe evidence but have none (required controls only)."""
    counted = bitmaps.groupBy("control_id").agg(
        F.sum(F.bit_count("held").cast("long")).alias("systems_with_evidence"),
        F.sum(F.bit_count("current").cast("long")).alias("systems_with_current_evidence"),
    )
    required, covered = gold.required(controls), gold.covered(systems)
    masks = unit_bitmaps(covered, numbers, [])
    owing = bitmaps.join(required.select("control_id"), "control_id", "left_semi").join(
        masks, list(PLACE)
    )
    met = _common(owing, ["control_id"], "held", "members", "met")
    expected = covered.agg(F.count(F.lit(1))).scalar()
    missing = (
        required.select("control_id")
        .join(met, "control_id", "left")
        .select("control_id", (expected - F.coalesce("met", F.lit(0))).alias("missing_systems"))
    )
    zero = F.lit(0)
    return (
        controls.select("control_id", "control_family_code")
        .join(counted, "control_id", "left")
        .join(missing, "control_id", "left")
        .select(
            "control_id",
            "control_family_code",
            F.coalesce("systems_with_evidence", zero).alias("systems_with_evidence"),
            F.coalesce("systems_with_current_evidence", zero).alias(
                "systems_with_current_evidence"
            ),
            "missing_systems",
        )
    )


def family_unit_coverage(
    controls: DataFrame, systems: DataFrame, bitmaps: DataFrame, numbers: DataFrame, unit: str
) -> DataFrame:
    """Per family and unit: the unit's systems in scope, and how many of them
    have any, any current and no evidence for the family's controls."""
    families = controls.select("control_id", "control_family_code")
    by_family = merged(
        bitmaps.join(families, "control_id"), ["control_family_code"], "held", "current"
    )
    covered = systems.join(gold.covered(systems).select("system_id"), "system_id", "left_semi")
    members = unit_bitmaps(covered, numbers, [unit])
    by = ["control_family_code", unit]
    met = materialise(by_family.join(members, list(PLACE)), "family-units")
    # Units and families are short lists; every one meets every other.
    known = by_family.agg(F.collect_set("control_family_code")).scalar()
    size = covered.groupBy(unit).agg(F.count(F.lit(1)).alias("systems"))
    out = (
        size.withColumn("control_family_code", F.explode(known))
        .join(_common(met, by, "held", "members", "held"), by, "left")
        .join(_common(met, by, "current", "members", "now"), by, "left")
    )
    held = F.coalesce("held", F.lit(0))
    return out.select(
        *by,
        "systems",
        held.alias("with_evidence"),
        F.coalesce("now", F.lit(0)).alias("with_current_evidence"),
        (F.col("systems") - held).alias("without_evidence"),
    )


def missing_pairs(
    controls: DataFrame, systems: DataFrame, bitmaps: DataFrame, numbers: DataFrame
) -> DataFrame:
    """(control_id, system_id) of expected pairs without evidence, for the
    controls and systems given: choose a family and a unit first, for all
    together may be as many as controls times systems.

    A word's systems are a list, and a control lists those of it whose bits it
    lacks: what it holds is looked up once per word, not once per pair."""
    owing = _placed(gold.covered(systems).join(numbers, "system_id"))
    words = owing.groupBy(*PLACE).agg(F.collect_list(F.struct("bit", "system_id")).alias("owing"))
    blocks = owing.select("block").distinct()
    # A control without any bit in a block lacks the whole block.
    asked = gold.required(controls).select("control_id").withColumn(
        "block", F.explode(blocks.agg(F.collect_set("block")).scalar())
    )
    own = (
        bitmaps.join(asked.select("control_id").distinct(), "control_id", "left_semi")
        .groupBy("control_id", "block")
        .agg(F.map_from_entries(F.collect_list(F.struct("word", "held"))).alias("own"))
    )
    has = F.coalesce(F.col("own")[F.col("word")], F.lit(0).cast("long"))
    return (
        asked.join(own, ["control_id", "block"], "left")
        .join(words, "block")
        .select("control_id", has.alias("held"), F.inline("owing"))
        .where(F.col("held").bitwiseAND(F.col("bit")) == 0)
        .select("control_id", "system_id")
    )
