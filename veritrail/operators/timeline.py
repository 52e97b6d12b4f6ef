"""What ages, on every day of a range, from one pass over the rows.

A flag that depends on the day changes on a few days only: an open remediation
becomes overdue the day after it is due, evidence is current from its start to
its end. These changes are a table of transitions, (day, measure, change); summed
by day it has at most a row per calendar day, and the measures of any day are
its running totals. The cost does not follow the number of days asked for.

Where several rows share a key (the periods that cover a control, the evidence
of a pair) changes are first summed by key and day, so a hot key has at most a
row per calendar day before its running total is taken.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veritrail import vocabulary as v
from veritrail.operators import gold, rollups
from veritrail.sources.scratch import materialise

#: What the timeline reads of the large silver tables.
READ = {
    "assessments": (
        "control_id", "system_id", "implementation_status", "compliance_score",
        "remediation_due_date", "is_overdue",
    ),
    "evidence": (
        "control_id", "system_id", "status", "assessment_period_start", "assessment_period_end",
        "is_expired", "is_current",
    ),
}

MEASURES = (
    "overdue_remediation_count",
    "expired_evidence",
    "controls_with_current_evidence",
    "systems_assessment_overdue",
    "low_gaps",
    "medium_gaps",
    "high_gaps",
)


def _from(rows: DataFrame, day: Column, measure: str) -> DataFrame:
    """One more from ``day`` on for every row that has one."""
    counted = rows.select(day.alias("day")).where("day is not null").groupBy("day")
    return counted.agg(F.count(F.lit(1)).alias("change")).withColumn("measure", F.lit(measure))


def _within(spans: DataFrame, measure: str) -> DataFrame:
    """One more from ``first`` until before ``until`` for every row of ``spans``."""
    ends = F.array(
        F.struct(F.col("first").alias("day"), F.lit(1).cast("long").alias("change")),
        F.struct(F.col("until").alias("day"), F.lit(-1).cast("long").alias("change")),
    )
    return (
        spans.where("first < until")
        .select(F.inline(ends))
        .groupBy("day")
        .agg(F.sum("change").alias("change"))
        .withColumn("measure", F.lit(measure))
    )


def covered(periods: DataFrame, key: str) -> DataFrame:
    """(key, first, until): the stretches of days that the key's periods
    (key, start, end) cover together."""
    ends = F.array(
        F.struct(F.col("start").alias("day"), F.lit(1).alias("change")),
        F.struct(F.date_add("end", 1).alias("day"), F.lit(-1).alias("change")),
    )
    by_day = (
        periods.where("start <= end")
        .select(key, F.inline(ends))
        .groupBy(key, "day")
        .agg(F.sum("change").alias("change"))
    )
    order = Window.partitionBy(key).orderBy("day")
    running = F.sum("change").over(order.rowsBetween(Window.unboundedPreceding, 0))
    held = by_day.withColumn("held", running)
    was = F.coalesce(F.lag("held").over(order), F.lit(0))
    edges = held.withColumn("was", was).where("(held > 0) <> (was > 0)")
    return edges.select(
        key, F.col("day").alias("first"), F.lead("day").over(order).alias("until"), "held"
    ).where("held > 0").drop("held")


def severity_spans(periods: DataFrame) -> dict[str, DataFrame]:
    """Stretches (first, until) in which a pair's gap is Low, Medium or High;
    on all other days it is Critical. ``periods`` has control_id, system_id,
    start, end, accepted.

    On a day with accepted current evidence the days left come from the latest
    end of any evidence that has started: that evidence is current too.
    """
    pair = ["control_id", "system_id"]
    # Moved once, to their pair: sums by day and running totals stay there.
    rows = periods.where("start <= end").repartition(*pair)
    begun = F.struct(
        F.col("start").alias("day"), F.col("end").alias("reach"),
        F.col("accepted").cast("int").alias("change"),
    )
    ended = F.struct(
        F.date_add("end", 1).alias("day"), F.lit(None).cast("date").alias("reach"),
        F.lit(-1).alias("change"),
    )
    changes = F.when(F.col("accepted"), F.array(begun, ended)).otherwise(F.array(begun))
    by_day = (
        rows.select(*pair, F.inline(changes))
        .groupBy(*pair, "day")
        .agg(F.max("reach").alias("reach"), F.sum("change").alias("change"))
    )
    order = Window.partitionBy(*pair).orderBy("day")
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    states = by_day.select(
        "day",
        F.max("reach").over(so_far).alias("reach"),
        F.sum("change").over(so_far).alias("accepted"),
        F.lead("day").over(order).alias("next"),
    ).where("accepted > 0")
    states = materialise(states.select("day", "reach", "next"), "pair-states")
    soon = F.date_add("reach", 1 - v.EXPIRES_SOON_DAYS)
    later = F.date_add("reach", 1 - v.EXPIRES_LATER_DAYS)
    day, following = F.col("day"), F.col("next")
    return {
        "low_gaps": states.select(day.alias("first"), F.least(following, later).alias("until")),
        "medium_gaps": states.select(
            F.greatest(day, later).alias("first"), F.least(following, soon).alias("until")
        ),
        "high_gaps": states.select(
            F.greatest(day, soon).alias("first"), following.alias("until")
        ),
    }


def transitions(assessments: DataFrame, periods: DataFrame, systems: DataFrame) -> DataFrame:
    """(day, measure, change) of all measures. ``periods`` counts evidence rows
    by control_id, system_id, start, end and accepted."""
    is_open = ~F.col("implementation_status").isin(v.IMPLEMENTED, v.NOT_APPLICABLE)
    late = F.when(is_open, F.date_add("remediation_due_date", 1))
    stale = F.date_add("last_assessment_date", v.ASSESSMENT_VALID_DAYS + 1)
    expired = periods.where("end is not null").groupBy(F.date_add("end", 1).alias("day"))
    controls = periods.where("control_id is not null").select("control_id", "start", "end")
    parts = [
        _from(assessments, late, "overdue_remediation_count"),
        expired.agg(F.sum("rows").alias("change")).withColumn("measure", F.lit("expired_evidence")),
        _from(rollups.in_scope(systems), stale, "systems_assessment_overdue"),
        _within(covered(controls.distinct(), "control_id"), "controls_with_current_evidence"),
        *(_within(spans, name) for name, spans in severity_spans(periods).items()),
    ]
    return reduce(DataFrame.unionByName, parts)


def evidence_periods(evidence: DataFrame) -> DataFrame:
    return evidence.groupBy(
        "control_id",
        "system_id",
        F.col("assessment_period_start").alias("start"),
        F.col("assessment_period_end").alias("end"),
        F.coalesce(F.col("status") == v.ACCEPTED, F.lit(False)).alias("accepted"),
    ).agg(F.count(F.lit(1)).alias("rows"))


def daily(changes: DataFrame, first: dt.date, last: dt.date) -> DataFrame:
    """(day, one column per measure) for every day of the range. The window
    orders at most a row per calendar day."""
    by_day = changes.groupBy("day").pivot("measure", list(MEASURES)).agg(F.sum("change"))
    asked = changes.sparkSession.range(1).select(
        F.explode(F.sequence(F.lit(first), F.lit(last))).alias("day")
    )
    order = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    every = by_day.withColumn("asked", F.lit(False)).unionByName(
        asked.withColumn("asked", F.lit(True)), allowMissingColumns=True
    )
    summed = every.groupBy("day").agg(
        F.max("asked").alias("asked"), *(F.sum(m).alias(m) for m in MEASURES)
    )
    running = [F.coalesce(F.sum(m).over(order), F.lit(0)).alias(m) for m in MEASURES]
    return summed.select("day", "asked", *running).where("asked").drop("asked")


def readiness_timeline(
    assessments: DataFrame, evidence: DataFrame, systems: DataFrame, first: dt.date, last: dt.date
) -> DataFrame:
    """Readiness metrics and gap counts for every day from ``first`` to ``last``,
    from silver tables of any day. Rows are never dropped by their date: a day
    shows how the stored rows look on it."""
    periods = materialise(evidence_periods(evidence), "evidence-periods")
    days = daily(transitions(assessments, periods, systems), first, last)
    pairs = periods.select("control_id", "system_id").distinct().agg(F.count(F.lit(1))).scalar()
    totals = gold.side_by_side(
        rollups.assessment_totals(assessments),
        rollups.evidence_totals(evidence),
        rollups.scope_totals(systems),
    )
    # One row, put beside each of the days.
    constant = totals.drop(*MEASURES).select(F.struct("*")).scalar()
    graded = gold.readiness_scores(
        days.withColumn("_totals", constant).select("*", "_totals.*").drop("_totals")
    )
    gaps = F.col("low_gaps") + F.col("medium_gaps") + F.col("high_gaps")
    return graded.withColumn("critical_gaps", pairs - gaps)
