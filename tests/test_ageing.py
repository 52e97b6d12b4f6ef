"""Timeline, bitmaps, failure bits and joins on heavy keys against plain Python."""

from __future__ import annotations

import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.conftest import AS_OF, by, day, rows
from tests.test_silver import frame
from veritrail.operators import bitmaps, quality, rollups, skew, timeline
from veritrail.operators import silver as s
from veritrail.plans.queries import QUERIES

# Timeline


def date(text):
    return dt.date.fromisoformat(text) if text else None


@pytest.fixture(scope="module")
def dated(spark):
    pick = random.Random(5)
    maybe = lambda lo, hi: day(pick.randint(lo, hi)) if pick.random() > 0.1 else None
    status = ["implemented", "not implemented", "partially implemented", "not applicable", "odd", None]
    assessments = [
        {"assessment_id": str(i), "control_id": f"ac-{pick.randint(1, 5)}",
         "system_id": str(pick.randint(1, 4)), "implementation_status": pick.choice(status),
         "assessment_date": day(-5), "remediation_due_date": maybe(-20, 20)}
        for i in range(120)
    ]
    evidence = [
        {"evidence_id": str(i), "control_id": f"ac-{pick.randint(1, 5)}",
         "system_id": str(pick.randint(1, 3)),
         "assessment_period_start": maybe(-120, 10), "assessment_period_end": maybe(-30, 120),
         "status": pick.choice(["Accepted", "Accepted", "Pending Review", "Rejected", None])}
        for i in range(60)
    ]
    systems = [
        {"system_id": str(i), "certification_scope": pick.choice(["soc2", "none", "both"]),
         "last_assessment_date": day(pick.randint(-380, -350))}
        for i in range(30)
    ]
    return (
        s.silver_assessments(frame(spark, "assessments", assessments), AS_OF),
        s.silver_evidence(frame(spark, "evidence", evidence), AS_OF),
        s.silver_systems(frame(spark, "systems", systems), AS_OF),
    )


def test_every_day_of_the_timeline(dated):
    assessments, evidence, systems = dated
    first, last = AS_OF - dt.timedelta(days=40), AS_OF + dt.timedelta(days=130)
    got = {r["day"]: r for r in rows(timeline.readiness_timeline(*dated, first, last))}
    assert len(got) == 171
    a_rows, e_rows, s_rows = rows(assessments), rows(evidence), rows(systems)
    for today, r in got.items():
        late = [
            x for x in a_rows
            if x["implementation_status"] not in ("Implemented", "Not Applicable", None)
            and x["remediation_due_date"] and x["remediation_due_date"] < today
        ]
        assert r["overdue_remediation_count"] == len(late)
        current, gaps = [], {}
        expired = 0
        for x in e_rows:
            start, end = x["assessment_period_start"], x["assessment_period_end"]
            expired += bool(end and end < today)
            now = bool(start and end and start <= today <= end)
            pair = gaps.setdefault((x["control_id"], x["system_id"]), [0, []])
            if now:
                current.append(x["control_id"])
                pair[0] += x["status"] == "Accepted"
                pair[1].append((end - today).days)
        assert r["expired_evidence"] == expired
        assert r["controls_with_current_evidence"] == len(set(current))
        grades = Counter(
            "critical" if not n else "high" if max(left) < 30 else "medium" if max(left) < 90 else "low"
            for n, left in gaps.values()
        )
        assert {k: r[f"{k}_gaps"] for k in ("low", "medium", "high", "critical")} == {
            k: grades[k] for k in ("low", "medium", "high", "critical")
        }
        old = [
            x for x in s_rows
            if (x["in_soc2_scope"] or x["in_iso_scope"]) and (today - x["last_assessment_date"]).days > 365
        ]
        assert r["systems_assessment_overdue"] == len(old)


def test_covered_days_of_overlapping_touching_and_reversed_periods(spark):
    periods = [("a", 1, 5), ("a", 3, 9), ("a", 10, 12), ("a", 20, 21), ("a", 30, 25), ("b", 4, 4), ("b", 4, 4)]
    frame_ = spark.createDataFrame(
        [(k, date(day(x)), date(day(y))) for k, x, y in periods], "k string, start date, end date"
    )
    got = {(r["k"], r["first"], r["until"]) for r in rows(timeline.covered(frame_, "k"))}
    want = {("a", 1, 13), ("a", 20, 22), ("b", 4, 5)}
    assert got == {(k, date(day(x)), date(day(y))) for k, x, y in want}


def test_timeline_of_empty_tables(dated):
    none = [df.where("false") for df in dated]
    got = rows(timeline.readiness_timeline(*none, AS_OF, AS_OF))
    assert len(got) == 1 and got[0]["critical_gaps"] == 0 and got[0]["total_assessments"] == 0


# Bitmaps


def test_dense_ids_number_keys_in_order(spark):
    keys = [f"k{i:04}" for i in range(500)]
    df = spark.createDataFrame([(k,) for k in keys + keys[:50]] + [(None,)], "k string")
    got = {r["k"]: r["number"] for r in rows(bitmaps.dense_ids(df, "k"))}
    assert got == {k: i + 1 for i, k in enumerate(keys)}


@pytest.fixture(scope="module")
def covered(spark):
    """Systems on both sides of a block border, so there are two blocks."""
    pick = random.Random(9)
    size = 32_768
    numbers = [(str(n), n) for n in (1, 8, 9, 300, size - 1, size, size + 1, size + 9, 2 * size, 2 * size + 1)]
    systems = spark.createDataFrame(
        [(i, f"name {i}", f"unit{n % 3}", n % 4 != 1, n % 5 == 1) for i, n in numbers],
        "system_id string, system_name string, business_unit string, in_soc2_scope boolean, "
        "in_iso_scope boolean",
    )
    controls = spark.createDataFrame(
        [(f"A{f}-{i}", f"A{f}", f"name {i}", "x", i != 3) for f in range(3) for i in range(5)],
        "control_id string, control_family_code string, control_name string, "
        "control_family string, baseline_moderate boolean",
    )
    pairs = {
        (c.control_id, i): pick.randint(0, 1)
        for c in controls.collect() for i, _ in numbers
        if pick.random() < 0.4 and c.control_id != "A0-0"
    }
    frame_ = spark.createDataFrame(
        [(*k, n) for k, n in pairs.items()],
        "control_id string, system_id string, current_evidence_count long",
    )
    numbered = spark.createDataFrame(numbers, "system_id string, number long")
    return controls, systems, pairs, bitmaps.system_bitmaps(frame_, numbered), numbered


def test_coverage_by_control(covered):
    controls, systems, pairs, bits, numbers = covered
    assert bits.select("block").distinct().count() == 3
    scope = {r.system_id for r in systems.collect() if r.in_soc2_scope or r.in_iso_scope}
    got = by(bitmaps.control_coverage(controls, systems, bits, numbers), "control_id")
    for c in controls.collect():
        own = {i for k, i in pairs if k == c.control_id}
        r = got[c.control_id]
        assert r["systems_with_evidence"] == len(own)
        assert r["systems_with_current_evidence"] == sum(pairs[c.control_id, i] for i in own)
        assert r["missing_systems"] == (len(scope - own) if c.baseline_moderate else None)


def test_coverage_by_family_and_unit(covered):
    controls, systems, pairs, bits, numbers = covered
    got = rows(bitmaps.family_unit_coverage(controls, systems, bits, numbers, "business_unit"))
    assert len(got) == 9
    for r in got:
        own = {
            x.system_id for x in systems.collect()
            if x.business_unit == r["business_unit"] and (x.in_soc2_scope or x.in_iso_scope)
        }
        held = {i for (c, i) in pairs if c.startswith(r["control_family_code"]) and i in own}
        now = {i for (c, i), n in pairs.items() if n and c.startswith(r["control_family_code"]) and i in own}
        assert (r["systems"], r["with_evidence"], r["with_current_evidence"], r["without_evidence"]) == (
            len(own), len(held), len(now), len(own - held),
        )


def test_missing_pairs_are_listed(covered):
    controls, systems, pairs, bits, numbers = covered
    asked = systems.where("business_unit = 'unit1'")
    got = {tuple(r) for r in bitmaps.missing_pairs(controls, asked, bits, numbers).collect()}
    want = {
        (c.control_id, x.system_id)
        for c in controls.collect() for x in asked.collect()
        if c.baseline_moderate and (x.in_soc2_scope or x.in_iso_scope)
        and (c.control_id, x.system_id) not in pairs
    }
    assert got == want and len(want) > 5


# Bits of expectations


def test_unknown_outcomes_are_failures(spark):
    df = spark.createDataFrame([(1, "x"), (None, "x"), (5, None)], "n int, t string")
    checks = {"small": "n < 3", "text": "t = 'x'"}
    marked = quality.with_failure_bits(df, "", checks)
    assert [r[quality.BITS] for r in rows(marked)] == [0, 1, 3]
    assert quality.failing(marked, "", "text", expectations=checks).count() == 1
    assert quality.failing(marked, "", expectations=checks).count() == 2


# Heavy keys


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("limit", [0, 1 << 20])
def test_skew_join_equals_a_join(spark, how, limit):
    left = spark.range(3000).select(
        F.col("id").alias("v"),
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 50 == 1, None).otherwise(F.col("id") % 400)
        .cast("int").alias("k"),
        F.lit("a").alias("j"),
    )
    right = spark.range(800).selectExpr("cast(id % 350 AS int) AS k", "'a' AS j", "id AS w")
    heavy = left.where("k = 7").count()
    assert [r["_rows"] for r in rows(skew.heavy_keys(left, ["k", "j"]))] == [heavy]
    got = skew.skew_join(left, right, ["k", "j"], how, broadcast_bytes=limit, rows_per_salt=100)
    want = left.join(right, ["k", "j"], how)
    assert got.columns == want.columns
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


def test_a_third_on_one_key_is_split_though_a_side_is_an_aggregate(spark, tmp_path):
    rows_ = spark.range(30_000).select(
        "id", F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id") % 5000).alias("k")
    )
    rows_.write.parquet(str(tmp_path / "rows"))
    stored = spark.read.parquet(str(tmp_path / "rows"))
    sums = stored.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = skew.skew_join(stored, sums, "k", broadcast_bytes=0, rows_per_salt=500)
        largest = joined.groupBy(F.spark_partition_id()).count().agg(F.max("count")).head()[0]
        plain = stored.join(sums, "k").groupBy(F.spark_partition_id()).count()
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        assert joined.count() == 30_000
        salted = joined.groupBy(F.spark_partition_id()).count().agg(F.max("count")).head()[0]
        assert salted < plain.agg(F.max("count")).head()[0] / 2 and largest
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_skew_join_without_heavy_keys_and_on_empty_tables(spark):
    left = spark.range(300).selectExpr("id AS k", "id AS v")
    right = spark.range(200).selectExpr("id AS k", "id * 2 AS w")
    assert skew.skew_join(left, right, "k").count() == 200
    assert skew.skew_join(left.where("false"), right, "k", "left").count() == 0
    assert skew.skew_join(left, right.where("false"), "k", "left").count() == 300
    with pytest.raises(ValueError):
        skew.skew_join(left, right, "k", "full")


def test_pair_rollup_stays_as_it_was(dated):
    _, evidence, _ = dated
    periods = timeline.evidence_periods(evidence)
    assert periods.agg(F.sum("rows")).head()[0] == evidence.count()
    assert rollups.evidence_pairs(evidence).count() == periods.select("control_id", "system_id").distinct().count()


def test_readiness_copies_no_rows_for_distinct_counts(spark):
    df = QUERIES["gold_audit_readiness"](spark, "/root/testdata/sf0.001")
    assert "Expand" not in df._jdf.queryExecution().toString()


def test_bitmaps_of_sparse_controls_are_no_larger_than_the_pairs(spark):
    """Far apart systems: a word each, numbers instead of blocks of bytes, and no
    bit lost at either end of a word."""
    numbers = [1, 64, 65, 128, 129, 32_767, 32_768, 32_769, 1_000_000]
    numbered = spark.createDataFrame([(str(n), n) for n in numbers], "system_id string, number long")
    pairs = spark.createDataFrame(
        [("c", str(n), n % 2) for n in numbers],
        "control_id string, system_id string, current_evidence_count long",
    )
    bits = bitmaps.system_bitmaps(pairs, numbered)
    assert {t for c, t in bits.dtypes if c in ("held", "current")} == {"bigint"}
    assert len(rows(bits)) <= len(numbers)
    assert sum(r["held"].bit_count() if r["held"] >= 0 else 64 - (~r["held"]).bit_count() for r in rows(bits)) == 9
    controls = spark.createDataFrame(
        [("c", "C", "n", "f", True)],
        "control_id string, control_family_code string, control_name string, "
        "control_family string, baseline_moderate boolean",
    )
    systems = numbered.selectExpr(
        "system_id", "system_id AS system_name", "true AS in_soc2_scope", "false AS in_iso_scope"
    )
    (got,) = rows(bitmaps.control_coverage(controls, systems, bits, numbered))
    assert got["systems_with_evidence"] == 9 and got["missing_systems"] == 0
    assert got["systems_with_current_evidence"] == sum(n % 2 for n in numbers)
    assert bitmaps.missing_pairs(controls, systems, bits, numbered).count() == 0
