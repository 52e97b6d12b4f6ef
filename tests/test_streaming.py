from __future__ import annotations

import datetime as dt
import glob
import os

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tests.conftest import by, day
from tests.test_silver import frame
from veritrail import session
from veritrail.operators import quality, rollups
from veritrail.operators import silver as s
from veritrail.plans import incremental, landing, queries
from veritrail.plans.entities import Entities
from veritrail.sources import schemas, scratch
from veritrail.streaming import ingest, live, refine, schema_log
from veritrail.streaming.manifest import BatchTable


def _assessments(spark, ids, status="Implemented"):
    return frame(
        spark,
        "assessments",
        [
            {"assessment_id": i, "control_id": " ac-1", "system_id": "1",
             "assessment_date": day(-1), "implementation_status": status,
             "remediation_due_date": day(5)}
            for i in ids
        ],
    )


def test_only_new_files_are_ingested(spark, tmp_path):
    source, store = str(tmp_path / "in"), str(tmp_path / "store")
    landing.land_csv(_assessments(spark, ["1", "2"]).coalesce(1), source)
    assert ingest.rows_read(ingest.ingest_csv(spark, source, store, "assessments")) == 2
    assert ingest.rows_read(ingest.ingest_csv(spark, source, store, "assessments")) == 0
    landing.land_csv(_assessments(spark, ["3"]).coalesce(1), source)
    assert ingest.rows_read(ingest.ingest_csv(spark, source, store, "assessments")) == 1
    table = ingest.bronze_table(spark, store, "assessments")
    assert table.count() == 3
    assert table.where("_source_file IS NULL OR _ingestion_timestamp IS NULL").isEmpty()
    assert ingest.without_audit(table).columns == list(schemas.ASSESSMENT_COLUMNS)


def test_schema_is_remembered(spark, tmp_path):
    source, location = str(tmp_path / "in"), str(tmp_path / "schema")
    landing.land_csv(spark.createDataFrame([("1", "2")], "a string, b string"), source)
    first = ingest.remembered_schema(spark, source, location)
    assert first.names == ["a", "b"]
    other = str(tmp_path / "other")
    landing.land_csv(spark.createDataFrame([("1",)], "z string"), other)
    assert ingest.remembered_schema(spark, other, location) == first


def test_reordered_columns_stop_the_stream(spark, tmp_path):
    source, store = str(tmp_path / "in"), str(tmp_path / "store")
    rows = _assessments(spark, ["1"]).coalesce(1)
    landing.land_csv(rows, source)
    ingest.ingest_csv(spark, source, store, "assessments")
    landing.land_csv(rows.select(*reversed(rows.columns)), source)
    with pytest.raises(StreamingQueryException):
        ingest.ingest_csv(spark, source, store, "assessments")


def test_batches_are_bounded_by_file_count(spark, tmp_path):
    source, store = str(tmp_path / "in"), str(tmp_path / "store")
    for i in range(3):
        landing.land_csv(_assessments(spark, [str(i)]).coalesce(1), source)
    run = ingest.ingest_csv(spark, source, store, "assessments", files_per_batch=1)
    busy = [p for p in run.query.recentProgress if p["numInputRows"]]
    assert len(busy) == 3 and ingest.rows_read(run) == 3


def test_evidence_json_stream(spark, tmp_path):
    source, store = str(tmp_path / "in"), str(tmp_path / "store")
    rows = frame(spark, "evidence", [{"evidence_id": "1", "control_id": "x", "system_id": "1"}])
    landing.land_json(rows, source)
    for _ in range(2):
        ingest.ingest_json(spark, source, store, "evidence", schemas.EVIDENCE_SCHEMA)
    got = ingest.without_audit(ingest.bronze_table(spark, store, "evidence"))
    assert got.collect() == rows.collect()


def test_streamed_silver_equals_batch_and_ages(spark, tmp_path, as_of):
    store = str(tmp_path / "store")
    raw = _assessments(spark, ["1", "2"], "not implemented").unionByName(
        _assessments(spark, ["3"], "planned")
    )
    raw.write.parquet(f"{store}/bronze/assessments")
    query = refine.refine(spark, store, "assessments")
    failed = refine.failed_expectations(query, "assessments")
    assert failed["failed_valid_status"] == 1 and failed["failed_valid_assessment_id"] == 0
    assert ingest.rows_read(refine.refine(spark, store, "assessments")) == 0

    def ordered(df):
        return sorted(df.collect(), key=lambda r: r.assessment_id)

    for shift, overdue in ((0, False), (5, False), (6, True)):
        today = as_of + dt.timedelta(days=shift)
        got = refine.silver_table(spark, store, "assessments", today)
        want = s.silver_assessments(raw, today)
        assert ordered(got.select(*want.columns)) == ordered(want)
        assert by(got, "assessment_id")["1"]["is_overdue"] is overdue


def test_one_table_of_a_shared_folder(spark, tmp_path):
    folder = tmp_path / "shared"
    folder.mkdir()
    for name, value in (("alpha", 1), ("beta", 2)):
        part = str(tmp_path / name)
        spark.createDataFrame([(value,)], "v int").coalesce(1).write.parquet(part)
        (file,) = (tmp_path / name).glob("*.parquet")
        (folder / f"{name}.parquet").write_bytes(file.read_bytes())
    stream = ingest.table_stream(spark, str(folder), files="beta.parquet")
    run = ingest.append_available(stream, str(tmp_path / "out"), str(tmp_path / "cp"))
    assert [r.v for r in run.rows().collect()] == [2]


def test_every_batch_counts(spark, tmp_path):
    """More batches than the stream's progress keeps: rows and failures of all
    of them are counted."""
    kept = "spark.sql.streaming.numRecentProgressUpdates"
    before = spark.conf.get(kept)
    spark.conf.set(kept, "3")
    try:
        source, store = str(tmp_path / "in"), str(tmp_path / "store")
        for i in range(8):
            rows = _assessments(spark, [f"{i}a", f"{i}b"], "planned")
            landing.land_csv(rows.coalesce(1), source)
        run = ingest.ingest_csv(spark, source, store, "assessments", files_per_batch=1)
        assert ingest.rows_read(run) == 16
        raw = ingest.table_stream(spark, f"{store}/bronze/assessments", files_per_batch=1)
        target = f"{store}/silver/assessments"
        cleaned = quality.with_failure_bits(refine.CLEANERS["assessments"](raw), "assessments")
        run = ingest.append_available(
            cleaned, target, f"{store}/checkpoints/s", measures=quality.bit_metrics("assessments")
        )
        assert refine.failed_expectations(run, "assessments")["failed_valid_status"] == 16
    finally:
        spark.conf.set(kept, before)


def test_a_schema_write_that_died_is_repaired(spark, tmp_path):
    source, location = str(tmp_path / "in"), tmp_path / "schema"
    landing.land_csv(spark.createDataFrame([("1", "2")], "a string, b string"), source)
    location.mkdir()
    assert ingest.remembered_schema(spark, source, str(location)).names == ["a", "b"]
    assert ingest.remembered_schema(spark, source, str(location)).names == ["a", "b"]


# Manifest


def test_a_repeated_batch_is_skipped_and_a_dead_one_written_over(spark, tmp_path):
    table = BatchTable(spark, str(tmp_path / "t"))
    rows = spark.range(5)
    assert table.read() is None and table.counted() == (0, {})
    # A write that died before its record: its rows are not in the table.
    spark.range(100).write.parquet(f"{table.root}/batch-0")
    assert table.read() is None
    even = F.count_if(F.col("id") % 2 == 0).alias("even")
    assert table.write(rows, 0, "a", [even])
    assert not table.write(spark.range(50), 0, "b", [even])
    assert table.write(spark.range(7), 1, "b", [even])
    assert table.counted() == (12, {"even": 7})
    assert table.counted("b") == (7, {"even": 4}) and table.counted("none") == (0, {})
    assert table.read().count() == 12 and table.read("a").count() == 5


def test_counting_opens_no_data(spark, tmp_path):
    source, store = str(tmp_path / "in"), str(tmp_path / "store")
    landing.land_csv(_assessments(spark, ["1", "2"]).coalesce(1), source)
    run = ingest.ingest_csv(spark, source, store, "assessments")
    for data in (tmp_path / "store/bronze/assessments").glob("batch-*/*.parquet"):
        data.write_bytes(b"")
    assert ingest.rows_read(run) == 2


def test_failing_rows_by_bits_and_run(spark, tmp_path):
    store = str(tmp_path / "store")
    runs = []
    for ids, status in ((["1", "2"], "planned"), (["3", None], "implemented")):
        rows = _assessments(spark, ids, status)
        rows.write.mode("append").parquet(f"{store}/bronze/assessments")
        runs.append(refine.refine(spark, store, "assessments").run_id)

    def failing(*names, run=None):
        found = refine.failing_rows(spark, store, "assessments", *names, run=run)
        return sorted((r[0] or "-") for r in found.select("assessment_id").collect())

    assert failing() == ["-", "1", "2"]
    assert failing("valid_status") == ["1", "2"] and failing("valid_assessment_id") == ["-"]
    assert failing("valid_status", run=runs[1]) == [] and failing(run=runs[0]) == ["1", "2"]
    assert failing("valid_assessment_date") == []
    stored = BatchTable(spark, f"{store}/silver/assessments").read()
    want = quality.expectation_report(stored, "assessments", quality.EXPECTATIONS["assessments"])
    got = quality.bit_report(stored, "assessments")
    assert got.collect() == want.drop("violations").collect()


# Schema log


def test_files_with_other_headers_are_ingested(spark, tmp_path):
    source, store = str(tmp_path / "in"), str(tmp_path / "store")

    def land(text, name):
        (tmp_path / "in").mkdir(exist_ok=True)
        (tmp_path / "in" / name).write_text(text)

    def run():
        return ingest.rows_read(ingest.ingest_evolving_csv(spark, source, store, "things"))

    def table():
        rows = ingest.bronze_table(spark, store, "things", evolving=True).orderBy("a").collect()
        return [r.asDict() for r in rows]

    land("a,b,c\n1,x,y\n", "one.csv")
    assert run() == 1 and run() == 0
    land('c,a,b\n"Y, y",2,X\n', "moved.csv")
    land("a,b,c,new col,d\n3,p,q,r,\n4,p,q,,\n", "added.csv")
    land("a,c\n5,z\n", "missing.csv")
    land("", "empty.csv")
    assert run() == 4
    rows = table()
    assert [(r["a"], r["b"], r["c"]) for r in rows] == [
        ("1", "x", "y"), ("2", "X", "Y, y"), ("3", "p", "q"), ("4", "p", "q"), ("5", None, "z"),
    ]
    assert [r[schema_log.RESCUED] for r in rows] == [None, None, {"new col": "r"}, None, None]
    assert {r[schema_log.VERSION] for r in rows} == {0}
    before = rows
    log = schema_log.SchemaLog(spark, f"{store}/schema_log/things")
    assert log.promote("d") == 1 and log.promote("d") == 1
    land("d,a,b,c,e\n8,6,m,n,o\n", "later.csv")
    assert run() == 1
    *old, new = table()
    assert [{k: x for k, x in r.items() if k != "d"} for r in old] == before
    assert (new["d"], new[schema_log.RESCUED], new[schema_log.VERSION]) == ("8", {"e": "o"}, 1)


# Live rollups


def test_states_take_new_rows_once_and_merge(spark, tmp_path, monkeypatch, as_of):
    monkeypatch.setattr(live, "MOST_PARTS", 2)
    store = str(tmp_path / "store")
    state = live.LiveState(spark, store, "assessments")
    assert live.LiveRollups(spark, store, as_of).family_rollup().collect() == []
    taken = []
    for i in range(4):
        raw = _assessments(spark, [str(i), f"{i}b"], "not implemented")
        raw = raw.withColumn("system_id", F.lit(str(i % 3))).withColumn(
            "control_id", F.lit(f"ac-{i % 2}")
        )
        raw.write.mode("append").parquet(f"{store}/bronze/assessments")
        refine.refine(spark, store, "assessments")
        live.start_update(spark, store, "assessments").awaitTermination()
        taken.append([r.rows for r in state.commits().orderBy("batch").collect()])
    assert taken[-1] == [2, 2, 2, 2]
    assert len(state.commits().orderBy(F.desc("batch")).head().parts) <= 2
    silver = refine.silver_table(spark, store, "assessments", as_of)
    # A batch that comes again changes nothing.
    assert not state.apply(silver, 3) and not state.apply(silver, 0)
    for shift in (0, 6):
        today = as_of + dt.timedelta(days=shift)
        rows = refine.silver_table(spark, store, "assessments", today)
        now = live.LiveRollups(spark, store, today)
        for got, want in (
            (now.family_rollup(), rollups.family_rollup(rows)),
            (now.system_assessment_rollup(), rollups.system_assessment_rollup(rows)),
            (now.control_rollup(), rollups.control_rollup(rows)),
            (now.assessment_totals(), rollups.assessment_totals(rows)),
        ):
            got = got.select(*want.columns)
            assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


def test_states_keep_no_copy_of_the_rows(spark, tmp_path):
    """Whole rows are not kept on the executors while the states take them in."""
    state = live.LiveState(spark, str(tmp_path), "assessments")
    state.prepare()
    rows = s.clean_assessments(_assessments(spark, ["1", "2"]))
    asked = []
    rows.persist = lambda *_: asked.append(1) or rows
    assert state.apply(rows, 0) and not asked and not rows.is_cached
    assert state.read("by_family").agg({"n": "sum"}).head()[0] == 2


def test_sums_over_fewer_keys_read_parts_unmerged(spark, tmp_path, as_of, monkeypatch):
    """Only the count of pairs merges a state by key, which moves every row of it."""
    store = str(tmp_path)
    for entity in live.ENTITIES:
        state = live.LiveState(spark, store, entity)
        raw = spark.createDataFrame([], schemas.text_schema(schemas.ENTITY_COLUMNS[entity]))
        for batch in range(2):
            assert state.apply(refine.CLEANERS[entity](raw), batch)
    merged = []
    real = live.State.merged
    monkeypatch.setattr(
        live.State, "merged", lambda self, parts: merged.append(list(self.keys)) or real(self, parts)
    )
    now = live.LiveRollups(spark, store, as_of)
    now.family_rollup(), now.system_assessment_rollup(), now.evidence_pairs()
    now.assessment_totals(), now.evidence_totals()
    assert merged == []
    now.control_rollup()
    assert merged == [["control_id", "system_id"]]


def test_files_taken_in_are_deleted_if_asked(spark, tmp_path):
    store, kept, cleaned = (str(tmp_path / n) for n in ("store", "kept", "cleaned"))
    schema = schemas.text_schema(["a"])
    for n in range(2):
        for folder, clean in ((kept, False), (cleaned, True)):
            landing.land_json(spark.createDataFrame([(str(n),)], schema).coalesce(1), folder)
            ingest.ingest_json(spark, folder, store, folder.rsplit("/", 1)[1], schema, clean=clean)
    assert len(glob.glob(f"{kept}/*.json.gz")) == 2 and len(glob.glob(f"{cleaned}/*.json.gz")) == 1
    for entity in ("kept", "cleaned"):
        rows = ingest.bronze_table(spark, store, entity).select("a").collect()
        assert sorted(r[0] for r in rows) == ["0", "1"]


def test_removal_of_shuffles_is_set_for_a_block_only(spark, tmp_path):
    """Only inside the block; the session's own setting is there again after it."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    with scratch.shuffles_removed(spark):
        assert spark.conf.get(key) == "true"
    with pytest.raises(ZeroDivisionError), scratch.shuffles_removed(spark):
        1 / 0
    assert spark.conf.get(key) == before


def test_tasks_are_bounded_for_a_block_only(spark, tmp_path, monkeypatch):
    """A task reads a bounded part of a file; a session that asks for less keeps that."""
    read, merged = session.SIZES
    before = {key: spark.conf.get(key, None) for key in (*session.SIZES, session.SPREAD)}
    spark.range(200_000).selectExpr("xxhash64(id) AS x").coalesce(1).write.parquet(str(tmp_path / "x"))

    def parts():
        return spark.read.parquet(str(tmp_path / "x")).rdd.getNumPartitions()

    assert parts() <= 8
    monkeypatch.setattr(session, "TASK_BYTES", 20_000)
    with session.bounded_tasks(spark):
        assert parts() > 8
        assert int(spark.conf.get(session.SPREAD)) == session.LEAST_SPREAD
    try:
        spark.conf.set(merged, "10kb")
        spark.conf.set(session.SPREAD, "300")
        with pytest.raises(ZeroDivisionError), session.bounded_tasks(spark):
            assert (spark.conf.get(read), spark.conf.get(merged)) == ("20000", "10240")
            assert spark.conf.get(session.SPREAD) == "300"
            1 / 0
        assert (spark.conf.get(merged), spark.conf.get(session.SPREAD)) == ("10kb", "300")
    finally:
        spark.conf.unset(merged)
        spark.conf.unset(session.SPREAD)
    assert {key: spark.conf.get(key, None) for key in before} == before and parts() <= 8


def test_the_incremental_run_bounds_its_tasks(spark, monkeypatch):
    def run(spark_, folder):
        return {key: spark_.conf.get(key) for key in session.SIZES}

    monkeypatch.setattr(queries, "_run_incremental", run)
    monkeypatch.setattr(queries, "_identity", lambda *_: ("bounded",))
    monkeypatch.setattr(queries, "_published", {})
    seen = queries._incremental_run(spark, "none")
    assert set(seen.values()) == {str(session.TASK_BYTES)}
    assert spark.conf.get(session.SIZES[0]) != str(session.TASK_BYTES)


def test_json_lands_at_the_level_asked_for(spark, tmp_path):
    df = spark.range(20_000).selectExpr("id", "CONCAT('text ', id % 97, ' of ', id) AS value").coalesce(1)
    size = {}
    for level in (landing.USUAL, landing.FAST):
        folder = landing.land_json(df, str(tmp_path / level), level=level)
        size[level] = sum(os.path.getsize(f) for f in glob.glob(f"{folder}/*.json.gz"))
        assert spark.read.schema(df.schema).json(folder).exceptAll(df).isEmpty()
    assert size[landing.USUAL] < size[landing.FAST]


def test_the_incremental_run_keeps_no_landed_text_and_no_shuffles(spark, tmp_path, monkeypatch):
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    places, setting = [], []
    real = queries.live.update
    monkeypatch.setattr(queries, "new_scratch_dir", lambda *_: f"{tmp_path}/stream-all-test")
    monkeypatch.setattr(queries, "_published", {})

    def update(spark, store):
        places.append([f for f in glob.glob(f"{store}/landing/*/*.gz") if os.path.getsize(f)])
        setting.append(spark.conf.get(key))
        real(spark, store)

    monkeypatch.setattr(queries.live, "update", update)
    run = queries._incremental_run(spark, "/root/testdata/sf0.001")
    streamed = [f for seen in places for f in seen if f.split("/")[-2] in incremental.STREAMED]
    assert len(places) == 3 and streamed == [] and set(setting) == {"true"}
    e = Entities(spark, "/root/testdata/sf0.001")
    for entity in incremental.STREAMED:
        assert BatchTable(spark, f"{run['store']}/silver/{entity}").read().count() == e.bronze(entity).count()


def test_an_emptied_landing_folder_takes_new_files(spark, tmp_path):
    store, folder = str(tmp_path / "store"), str(tmp_path / "in")
    schema = schemas.text_schema(["a"])
    for n in range(2):
        landing.land_json(spark.createDataFrame([(str(n),)], schema).coalesce(1), folder)
        ingest.ingest_json(spark, folder, store, "x", schema)
        landing.empty(spark, folder)
        assert glob.glob(f"{folder}/*.json.gz") == []
    rows = ingest.bronze_table(spark, store, "x").select("a").collect()
    assert sorted(r[0] for r in rows) == ["0", "1"]


def test_stored_batches_are_sorted_where_asked(spark, tmp_path):
    rows = spark.range(20_000).selectExpr(
        "HEX(xxhash64(id)) AS id",
        "IF(id = 7, NULL, CONCAT('c-', xxhash64(xxhash64(id) % 2000))) AS control_id",
        "CONCAT('Findings on ', xxhash64(xxhash64(id) % 2000)) AS findings",
    ).coalesce(1)
    plain, near = str(tmp_path / "plain"), str(tmp_path / "near")
    BatchTable(spark, plain).write(rows, 0)
    table = BatchTable(spark, near, near=("control_id", "not_there"))
    assert table.write(rows, 0) and not table.write(rows, 0)
    keys = [r[0] for r in table.read().select("control_id").collect()]
    assert keys[0] is None and keys[1:] == sorted(keys[1:])
    assert table.read().exceptAll(rows).isEmpty() and table.counted() == (20_000, {})

    def size(root):
        return sum(os.path.getsize(f) for f in glob.glob(f"{root}/batch-0/*.parquet"))

    assert size(near) < 0.9 * size(plain)


def test_an_advance_sorts_what_it_stores(spark, tmp_path):
    store, rows = str(tmp_path / "store"), []
    for n in range(60):
        rows.append({"assessment_id": str(n), "control_id": f"AC-{n * 37 % 60}", "system_id": "1"})
    paths = {e: str(tmp_path / e) for e in incremental.STREAMED}
    landing.land_csv(frame(spark, "assessments", rows).coalesce(1), paths["assessments"])
    landing.land_csv(frame(spark, "systems", [{"system_id": "1"}]).coalesce(1), paths["systems"])
    landing.land_json(frame(spark, "evidence", [{"evidence_id": "1"}]).coalesce(1), paths["evidence"])
    incremental.advance(spark, paths, store)
    for layer in ("bronze", "silver"):
        stored = BatchTable(spark, f"{store}/{layer}/assessments").read()
        keys = [r[0] for r in stored.select("control_id").collect()]
        assert len(keys) == 60 and keys == sorted(keys)
