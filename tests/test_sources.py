from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from veritrail.plans import landing
from veritrail.sources import audit, readers, schemas, scratch, sinks


@pytest.fixture
def people(spark):
    return spark.createDataFrame(
        [("  a", "1", "2024-01-02", "x, y"), ("b", "2", None, 'quoted "text"')],
        "name string, n string, d string, note string",
    )


def test_csv_round_trip_keeps_text(spark, people, tmp_path):
    path = landing.land_csv(people, str(tmp_path / "csv"))
    got = readers.read_csv(spark, path, infer=False)
    assert [f.dataType.simpleString() for f in got.schema] == ["string"] * 4
    assert sorted(got.collect()) == sorted(people.collect())


def test_csv_inference(spark, people, tmp_path):
    path = landing.land_csv(people, str(tmp_path / "csv"))
    assert dict(readers.read_csv(spark, path).dtypes) == {
        "name": "string", "n": "int", "d": "date", "note": "string",
    }


def test_csv_with_given_schema(spark, people, tmp_path):
    path = landing.land_csv(people, str(tmp_path / "csv"))
    got = readers.read_csv(spark, path, schema=people.schema)
    assert got.schema == people.schema and got.count() == 2


def test_json_lines(spark, people, tmp_path):
    path = landing.land_json(people, str(tmp_path / "json"))
    assert readers.read_jsonl(spark, path).count() == 2
    typed = readers.read_jsonl(spark, path, schema=schemas.text_schema(people.columns))
    assert sorted(typed.collect()) == sorted(people.collect())


def test_evidence_schema_marks_required_fields():
    required = [f.name for f in schemas.EVIDENCE_SCHEMA if not f.nullable]
    assert required == list(schemas.EVIDENCE_REQUIRED)
    assert len(schemas.EVIDENCE_SCHEMA) == 15


def test_audit_columns(spark, people, tmp_path):
    path = landing.land_csv(people, str(tmp_path / "csv"))
    got = audit.with_audit(readers.read_csv(spark, path), source="tag", file=True)
    for r in rows(got):
        assert r["_source"] == "tag" and str(tmp_path) in r["_source_file"]
        assert r["_ingestion_timestamp"] is not None
    plain = audit.with_audit(people)
    assert plain.columns == [*people.columns, "_ingestion_timestamp"]


def test_write_table_overwrites_and_reports(spark, people, tmp_path):
    name, path = "sink_test", str(tmp_path / "table")
    sinks.write_table(people.limit(1), name, path=path)
    seen = sinks.write_table(
        people,
        name,
        path=path,
        comment="People's list",
        properties={"quality": "silver", "it's": "quoted"},
        metrics=[F.count_if(F.col("d").isNull()).alias("undated")],
    )
    assert seen == {"rows": 2, "undated": 1}
    assert readers.read_table(spark, name).count() == 2
    detail = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {name}").collect()}
    assert detail["Comment"] == "People's list"
    properties = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    assert properties["quality"] == "silver" and properties["it's"] == "quoted"


def test_a_write_that_dies_leaves_the_old_table(spark, people, tmp_path):
    name = "sink_survivor"
    sinks.write_table(people, name, path=str(tmp_path / "t"))
    broken = people.withColumn("note", F.raise_error(F.lit("lost")).cast("string"))
    with pytest.raises(Exception, match="lost"):
        sinks.write_table(broken, name, path=str(tmp_path / "t"))
    assert sorted(readers.read_table(spark, name).collect()) == sorted(people.collect())
    sinks.write_table(people.select("n"), name, path=str(tmp_path / "t"))
    assert readers.read_table(spark, name).columns == ["n"]


def test_layer_counts(spark, people):
    got = sinks.layer_counts({"people": people, "nobody": people.limit(0)})
    assert {r["table_name"]: r["row_count"] for r in rows(got)} == {"people": 2, "nobody": 0}


def test_scratch_is_shared_and_fresh(spark, people):
    root = scratch.scratch_root(spark)
    configured = spark.conf.get("spark.checkpoint.dir", None)
    assert configured is None or root == configured.rstrip("/")
    first, second = (scratch.new_scratch_dir(spark, "x") for _ in range(2))
    assert first != second and first.startswith(root)
    assert sorted(scratch.materialise(people, "people").collect()) == sorted(people.collect())



def test_landed_files_are_compressed_and_bounded(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(landing, "FILE_ROWS", 10)
    df = spark.range(25).selectExpr("CAST(id AS STRING) AS id", "repeat('  x', 200) AS t").coalesce(1)
    for land, read, end in (
        (landing.land_csv, lambda p: readers.read_csv(spark, p, infer=False), "csv.gz"),
        (landing.land_json, lambda p: readers.read_jsonl(spark, p), "json.gz"),
    ):
        path = land(df, str(tmp_path / end))
        files = list((tmp_path / end).glob(f"*.{end}"))
        assert len(files) == 3 and sum(f.stat().st_size for f in files) < 25 * 200
        assert sorted(map(tuple, read(path).select("id", "t").collect())) == sorted(map(tuple, df.collect()))
