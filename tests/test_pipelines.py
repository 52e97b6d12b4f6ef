"""Whole runs from landing files, compared with the directly computed tables."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from veritrail.plans import incremental, landing, medallion
from veritrail.plans.entities import AS_OF, BRONZE, Entities
from veritrail.plans.queries import QUERIES
from veritrail.sources import scratch
from veritrail.streaming import live

SMALL = "/root/testdata/sf0.001"
IDS = {"systems": "system_id", "assessments": "assessment_id", "evidence": "evidence_id"}


def _land(spark, root):
    e = Entities(spark, SMALL)
    paths = {}
    for name in BRONZE:
        land = landing.land_json if name == "evidence" else landing.land_csv
        paths[name] = land(e.bronze(name), f"{root}/{name}")
    return paths


def _same(got, want):
    columns = sorted(want.columns)
    assert sorted(got.columns) == columns
    got, want = got.select(*columns), want.select(*columns)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


@pytest.fixture(scope="module")
def batch(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("batch")
    layers = medallion.Layers("t_bronze", "t_silver", "t_gold", location=str(root / "lake"))
    seen = medallion.run_batch(spark, _land(spark, root / "landing"), AS_OF, layers)
    return layers, seen


GOLD = {
    "control_compliance_summary": "gold_compliance_summary",
    "system_compliance_scorecard": "gold_system_scorecard",
    "cross_framework_mapping": "gold_cross_framework",
    "evidence_gap_analysis": "gold_evidence_gap_observed",
    "audit_readiness_metrics": "gold_audit_readiness",
    "compliance_alerts": "alerts_all",
}


@pytest.mark.parametrize("table", GOLD)
def test_batch_run_builds_gold(spark, batch, table):
    layers, _ = batch
    _same(spark.table(f"{layers.gold}.{table}"), QUERIES[GOLD[table]](spark, SMALL))


def test_batch_run_reports_what_it_wrote(spark, batch):
    layers, seen = batch
    e = Entities(spark, SMALL)
    assert seen["silver.assessments"]["rows"] == e.assessments.count()
    assert seen["silver.assessments"]["failed_valid_status"] == 0
    predictions = spark.table(f"{layers.gold}.control_risk_predictions")
    assert seen["risk.control_risk_predictions"]["rows"] == predictions.count()
    assert 0.5 < seen["risk.control_risk_predictions"]["auc"] <= 1.0
    assert seen["alerts.compliance_rules"]["rows"] == 5


def test_batch_bronze_keeps_rows_and_tags(spark, batch):
    layers, _ = batch
    controls = spark.table(f"{layers.bronze}.controls")
    assert [r[0] for r in controls.select("_source").distinct().collect()] == ["control-catalogue"]
    assert dict(controls.dtypes)["baseline_low"] == "string"
    assert "_ingestion_timestamp" in spark.table(f"{layers.bronze}.evidence").columns


@pytest.fixture(scope="module")
def streamed(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("stream")
    e = Entities(spark, SMALL)
    paths = {name: f"{root}/landing/{name}" for name in BRONZE}
    for name in incremental.CATALOGUES:
        landing.land_csv(e.bronze(name), paths[name])
    arrived = []
    for i in range(2):
        for name, key in IDS.items():
            land = landing.land_json if name == "evidence" else landing.land_csv
            land(landing.deliveries(e.bronze(name), key)[i], paths[name])
        arrived.append(incremental.advance(spark, paths, str(root)))
    idle = incremental.advance(spark, paths, str(root))
    layers = medallion.Layers("i_bronze", "i_silver", "i_gold", location=str(root / "lake"))
    return layers, arrived, idle, incremental.publish(spark, paths, str(root), AS_OF, layers)


def test_incremental_run_reads_each_row_once(spark, streamed):
    _, arrived, idle, _ = streamed
    e = Entities(spark, SMALL)
    assert idle == dict.fromkeys(IDS, 0)
    for name in IDS:
        assert sum(run[name] for run in arrived) == e.bronze(name).count()


STORED = {
    **{t: key for t, key in GOLD.items() if t != "compliance_alerts"},
    "evidence_gap_analysis": "gold_evidence_gap_matrix",
    "missing_evidence_by_system": "gold_missing_by_system",
    "missing_evidence_by_control": "gold_missing_by_control",
}


@pytest.mark.parametrize("table", STORED)
def test_incremental_run_stores_gold(spark, streamed, table):
    name = f"{streamed[0].gold}.{table}"
    _same(spark.table(name), QUERIES[STORED[table]](spark, SMALL))
    detail = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {name}").collect()}
    assert detail["Comment"] == medallion.COMMENTS[table]
    assert "quality=gold" in detail["Table Properties"]


@pytest.fixture(scope="module")
def refreshed(spark, tmp_path_factory):
    """Two deliveries, the business tables brought up to date after each."""
    root = tmp_path_factory.mktemp("live")
    e = Entities(spark, SMALL)
    paths = {name: f"{root}/landing/{name}" for name in BRONZE}
    for name in incremental.CATALOGUES:
        landing.land_csv(e.bronze(name), paths[name])
    layers = medallion.Layers("l_bronze", "l_silver", "l_gold", location=str(root / "lake"))
    for i in range(2):
        for name, key in IDS.items():
            land = landing.land_json if name == "evidence" else landing.land_csv
            land(landing.deliveries(e.bronze(name), key)[i], paths[name])
        arrived = incremental.advance(spark, paths, str(root))
        incremental.refresh(spark, paths, str(root), AS_OF, layers)
    return layers, paths, root, arrived


@pytest.mark.parametrize("table", STORED)
def test_refreshed_tables_equal_a_recompute(spark, refreshed, table):
    _same(spark.table(f"{refreshed[0].gold}.{table}"), QUERIES[STORED[table]](spark, SMALL))


def test_a_refresh_reads_new_rows_only(spark, refreshed):
    layers, paths, root, arrived = refreshed
    for entity in live.ENTITIES:
        state = live.LiveState(spark, str(root), entity)
        taken = [r.rows for r in state.commits().orderBy("batch").collect()]
        assert len(taken) == 2 and taken[1] == arrived[entity]
    incremental.refresh(spark, paths, str(root), AS_OF, layers)
    assert state.commits().count() == 2


def test_scratch_needs_a_shared_folder_on_a_cluster():
    class Session:
        conf = {}

        class sparkContext:  # noqa: N801
            master = "yarn"

    with pytest.raises(ValueError):
        scratch.scratch_root(Session)
    Session.conf = {"spark.checkpoint.dir": "hdfs://shared/"}
    assert scratch.scratch_root(Session) == "hdfs://shared"


def test_incremental_run_stores_catalogues_alerts_and_risk(spark, streamed):
    layers, *_, seen = streamed
    assert seen["silver.controls"]["failed_valid_control_id"] == 0
    assert seen["alerts.compliance_alerts"]["rows"] > 0
    predictions = spark.table(f"{layers.gold}.control_risk_predictions")
    assert predictions.count() == Entities(spark, SMALL).assessments.count()


def test_ids_and_flags_mean_the_same_in_both_runs(spark, tmp_path):
    """Ids with leading zeros and flags in any case, as files may bring them."""
    root = str(tmp_path)
    e = Entities(spark, SMALL)
    pad = F.concat(F.lit("00"), F.col("system_id"))
    paths = {}
    for name in BRONZE:
        df = e.bronze(name)
        if "system_id" in df.columns:
            df = df.withColumn("system_id", pad)
        if name == "controls":
            df = df.withColumn("baseline_moderate", F.initcap("baseline_moderate"))
        land = landing.land_json if name == "evidence" else landing.land_csv
        paths[name] = land(df, f"{root}/landing/{name}")
    batch = medallion.Layers("z_bronze", "z_silver", "z_gold", location=f"{root}/batch")
    batch.create(spark)
    medallion.load_bronze(spark, paths, batch)
    medallion.build_silver(spark, batch, AS_OF)
    medallion.build_gold(spark, batch, AS_OF, expected=True)
    stream = medallion.Layers("y_bronze", "y_silver", "y_gold", location=f"{root}/stream")
    incremental.advance(spark, paths, f"{root}/store")
    incremental.publish(spark, paths, f"{root}/store", AS_OF, stream)
    want = QUERIES["gold_system_scorecard"](spark, SMALL).withColumn("system_id", pad)
    gaps = QUERIES["gold_evidence_gap_matrix"](spark, SMALL).withColumn("system_id", pad)
    for layers in (batch, stream):
        _same(spark.table(f"{layers.gold}.system_compliance_scorecard"), want)
        _same(spark.table(f"{layers.gold}.evidence_gap_analysis"), gaps)
