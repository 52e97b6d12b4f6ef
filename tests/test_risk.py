from __future__ import annotations

import hashlib

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from tests.conftest import by, day, rows
from tests.test_gold import assessments, evidence, systems
from tests.test_silver import frame
from veritrail.operators import forest, risk, rollups
from veritrail.operators import silver as s
from veritrail.plans import queries
from veritrail.plans.entities import AS_OF, Entities


@pytest.fixture(scope="module")
def inputs(spark):
    from tests.conftest import AS_OF as as_of

    return {
        "assessments": assessments(
            spark,
            as_of,
            [
                {"assessment_id": "a", "implementation_status": "Implemented"},
                {"assessment_id": "b", "implementation_status": "Not Applicable",
                 "control_id": "AC-2"},
                {"assessment_id": "c", "implementation_status": "Partially Implemented",
                 "control_id": "AC-3", "remediation_due_date": day(7)},
                {"assessment_id": "d", "implementation_status": "Not Implemented",
                 "system_id": "9"},
            ],
        ),
        "systems": systems(
            spark, as_of, [{"system_id": "1", "criticality": "critical"}]
        ),
        "pairs": rollups.evidence_pairs(
            evidence(
                spark,
                as_of,
                [
                    {},
                    {"assessment_period_end": day(-1)},
                    {"control_id": "AC-2", "status": "Rejected"},
                ],
            )
        ),
        "controls": s.silver_controls(
            frame(spark, "controls", [{"control_id": f"AC-{i}", "baseline_moderate": b} for i, b in
                                      ((1, "TRUE"), (2, "FALSE"), (3, "TRUE"))])
        ),
    }


def _features(df):
    names = ("historical_compliance", "days_to_remediation", "evidence_count",
             "gap_severity_score", "criticality_score", "is_at_risk")
    return {k: tuple(r[n] for n in names) for k, r in by(df, "assessment_id").items()}


def test_features(inputs):
    got = risk.risk_features(inputs["assessments"], inputs["systems"], inputs["pairs"])
    assert _features(got) == {
        "a": (100, 0, 2, 1, 4, 0.0),
        "b": (0, 0, 0, 4, 4, 0.0),
        "c": (50, 7, 0, 0, 4, 1.0),  # no evidence at all: below Low
        "d": (0, 0, 0, 0, 1, 1.0),  # unknown system
    }


def test_features_over_the_matrix(inputs):
    got = risk.risk_features_matrix(
        inputs["assessments"], inputs["systems"], inputs["controls"], inputs["pairs"]
    )
    severity = {k: f[3] for k, f in _features(got).items()}
    assert severity == {"a": 1, "b": 0, "c": 4, "d": 0}


def test_split_depends_on_the_id_alone(spark):
    ids = [f"id-{i}" for i in range(500)]
    df = spark.createDataFrame([(i,) for i in ids], "assessment_id string")
    want = {
        i: "train" if int(hashlib.md5(i.encode()).hexdigest()[:8], 16) % 10 < 8 else "test"
        for i in ids
    }
    for parts in (1, 7):
        got = risk.with_split(df.repartition(parts))
        assert {r["assessment_id"]: r["split"] for r in rows(got)} == want
    train, test = risk.train_test(df)
    assert train.count() + test.count() == len(ids)
    assert train.join(test, "assessment_id").isEmpty()


def test_train_score_and_evaluate(spark):
    e = Entities(spark, "/root/testdata/sf0.001")
    features = risk.risk_features(e.assessments, e.systems, rollups.evidence_pairs(e.evidence))
    train, test = risk.train_test(features)
    model = risk.train(train, trees=5)
    assert 0.9 < risk.area_under_roc(model, test) <= 1.0
    scored = risk.score(model, features, AS_OF)
    assert scored.count() == e.assessments.count()
    limits = F.when(F.col("risk_score") >= 0.7, "High").when(
        F.col("risk_score") >= 0.4, "Medium"
    ).otherwise("Low")
    assert scored.where((F.col("risk_level") != limits) | ~F.col("risk_score").between(0, 1)).isEmpty()


def test_leaking_inputs_can_be_left_out(spark):
    e = Entities(spark, "/root/testdata/sf0.001")
    features = risk.risk_features(e.assessments, e.systems, rollups.evidence_pairs(e.evidence))
    honest = [f for f in risk.FEATURES if f not in ("historical_compliance", "days_to_remediation")]
    model = risk.train(features, inputs=honest, trees=5)
    assert model.stages[-1].numFeatures == len(honest)


def many_families(spark, number):
    return spark.range(400).select(
        F.col("id").cast("string").alias("assessment_id"),
        F.lit("c").alias("control_id"),
        F.lit("s").alias("system_id"),
        F.concat(F.lit("F'"), F.col("id") % number).alias("control_family_code"),
        *(
            (F.col("id") % (k + 2)).cast("int").alias(name)
            for k, name in enumerate(risk.FEATURES)
            if name != "family_index"
        ),
        (F.col("id") % 2).cast("double").alias(risk.LABEL),
    )


def test_families_beyond_the_commonest_share_categories(spark):
    df = many_families(spark, 60)
    model = risk.train(df, trees=2)
    assert model.stages[-1].getNumTrees == 2
    own, shared = risk.FAMILIES - 1, risk.GROUPS
    assert len(model.stages[1].labels) == own + shared
    index = {r[0]: r[1] for r in model.transform(df).select("control_family_code", "family_index").collect()}
    assert sorted(i for i in index.values() if i < own) == list(range(own))
    rest = [i for i in index.values() if i >= own]
    # No known family is an unseen one, and the rare ones do not all fall together.
    assert len(rest) == 60 - own and max(rest) < own + shared and len(set(rest)) > 10
    new = df.limit(1).withColumn("control_family_code", F.lit("zz"))
    assert own <= model.transform(new).head().family_index < own + shared


def test_as_many_families_as_categories_have_their_own(spark):
    model = risk.train(many_families(spark, risk.FAMILIES - 1), trees=2)
    assert len(model.stages[0].labels) == risk.FAMILIES - 1


def walked(nodes, x):
    """Mean vote of the trees for one row, node by node."""
    votes = []
    for tree in nodes.values():
        node = tree[0]
        while node["feature"] is not None:
            value = x[node["feature"]]
            if node["threshold"] is not None:
                left = value <= node["threshold"]
            else:
                left = value in node["categories"]
            node = tree[node["left"] if left else node["right"]]
        votes.append(node["share"])
    return sum(votes) / len(votes)


@pytest.mark.parametrize("families", [12, 60])
def test_trees_as_a_table_score_like_the_model(spark, families):
    df = many_families(spark, families).withColumn(
        risk.LABEL, (F.xxhash64("control_family_code", "evidence_count") % 2 == 0).cast("double")
    )
    model = risk.train(df, trees=7)
    table = forest.nodes(model)
    trees = {}
    for r in rows(table):
        trees.setdefault(r["tree"], {})[r["node"]] = r
    assert len(trees) == 7 and any(r["categories"] for r in rows(table))
    indexed = PipelineModel(model.stages[:-2]).transform(df)
    by_model = {r["assessment_id"]: r["risk_score"] for r in rows(risk.score(model, df, AS_OF))}
    by_joins = forest.scores(indexed, table, risk.FEATURES, ["assessment_id"])
    got = {r["assessment_id"]: r["risk_score"] for r in rows(by_joins)}
    plain = {
        r["assessment_id"]: walked(trees, [float(r[c]) for c in risk.FEATURES]) for r in rows(indexed)
    }
    assert got == pytest.approx(by_model) and plain == pytest.approx(by_model)


def test_reports_follow_the_walked_trees(spark):
    """Score, area, summary and list of the registered queries, recomputed."""
    e = Entities(spark, "/root/testdata/sf0.001")
    folder = e.sf_dir
    scored = rows(queries.QUERIES["risk_score"](spark, folder))
    by_joins = rows(queries.QUERIES["risk_score_by_trees"](spark, folder))
    assert sorted(r["risk_score"] for r in scored) == pytest.approx(
        sorted(r["risk_score"] for r in by_joins)
    )
    at_risk = {
        r["assessment_id"]: r["implementation_status"] in ("Not Implemented", "Partially Implemented")
        for r in rows(e.assessments)
    }
    test_ids = {r.assessment_id for r in risk.train_test(e.assessments)[1].collect()}
    pos = [r["risk_score"] for r in scored if r["assessment_id"] in test_ids and at_risk[r["assessment_id"]]]
    neg = [r["risk_score"] for r in scored if r["assessment_id"] in test_ids and not at_risk[r["assessment_id"]]]
    won = sum((p > n) + (p == n) / 2 for p in pos for n in neg) / len(pos) / len(neg)
    (auc,) = rows(queries.QUERIES["risk_auc"](spark, folder))
    assert auc == {"test_rows": len(pos) + len(neg), "area_under_roc": pytest.approx(won, abs=1e-6)}
    summary = rows(queries.QUERIES["report_risk_summary"](spark, folder))
    assert [r["risk_level"] for r in summary] == [
        x for x in ("High", "Medium", "Low") if any(r["risk_level"] == x for r in scored)
    ]
    for r in summary:
        own = [x["risk_score"] for x in scored if x["risk_level"] == r["risk_level"]]
        assert r["control_count"] == len(own)
        assert r["avg_risk_pct"] == pytest.approx(100 * sum(own) / len(own), abs=0.051)
    named = {r["system_id"]: r["system_name"] for r in rows(e.systems)}
    high = [r for r in scored if r["risk_level"] == "High" and r["system_id"] in named]
    high.sort(key=lambda r: (-r["risk_score"], r["control_id"], r["system_id"], r["assessment_id"]))
    listed = rows(queries.QUERIES["report_high_risk"](spark, folder))
    assert [(r["control_id"], r["system_id"], r["system_name"]) for r in listed] == [
        (r["control_id"], r["system_id"], named[r["system_id"]]) for r in high[:20]
    ]


def test_malformed_ids_leave_the_bins_alone(spark):
    df = spark.createDataFrame(
        [("1", "AC"), ("2", "AC"), ("3", "AU"), ("4", ""), ("5", "")],
        "assessment_id string, control_family_code string",
    )
    assert risk.family_labels(df) == ["AC", "AU"]


def test_training_rows_are_bounded(spark):
    df = spark.range(10_000).selectExpr("cast(id AS string) AS assessment_id")
    assert 700 < risk.bounded_sample(df, 1000).count() < 1300
    assert risk.bounded_sample(df, 10_000).count() == 10_000


def test_area_by_ranks_counts_ordered_pairs(spark):
    scored = [(0.1, 0.0), (0.4, 1.0), (0.4, 0.0), (0.8, 1.0), (0.2, 1.0), (0.2, 0.0), (0.9, 0.0)]
    frame = spark.createDataFrame(scored, f"risk_score double, {risk.LABEL} double")
    pos = [s for s, y in scored if y]
    neg = [s for s, y in scored if not y]
    want = sum((p > n) + (p == n) / 2 for p in pos for n in neg) / len(pos) / len(neg)
    assert risk.area_by_ranks(frame).head()[0] == pytest.approx(want)


def test_training_learns_from_every_row(spark, monkeypatch):
    """Equal rows become weights; no row is left out, however many there are."""
    df = spark.range(5000).select(
        (F.col("id") % 3).alias("x"), F.lit("AC").alias("control_family_code"),
        (F.col("id") % 7 == 0).cast("double").alias(risk.LABEL),
    )
    got = rows(risk.weighted(df, ["x"]))
    assert sum(r[risk.WEIGHT] for r in got) == pytest.approx(5000)
    assert len(got) == 6 * risk.EQUAL_ROWS
    plain = risk.train(df, inputs=["x"], trees=3)
    monkeypatch.setattr(risk, "PLAIN_ROWS", 100)
    model = risk.train(df, inputs=["x"], trees=3)
    for m in (plain, model):
        votes = m.transform(df.where("id = 0")).head().rawPrediction
        assert sum(votes) == pytest.approx(3)
    few = rows(risk.weighted(df.limit(20), ["x"]))
    assert len(few) == 20 and {r[risk.WEIGHT] for r in few} == {1.0}


def test_rows_between_the_same_thresholds_walk_as_one_cell(spark):
    x = [None, float("nan"), -5.0, 1.0, 1.5, 2.0, 9.0]
    df = spark.createDataFrame([(v_,) for v_ in x], "x double")
    cells = df.select(forest._cell(F.col("x"), [1.0, 2.0]).alias("c"))
    inf = float("inf")
    assert [r["c"] for r in rows(cells)] == [inf, inf, 1.0, 1.0, 2.0, 2.0, inf]
