"""Risk model: features, stable split, random forest, scoring."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import SQLTransformer, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from veritrail import vocabulary as v
from veritrail.functions import grading as g

# Model inputs in order, label and forest settings.
FEATURES = (
    "historical_compliance",
    "days_to_remediation",
    "evidence_count",
    "gap_severity_score",
    "criticality_score",
    "family_index",
)
LABEL = "is_at_risk"
TREES = 50
DEPTH = 5
SEED = 42
BINS = 32
# The forest needs a bin per family and one for unseen ones. Up to this many
# families each have their own. Of more, the rarer ones share GROUPS categories,
# chosen by a hash of the family, and the forest has that many bins more: no
# family counts as unseen, and the bins still do not follow the data.
FAMILIES = BINS - 1
GROUPS = 32
SCORE_BANDS = 1000
# The forest learns from every labelled row. Of more than PLAIN_ROWS, equal rows are
# learned as weights: up to EQUAL_ROWS of them stay rows of their own, so that each
# tree draws among them; more share their number over this many.
PLAIN_ROWS = 2_000_000
EQUAL_ROWS = 16
WEIGHT = "_weight"
TRAIN_BUCKETS = 8
BUCKETS = 10

KEY_COLUMNS = ("assessment_id", "control_id", "system_id", "control_family_code")


def _pair_severity(pairs: DataFrame) -> DataFrame:
    return pairs.select(
        "control_id",
        "system_id",
        "accepted_evidence_count",
        g.gap_severity(F.col("current_evidence_count"), F.col("days_until_expiry")).alias(
            "gap_severity"
        ),
    )


def _feature_columns(joined: DataFrame) -> DataFrame:
    at_risk = F.col("implementation_status").isin(*v.GAP_STATUSES)
    return joined.select(
        *KEY_COLUMNS,
        F.col("compliance_score").alias("historical_compliance"),
        "days_to_remediation",
        g.zero_if_null(F.col("accepted_evidence_count")).alias("evidence_count"),
        g.lookup(F.col("gap_severity"), v.GAP_SEVERITY_SCORES, 0).alias("gap_severity_score"),
        g.lookup(
            F.col("criticality"), v.CRITICALITY_SCORES, v.CRITICALITY_SCORE_OTHERWISE
        ).alias("criticality_score"),
        F.when(at_risk, 1.0).otherwise(0.0).alias(LABEL),
    ).na.fill(0)


def risk_features(assessments: DataFrame, systems: DataFrame, pairs: DataFrame) -> DataFrame:
    """Training rows, one per assessment.

    Evidence count and gap severity share one pair rollup, hence one join. Give
    ``pairs`` as a stored table: then both sides come straight from a shuffle and
    Spark splits the rows of a hot pair by their size. A pair without any evidence is not in the observed gap table and scores 0.
    """
    joined = assessments.join(_pair_severity(pairs), ["control_id", "system_id"], "left")
    attributes = systems.select("system_id", "criticality")
    return _feature_columns(joined.join(attributes, "system_id", "left"))


def risk_features_matrix(
    assessments: DataFrame, systems: DataFrame, controls: DataFrame, pairs: DataFrame
) -> DataFrame:
    """Training rows whose severity comes from the expected matrix.

    The matrix itself is not built: whether a pair belongs to it follows from
    the control's baseline and the system's scope. Expected pairs without
    evidence score as Critical, pairs outside the matrix as 0.
    """
    scope = systems.select(
        "system_id",
        "criticality",
        (F.col("in_soc2_scope") | F.col("in_iso_scope")).alias("_in_scope"),
    )
    baseline = controls.select(
        "control_id", F.col(f"baseline_{v.EXPECTED_EVIDENCE_BASELINE}").alias("_required")
    )
    joined = assessments.join(_pair_severity(pairs), ["control_id", "system_id"], "left")
    placed = joined.join(scope, "system_id", "left").join(baseline, "control_id", "left")
    expected = F.col("_in_scope") & F.col("_required")
    severity = F.when(expected, F.coalesce("gap_severity", F.lit("Critical")))
    return _feature_columns(placed.withColumn("gap_severity", severity))


def split_bucket(row_id: str):
    """0-9 from the row id alone, so it does not depend on partitioning."""
    digest = F.conv(F.substring(F.md5(F.col(row_id)), 1, 8), 16, 10).cast("bigint")
    return (digest % BUCKETS).cast("int")


def with_split(features: DataFrame) -> DataFrame:
    bucket = split_bucket("assessment_id")
    return features.withColumn(
        "split", F.when(bucket < TRAIN_BUCKETS, "train").otherwise("test")
    )


def train_test(features: DataFrame) -> tuple[DataFrame, DataFrame]:
    marked = with_split(features)
    return tuple(marked.where(F.col("split") == part).drop("split") for part in ("train", "test"))


def bounded_sample(features: DataFrame, max_rows: int) -> DataFrame:
    """About ``max_rows`` rows at most, the same under any layout."""
    rows = features.count()
    if rows <= max_rows:
        return features
    spread = F.pmod(F.xxhash64("assessment_id"), F.lit(1_000_000))
    return features.where(spread < int(1_000_000 * max_rows / rows))


def weighted(features: DataFrame, inputs: Sequence[str]) -> DataFrame:
    """The rows by what is learned of them, with a weight: as many equal rows as
    there are, but at most EQUAL_ROWS, which then weigh as much as all."""
    counted = features.groupBy(*inputs, "control_family_code", LABEL).agg(
        F.count(F.lit(1)).alias("_rows")
    )
    kept = F.least(F.col("_rows"), F.lit(EQUAL_ROWS))
    return (
        counted.withColumn(WEIGHT, F.col("_rows") / kept)
        .withColumn("_copy", F.explode(F.sequence(F.lit(1), kept.cast("int"))))
        .drop("_rows", "_copy")
    )


def family_labels(features: DataFrame) -> list[str]:
    """The commonest well-formed families, commonest first, one more than have
    a category of their own. An id that does not follow the control-id pattern
    has the family '' and adds no category."""
    family = F.col("control_family_code")
    counted = features.where(family != "").groupBy("control_family_code").count()
    first = counted.orderBy(F.desc("count"), "control_family_code").limit(FAMILIES)
    return [r[0] for r in first.collect()] or [""]


def family_stages(labels: Sequence[str]) -> tuple[list[Transformer], int]:
    """Stages that give every family its index, and the bins they need."""
    if len(labels) < FAMILIES:
        return [_index("control_family_code", labels)], BINS
    own = labels[: FAMILIES - 1]
    quoted = ", ".join("'" + x.replace("\\", "\\\\").replace("'", "\\'") + "'" for x in own)
    group = f"concat('#', pmod(xxhash64(control_family_code), {GROUPS}))"
    grouped = SQLTransformer(
        statement="SELECT *, CASE WHEN control_family_code = '' OR control_family_code IN "
        f"({quoted}) THEN control_family_code ELSE {group} END AS family_group FROM __THIS__"
    )
    shared = [f"#{i}" for i in range(GROUPS)]
    return [grouped, _index("family_group", [*own, *shared])], BINS + GROUPS


def _index(column: str, labels: Sequence[str]) -> StringIndexerModel:
    return StringIndexerModel.from_labels(
        list(labels), inputCol=column, outputCol="family_index", handleInvalid="keep"
    )


def train(
    features: DataFrame,
    *,
    inputs: Sequence[str] = FEATURES,
    trees: int = TREES,
    depth: int = DEPTH,
    seed: int = SEED,
    max_rows: int | None = None,
) -> PipelineModel:
    """Fit the forest. Pass ``inputs`` without ``historical_compliance`` and
    ``days_to_remediation`` to leave out the columns that leak the label.

    The fitted model is copied because its training summary refers to the
    session and the training frame; a copy carries only the trees, which is
    all that tasks need when the model is shipped to them. All rows are learned
    from unless ``max_rows`` asks for a sample.
    """
    if max_rows is not None:
        features = bounded_sample(features, max_rows)
    families, bins = family_stages(family_labels(features))
    forest = RandomForestClassifier(
        labelCol=LABEL,
        featuresCol="features",
        weightCol=WEIGHT,
        numTrees=trees,
        maxDepth=depth,
        seed=seed,
        maxBins=bins,
    )
    assembler = VectorAssembler(inputCols=list(inputs), outputCol="features")
    if features.count() > PLAIN_ROWS:
        learned = weighted(features, [c for c in inputs if c in features.columns])
    else:
        learned = features.withColumn(WEIGHT, F.lit(1.0))
    return Pipeline(stages=[*families, assembler, forest]).fit(learned).copy()


def area_under_roc(model: PipelineModel, test: DataFrame) -> float:
    return BinaryClassificationEvaluator(labelCol=LABEL, metricName="areaUnderROC").evaluate(
        model.transform(test)
    )


def area_by_ranks(scored: DataFrame) -> DataFrame:
    """One row with ``area_under_roc``: the share of (at risk, not at risk)
    pairs that the score puts in order, a tie counting one half.

    Rows of equal score are counted together first. Running totals are taken
    within bands of the score and over the bands, so no task sees all scores."""
    by_score = (
        scored.groupBy("risk_score")
        .agg(
            F.count_if(F.col(LABEL) == 1).alias("pos"),
            F.count_if(F.col(LABEL) == 0).alias("neg"),
        )
        .withColumn("band", F.floor(F.col("risk_score") * SCORE_BANDS))
    )
    before = Window.orderBy("band").rowsBetween(Window.unboundedPreceding, -1)
    bands = by_score.groupBy("band").agg(F.sum("neg").alias("neg")).select(
        "band", F.coalesce(F.sum("neg").over(before), F.lit(0)).alias("lower")
    )
    below = (
        Window.partitionBy("band").orderBy("risk_score").rowsBetween(Window.unboundedPreceding, -1)
    )
    ranked = by_score.join(bands, "band").withColumn(
        "neg_below", F.col("lower") + F.coalesce(F.sum("neg").over(below), F.lit(0))
    )
    won = F.sum(F.col("pos") * (F.col("neg_below") + F.col("neg") / 2))
    return ranked.agg(
        F.try_divide(won, F.sum("pos") * F.sum("neg").cast("double")).alias("area_under_roc")
    )


def score(model: PipelineModel, features: DataFrame, as_of: dt.date) -> DataFrame:
    """Risk of every assessment, training rows included."""
    probability = vector_to_array("probability")[1]
    scored = model.transform(features.drop(LABEL)).select(
        *KEY_COLUMNS,
        probability.alias("risk_score"),
        F.col("prediction").alias("predicted_at_risk"),
    )
    return scored.withColumns(
        {"risk_level": g.risk_grade(F.col("risk_score")), "prediction_date": F.lit(as_of)}
    )
