"""Business rollups kept up to date from new rows only.

Each rollup has a state: partial aggregates per key that merge by sums and
maxima. What ages (overdue, current, expired) depends on a row's dates, so these
dates are part of the keys and any day's figures come from the state alone.
Distinct counts are exact: the key sets themselves are kept.

A micro-batch of silver rows is reduced to a part per state, written to a folder
named after the batch. A commit record then lists the parts that count; it is
the only thing that readers follow. A batch that died is written over by its
repetition, one that was committed is skipped, so a replay changes nothing. When
parts have become many they are merged into one, which the next commit lists
instead. State and checkpoint of an entity belong together: remove both or none.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from veritrail import vocabulary as v
from veritrail.operators import rollups
from veritrail.sources.schemas import ENTITY_COLUMNS, text_schema
from veritrail.streaming import ingest, refine
from veritrail.streaming.manifest import PACKED

#: Parts that a state may consist of before they are merged.
MOST_PARTS = 8
COMMIT = "batch long, rows long, parts array<string>"


@dataclass(frozen=True)
class State:
    """Partial aggregates of silver rows per key; ``sums`` and ``maxima`` say
    how a column is computed from rows, its name how it is found again."""

    keys: Mapping[str, Column]
    sums: Mapping[str, Column]
    maxima: Mapping[str, Column]

    def partial(self, rows: DataFrame) -> DataFrame:
        return rows.groupBy(*(c.alias(k) for k, c in self.keys.items())).agg(
            *(F.sum(c).alias(n) for n, c in self.sums.items()),
            *(F.max(c).alias(n) for n, c in self.maxima.items()),
        )

    def merged(self, parts: DataFrame) -> DataFrame:
        return parts.groupBy(*self.keys).agg(
            *(F.sum(n).alias(n) for n in self.sums),
            *(F.max(n).alias(n) for n in self.maxima),
        )


def _is(column: str, value: str) -> Column:
    return F.coalesce(F.col(column) == value, F.lit(False)).cast("long")


def _counters() -> dict[str, Column]:
    one = F.lit(1).cast("long")
    statuses = {n: _is("implementation_status", s) for n, s in rollups.STATUS_COUNTS.items()}
    score = F.col("compliance_score").cast("long")
    return {"n": one, **statuses, "score": score, "scored": score.isNotNull().cast("long")}


def _states(entity: str) -> dict[str, State]:
    one = {"n": F.lit(1).cast("long")}
    if entity == "assessments":
        is_open = ~F.col("implementation_status").isin(v.IMPLEMENTED, v.NOT_APPLICABLE)
        due = {"open_due": F.when(is_open, F.col("remediation_due_date"))}
        family, system = F.col("control_family_code"), F.col("system_id")
        assessed = {"last_assessment_date": F.col("assessment_date")}
        pair = {"control_id": F.col("control_id"), "system_id": system}
        return {
            "by_family": State({"control_family_code": family, **due}, _counters(), {}),
            "by_system": State({"system_id": system, **due}, _counters(), assessed),
            "by_pair": State(pair, _counters(), {}),
        }
    period = {c: F.col(f"assessment_period_{c}") for c in ("start", "end")}
    return {
        "by_period": State(
            {
                "control_id": F.col("control_id"),
                "system_id": F.col("system_id"),
                **period,
                "accepted": _is("status", v.ACCEPTED) == 1,
            },
            one,
            {"last_evidence_date": F.col("upload_timestamp")},
        ),
        "by_status": State({"status": F.col("status"), "end": period["end"]}, one, {}),
    }


ENTITIES = ("assessments", "evidence")


class LiveState:
    """The states of one entity below ``store``."""

    def __init__(self, spark: SparkSession, store: str, entity: str):
        self.spark, self.entity = spark, entity
        self.root = f"{store}/live/{entity}"
        self.states = _states(entity)

    def commits(self) -> DataFrame:
        try:
            return self.spark.read.schema(COMMIT).json(f"{self.root}/commits/*")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], COMMIT)

    def prepare(self) -> None:
        """An empty list of commits, where there is none yet."""
        first = f"{self.root}/commits/none"
        self.spark.createDataFrame([], COMMIT).write.mode("ignore").json(first)

    def _last(self):
        return self.commits().orderBy(F.desc("batch")).head()

    def apply(self, rows: DataFrame, batch: int) -> bool:
        """Take the rows of a micro-batch into account; False if they already are."""
        last = self._last()
        if last is not None and batch <= last.batch:
            return False
        parts = list(last.parts) if last is not None else []
        # Each state reads its own columns of the stored rows; a copy of whole
        # rows for all states would lie on the executors' disks.
        for name, state in self.states.items():
            self._store(state.partial(rows), name, f"batch-{batch}")
        parts.append(f"batch-{batch}")
        if len(parts) > MOST_PARTS:
            for name, state in self.states.items():
                self._store(state.merged(self._parts(name, parts)), name, f"merged-{batch}")
            parts = [f"merged-{batch}"]
        first = next(iter(self.states))
        taken = self._parts(first, [f"batch-{batch}"]).agg(F.coalesce(F.sum("n"), F.lit(0))).head()[0]
        record = self.spark.createDataFrame([(batch, taken, parts)], COMMIT)
        record.coalesce(1).write.mode("overwrite").json(f"{self.root}/commits/batch-{batch}")
        return True

    def _store(self, part: DataFrame, name: str, folder: str) -> None:
        placed = part.sortWithinPartitions(*self.states[name].keys)
        placed.write.mode("overwrite").options(**PACKED).parquet(f"{self.root}/{name}/{folder}")

    def _parts(self, name: str, parts: list[str]) -> DataFrame:
        return self.spark.read.parquet(*(f"{self.root}/{name}/{p}" for p in parts))

    def parts(self, name: str) -> DataFrame:
        """The rows of the state ``name`` as of the last commit, a key once per part
        that has it. Sums and maxima over fewer keys are the merged state's."""
        state, last = self.states[name], self._last()
        if last is None:
            raw = self.spark.createDataFrame([], text_schema(ENTITY_COLUMNS[self.entity]))
            return state.partial(refine.CLEANERS[self.entity](raw))
        return self._parts(name, last.parts)

    def read(self, name: str) -> DataFrame:
        """The merged state ``name`` as of the last commit."""
        last, parts = self._last(), self.parts(name)
        return parts if last is None or len(last.parts) == 1 else self.states[name].merged(parts)


def start_update(
    spark: SparkSession, store: str, entity: str, *, files_per_batch: int = ingest.FILES_PER_BATCH
) -> StreamingQuery:
    """Start taking all silver rows that are new into the entity's states."""
    live = LiveState(spark, store, entity)
    live.prepare()
    rows = ingest.table_stream(spark, f"{store}/silver/{entity}", files_per_batch=files_per_batch)
    return (
        rows.writeStream.foreachBatch(lambda batch, number: live.apply(batch, number) and None)
        .option("checkpointLocation", f"{live.root}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )


def update(spark: SparkSession, store: str) -> None:
    """All entities, side by side, until nothing is new."""
    for query in [start_update(spark, store, entity) for entity in ENTITIES]:
        query.awaitTermination()


class LiveRollups:
    """The rollups of the business tables on a day, from the states alone. Where
    parts merge by the same sums and maxima, they are not merged by key before."""

    def __init__(self, spark: SparkSession, store: str, as_of: dt.date):
        self.assessments = LiveState(spark, store, "assessments")
        self.evidence = LiveState(spark, store, "evidence")
        self.today = F.lit(as_of)

    def _overdue(self) -> Column:
        late = F.when(F.col("open_due") < self.today, F.col("n"))
        return F.coalesce(F.sum(late), F.lit(0))

    @staticmethod
    def _average() -> Column:
        return F.try_divide(F.sum("score").cast("double"), F.sum("scored"))

    def _summed(self, state: str, key: str, total: str, counts, overdue: str, *more: Column):
        return self.assessments.parts(state).groupBy(key).agg(
            F.sum("n").alias(total),
            *(F.sum(c).alias(c) for c in counts),
            self._overdue().alias(overdue),
            self._average().alias("avg_compliance_score"),
            *more,
        )

    def family_rollup(self) -> DataFrame:
        return self._summed(
            "by_family", "control_family_code", "total_assessments", rollups.STATUS_COUNTS,
            "overdue_count",
        )

    def system_assessment_rollup(self) -> DataFrame:
        return self._summed(
            "by_system", "system_id", "total_controls_assessed",
            ("implemented_count", "partial_count", "not_implemented_count"),
            "overdue_remediation_count", F.max("last_assessment_date").alias("last_assessment_date"),
        )

    def control_rollup(self) -> DataFrame:
        # Pairs are counted, so each has to be there once.
        return self.assessments.read("by_pair").groupBy("control_id").agg(
            self._average().alias("avg_compliance_pct"),
            F.count("system_id").alias("systems_assessed"),
            F.sum("n").alias("total_assessments"),
        )

    def _current(self) -> Column:
        return F.coalesce(self.today.between(F.col("start"), F.col("end")), F.lit(False))

    def evidence_pairs(self) -> DataFrame:
        current, n = self._current(), F.col("n")

        def total(condition: Column) -> Column:
            return F.coalesce(F.sum(F.when(condition, n)), F.lit(0))

        return self.evidence.parts("by_period").groupBy("control_id", "system_id").agg(
            F.sum("n").alias("total_evidence_count"),
            total(F.col("accepted") & current).alias("current_evidence_count"),
            F.max(F.when(current, F.datediff("end", self.today))).alias("days_until_expiry"),
            F.max("last_evidence_date").alias("last_evidence_date"),
            total(F.col("accepted")).alias("accepted_evidence_count"),
        )

    def assessment_totals(self) -> DataFrame:
        """One row. Distinct ids are the keys of the pair state, counted after
        a grouping each, so no row is copied per distinct count."""

        def distinct(key: str) -> Column:
            keys = self.assessments.parts("by_pair").groupBy(key).agg(F.lit(1).alias("one"))
            return keys.agg(F.count(key)).scalar()

        totals = self.assessments.parts("by_family").agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("total_assessments"),
            self._average().alias("overall_compliance_pct"),
            F.sum("implemented_count").alias("implemented_count"),
            F.sum("partial_count").alias("partial_count"),
            F.sum("not_implemented_count").alias("gap_count"),
            F.sum(F.when(F.col("open_due") < self.today, F.col("n")).otherwise(0)).alias(
                "overdue_remediation_count"
            ),
        )
        return totals.withColumns(
            {
                "unique_controls_assessed": distinct("control_id"),
                "systems_assessed": distinct("system_id"),
            }
        )

    def evidence_totals(self) -> DataFrame:
        n, status = F.col("n"), F.col("status")
        controls = self.evidence.parts("by_period").where(self._current()).groupBy("control_id")
        held = controls.agg(F.lit(1).alias("one")).agg(F.count("control_id")).scalar()
        return (
            self.evidence.parts("by_status")
            .agg(
                F.coalesce(F.sum("n"), F.lit(0)).alias("total_evidence_items"),
                F.sum(F.when(status == v.ACCEPTED, n).otherwise(0)).alias("accepted_evidence"),
                F.sum(F.when(status == v.PENDING_REVIEW, n).otherwise(0)).alias("pending_review"),
                F.sum(F.when(F.col("end") < self.today, n).otherwise(0)).alias("expired_evidence"),
            )
            .withColumn("controls_with_current_evidence", held)
        )
