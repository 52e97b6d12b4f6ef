"""Incremental run: landed files -> streamed bronze -> streamed silver -> gold.

Operational entities flow through file streams that process only what is new;
the small framework catalogues are read as a whole. Once the streams have
drained, a snapshot of silver and everything built on it is stored as tables.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

from veritrail.operators import gold, rollups
from veritrail.operators import silver as s
from veritrail.plans import medallion
from veritrail.sources import schemas
from veritrail.sources.audit import with_audit
from veritrail.sources.readers import read_csv, read_table
from veritrail.sources.sinks import write_table
from veritrail.streaming import ingest, live, refine

STREAMED = ("systems", "assessments", "evidence")
CATALOGUES = ("controls", "criteria", "control_mapping")
# Stored files are sorted by these keys, with which most other columns repeat.
NEAR = {
    "systems": ("system_id",),
    "assessments": ("control_id", "system_id"),
    "evidence": ("control_id", "system_id"),
}


def advance(
    spark: SparkSession,
    landing: Mapping[str, str],
    store: str,
    *,
    clean: bool = False,
    taken: Callable[[str], None] | None = None,
) -> dict[str, int]:
    """Process files that arrived since the last call. Returns new rows per entity.
    With ``clean`` the files taken in by calls before are deleted. ``taken`` is called
    with an entity once bronze has all its rows that had landed before the call."""

    def start(entity: str) -> ingest.Run:
        place, options = (spark, landing[entity], store, entity), {"clean": clean, "near": NEAR[entity]}
        if entity == "evidence":
            return ingest.start_json(*place, schemas.EVIDENCE_SCHEMA, **options)
        return ingest.start_evolving_csv(*place, **options)

    # The entities are independent: their streams run side by side.
    landed, refined = {entity: start(entity) for entity in STREAMED}, []
    for entity, run in landed.items():
        run.wait()
        if taken:
            taken(entity)
        refined.append(refine.start_refine(spark, store, entity, near=NEAR[entity]))
    for run in refined:
        run.wait()
    return {entity: ingest.rows_read(run) for entity, run in landed.items()}


def catalogues(spark: SparkSession, landing: Mapping[str, str]) -> dict[str, DataFrame]:
    raw = {
        name: with_audit(read_csv(spark, landing[name], infer=False), file=True)
        for name in CATALOGUES
        if name in landing
    }
    clean = {"controls": s.silver_controls, "criteria": s.silver_criteria}
    return {name: clean[name](df) if name in clean else df for name, df in raw.items()}


def publish(
    spark: SparkSession,
    landing: Mapping[str, str],
    store: str,
    as_of: dt.date,
    layers: medallion.Layers,
) -> dict[str, dict]:
    """Store the current snapshot as tables: cleaned entities and catalogues
    with their expectations, the business tables, alerts and risk on top.
    Returns what each write observed, keyed ``layer.table``.

    The gap table holds the expected pairs that have evidence; the missing ones
    are counted per system and per control.
    """
    layers.create(spark)
    frames = catalogues(spark, landing)
    mapping = write_table(
        frames.pop("control_mapping"),
        f"{layers.bronze}.control_mapping",
        path=layers.path(layers.bronze, "control_mapping"),
        comment=medallion.COMMENTS["control_mapping"],
        properties={"quality": "bronze"},
    )
    frames |= {entity: refine.silver_table(spark, store, entity, as_of) for entity in STREAMED}
    steps = (
        ("bronze", {"control_mapping": mapping}),
        ("silver", medallion.store_silver(frames, layers)),
        ("gold", medallion.build_gold(spark, layers, as_of, expected=True)),
        ("alerts", medallion.build_alerts(spark, layers, as_of)),
        ("risk", medallion.build_risk(spark, layers, as_of)),
    )
    return {f"{step}.{table}": seen for step, tables in steps for table, seen in tables.items()}


def refresh(
    spark: SparkSession,
    landing: Mapping[str, str],
    store: str,
    as_of: dt.date,
    layers: medallion.Layers,
) -> dict[str, dict]:
    """Bring the business tables up to date from the silver rows that are new.

    The rollups' states take in the new rows; every table then follows from the
    states, the inventory of systems and the catalogues. Nothing reads the
    assessments or the evidence as a whole. Returns what each write observed.
    """
    layers.create(spark)
    live.update(spark, store)
    now = live.LiveRollups(spark, store, as_of)
    frames = catalogues(spark, landing)
    mapping = frames.pop("control_mapping")
    frames["systems"] = refine.silver_table(spark, store, "systems", as_of)
    written = {f"silver.{n}": seen for n, seen in medallion.store_silver(frames, layers).items()}
    controls, criteria, systems = (
        read_table(spark, f"{layers.silver}.{n}") for n in ("controls", "criteria", "systems")
    )

    def put(name: str, df: DataFrame) -> DataFrame:
        written[f"gold.{name}"] = medallion.write_gold(df, layers, name)
        return read_table(spark, f"{layers.gold}.{name}")

    pairs = put("evidence_pairs", now.evidence_pairs().sortWithinPartitions("control_id", "system_id"))
    rollup = rollups.evidence_rollup(pairs)
    by_system = rollups.system_evidence_from_pairs(pairs)
    put("control_compliance_summary", gold.family_summary(now.family_rollup(), as_of))
    put(
        "system_compliance_scorecard",
        gold.system_scorecard(systems, now.system_assessment_rollup(), by_system, as_of),
    )
    crosswalk = gold.cross_framework(controls, mapping, criteria, now.control_rollup(), as_of)
    put("cross_framework_mapping", crosswalk)
    put("missing_evidence_by_system", gold.missing_by_system(controls, systems, rollup))
    put("missing_evidence_by_control", gold.missing_by_control(controls, systems, rollup))
    put("evidence_gap_analysis", gold.evidence_gap_matrix(controls, systems, rollup, as_of))
    totals = (now.assessment_totals(), now.evidence_totals(), rollups.scope_totals(systems))
    put("audit_readiness_metrics", gold.readiness(*totals, as_of))
    return written
