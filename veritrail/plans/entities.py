"""The six compliance entities as views over the star-schema tables.

``bronze_*`` gives raw rows as they would be landed: ids padded and in lower
case, vocabulary words in the wrong case, dates as text. The silver functions
then have real cleaning to do.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veritrail import vocabulary as v
from veritrail.functions.grading import at_least, first_match, lookup
from veritrail.operators import silver as s
from veritrail.sources import schemas

AS_OF = dt.date(2001, 6, 30)

# Fixed values of the view definitions.
CRITERION_CODES = ("CC", "A", "C", "PI", "P")
BASELINE_SIZES = {"low": 5, "moderate": 10, "high": 25}
CRITICALITY_BALANCES = ((8000, "Critical"), (5000, "High"), (2000, "Medium"))
RAW_SCOPES = ("SOC2", "ISO27001", "Both", "None")
STATUS_QUANTITIES = (
    (32, v.IMPLEMENTED),
    (42, v.PARTIALLY_IMPLEMENTED),
    (47, v.NOT_IMPLEMENTED),
)
EFFECTIVENESS = {
    v.IMPLEMENTED: "Effective",
    v.PARTIALLY_IMPLEMENTED: "Partially Effective",
    v.NOT_IMPLEMENTED: "Not Effective",
}
ASSESSMENT_TYPES = {"A": "Internal Audit", "N": "Self-Assessment"}
ASSESSMENT_TYPE_OTHERWISE = "External Audit"
EVIDENCE_TYPES = (
    "Screenshot",
    "Configuration Export",
    "Policy Document",
    "Audit Log",
    "Access Review Report",
    "Vulnerability Scan",
    "Penetration Test Report",
)


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _messy(c: Column) -> Column:
    return F.concat(F.lit("  "), F.lower(c))


def _day(c: Column) -> Column:
    return F.date_format(c, v.DATE_FORMAT)


def _at(values, index: Column) -> Column:
    return F.get(F.array(*(F.lit(x) for x in values)), index.cast("int"))


def _control_id(partkey: str) -> Column:
    return F.concat_ws("-", F.upper(F.substring("p_type", 1, 2)), F.col(partkey).cast("string"))


def _system_name(suppkey: str) -> Column:
    return F.concat(F.lit("Supplier#"), F.lpad(F.col(suppkey).cast("string"), 9, "0"))


def _line_id() -> Column:
    return F.concat_ws(
        "-",
        *(
            F.col(c).cast("string")
            for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
        ),
    )


def _null_text() -> Column:
    return F.lit(None).cast("string")


def _in_order(df: DataFrame, entity: str) -> DataFrame:
    return df.select(*schemas.ENTITY_COLUMNS[entity])


def bronze_controls(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = _read(spark, sf_dir, "part")
    baselines = {
        f"baseline_{b}": F.upper((F.col("p_size") <= size).cast("string"))
        for b, size in BASELINE_SIZES.items()
    }
    return _in_order(
        part.select(
            _messy(_control_id("p_partkey")).alias("control_id"),
            F.col("p_type").alias("control_family"),
            F.col("p_name").alias("control_name"),
            F.concat_ws(" ", "p_name", "p_brand").alias("control_description"),
            *(c.alias(name) for name, c in baselines.items()),
        ),
        "controls",
    )


def _criterion_id() -> Column:
    return F.concat(_at(CRITERION_CODES, F.col("n_regionkey")), F.col("n_nationkey"))


def _nations(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = _read(spark, sf_dir, "nation")
    region = _read(spark, sf_dir, "region")
    return nation.join(region, nation["n_regionkey"] == region["r_regionkey"])


def bronze_criteria(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _nations(spark, sf_dir).select(
        _messy(_criterion_id()).alias("tsc_id"),
        F.col("r_name").alias("tsc_category"),
        F.col("n_name").alias("tsc_name"),
        F.concat_ws(" ", "r_name", "n_name").alias("tsc_description"),
        F.col("n_name").alias("points_of_focus"),
    )


def bronze_control_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("p_partkey")
    links = F.array_compact(
        F.array(
            F.when(
                key % 2 == 0,
                F.struct((key % 25).alias("target"), F.lit("equivalent").alias("mapping_type")),
            ),
            F.when(
                key % 16 == 0,
                F.struct(((key + 7) % 25).alias("target"), F.lit("related").alias("mapping_type")),
            ),
        )
    )
    mapped = _read(spark, sf_dir, "part").select(
        "p_partkey", _control_id("p_partkey").alias("source_control_id"), F.inline(links)
    )
    targets = _nations(spark, sf_dir).select(
        F.col("n_nationkey").cast("long").alias("target"),
        _criterion_id().alias("target_control_id"),
    )
    return _in_order(
        mapped.join(targets, "target").select(
            F.concat_ws("-", F.lit("MAP"), key.cast("string"), "mapping_type").alias("mapping_id"),
            F.lit("CATALOGUE").alias("source_framework"),
            "source_control_id",
            F.lit("CRITERIA").alias("target_framework"),
            "target_control_id",
            "mapping_type",
            _null_text().alias("mapping_notes"),
        ),
        "control_mapping",
    )


def bronze_systems(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier = _read(spark, sf_dir, "supplier")
    nation = _read(spark, sf_dir, "nation")
    key = F.col("s_suppkey")
    age = (1 + (key * 37) % 540).cast("int")
    last = F.date_sub(F.lit(AS_OF), age)
    criticality = at_least(F.col("s_acctbal"), CRITICALITY_BALANCES, "Low")
    joined = supplier.join(nation, supplier["s_nationkey"] == nation["n_nationkey"])
    return _in_order(
        joined.select(
            key.cast("string").alias("system_id"),
            _system_name("s_suppkey").alias("system_name"),
            F.concat(F.lit("owner-"), F.col("s_nationkey")).alias("system_owner"),
            F.concat(F.lit("owner-"), F.col("s_nationkey"), F.lit("@example.com")).alias(
                "owner_email"
            ),
            F.col("n_name").alias("business_unit"),
            _messy(_at(v.CLASSIFICATIONS, F.col("n_regionkey") % 4)).alias("data_classification"),
            F.lit("Production").alias("environment"),
            F.lit("Cloud").alias("hosting_type"),
            _messy(criticality).alias("criticality"),
            _messy(_at(RAW_SCOPES, key % 4)).alias("certification_scope"),
            _day(last).alias("last_assessment_date"),
            _day(F.date_sub(last, 1000)).alias("created_date"),
            F.concat_ws(" ", _system_name("s_suppkey"), "n_name").alias("description"),
        ),
        "systems",
    )


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = _read(spark, sf_dir, "lineitem")
    part = _read(spark, sf_dir, "part").select("p_partkey", "p_type")
    return lineitem.join(part, lineitem["l_partkey"] == part["p_partkey"])


def bronze_assessments(spark: SparkSession, sf_dir: str) -> DataFrame:
    level = F.col("l_quantity") + ((F.col("l_suppkey") % 5) - 2) * 10
    status = first_match(
        ((level <= top, name) for top, name in STATUS_QUANTITIES), v.NOT_APPLICABLE
    )
    day = F.to_date("l_shipdate")
    control = _control_id("l_partkey")
    gap = status.isin(*v.GAP_STATUSES)
    due = F.date_add(day, (30 + F.col("l_partkey") % 151).cast("int"))
    return _in_order(
        _lines(spark, sf_dir).select(
            _line_id().alias("assessment_id"),
            _messy(control).alias("control_id"),
            F.col("p_type").alias("control_family"),
            F.col("l_suppkey").cast("string").alias("system_id"),
            _system_name("l_suppkey").alias("system_name"),
            _day(day).alias("assessment_date"),
            lookup(F.col("l_returnflag"), ASSESSMENT_TYPES, ASSESSMENT_TYPE_OTHERWISE).alias(
                "assessment_type"
            ),
            F.concat(F.lit("assessor-"), F.col("l_linenumber")).alias("assessor"),
            _messy(status).alias("implementation_status"),
            lookup(status, EFFECTIVENESS, _null_text()).alias("effectiveness_rating"),
            F.when(gap, F.concat(F.lit("Gap in "), control)).alias("gap_description"),
            F.when(gap, F.concat(F.lit("Close gap in "), control)).alias("remediation_plan"),
            F.when(gap, _day(due)).alias("remediation_due_date"),
            F.when(gap, F.concat(F.lit("owner-"), F.col("l_linenumber"))).alias(
                "remediation_owner"
            ),
            F.concat_ws(" ", F.lit("Assessment of"), control).alias("findings"),
        ),
        "assessments",
    )


def bronze_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _read(spark, sf_dir, "orders")
    lines = _lines(spark, sf_dir)
    joined = lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"])
    priority = F.col("o_orderpriority")
    status = first_match(
        (
            (priority == "1-URGENT", v.PENDING_REVIEW),
            (priority != "5-LOW", v.ACCEPTED),
            (F.col("o_orderstatus") == "F", v.EXPIRED),
        ),
        v.REJECTED,
    )
    control = _control_id("l_partkey")
    kind = _at(EVIDENCE_TYPES, F.col("l_linenumber") - 1)
    day = F.to_date("o_orderdate")
    iso = "yyyy-MM-dd'T'HH:mm:ss"
    reviewed = status != v.PENDING_REVIEW
    review_day = F.date_add(day, F.col("l_linenumber"))
    return _in_order(
        joined.select(
            _line_id().alias("evidence_id"),
            _messy(control).alias("control_id"),
            F.col("l_suppkey").cast("string").alias("system_id"),
            _system_name("l_suppkey").alias("system_name"),
            kind.alias("evidence_type"),
            F.concat_ws(" ", kind, control).alias("evidence_description"),
            F.concat(F.lit("/evidence/"), _line_id()).alias("evidence_path"),
            F.concat(F.lit("uploader-"), F.col("l_linenumber")).alias("uploaded_by"),
            F.date_format("o_orderdate", iso).alias("upload_timestamp"),
            _day(day).alias("assessment_period_start"),
            _day(F.date_add(day, 365)).alias("assessment_period_end"),
            status.alias("status"),
            F.when(reviewed, F.concat(F.lit("reviewer-"), F.col("l_linenumber"))).alias("reviewer"),
            F.when(reviewed, F.date_format(review_day, iso)).alias("review_timestamp"),
            F.when(reviewed, status).alias("review_notes"),
        ),
        "evidence",
    )


BRONZE = {
    "controls": bronze_controls,
    "criteria": bronze_criteria,
    "control_mapping": bronze_control_mapping,
    "systems": bronze_systems,
    "assessments": bronze_assessments,
    "evidence": bronze_evidence,
}


def silver_tables(bronze: dict[str, DataFrame], as_of: dt.date) -> dict[str, DataFrame]:
    """The cleaned tables; the mapping is used as it was landed."""
    return {
        "controls": s.silver_controls(bronze["controls"]),
        "criteria": s.silver_criteria(bronze["criteria"]),
        "control_mapping": bronze["control_mapping"],
        "systems": s.silver_systems(bronze["systems"], as_of),
        "assessments": s.silver_assessments(bronze["assessments"], as_of),
        "evidence": s.silver_evidence(bronze["evidence"], as_of),
    }


class Entities:
    """Bronze and silver views over one data folder, built on first use."""

    def __init__(self, spark: SparkSession, sf_dir: str, as_of: dt.date = AS_OF):
        self.spark, self.sf_dir, self.as_of = spark, sf_dir, as_of

    def bronze(self, name: str) -> DataFrame:
        return BRONZE[name](self.spark, self.sf_dir)

    @property
    def controls(self) -> DataFrame:
        return s.silver_controls(self.bronze("controls"))

    @property
    def criteria(self) -> DataFrame:
        return s.silver_criteria(self.bronze("criteria"))

    @property
    def control_mapping(self) -> DataFrame:
        return self.bronze("control_mapping")

    @property
    def systems(self) -> DataFrame:
        return s.silver_systems(self.bronze("systems"), self.as_of)

    @property
    def assessments(self) -> DataFrame:
        return s.silver_assessments(self.bronze("assessments"), self.as_of)

    @property
    def evidence(self) -> DataFrame:
        return s.silver_evidence(self.bronze("evidence"), self.as_of)
