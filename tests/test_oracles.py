"""Every query against its DuckDB statement on the given tables."""

from __future__ import annotations

import os

import duckdb
import pytest

from veritrail.plans import oracles
from veritrail.plans.queries import QUERIES

FOLDER = f"/root/testdata/sf{os.environ.get('TEST_SF', '0.001')}"
TABLES = ("region", "nation", "supplier", "part", "orders", "lineitem")
SPARK_TO_DUCKDB = {
    "string": "VARCHAR",
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "date": "DATE",
    "timestamp": "TIMESTAMP",
    "boolean": "BOOLEAN",
}
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables not present")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return con


def _normal(value):
    return round(value, 9) if isinstance(value, float) else value


def _sorted(records, order):
    return sorted((tuple(_normal(r[i]) for i in order) for r in records), key=repr)


#: What a trained forest says has no SQL form; tests/test_risk.py walks the trees.
WITHOUT_SQL = {
    "risk_score", "risk_auc", "report_risk_summary", "report_high_risk", "risk_score_by_trees",
}


def test_every_query_has_sql():
    assert set(QUERIES) - WITHOUT_SQL == set(oracles.STATEMENTS)


@pytest.mark.parametrize("key", sorted(oracles.STATEMENTS))
def test_query_matches_sql(spark, duck, key):
    df = QUERIES[key](spark, FOLDER)
    result = duck.execute(oracles.statement(key))
    sql_types = {d[0]: str(d[1]) for d in result.description}
    assert sql_types == {c: SPARK_TO_DUCKDB[t] for c, t in df.dtypes}
    columns = sorted(df.columns)
    names = [d[0] for d in result.description]
    want = _sorted(result.fetchall(), [names.index(c) for c in columns])
    got = _sorted(df.select(*(f"`{c}`" for c in columns)).collect(), range(len(columns)))
    assert got == want

