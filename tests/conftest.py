from __future__ import annotations

import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from veritrail.session import build_session  # noqa: E402

AS_OF = dt.date(2024, 6, 30)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "veritrail-tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "4g",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def as_of():
    return AS_OF


def day(offset: int) -> str:
    """ISO text of the day ``offset`` days after the tests' as-of date."""
    return (AS_OF + dt.timedelta(days=offset)).isoformat()


def rows(df) -> list[dict]:
    return [r.asDict() for r in df.collect()]


def by(df, key: str) -> dict:
    return {r[key]: r for r in rows(df)}
