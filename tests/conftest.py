from __future__ import annotations

import os
import sys
from datetime import datetime

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemark.catalog.registry import StagedClock
from tidemark.plans import Layers
from tidemark.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
            "spark.driver.memory": "6g",
            # Whole paths in the plans that tests look at.
            "spark.sql.maxMetadataStringLength": "1000",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def clock():
    return StagedClock(datetime(2025, 6, 1, 9, 30))


@pytest.fixture
def layers(tmp_path):
    return Layers.under(str(tmp_path), "coins")


def rows(df, *columns):
    """Rows as sorted tuples, nulls first."""
    chosen = df.select(*columns) if columns else df
    found = [tuple(r) for r in chosen.collect()]
    return sorted(found, key=lambda r: [(v is not None, v) for v in r])


def plan_of(df) -> str:
    """The physical plan; after an action on ``df``, the one that ran."""
    return df._jdf.queryExecution().executedPlan().toString()
