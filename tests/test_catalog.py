"""Every registered query against its SQL, and what all of them have to keep to."""

from __future__ import annotations

import ast
import pathlib

import pytest

import __spark_entry__ as entry_points
from oracle import differences
from tidemark.catalog import QUERIES, SQL

SMALLEST = "/root/testdata/sf0.001"
ROOT = pathlib.Path(__file__).parent.parent

pytestmark = pytest.mark.skipif(
    not pathlib.Path(SMALLEST).exists(), reason="the shared test tables are not here"
)


@pytest.mark.parametrize("name", list(SQL))
def test_query_equals_its_sql(spark, name):
    assert differences(spark, name, SMALLEST) == ""


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry_points.queries())


def test_flagship_query_runs(spark):
    assert entry_points.entry(spark).count() > 0


def test_library_stays_off_the_slow_paths():
    """No Python functions on rows, no RDDs, no local checkpoints, no cross joins."""
    banned = {
        "udf", "pandas_udf", "rdd", "parallelize", "localCheckpoint", "crossJoin",
        "toPandas", "collect", "toLocalIterator", "foreach",
    }
    for path in (ROOT / "tidemark").rglob("*.py"):
        if "llm" in path.parts:  # the corpus operators choose their own style
            continue
        used = {
            n.attr for n in ast.walk(ast.parse(path.read_text())) if isinstance(n, ast.Attribute)
        }
        assert not used & banned, f"{path} uses {used & banned}"
