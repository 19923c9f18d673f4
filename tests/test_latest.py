from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from conftest import plan_of, rows
from tidemark.operators import latest_per_key, latest_versions, total_order


def test_newest_row_wins_and_columns_stay(spark):
    df = spark.createDataFrame(
        [("a", 1, "old"), ("a", 3, "new"), ("b", 2, "only")], "k string, at int, v string"
    )
    latest = latest_per_key(df, "k", "at", ["v"])
    assert latest.columns == ["k", "at", "v"]
    assert rows(latest) == [("a", 3, "new"), ("b", 2, "only")]


def test_ties_are_broken_by_the_given_columns(spark):
    df = spark.createDataFrame([("a", 1, i) for i in range(50)], "k string, at int, n int")
    for partitions in (1, 3, 7):
        spread = df.repartition(partitions, "n")
        assert rows(latest_per_key(spread, "k", "at", ["n"])) == [("a", 1, 49)]
        assert rows(latest_per_key(spread, "k", "at", [F.asc("n")])) == [("a", 1, 0)]


def test_tie_breaker_is_required(spark):
    with pytest.raises(ValueError, match="tie-breaker"):
        latest_per_key(spark.range(1), "id", "id", [])


def test_null_recency_is_oldest_and_null_keys_form_a_group(spark):
    df = spark.createDataFrame(
        [("a", None, 9), ("a", 1, 1), ("b", None, 2), (None, 5, 3), (None, 4, 4)],
        "k string, at int, n int",
    )
    assert rows(latest_per_key(df, "k", "at", ["n"])) == [
        (None, 5, 3),
        ("a", 1, 1),
        ("b", None, 2),
    ]


def test_composite_keys_match_brute_force(spark):
    rng = random.Random(7)
    data = [(rng.randrange(5), rng.randrange(4), rng.randrange(6), i) for i in range(500)]
    best = {}
    for r in data:
        best[r[:2]] = max(best.get(r[:2], (-1, -1)), r[2:])
    df = spark.createDataFrame(data, "a int, b int, at int, n int").repartition(6)
    assert rows(latest_per_key(df, ["a", "b"], "at", ["n"])) == sorted(
        k + v for k, v in best.items()
    )


def test_latest_versions_orders_by_run_and_then_totally(spark):
    schema = "id string, m map<string, int>, dt_atualizacao string, hash_chave string, hash_columns string"
    df = spark.createDataFrame(
        [
            ("x", {"a": 1}, "2025-06-01 00:00:00", "k", "h1"),
            ("y", {"a": 1}, "2025-06-02 00:00:00", "k", "h2"),
            ("z", {"a": 1}, "2025-06-02 00:00:00", "k", "h3"),
            ("w", {"a": 1}, "not a time", "k", "h9"),
        ],
        schema,
    )
    assert rows(latest_versions(df), "id") == [("z",)]
    assert len(total_order(df, ["hash_columns"])) == 4


def test_a_crowded_key_is_reduced_before_the_shuffle(spark):
    df = spark.range(100_000).selectExpr("if(id % 3 = 0, 0, id) AS k", "id AS at", "id AS n")
    latest = latest_per_key(df, "k", "at", ["n"])
    assert latest.count() == 66_667
    plan = plan_of(latest_per_key(df, "k", "at", ["n"]))
    assert plan.index("WindowGroupLimit") < plan.index("Exchange") < plan.rindex("WindowGroupLimit")
