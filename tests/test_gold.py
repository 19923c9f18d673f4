from __future__ import annotations

import random
from datetime import datetime, timedelta
from pathlib import Path

import pytest

from conftest import plan_of, rows
from tidemark import names as N
from tidemark.plans import (
    daily_variation,
    rank_by_value,
    refresh_daily_states,
    segment_indicators,
    top_by_value,
    variation_of_states,
)
from tidemark.sources import CurrentTable, HistoryTable, UpsertCounts


@pytest.mark.parametrize("bands", [2, 5, 1000])
def test_ranks_match_brute_force_wherever_the_bands_fall(spark, bands):
    rng = random.Random(bands)
    values = [1.0] * 100 + [rng.choice([None, rng.randrange(40) / 4]) for _ in range(200)]
    df = spark.createDataFrame(list(enumerate(values)), "id int, v double").repartition(5)
    present = [v for v in values if v is not None]
    expected = sorted(
        (
            i,
            None if v is None else 1 + sum(w > v for w in present),
            None if v is None else 1 + len({w for w in present if w > v}),
        )
        for i, v in enumerate(values)
    )
    ranked = rank_by_value(df, "v", bands)
    assert ranked.columns == ["id", "v", "rank", "dense_rank"]
    assert sorted(map(tuple, ranked.select("id", "rank", "dense_rank").collect())) == expected


def test_ranks_of_nothing_and_of_one_value(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "id int, v double")
    assert rows(rank_by_value(df, "v"), "id", "rank") == [(1, None), (2, None)]
    same = spark.createDataFrame([(1, 5.0), (2, 5.0)], "id int, v double")
    assert rows(rank_by_value(same, "v"), "id", "rank", "dense_rank") == [(1, 1, 1), (2, 1, 1)]


def test_ranks_of_decimals_and_integers(spark):
    df = spark.range(5).selectExpr("id", "cast(id AS decimal(20, 2)) AS d")
    assert rows(rank_by_value(df, "d"), "id", "rank") == [(i, 5 - i) for i in range(5)]
    assert rows(rank_by_value(df.select("id"), "id"), "id", "rank") == [(i, 5 - i) for i in range(5)]


def test_top_breaks_ties_by_the_given_columns(spark):
    df = spark.createDataFrame([("c", 2.0), ("b", 3.0), ("a", 2.0), ("z", None)], "id string, v double")
    assert rows(top_by_value(df, "v", 2, ["id"]), "position", "id") == [(1, "b"), (2, "a")]
    assert top_by_value(df, "v", 10, ["id"]).count() == 3


def test_daily_variation(spark):
    start = datetime(2025, 6, 1)
    data = [
        ("a", start, 1, 10.0),
        ("a", start + timedelta(hours=9), 2, 12.0),
        ("a", start + timedelta(hours=9), 3, 11.0),
        ("a", start + timedelta(days=1), 4, 22.0),
        ("b", start, 5, 0.0),
        ("b", start + timedelta(days=3), 6, 5.0),
    ]
    df = spark.createDataFrame(data, "id string, at timestamp_ntz, n int, v double")
    found = rows(
        daily_variation(df, ["id"], "at", "v", ["n"]),
        "id", "opened", "closed", "lowest", "highest", "readings",
        "change_in_day", "change_from_previous", "relative_change",
    )
    assert found == [
        ("a", 10.0, 11.0, 10.0, 12.0, 3, 1.0, None, None),
        ("a", 22.0, 22.0, 22.0, 22.0, 1, 0.0, 11.0, 1.0),
        ("b", 0.0, 0.0, 0.0, 0.0, 1, 0.0, None, None),
        ("b", 5.0, 5.0, 5.0, 5.0, 1, 0.0, 5.0, None),
    ]


def test_segment_indicators(spark):
    df = spark.createDataFrame([("x", 1.0), ("x", 3.0), ("y", 4.0), ("z", None)], "s string, v double")
    found = rows(segment_indicators(df, "s", "v"), "s", "members", "total", "mean", "share")
    assert found == [("x", 2, 4.0, 2.0, 0.5), ("y", 1, 4.0, 4.0, 0.5), ("z", 1, None, None, None)]


def test_the_share_of_a_total_of_zero_is_null(spark):
    df = spark.createDataFrame([("a", 1), ("b", -1)], "s string, v int")
    assert rows(segment_indicators(df, "s", "v"), "s", "total", "share") == [("a", 1, None), ("b", -1, None)]


def sizes_of_ranges(spark):
    """Rows in each range of the newest ranking."""
    folder = max(Path(spark.conf.get("spark.checkpoint.dir")).glob("ranges-*"), key=lambda p: p.stat().st_mtime)
    counts = spark.read.parquet(str(folder)).groupBy("__part").count()
    return sorted(r["count"] for r in counts.collect())


@pytest.mark.parametrize("kind", ["double", "decimal(12,2)", "string", "date"])
def test_a_hot_value_and_nulls_leave_no_range_large(spark, kind):
    value = {"string": "string(v)", "date": "date_add(date'2025-01-01', int(v))"}.get(kind, f"cast(v AS {kind})")
    chosen = "CASE WHEN id % 2 = 0 THEN NULL WHEN id % 3 = 0 THEN 50 ELSE id % 97 END"
    df = spark.range(24_000).selectExpr("id", f"{chosen} AS v").selectExpr("id", f"{value} AS v").repartition(6)
    ranked = rank_by_value(df, "v", 16)
    by_window = df.where("v IS NOT NULL").selectExpr(
        "id", "v", "rank() OVER (ORDER BY v DESC) AS rank", "dense_rank() OVER (ORDER BY v DESC) AS dense_rank"
    )
    assert rows(ranked.where("v IS NOT NULL").selectExpr("id", "rank", "int(dense_rank)")) == rows(
        by_window.selectExpr("id", "rank", "dense_rank")
    )
    assert ranked.where("v IS NULL AND rank IS NULL AND dense_rank IS NULL").count() == 12_000
    sizes = sizes_of_ranges(spark)
    assert sum(sizes) == 12_000 and len(sizes) == 16
    assert sizes[-1] <= 2 * sizes[len(sizes) // 2]


def test_ranks_of_values_that_are_no_numbers(spark):
    data = [(1, float("nan")), (2, float("nan")), (3, float("inf")), (4, 0.0), (5, -0.0), (6, None), (7, float("-inf"))]
    df = spark.createDataFrame(data, "id int, v double").repartition(3)
    for bands in (2, 7):
        assert rows(rank_by_value(df, "v", bands), "id", "rank", "dense_rank") == [
            (1, 1, 1), (2, 1, 1), (3, 3, 2), (4, 4, 3), (5, 4, 3), (6, None, None), (7, 6, 4),
        ]


def test_ranking_joins_nothing_by_value(spark):
    df = spark.range(50).selectExpr("id", "double(id % 7) AS v")
    plan = plan_of(rank_by_value(df, "v", 4))
    assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan


def test_daily_states_are_kept_up_to_date(spark, tmp_path):
    rng = random.Random(2)
    history, states = HistoryTable(spark, str(tmp_path / "h")), CurrentTable(spark, str(tmp_path / "s"))
    schema = f"id string, at timestamp_ntz, n int, v double, {N.INGESTED_ON} string"
    every = []
    for turn in range(3):
        batch = [
            (
                rng.choice(["a", "b", None]),
                datetime(2025, 6, 1) + timedelta(hours=rng.randrange(100)),
                100 * turn + i,
                rng.choice([None, float(rng.randrange(50))]),
                f"2025-07-0{turn + 1}",
            )
            for i in range(40)
        ]
        every += batch
        history.append(spark.createDataFrame(batch, schema))
        refresh_daily_states(history, states, ["id"], "at", "v", ["n"])
        kept = variation_of_states(states.read(), ["id"])
        whole = daily_variation(spark.createDataFrame(every, schema), ["id"], "at", "v", ["n"])
        assert kept.columns == whole.columns
        assert rows(kept) == rows(whole)
        assert states.last_release().source == turn + 1
    before = states.last_release()
    assert refresh_daily_states(history, states, ["id"], "at", "v", ["n"]).inserted == 0
    assert states.last_release() == before


def test_a_refresh_of_daily_states_replaces_touched_days_only(spark, tmp_path):
    history, states = HistoryTable(spark, str(tmp_path / "h")), CurrentTable(spark, str(tmp_path / "s"))
    schema = f"id string, at timestamp_ntz, v double, {N.INGESTED_ON} string"
    days = [(f"k{i}", datetime(2025, 6, 1 + i), 1.0, "2025-07-01") for i in range(9)]
    history.append(spark.createDataFrame(days, schema))
    refresh_daily_states(history, states, ["id"], "at", "v")
    history.append(spark.createDataFrame([("k3", datetime(2025, 6, 4, 5), 9.0, "2025-07-02"), ("new", datetime(2025, 6, 4), 2.0, "2025-07-02")], schema))
    assert refresh_daily_states(history, states, ["id"], "at", "v") == UpsertCounts(inserted=1, updated=1, copied=8)
    found = variation_of_states(states.read(), ["id"]).where("id = 'k3'")
    assert rows(found, "opened", "closed", "readings") == [(1.0, 9.0, 2)]
