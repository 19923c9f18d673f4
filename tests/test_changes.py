from __future__ import annotations

import random
from collections import Counter
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from conftest import plan_of, rows
from tidemark.functions import fingerprint
from tidemark.operators import (
    changed_rows,
    insert_only,
    lineage,
    merge_actions,
    merge_metrics,
    unseen_rows,
    upsert,
)


def frame(spark, data, columns="id string, v int"):
    df = spark.createDataFrame(data, columns)
    return df.withColumns(
        {"hash_chave": fingerprint(["id"]), "hash_columns": fingerprint(["id", "v"])}
    )


def test_only_unknown_rows_are_new(spark):
    history = frame(spark, [("a", 1), ("b", 1)])
    stage = frame(spark, [("a", 1), ("a", 2), ("c", 1)])
    new = unseen_rows(stage, history)
    assert new.columns == stage.columns
    assert rows(new, "id", "v") == [("a", 2), ("c", 1)]


def test_replay_adds_nothing(spark):
    stage = frame(spark, [("a", 1), ("b", 2), ("b", 2)])
    merged = insert_only(stage.limit(0), stage)
    assert rows(merged) == rows(stage)
    assert unseen_rows(stage, merged).count() == 0


def test_a_value_that_returns_is_known(spark):
    history = frame(spark, [("a", 1), ("a", 2)])
    assert unseen_rows(frame(spark, [("a", 1)]), history).count() == 0


def test_copies_in_one_batch_are_all_inserted_unless_distinct(spark):
    history = frame(spark, [("z", 0)])
    stage = frame(spark, [("a", 1), ("a", 1), ("a", 1), ("z", 0)])
    assert rows(unseen_rows(stage, history), "id") == [("a",)] * 3
    assert rows(unseen_rows(stage, history, distinct=True), "id") == [("a",)]


def test_a_missing_digest_is_never_known(spark):
    stage = frame(spark, [("a", 1), ("b", 1)]).withColumn(
        "hash_columns", F.when(F.col("id") == "a", F.col("hash_columns"))
    )
    assert rows(unseen_rows(stage, stage), "id") == [("b",)]


@pytest.mark.parametrize("threshold", ["-1", "10485760"])
def test_unseen_rows_match_brute_force_with_a_third_in_one_group(spark, threshold):
    rng = random.Random(11)

    def draw(n):
        return [("hot", 1) if rng.random() < 0.34 else (f"k{rng.randrange(40)}", 0) for _ in range(n)]

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        for known in ([], [("hot", 1)] * 100, draw(60)):
            data = draw(600)
            expected = Counter(r for r in data if r not in set(known))
            stage = frame(spark, data).repartition(5)
            history = frame(spark, known or [("none", 9)])
            found = unseen_rows(stage, history)
            assert Counter(rows(found, "id", "v")) == expected
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def stored_history(spark, path):
    df = spark.range(200_000).selectExpr("cast(id AS string) AS id", "1 AS v")
    df.withColumn("hash_columns", fingerprint(["id", "v"])).write.parquet(path)
    return spark.read.parquet(path)


def test_a_small_stage_prunes_the_history(spark, tmp_path):
    history = stored_history(spark, str(tmp_path / "history"))
    stage = frame(spark, [("1", 1), ("x", 1), ("x", 1)])
    new = unseen_rows(stage, history)
    assert rows(new, "id") == [("x",), ("x",)]
    # Few digests are broadcast to the history, and few of those go on.
    assert "Exchange hashpartitioning(hash_columns#" not in plan_of(new).split("Initial Plan")[0].split("Aggregate")[-1]


def test_rows_that_change_between_actions_are_merged_once(spark):
    history = frame(spark, [("old", 0)])
    moving = spark.range(20).selectExpr("string(id) AS id", "int(rand() * 1e9) AS v", "current_timestamp() AS at")
    stage = moving.withColumn("hash_columns", fingerprint(["id", "v", "at"]))
    assert unseen_rows(stage, history).count() == 20


def test_few_changes_do_not_shuffle_the_current_table(spark, tmp_path):
    """The current table is above the broadcast limit, the news are below it."""
    current = stored_history(spark, str(tmp_path / "current"))
    frame(spark, [(str(i), 1 + i % 2) for i in range(50)]).write.parquet(str(tmp_path / "news"))
    news = spark.read.parquet(str(tmp_path / "news"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1m")
    try:
        changed = changed_rows(news, current)
        before = shuffled_bytes(spark)
        assert len(changed.collect()) == 25
        assert "SortMergeJoin" not in plan_of(changed).split("Initial Plan")[0]
        # 200,000 digests would be some megabytes.
        assert shuffled_bytes(spark) - before < 50_000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def shuffled_bytes(spark):
    """Bytes that all stages of the session have written to shuffles."""
    jvm = spark._jvm
    store = spark._jsc.sc().statusStore()
    quantiles = spark._sc._gateway.new_array(jvm.double, 0)
    nothing = jvm.java.util.ArrayList()
    stages = store.stageList(nothing, False, False, quantiles, nothing)
    return sum(stages.apply(i).shuffleWriteBytes() for i in range(stages.size()))


def test_changed_rows_compare_with_every_current_row(spark):
    current = frame(spark, [("a", 1), ("b", 1)])
    latest = frame(spark, [("a", 1), ("b", 2), ("c", 3)])
    assert rows(changed_rows(latest, current), "id", "v") == [("b", 2), ("c", 3)]
    with pytest.raises(ValueError, match="current table has no column"):
        changed_rows(latest, current.drop("hash_columns"))


def test_upsert_updates_inserts_and_keeps(spark):
    target = frame(spark, [("a", 1), ("b", 1), ("gone", 7)])
    source = frame(spark, [("b", 2), ("c", 3)])
    assert rows(upsert(target, source), "id", "v") == [("a", 1), ("b", 2), ("c", 3), ("gone", 7)]
    assert rows(merge_actions(target, source).groupBy("action").count()) == [
        ("COPY", 2),
        ("INSERT", 1),
        ("UPDATE", 1),
    ]
    assert rows(merge_metrics(target, source)) == [(2, 1, 1, 2, 4)]


def test_upsert_has_no_recency_test(spark):
    assert rows(upsert(frame(spark, [("a", 9)]), frame(spark, [("a", 1)])), "id", "v") == [("a", 1)]


def test_upsert_brings_new_columns(spark):
    target = frame(spark, [("a", 1), ("b", 1)])
    source = frame(spark, [("b", 2)]).withColumn("extra", F.lit("x"))
    merged = upsert(target, source)
    assert merged.columns == [*target.columns, "extra"]
    assert rows(merged, "id", "v", "extra") == [("a", 1, None), ("b", 2, "x")]


def test_upsert_size_identities_hold(spark):
    rng = random.Random(3)
    for _ in range(4):
        old = {f"k{rng.randrange(60)}": rng.randrange(5) for _ in range(40)}
        new = {f"k{rng.randrange(60)}": rng.randrange(5) for _ in range(40)}
        target, source = frame(spark, list(old.items())), frame(spark, list(new.items()))
        assert rows(upsert(target, source), "id", "v") == sorted({**old, **new}.items())
        sizes = merge_metrics(target, source).first()
        assert sizes.source_rows == sizes.inserted + sizes.updated == len(new)
        assert sizes.inserted + sizes.updated + sizes.copied == sizes.rows_after
        assert sizes.rows_after == len({**old, **new})


@contextmanager
def settings(spark, **values):
    """Session settings for one block; dots are written as two underscores."""
    names = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def digests(spark, first, last):
    return spark.range(first, last).selectExpr("sha2(string(id), 256) AS hash_columns", "id")


def test_a_stage_too_large_to_broadcast_filters_the_scan_of_the_history(spark, tmp_path):
    digests(spark, 0, 5000).write.parquet(str(tmp_path / "history"))
    history = spark.read.parquet(str(tmp_path / "history"))
    with settings(
        spark,
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__optimizer__runtime__bloomFilter__applicationSideScanSizeThreshold="1k",
    ):
        fresh = unseen_rows(digests(spark, 4990, 6000), history)
        assert rows(fresh, "id") == [(i,) for i in range(5000, 6000)]
        plan = fresh._jdf.queryExecution().optimizedPlan().toString()
    scan_of_history = plan.split("LeftSemi")[1].split("Relation")[0]
    assert "might_contain" in scan_of_history and "bloom_filter_agg" in scan_of_history
    small = unseen_rows(digests(spark, 4990, 6000), history)
    assert rows(small, "id") == [(i,) for i in range(5000, 6000)]


def test_digests_in_bytes_tell_apart_what_their_text_does(spark):
    """Hex digests, other text, text that is hex of another length, empty text and nulls."""
    values = ["ab" * 32, "AB", "ab", "0ab", "", "x" * 64, "ab" * 31, "é", None]
    history = spark.createDataFrame([(v,) for v in values[::2]], "hash_columns string")
    stage = spark.createDataFrame([(v,) for v in values], "hash_columns string")
    assert rows(unseen_rows(stage, history)) == sorted(
        ((v,) for v in [*values[1::2], None]), key=lambda r: (r[0] is not None, r[0])
    )


def sides(spark, tmp_path):
    keyed = "concat('k', id) AS hash_chave"
    spark.range(1000).selectExpr(keyed).union(spark.range(1).selectExpr("null")).write.parquet(str(tmp_path / "t"))
    return spark.read.parquet(str(tmp_path / "t")), spark.range(990, 1010).selectExpr(keyed)


def test_merge_counts_leave_the_target_where_it_is(spark, tmp_path):
    target, source = sides(spark, tmp_path)
    counts = merge_metrics(target, source)
    assert rows(counts) == [(20, 10, 10, 991, 1011)]
    plan = plan_of(counts)
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
    # What is exchanged are counts, not keys.
    assert "hashpartitioning(hash_chave" not in plan
    actions = merge_actions(target, source)
    assert rows(actions.groupBy("action").count()) == [("COPY", 991), ("INSERT", 10), ("UPDATE", 10)]
    assert "hashpartitioning(hash_chave" not in plan_of(actions)


def test_merge_counts_of_a_source_too_large_to_broadcast(spark, tmp_path):
    target, source = sides(spark, tmp_path)
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        assert rows(merge_metrics(target, source)) == [(20, 10, 10, 991, 1011)]
        assert rows(merge_metrics(target.limit(0), source)) == [(20, 20, 0, 0, 20)]
        assert rows(merge_metrics(target, source.limit(0))) == [(0, 0, 0, 1001, 1001)]


def test_rows_of_one_run_are_dealt_out(spark):
    """Nearly all rows come from one run; without broadcasts no task gets many of them."""
    run_of = "CASE WHEN id < 11000 THEN 'big' WHEN id < 11900 THEN concat('r', id % 5) END AS key_log_file_path"
    written_rows = spark.range(12_000).selectExpr("id", run_of)
    log = spark.createDataFrame([("big", "a"), ("r0", "b"), ("r1", "c"), ("idle", "d")], "id_log_file_path string, note string")
    with settings(
        spark,
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__coalescePartitions__enabled="false",
        spark__sql__shuffle__partitions="8",
    ):
        whole = written_rows.join(log, F.col("key_log_file_path") == F.col("id_log_file_path"))
        dealt = lineage(written_rows, log, split_rows=100)
        assert dealt.columns == whole.columns
        assert rows(dealt) == rows(whole)
        sizes = sorted(r["count"] for r in dealt.groupBy(F.spark_partition_id()).count().collect())
    assert len(sizes) == 8
    assert sizes[-1] <= 2 * sizes[len(sizes) // 2]


def test_runs_that_are_small_are_joined_plainly(spark):
    written_rows = spark.createDataFrame([("a", 1), ("a", 2), (None, 3)], "key_log_file_path string, n int")
    log = spark.createDataFrame([("a", "x")], "id_log_file_path string, note string")
    assert rows(lineage(written_rows, log), "n", "note") == [(1, "x"), (2, "x")]
    assert lineage(written_rows.limit(0), log).count() == 0
    assert rows(lineage(written_rows, log, split_rows=1), "n", "note") == [(1, "x"), (2, "x")]
