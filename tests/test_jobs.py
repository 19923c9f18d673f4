from __future__ import annotations

import json
import random
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.errors import UnsupportedOperationException
from pyspark.sql import functions as F

from conftest import rows
from tidemark import names as N
from tidemark.plans import (
    Layers,
    audited,
    ingest_record,
    ingest_snapshot,
    read_run_log,
    refresh_current,
    run_chain,
    typed_run_log,
)
from tidemark.operators import RunContext
from tidemark.sources import (
    BAD_RECORD,
    AppendTable,
    CurrentTable,
    HistoryTable,
    MergeTable,
    UpsertCounts,
)
from tidemark.streaming import follow_landing, landing, parent_folder

SCHEMA = "id string, name string, price double"


def snapshot(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def coins(prices, prefix="c"):
    return [(f"{prefix}{i:03}", f" coin {i} ", float(p)) for i, p in enumerate(prices)]


def test_first_load_then_replay_then_change(spark, layers, clock):
    data = coins(range(10))
    assert ingest_snapshot(spark, snapshot(spark, data), layers, "id", clock)["records_processed"] == "10"
    clock.at += timedelta(days=1)
    assert ingest_snapshot(spark, snapshot(spark, data), layers, "id", clock)["records_processed"] == "0"
    clock.at += timedelta(days=1)
    data[3] = ("c003", " coin 3 ", 99.0)
    assert ingest_snapshot(spark, snapshot(spark, data), layers, "id", clock)["records_processed"] == "1"
    history = HistoryTable(spark, layers.history).read()
    assert history.columns == ["id", "name", "price", *N.CONTROL_COLUMNS]
    assert rows(history.groupBy(N.UPDATED_AT).count()) == [
        ("2025-06-01 09:30:00", 10),
        ("2025-06-03 09:30:00", 1),
    ]


def test_merge_into_a_catalog_table(spark, layers, clock, monkeypatch):
    """No catalog here has row-level operations, so Spark's own refusal is as far as MERGE goes:
    it comes after table, columns and condition have been resolved."""
    data = coins(range(4))
    run_chain(spark, [snapshot(spark, data)], layers, "id", clock)
    CurrentTable(spark, layers.current).read().limit(0).write.saveAsTable("coins_now")
    target = MergeTable(spark, "spark_catalog.default.coins_now")
    stored = CurrentTable(spark, layers.current).read()
    for evolve in (True, False):
        with pytest.raises(UnsupportedOperationException, match="MERGE INTO TABLE"):
            target.merge(stored, evolve=evolve)
    with pytest.raises(ValueError, match="other"):
        target.merge(stored, on="other")
    with pytest.raises(UnsupportedOperationException):
        refresh_current(spark, layers, clock, merge_into=target.name)
    log = read_run_log(spark, layers.refresh_log).filter("status = 'ERRO'")
    assert rows(log, "output_path") == [(target.name,)]

    merges = []

    class Merge:
        def __getattr__(self, step):
            return lambda *_: merges.append(step) or self

    monkeypatch.setattr(type(stored), "mergeInto", lambda *_: Merge())
    stored.limit(3).write.insertInto("coins_now")
    record = refresh_current(spark, layers, clock, merge_into=target.name)
    assert (record["records_inserted"], record["records_updated"]) == ("1", "0")
    assert merges == ["withSchemaEvolution", "whenMatched", "updateAll", "whenNotMatched", "insertAll", "merge"]
    held = {r[N.KEY_HASH] for r in target.read().select(N.KEY_HASH).collect()}
    changed = stored.withColumn("price", F.col("price") + 1)
    counts = target.merge(changed)
    assert (counts.inserted, counts.updated, counts.copied) == (1, len(held), 0)
    merges.clear()
    assert target.merge(stored.limit(0)) == UpsertCounts(0, 0, 3) and merges == []
    spark.sql("DROP TABLE coins_now")


def test_disjoint_snapshots_add_up(spark, layers, clock):
    for number in range(4):
        clock.at += timedelta(hours=1)
        batch = coins([number * 100 + i for i in range(20)])
        assert (
            ingest_snapshot(spark, snapshot(spark, batch), layers, "id", clock)["records_processed"] == "20"
        )
    assert HistoryTable(spark, layers.history).read().count() == 80


def test_refresh_cleans_counts_and_keeps_lost_keys(spark, layers, clock):
    ingest_snapshot(spark, snapshot(spark, coins(range(5))), layers, "id", clock)
    first = refresh_current(spark, layers, clock)
    assert (first["records_inserted"], first["records_updated"]) == ("5", "0")
    clock.at += timedelta(days=1)
    later = [*coins([0, 1, 72, 3])[1:], ("new", "", None)]
    ingest_snapshot(spark, snapshot(spark, later), layers, "id", clock)
    second = refresh_current(spark, layers, clock)
    assert (second["records_inserted"], second["records_updated"]) == ("1", "1")
    current = CurrentTable(spark, layers.current).read()
    assert current.columns == ["id", "name", "price", *N.HASH_COLUMNS, *N.RUN_COLUMNS]
    assert rows(current, "id", "name", "price", N.INGESTED_ON) == [
        ("C000", "COIN 0", 0.0, "2025-06-01"),
        ("C001", "COIN 1", 1.0, "2025-06-01"),
        ("C002", "COIN 2", 72.0, "2025-06-02"),
        ("C003", "COIN 3", 3.0, "2025-06-01"),
        ("C004", "COIN 4", 4.0, "2025-06-01"),
        ("NEW", None, None, "2025-06-02"),
    ]
    history = HistoryTable(spark, layers.history).read()
    # Digests are those of the raw rows.
    assert current.join(history, [*N.HASH_COLUMNS], "left_anti").count() == 0


def test_refresh_without_news_releases_nothing(spark, layers, clock):
    ingest_snapshot(spark, snapshot(spark, coins(range(5))), layers, "id", clock)
    refresh_current(spark, layers, clock)
    before = CurrentTable(spark, layers.current).last_release()
    again = refresh_current(spark, layers, clock)
    assert (again["records_inserted"], again["records_updated"]) == ("0", "0")
    assert CurrentTable(spark, layers.current).last_release() == before


def test_a_value_that_returns_leaves_the_current_row(spark, layers, clock):
    for price in (1.0, 2.0, 1.0):
        clock.at += timedelta(days=1)
        run_chain(spark, [snapshot(spark, [("a", "x", price)])], layers, "id", clock)
    assert rows(CurrentTable(spark, layers.current).read(), "price") == [(2.0,)]


def test_copies_in_a_snapshot_give_one_current_row(spark, layers, clock):
    data = [("a", "x", 1.0)] * 3 + [("a", "x", 2.0)]
    assert ingest_snapshot(spark, snapshot(spark, data), layers, "id", clock)["records_processed"] == "4"
    assert refresh_current(spark, layers, clock)["records_inserted"] == "1"


def test_incremental_refreshes_give_the_full_result(spark, tmp_path, clock):
    rng = random.Random(5)
    batches = [
        [(f"k{i}", None if rng.random() < 0.1 else "n", float(rng.randrange(3)))
         for i in rng.sample(range(12), 8)]
        for _ in range(5)
    ]
    results = []
    for incremental in (True, False):
        layers = Layers.under(str(tmp_path / str(incremental)), "coins")
        clock.at = datetime(2025, 6, 1)
        log = []
        for batch in batches:
            clock.at += timedelta(hours=17)
            log += run_chain(
                spark,
                [snapshot(spark, batch)],
                layers,
                "id",
                clock,
                incremental,
            )
        current = CurrentTable(spark, layers.current).read()
        results.append(
            (
                rows(current, "id", "name", "price", *N.HASH_COLUMNS, N.UPDATED_AT),
                [(r["status"], r.get("records_inserted"), r.get("records_updated")) for r in log],
            )
        )
    assert results[0] == results[1]
    ids = {k for batch in batches for k, _, _ in batch}
    assert len(results[0][0]) == len(ids)


def test_an_incremental_refresh_reads_only_later_releases(spark, layers, clock):
    history = HistoryTable(spark, layers.history)
    for price in (1.0, 2.0, 3.0):
        clock.at += timedelta(minutes=1)
        ingest_snapshot(spark, snapshot(spark, [("a", "x", price)]), layers, "id", clock)
    assert rows(history.read_news(None)[0], "price") == [(1.0,), (2.0,), (3.0,)]
    assert rows(history.read_news(2)[0], "price") == [(3.0,)]
    assert history.read_news(2)[1] == 3
    assert rows(history.read_news(3)[0], "price") == []


@pytest.mark.parametrize("late", [timedelta(0), timedelta(days=-3)])
def test_a_late_version_does_not_replace_a_newer_one(spark, layers, clock, late):
    """A run whose clock is not ahead makes the refresh read the whole history."""
    run_chain(spark, [snapshot(spark, [("a", "x", 2.0), ("b", "x", 2.0)])], layers, "id", clock)
    clock.at += late
    ingest_snapshot(spark, snapshot(spark, [("a", "x", 1.0), ("c", "x", 1.0)]), layers, "id", clock)
    refresh_current(spark, layers, clock)
    found = rows(CurrentTable(spark, layers.current).read(), "id", "price")
    full = Layers(**{**vars(layers), "current": layers.current + "-full"})
    refresh_current(spark, full, clock, incremental=False)
    assert found == rows(CurrentTable(spark, full.current).read(), "id", "price")
    if late:
        assert found == [("A", 2.0), ("B", 2.0), ("C", 1.0)]


def test_json_sources_are_read_and_traced(spark, layers, clock, tmp_path):
    path = tmp_path / "coins.json"
    path.write_text(json.dumps([{"id": "a", "name": "n", "price": 1, "roi": {"times": 2}}], indent=4))
    record = ingest_snapshot(spark, str(path), layers, "id", clock, schema=SCHEMA)
    assert record["status"] == N.SUCCEEDED
    history = HistoryTable(spark, layers.history).read().first()
    assert history[N.SOURCE_NAME].endswith("/coins.json")
    clock.at += timedelta(days=1)
    path.write_text(json.dumps([{"id": "a", "name": "n", "price": 2}, {"id": "b"}]))
    record = ingest_snapshot(spark, [str(path)], layers, "id", clock, schema=SCHEMA, source_name="api")
    assert record["records_processed"] == "2"
    assert rows(HistoryTable(spark, layers.history).read().filter("dt_ingestao > '2025-06-01'"), N.SOURCE_NAME) == [("api",)] * 2
    assert not spark._jsc.getPersistentRDDs()


def test_log_rows_have_their_columns_in_order(spark, layers, clock):
    run_chain(spark, [snapshot(spark, coins(range(3)))], layers, "id", clock)
    ingest = read_run_log(spark, layers.ingest_log)
    refresh = read_run_log(spark, layers.refresh_log)
    assert tuple(ingest.columns) == N.INGEST_LOG_COLUMNS
    assert tuple(refresh.columns) == N.REFRESH_LOG_COLUMNS
    assert {f.dataType.simpleString() for f in [*ingest.schema, *refresh.schema]} == {"string"}
    row = refresh.first()
    assert row.process_name == "SILVER_LOG_coins"
    assert row.status == "SUCESSO"
    assert row.msg == "EXECUTADO COM SUCESSO"
    assert row.id_log_file_path == f"{layers.refresh_log}_20250601_093000"
    typed = typed_run_log(refresh)
    assert dict(typed.dtypes)["records_inserted"] == "bigint"
    assert typed.first().start_filter_data == datetime(2025, 6, 1, 9, 30)
    assert str(typed.first().date_run) == "2025-06-01"


def test_missing_input_is_logged_and_raised(spark, layers, clock):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        ingest_snapshot(spark, f"{layers.stage}/none.json", layers, "id", clock, schema=SCHEMA)
    row = read_run_log(spark, layers.ingest_log).first()
    assert row.status == "ERRO"
    assert "PATH_NOT_FOUND" in row.msg_erro
    assert row.start_reading_file and not row.end_reading_file
    assert row.records_processed == "0"
    assert row.end_time_script == "2025-06-01 09:30:00"


def test_missing_key_column_is_logged_and_raised(spark, layers, clock):
    with pytest.raises(ValueError, match=r"snapshot has no column \['uid'\]"):
        ingest_snapshot(spark, snapshot(spark, coins([1])), layers, "id,uid", clock)
    assert read_run_log(spark, layers.ingest_log).first().status == "ERRO"
    assert not HistoryTable(spark, layers.history).exists()


def test_failing_refresh_leaves_later_steps_empty(spark, layers, clock):
    broken = snapshot(spark, coins([1])).withColumn(N.INGESTED_ON, F.lit("2025-06-01"))
    AppendTable(spark, layers.history).append(broken)
    with pytest.raises(ValueError, match="history has no column"):
        refresh_current(spark, layers, clock)
    row = read_run_log(spark, layers.refresh_log).first()
    assert row.status == "ERRO"
    assert row.msg.startswith("MSG ERRO -> history has no column")
    assert row.start_bronze_reading and not row.end_bronze_reading
    assert not row.start_update_delta_silver


def test_existing_target_skips_the_run(spark, layers, clock):
    table = AppendTable(spark, layers.history)
    for expected in ("SUCESSO", "IGNORADO"):
        clock.at += timedelta(minutes=1)
        run = RunContext("coins", layers.ingest_log, clock)
        with audited(spark, ingest_record(run, "in", "out")) as record:
            record.update(records_processed=table.create(spark.range(2)))
        row = read_run_log(spark, layers.ingest_log).orderBy(F.desc("id_log_file_path")).first()
        assert row.status == record.values["status"] == expected
    assert "already is a table" in row.msg_erro


def test_unknown_log_column_is_refused(clock):
    record = ingest_record(RunContext("p", "log", clock), "in", "out")
    with pytest.raises(ValueError, match="records_lost"):
        record.update(records_lost=1)


def test_stream_takes_each_landed_file_once(spark, layers, clock, tmp_path):
    checkpoint = str(tmp_path / "stream")

    def land(name, data):
        folder = tmp_path / "1-stage" / "coins"
        folder.mkdir(parents=True, exist_ok=True)
        (folder / f".{name}").write_text(json.dumps([dict(zip(("id", "name", "price"), r)) for r in data]))
        (folder / f".{name}").rename(folder / name)

    def follow():
        clock.at += timedelta(days=1)
        follow_landing(spark, layers, "id", SCHEMA, checkpoint, clock).awaitTermination()
        return rows(CurrentTable(spark, layers.current).read(), "id", "price", N.INGESTED_ON)

    land("1.json", [("a", "x", 1.0), ("b", "x", 1.0)])
    assert follow() == [("A", 1.0, "2025-06-02"), ("B", 1.0, "2025-06-02")]
    land("2.json", [("a", "x", 2.0), ("b", "x", 1.0)])
    assert follow() == [("A", 2.0, "2025-06-03"), ("B", 1.0, "2025-06-02")]
    assert follow() == [("A", 2.0, "2025-06-03"), ("B", 1.0, "2025-06-02")]
    log = read_run_log(spark, layers.ingest_log)
    assert rows(log, "records_processed") == [("1",), ("2",)]
    traced = HistoryTable(spark, layers.history).read()
    assert {r[0].rsplit("/", 1)[1] for r in rows(traced, N.SOURCE_NAME)} == {"1.json", "2.json"}


def test_the_later_of_equal_run_starts_counts(spark, layers, clock):
    """The clock stands still, and digests are in no order of time."""
    for version in range(3):
        batch = [(f"k{i}", "n", float(version)) for i in range(40)]
        ingest_snapshot(spark, snapshot(spark, batch), layers, "id", clock)
    refresh_current(spark, layers, clock)
    assert rows(CurrentTable(spark, layers.current).read(), "price") == [(2.0,)] * 40


def test_a_snapshot_with_a_clock_loses_no_rows(spark, layers, clock):
    def moving(first, last):
        return spark.range(first, last).selectExpr("string(id) AS id", "current_timestamp() AS at", "rand() AS r")

    ingest_snapshot(spark, moving(0, 20), layers, "id", clock)
    record = ingest_snapshot(spark, moving(20, 40), layers, "id", clock)
    assert (record["status"], record["records_processed"]) == (N.SUCCEEDED, "20")
    assert HistoryTable(spark, layers.history).read().count() == 40


def test_no_column_is_dropped_unless_named(spark, layers, clock):
    frame = spark.createDataFrame([("a", 1.5)], "id string, roi double")
    ingest_snapshot(spark, frame, layers, "id", clock)
    assert rows(HistoryTable(spark, layers.history).read(), "roi") == [(1.5,)]


def landed_array(path, records):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(json.dumps(records))
    return str(path)


def test_one_bad_object_of_a_hundred_is_quarantined(spark, layers, clock, tmp_path):
    records = [{"id": f"k{i}", "name": "n", "price": float(i)} for i in range(100)]
    records[42]["price"] = "a lot"
    path = landed_array(tmp_path / "coins.json", records)
    with pytest.raises(Exception, match="(?i)malformed"):
        ingest_snapshot(spark, path, layers, "id", clock, schema=SCHEMA)
    clock.at += timedelta(minutes=1)
    record = ingest_snapshot(spark, path, layers, "id", clock, schema=SCHEMA, bad_records="quarantine")
    assert (record["status"], record["records_processed"]) == (N.SUCCEEDED, "99")
    assert record["msg_erro"] == f"1 bad records in {layers.quarantine}"
    bad = AppendTable(spark, layers.quarantine).read()
    assert bad.columns == [BAD_RECORD, *N.RUN_COLUMNS]
    row = bad.first()
    assert json.loads(row[BAD_RECORD]) == records[42]
    assert row[N.RUN_ID] == record[N.LOG_ID] and row[N.SOURCE_NAME].endswith("/coins.json")
    clock.at += timedelta(minutes=1)
    clean = landed_array(tmp_path / "clean.json", records[:42])
    again = ingest_snapshot(spark, clean, layers, "id", clock, schema=SCHEMA, bad_records="quarantine")
    assert (again["records_processed"], again["msg_erro"]) == ("0", "")
    assert bad.count() == 1
    with pytest.raises(ValueError, match="bad_records"):
        ingest_snapshot(spark, path, layers, "id", clock, bad_records="drop")


def test_without_a_schema_a_bad_value_makes_no_column_of_strings(spark, layers, clock, tmp_path):
    first = landed_array(tmp_path / "1.json", [{"id": "a", "price": 1.5}, {"id": "b", "price": 2.5}])
    second = landed_array(tmp_path / "2.json", [{"id": "a", "price": 3.5}, {"id": "b", "price": "x"}])
    for path in (first, second):
        clock.at += timedelta(minutes=1)
        ingest_snapshot(spark, path, layers, "id", clock, bad_records="quarantine")
    assert rows(HistoryTable(spark, layers.history).read(), "id", "price") == [("a", 1.5), ("a", 3.5), ("b", 2.5)]
    assert AppendTable(spark, layers.quarantine).read().count() == 1


def test_prices_of_whole_units_become_fractions_and_keep_their_digests(spark, layers, clock, tmp_path):
    prices = [[1, 2, 3, None], [1.0, 2.5, 3.0, None], [1.0, 2.5, 4.0, 7.0]]
    added = []
    for number, snapshot_ in enumerate(prices):
        clock.at += timedelta(days=1)
        records = [{"id": f"k{i}", "price": p} for i, p in enumerate(snapshot_)]
        path = landed_array(tmp_path / f"{number}.json", records)
        added.append(ingest_snapshot(spark, path, layers, "id", clock)["records_processed"])
        refresh_current(spark, layers, clock)
    assert added == ["4", "1", "2"]
    current = CurrentTable(spark, layers.current).read()
    assert dict(current.dtypes)["price"] == "double"
    assert rows(current, "id", "price") == [("K0", 1.0), ("K1", 2.5), ("K2", 4.0), ("K3", 7.0)]


def test_a_run_that_fails_leaves_no_work_folder(spark, layers, clock, monkeypatch):
    run_chain(spark, [snapshot(spark, coins(range(3)))], layers, "id", clock)
    clock.at += timedelta(days=1)
    ingest_snapshot(spark, snapshot(spark, coins(range(1, 4))), layers, "id", clock)
    shared = Path(spark.conf.get("spark.checkpoint.dir"))
    before = {p.name for p in shared.iterdir()}

    def broken(*_, **__):
        raise RuntimeError("no disk")

    monkeypatch.setattr(CurrentTable, "upsert", broken)
    with pytest.raises(RuntimeError, match="no disk"):
        refresh_current(spark, layers, clock)
    assert {p.name for p in shared.iterdir()} == before


def land_folder(spark, layers, name, data, files=3):
    """A snapshot of several files, moved into the landing folder whole."""
    stage = Path(layers.stage)
    stage.mkdir(parents=True, exist_ok=True)
    draft = stage.parent / f"draft-{name}"
    snapshot(spark, data).repartition(files, "id").write.json(str(draft))
    draft.rename(stage / name)


def follow_folders(spark, layers, clock, tmp_path):
    follow_landing(
        spark, layers, "id", SCHEMA, str(tmp_path / "stream"), clock, multi_line=False, snapshot_of=parent_folder
    ).awaitTermination()


def test_a_snapshot_of_several_files_is_one_release(spark, layers, clock, tmp_path):
    clock.step = timedelta(seconds=1)
    for number in range(3):
        land_folder(spark, layers, f"day-{number}", coins([number] * 9))
    follow_folders(spark, layers, clock, tmp_path)
    history, current = HistoryTable(spark, layers.history), CurrentTable(spark, layers.current)
    assert (history.last_release().release, current.last_release().release) == (3, 3)
    assert {r[0] for r in rows(current.read(), "price")} == {2.0}
    assert rows(read_run_log(spark, layers.ingest_log), "records_processed") == [("9",)] * 3
    land_folder(spark, layers, "day-3", coins([5] * 9))
    follow_folders(spark, layers, clock, tmp_path)
    assert (history.last_release().release, current.last_release().release) == (4, 4)


def test_a_batch_that_is_repeated_goes_on_where_it_stopped(spark, layers, clock, tmp_path, monkeypatch):
    clock.step = timedelta(seconds=1)
    for number in range(2):
        land_folder(spark, layers, f"day-{number}", coins([number] * 4))
    calls = []

    def failing(*args, **options):
        calls.append(args)
        if len(calls) == 2:
            raise RuntimeError("lost")
        return refresh_current(*args, **options)

    monkeypatch.setattr(landing, "refresh_current", failing)
    with pytest.raises(Exception, match="lost"):
        follow_folders(spark, layers, clock, tmp_path)
    history, current = HistoryTable(spark, layers.history), CurrentTable(spark, layers.current)
    assert (history.last_release().release, current.last_release().release) == (2, 1)
    follow_folders(spark, layers, clock, tmp_path)
    assert (history.last_release().release, current.last_release().release) == (2, 2)
    assert rows(read_run_log(spark, layers.ingest_log), "records_processed") == [("4",)] * 2
    assert {r[0] for r in rows(current.read(), "price")} == {1.0}
