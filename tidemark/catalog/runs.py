"""The jobs from end to end, and their audit."""

from __future__ import annotations

from contextlib import suppress
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark import names as N
from tidemark.catalog.registry import StagedClock, query, table
from tidemark.catalog.scenarios import (
    SNAPSHOT_DAYS,
    SNAPSHOT_KEYS,
    SNAPSHOT_SCHEMA,
    SNAPSHOTS_SQL,
    run_snapshots,
    snapshots,
    without_root,
    write_json_arrays,
)
from tidemark.operators import RunContext, latest_per_key, lineage
from tidemark.plans import (
    Layers,
    audited,
    ingest_record,
    ingest_snapshot,
    read_run_log,
    run_chain,
    typed_run_log,
)
from tidemark.session import new_work_path
from tidemark.sources import BAD_RECORD, AppendTable, CurrentTable, HistoryTable
from tidemark.streaming import follow_landing, parent_folder


@query(f"""
WITH {SNAPSHOTS_SQL}
SELECT event_id, event_type, props, ts, user_id, value,
       '/5-logs/1-bronze/events_' || stamp AS key_log_file_path, day || ' 10:00:00' AS dt_atualizacao,
       day AS dt_ingestao, '/1-stage/events' AS nm_arquivo_origem, hash_chave, hash_columns
FROM history
""")
def bronze_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    layers = run_snapshots(spark, sf_dir, "history")
    history = HistoryTable(spark, layers.history).read()
    paths = {c: without_root(layers, c) for c in (N.RUN_ID, N.SOURCE_NAME)}
    return history.withColumns(paths)


CURRENT_SQL = f"""
WITH {SNAPSHOTS_SQL}
SELECT event_id, upper(event_type) AS event_type, upper(props) AS props, ts, user_id, value,
       hash_chave, hash_columns, '/5-logs/2-silver/events_' || stamp AS key_log_file_path,
       day || ' 10:00:00' AS dt_atualizacao, day AS dt_ingestao,
       '/2-bronze/events' AS nm_arquivo_origem
FROM versions WHERE age = 1
"""


def _current(spark: SparkSession, layers: Layers) -> DataFrame:
    current = CurrentTable(spark, layers.current).read()
    paths = {c: without_root(layers, c) for c in (N.RUN_ID, N.SOURCE_NAME)}
    return current.withColumns(paths)


@query(CURRENT_SQL)
def silver_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every refresh reads the whole history."""
    return _current(spark, run_snapshots(spark, sf_dir, "current", incremental=False))


@query(CURRENT_SQL)
def end_to_end_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From landed JSON files, with refreshes that read only the new days."""
    return _current(spark, run_snapshots(spark, sf_dir, "chain", files=True))


@query(f"""
SELECT * REPLACE ('/5-logs/2-silver/events_20240105_100000' AS key_log_file_path,
                  '2024-01-05 10:00:00' AS dt_atualizacao, '2024-01-05' AS dt_ingestao)
FROM ({CURRENT_SQL})
""")
def same_second_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshots of one second: the later ingested one holds the newest versions."""
    days = SNAPSHOT_DAYS[:1] * len(SNAPSHOT_DAYS)
    return _current(spark, run_snapshots(spark, sf_dir, "second", incremental=False, days=days))


@query("""
SELECT event_id, event_type, props, CAST(ts AS VARCHAR) AS ts, user_id, value
FROM events WHERE ts < TIMESTAMP '2024-01-15'
UNION
SELECT event_id, event_type, props, CAST(ts AS VARCHAR), user_id, floor(value) FROM events
""")
def scan_json_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A column of fractions that arrives with whole numbers only, without a schema."""
    layers = Layers.under(new_work_path(spark, "drift"), "events")
    events = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("string"))
    early = events.filter(F.col("ts") < "2024-01-15")
    whole = events.withColumn("value", F.floor("value"))
    for number, snapshot in enumerate((early, whole)):
        landed = write_json_arrays(snapshot, "event_id", f"{layers.stage}/{number}")
        clock = StagedClock(SNAPSHOT_DAYS[number])
        ingest_snapshot(spark, landed, layers, "event_id", clock)
    history = HistoryTable(spark, layers.history).read()
    return history.select("event_id", "event_type", "props", "ts", "user_id", "value")


@query("""
SELECT event_id, event_type, props, CAST(ts AS VARCHAR) AS ts, user_id, floor(value) AS value
FROM events WHERE ts < TIMESTAMP '2024-01-15'
UNION
SELECT event_id, event_type, props, CAST(ts AS VARCHAR), user_id, value FROM events
""")
def scan_json_widened(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A column of whole numbers to which fractions arrive: it becomes one of doubles, and
    rows whose number was whole already are known."""
    layers = Layers.under(new_work_path(spark, "widened"), "events")
    events = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("string"))
    whole = events.filter(F.col("ts") < "2024-01-15").withColumn("value", F.floor("value"))
    for number, snapshot in enumerate((whole, events)):
        landed = write_json_arrays(snapshot, "event_id", f"{layers.stage}/{number}")
        ingest_snapshot(spark, landed, layers, "event_id", StagedClock(SNAPSHOT_DAYS[number]))
    history = HistoryTable(spark, layers.history).read()
    return history.select("event_id", "event_type", "props", "ts", "user_id", "value")


@query("""
SELECT event_id, CASE WHEN event_id % 100 = 7 THEN 'quarantine' WHEN event_id % 100 = 8 THEN 'broken'
       ELSE 'history' END AS kept_in,
       CASE WHEN event_id % 100 IN (7, 8) THEN NULL ELSE value END AS value,
       (SELECT count(*) FILTER (WHERE event_id % 100 IN (7, 8)) FROM events) AS bad_records,
       '2024-01-05' AS dt_ingestao
FROM events
""")
def scan_json_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshot lines of which some hold a word for a number and some break off: all good
    records reach the history, the text of the others the quarantine."""
    layers = Layers.under(new_work_path(spark, "quarantine"), "events")
    events = table(spark, sf_dir, "events").select("event_id", "value")
    line = F.to_json(F.struct("event_id", "value"))
    turn = F.col("event_id") % 100
    worded = F.to_json(F.struct("event_id", F.lit("n/a").alias("value")))
    landed = F.when(turn == 7, worded).when(turn == 8, F.substring_index(line, "}", 1)).otherwise(line)
    events.select(landed.alias("value")).write.text(layers.stage)
    ingest_snapshot(
        spark, layers.stage, layers, "event_id", StagedClock(SNAPSHOT_DAYS[0]),
        "event_id bigint, value double", multi_line=False, bad_records="quarantine",
    )
    note = read_run_log(spark, layers.ingest_log).select("msg_erro").scalar()
    told = F.regexp_extract(note, "^[0-9]+", 0).cast("long").alias("bad_records")
    good = HistoryTable(spark, layers.history).read().select(
        "event_id", F.lit("history").alias("kept_in"), "value", told, N.INGESTED_ON
    )
    text = F.col(BAD_RECORD)
    bad = AppendTable(spark, layers.quarantine).read().select(
        F.regexp_extract(text, '"event_id":([0-9]+)', 1).cast("long").alias("event_id"),
        F.when(F.endswith(text, F.lit("}")), "quarantine").otherwise("broken").alias("kept_in"),
        F.lit(None).cast("double").alias("value"),
        told,
        N.INGESTED_ON,
    )
    return good.unionByName(bad)


@query(f"""
WITH {SNAPSHOTS_SQL},
run AS (SELECT *, printf('%02d', 24 * n - 13) AS seconds FROM versions WHERE age = 1)
SELECT event_id, upper(event_type) AS event_type, upper(props) AS props, ts, user_id, value,
       hash_chave, hash_columns,
       '/5-logs/2-silver/events_20240105_1000' || seconds AS key_log_file_path,
       '2024-01-05 10:00:' || seconds AS dt_atualizacao, '2024-01-05' AS dt_ingestao,
       '/2-bronze/events' AS nm_arquivo_origem, 3 AS releases
FROM run
""")
def landing_stream_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three snapshots of several files each, landed before the stream looks: as many
    releases of the current table. The clock goes on by a second with each look, of which
    an ingest and a refresh take 24."""
    root = new_work_path(spark, "landing-folders")
    layers = Layers.under(root, "events")
    for number, snapshot in enumerate(snapshots(spark, sf_dir)):
        snapshot.repartition(4).write.json(f"{layers.stage}/{number}")
    follow_landing(
        spark, layers, SNAPSHOT_KEYS, SNAPSHOT_SCHEMA, f"{root}/stream",
        StagedClock(SNAPSHOT_DAYS[0], timedelta(seconds=1)), multi_line=False,
        snapshot_of=parent_folder,
    ).awaitTermination()
    releases = CurrentTable(spark, layers.current).last_release().release
    return _current(spark, layers).withColumn("releases", F.lit(releases))


@query(CURRENT_SQL)
def landing_stream_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same table when a file stream picks the snapshots up."""
    root = new_work_path(spark, "landing-stream")
    layers = Layers.under(root, "events")
    clock = StagedClock(SNAPSHOT_DAYS[0])
    for day, snapshot in zip(SNAPSHOT_DAYS, snapshots(spark, sf_dir), strict=True):
        clock.at = day
        snapshot.write.mode("append").json(layers.stage)
        follow_landing(
            spark,
            layers,
            SNAPSHOT_KEYS,
            SNAPSHOT_SCHEMA,
            f"{root}/stream",
            clock,
            multi_line=False,
            files_per_batch=1000,
        ).awaitTermination()
    return _current(spark, layers)


def _timed_runs(spark: SparkSession, sf_dir: str) -> Layers:
    layers = Layers.under(new_work_path(spark, "audit"), "events")
    clock = StagedClock(SNAPSHOT_DAYS[0], timedelta(seconds=1))
    run_chain(spark, [table(spark, sf_dir, "events")], layers, "event_id", clock)
    return layers


@query("""
SELECT '/5-logs/1-bronze/events_20240105_100001' AS id_log_file_path,
       'BRONZE_LOG_events' AS process_name, '/1-stage/events' AS input_path,
       '/2-bronze/events' AS output_path, CAST(count(*) AS VARCHAR) AS records_processed,
       'SUCESSO' AS status, '' AS msg_erro,
       '2024-01-05 10:00:01' AS start_time_script,
       '2024-01-05 10:00:02' AS start_create_session,
       '2024-01-05 10:00:03' AS end_create_session,
       '2024-01-05 10:00:04' AS start_reading_file,
       '2024-01-05 10:00:05' AS end_reading_file,
       '2024-01-05 10:00:06' AS start_add_control_columns,
       '2024-01-05 10:00:07' AS end_add_control_columns,
       '2024-01-05 10:00:08' AS start_merge_delta,
       '2024-01-05 10:00:09' AS end_merge_delta,
       '2024-01-05 10:00:10' AS end_time_script
FROM events
""")
def run_log_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every column of an ingest run; the clock goes on by a second with each look."""
    layers = _timed_runs(spark, sf_dir)
    log = read_run_log(spark, layers.ingest_log)
    return log.withColumns(
        {c: without_root(layers, c) for c in (N.LOG_ID, "input_path", "output_path")}
    )


@query("""
SELECT '/5-logs/2-silver/events_20240105_100011' AS id_log_file_path,
       'SILVER_LOG_events' AS process_name, '2024-01-05' AS date_run, 'SUCESSO' AS status,
       'EXECUTADO COM SUCESSO' AS msg, '/2-bronze/events' AS input_path,
       '/3-silver/events' AS output_path, CAST(count(*) AS VARCHAR) AS records_inserted,
       '0' AS records_updated,
       '2024-01-05 10:00:11' AS start_time_script,
       '2024-01-05 10:00:12' AS start_bronze_reading,
       '2024-01-05 10:00:13' AS end_bronze_reading,
       '2024-01-05 10:00:14' AS start_filter_data,
       '2024-01-05 10:00:15' AS end_filter_data,
       '2024-01-05 10:00:16' AS start_filter_new_data,
       '2024-01-05 10:00:17' AS end_filter_new_data,
       '2024-01-05 10:00:18' AS start_transform_strings,
       '2024-01-05 10:00:19' AS end_transform_strings,
       '2024-01-05 10:00:20' AS start_add_column_log,
       '2024-01-05 10:00:21' AS end_add_column_log,
       '2024-01-05 10:00:22' AS start_update_delta_silver,
       '2024-01-05 10:00:23' AS end_update_delta_silver,
       '2024-01-05 10:00:24' AS end_time_script
FROM events
""")
def refresh_log_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every column of a refresh run, with the same clock."""
    layers = _timed_runs(spark, sf_dir)
    log = read_run_log(spark, layers.refresh_log)
    return log.withColumns(
        {c: without_root(layers, c) for c in (N.LOG_ID, "input_path", "output_path")}
    )


@query("""
SELECT 1 AS run, 'SUCESSO' AS status, CAST(count(*) AS VARCHAR) AS records_processed,
       '' AS msg_erro FROM orders
UNION ALL
SELECT 2, 'IGNORADO', '0', 'there already is a table at /2-bronze/events'
UNION ALL
SELECT 3, 'ERRO', '0', 'snapshot has no column [''o_customer'']; it has [''o_orderkey'', '
       || '''o_custkey'', ''o_orderstatus'', ''o_totalprice'', ''o_orderdate'', ''o_orderpriority'']'
FROM orders HAVING count(*) > 0
""")
def run_statuses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run that succeeds, one that finds its work done, and one that fails."""
    orders = table(spark, sf_dir, "orders")
    layers = Layers.under(new_work_path(spark, "statuses"), "events")
    history = AppendTable(spark, layers.history)
    for day in SNAPSHOT_DAYS[:2]:
        run = RunContext(layers.process, layers.ingest_log, StagedClock(day))
        with audited(spark, ingest_record(run, "orders", layers.history)) as record:
            record.update(records_processed=history.create(orders))
    with suppress(ValueError):
        ingest_snapshot(spark, orders, layers, "o_customer", StagedClock(SNAPSHOT_DAYS[2]))
    log = read_run_log(spark, layers.ingest_log)
    run_number = F.row_number().over(Window.orderBy("start_time_script"))
    return log.select(
        run_number.alias("run"),
        "status",
        "records_processed",
        without_root(layers, "msg_erro"),
    )


@query(f"""
WITH {SNAPSHOTS_SQL},
runs AS (
  SELECT n, stamp, day, count(*) AS changed,
         count(*) FILTER (WHERE NOT EXISTS (
           SELECT 1 FROM history e WHERE e.hash_chave = h.hash_chave AND e.n < h.n)) AS inserted
  FROM history h GROUP BY n, stamp, day
)
SELECT '/5-logs/2-silver/events_' || stamp AS id_log_file_path, 'SILVER_LOG_events' AS process_name,
       day AS date_run, 'SUCESSO' AS status, 'EXECUTADO COM SUCESSO' AS msg,
       '/2-bronze/events' AS input_path, '/3-silver/events' AS output_path,
       CAST(inserted AS VARCHAR) AS records_inserted,
       CAST(changed - inserted AS VARCHAR) AS records_updated,
       day || ' 10:00:00' AS start_bronze_reading,
       day || ' 10:00:00' AS end_update_delta_silver
FROM runs
""")
def run_log_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    layers = run_snapshots(spark, sf_dir, "audit")
    log = read_run_log(spark, layers.refresh_log)
    return log.select(
        without_root(layers, N.LOG_ID),
        "process_name",
        "date_run",
        "status",
        "msg",
        without_root(layers, "input_path"),
        without_root(layers, "output_path"),
        "records_inserted",
        "records_updated",
        "start_bronze_reading",
        "end_update_delta_silver",
    )


@query(f"""
WITH {SNAPSHOTS_SQL},
runs AS (
  SELECT n, stamp, day, count(*) AS changed,
         count(*) FILTER (WHERE NOT EXISTS (
           SELECT 1 FROM history e WHERE e.hash_chave = h.hash_chave AND e.n < h.n)) AS inserted
  FROM history h GROUP BY n, stamp, day
)
SELECT '/5-logs/2-silver/events_' || stamp AS id_log_file_path, 'SILVER_LOG_events' AS process_name,
       CAST(day AS DATE) AS date_run, 'SUCESSO' AS status, 'EXECUTADO COM SUCESSO' AS msg,
       '/2-bronze/events' AS input_path, '/3-silver/events' AS output_path,
       inserted AS records_inserted, changed - inserted AS records_updated,
       {", ".join(f"CAST(day || ' 10:00:00' AS TIMESTAMP) AS {c}" for c in N.REFRESH_LOG_COLUMNS
                  if c.startswith(("start_", "end_")))}
FROM runs
""")
def typed_log_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every column of the refresh log in its own type; the clock stands still in each run."""
    layers = run_snapshots(spark, sf_dir, "typed-audit")
    log = typed_run_log(read_run_log(spark, layers.refresh_log))
    paths = {c: without_root(layers, c) for c in (N.LOG_ID, "input_path", "output_path")}
    return log.withColumns(paths)


LINEAGE_SQL = f"""
WITH {SNAPSHOTS_SQL}
SELECT hash_columns, '/5-logs/1-bronze/events_' || stamp AS id_log_file_path,
       'BRONZE_LOG_events' AS process_name, 'SUCESSO' AS status,
       CAST(count(*) OVER (PARTITION BY n) AS VARCHAR) AS records_processed
FROM history
"""


@query(LINEAGE_SQL)
def lineage_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with runs of more than a hundred rows dealt out over tasks."""
    return _traced(run_snapshots(spark, sf_dir, "lineage-split"), spark, 100)


@query(LINEAGE_SQL)
def lineage_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each row of the history with the audit of the run that wrote it."""
    return _traced(run_snapshots(spark, sf_dir, "lineage"), spark)


def _traced(layers: Layers, spark: SparkSession, *split_rows: int) -> DataFrame:
    history = HistoryTable(spark, layers.history).read()
    traced = lineage(history, read_run_log(spark, layers.ingest_log), *split_rows)
    return traced.select(
        N.ROW_HASH,
        without_root(layers, N.LOG_ID),
        "process_name",
        "status",
        "records_processed",
    )


RETURNING_STATES_SQL = """
snapshot AS (
  SELECT 1 AS n, user_id, event_type FROM events WHERE ts < TIMESTAMP '2024-01-10'
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1
  UNION ALL
  SELECT 2, user_id, event_type FROM events WHERE ts < TIMESTAMP '2024-01-20'
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1
  UNION ALL
  SELECT 3, user_id, event_type FROM events
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1
)
"""


def _returning_states(spark: SparkSession, sf_dir: str, compare: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    layers = Layers.under(new_work_path(spark, "states"), "events")
    for number, end in enumerate(("2024-01-10", "2024-01-20", "9999-12-31"), start=1):
        before = events.filter(F.col("ts") < F.lit(end).cast("timestamp_ntz"))
        state = latest_per_key(before, "user_id", "ts", ["event_id"]).select(
            "user_id", "event_type"
        )
        clock = StagedClock(SNAPSHOT_DAYS[number - 1])
        ingest_snapshot(spark, state, layers, "user_id", clock, compare=compare)
    history = HistoryTable(spark, layers.history).read()
    return history.select("user_id", "event_type", N.INGESTED_ON)


@query(f"""
WITH {RETURNING_STATES_SQL}
SELECT user_id, event_type,
       CASE min(n) WHEN 1 THEN '2024-01-05' WHEN 2 THEN '2024-01-15' ELSE '2024-02-01' END
         AS dt_ingestao
FROM snapshot GROUP BY user_id, event_type
""")
def returning_state_known(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A state seen before, however long ago, is not recorded again."""
    return _returning_states(spark, sf_dir, "history")


@query(f"""
WITH {RETURNING_STATES_SQL}
SELECT user_id, event_type,
       CASE n WHEN 1 THEN '2024-01-05' WHEN 2 THEN '2024-01-15' ELSE '2024-02-01' END AS dt_ingestao
FROM snapshot
QUALIFY event_type IS DISTINCT FROM lag(event_type) OVER (PARTITION BY user_id ORDER BY n)
""")
def returning_state_recorded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Compared with the newest version only, every change is recorded."""
    return _returning_states(spark, sf_dir, "latest")
