"""Inputs that several registered queries share, and their SQL."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.catalog.registry import StagedClock, table
from tidemark.functions import fingerprint
from tidemark.operators import latest_per_key
from tidemark.plans import Layers, run_chain
from tidemark.session import new_work_path, written

# ---------------------------------------------------------------------------
# Entity snapshots: the newest event of each (user, type) as of a moment. The
# last snapshot sees every event.
# ---------------------------------------------------------------------------
SNAPSHOT_KEYS = "user_id,event_type"
SNAPSHOT_SCHEMA = (
    "event_id bigint, event_type string, props string, ts string, user_id bigint, value double"
)
SNAPSHOT_ENDS = ("2024-01-05", "2024-01-15", "9999-12-31")
SNAPSHOT_DAYS = (datetime(2024, 1, 5, 10), datetime(2024, 1, 15, 10), datetime(2024, 2, 1, 10))


def snapshots(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    events = table(spark, sf_dir, "events")
    columns = ["event_id", "event_type", "props", "ts", "user_id", "value"]
    return [
        latest_per_key(
            events.filter(F.col("ts") < F.lit(end).cast("timestamp_ntz")),
            ["user_id", "event_type"],
            "ts",
            ["event_id"],
        )
        .withColumn("ts", F.col("ts").cast("string"))
        .select(columns)
        for end in SNAPSHOT_ENDS
    ]


def write_json_arrays(df: DataFrame, unique_id: str, path: str, per_array: int = 1000) -> str:
    """Land ``df`` as files that each hold one JSON array of near ``per_array`` rows."""
    arrays = df.count() // per_array + 1
    packed = df.groupBy(F.pmod(F.xxhash64(unique_id), F.lit(arrays)).alias("slice")).agg(
        F.to_json(F.collect_list(F.struct(*df.columns))).alias("value")
    )
    packed.write.option("maxRecordsPerFile", 1).partitionBy("slice").text(path)
    return f"{path}/slice=*"


def run_snapshots(
    spark: SparkSession,
    sf_dir: str,
    label: str,
    incremental: bool = True,
    files: bool = False,
    days: tuple[datetime, ...] = SNAPSHOT_DAYS,
) -> Layers:
    """Run the chain over the three snapshots, from frames or from files of JSON arrays."""
    root = new_work_path(spark, label)
    layers = Layers.under(root, "events")
    clock = StagedClock(days[0])

    def arriving() -> Iterator[DataFrame | str]:
        for number, (day, snapshot) in enumerate(
            zip(days, snapshots(spark, sf_dir), strict=True)
        ):
            clock.at = day
            if files:
                yield write_json_arrays(snapshot, "event_id", f"{layers.stage}/{number}")
            else:
                yield snapshot

    options = {"schema": SNAPSHOT_SCHEMA} if files else {}
    run_chain(spark, arriving(), layers, SNAPSHOT_KEYS, clock, incremental, **options)
    return layers


def without_root(layers: Layers, column: str) -> F.Column:
    """Paths as they are below the work folder, which differs from run to run."""
    root = layers.stage.removesuffix("/1-stage/events")
    return F.replace(F.col(column), F.lit(root), F.lit("")).alias(column)


# Snapshots, then every distinct row with the first snapshot that has it, then
# the newest row of each key.
SNAPSHOTS_SQL = """
snapshot AS (
  SELECT 1 AS n, * FROM events WHERE ts < TIMESTAMP '2024-01-05'
  QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1
  UNION ALL
  SELECT 2 AS n, * FROM events WHERE ts < TIMESTAMP '2024-01-15'
  QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1
  UNION ALL
  SELECT 3 AS n, * FROM events
  QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1
),
staged AS (
  SELECT n, event_id, event_type, props, CAST(ts AS VARCHAR) AS ts, user_id, value,
         sha256(concat_ws('||', user_id, event_type)) AS hash_chave,
         sha256(concat_ws('||', event_id, event_type, props, CAST(ts AS VARCHAR), user_id, value))
           AS hash_columns,
         CASE n WHEN 1 THEN '20240105_100000' WHEN 2 THEN '20240115_100000'
                ELSE '20240201_100000' END AS stamp,
         CASE n WHEN 1 THEN '2024-01-05' WHEN 2 THEN '2024-01-15' ELSE '2024-02-01' END AS day
  FROM snapshot
),
history AS (
  SELECT * FROM staged QUALIFY n = min(n) OVER (PARTITION BY hash_columns)
),
versions AS (
  SELECT *, row_number() OVER (PARTITION BY hash_chave ORDER BY n DESC) AS age FROM history
)
"""

# ---------------------------------------------------------------------------
# Merge inputs: orders keyed by customer and priority. The current table is the
# newest order of each key before 1998, the new state that of all orders.
# ---------------------------------------------------------------------------
ORDER_KEYS = ["o_custkey", "o_orderpriority"]


def keyed_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return orders.withColumns(
        {"hash_chave": fingerprint(ORDER_KEYS), "hash_columns": fingerprint(orders.columns)}
    )


def order_states(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The current table and the newest state, both stored."""
    orders = keyed_orders(spark, sf_dir)

    def newest(df: DataFrame) -> DataFrame:
        return latest_per_key(df, "hash_chave", "o_orderdate", ["o_orderkey"])

    early = orders.filter(F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz"))
    return tuple(
        written(newest(df), new_work_path(spark, name)) for df, name in ((early, "current"), (orders, "latest"))
    )


ORDER_STATES_SQL = """
keyed AS (
  SELECT *, sha256(concat_ws('||', o_custkey, o_orderpriority)) AS hash_chave,
         sha256(concat_ws('||', o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
                          o_orderpriority)) AS hash_columns
  FROM orders
),
current AS (
  SELECT * FROM keyed WHERE o_orderdate < TIMESTAMP '1998-01-01'
  QUALIFY row_number() OVER (PARTITION BY hash_chave ORDER BY o_orderdate DESC, o_orderkey DESC) = 1
),
latest AS (
  SELECT * FROM keyed
  QUALIFY row_number() OVER (PARTITION BY hash_chave ORDER BY o_orderdate DESC, o_orderkey DESC) = 1
),
changed AS (
  SELECT * FROM latest WHERE hash_columns NOT IN (SELECT hash_columns FROM current)
)
"""
