"""Scans and sinks: JSON snapshots and stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import names as N
from tidemark.catalog.registry import query, table
from tidemark.catalog.scenarios import write_json_arrays
from tidemark.functions import fingerprint
from tidemark.session import new_work_path
from tidemark.sources import (
    AppendTable,
    CurrentTable,
    HistoryTable,
    literal_table as rows_table,
    read_json_snapshot,
)


@query("""
SELECT event_id, event_type, props, CAST(ts AS VARCHAR) AS ts, user_id, value FROM events
""")
def scan_json_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_work_path(spark, "landing")
    events = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("string"))
    nested = events.withColumn("roi", F.struct(F.col("value").alias("times")))
    landed = write_json_arrays(nested, "event_id", path)
    schema = "event_id bigint, event_type string, props string, ts string, user_id bigint, value double"
    return read_json_snapshot(spark, landed, schema)


@query("""
SELECT c_acctbal, c_custkey, c_mktsegment, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey
FROM customer
""")
def scan_json_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Without a schema: columns in alphabetical order, nested ``roi`` dropped."""
    path = new_work_path(spark, "landing")
    customers = table(spark, sf_dir, "customer")
    nested = customers.withColumn("roi", F.struct(F.col("c_acctbal").alias("times")))
    landed = write_json_arrays(nested, "c_custkey", path)
    return read_json_snapshot(spark, landed, drop=("roi",))


@query("SELECT * FROM orders")
def scan_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = CurrentTable(spark, new_work_path(spark, "orders"))
    stored.overwrite(table(spark, sf_dir, "orders"))
    return stored.read()


@query("""
SELECT o.*, p.weight, p.label
FROM orders o JOIN (VALUES ('1-URGENT', 5, 'now'), ('2-HIGH', 4, 'soon'), ('3-MEDIUM', 3, 'soon'),
                           ('4-NOT SPECIFIED', 2, NULL), ('5-LOW', 1, 'later')) p(name, weight, label)
  ON o.o_orderpriority = p.name
""")
def literal_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A literal table with an explicit schema, joined to the orders it describes."""
    rows = [
        ("1-URGENT", 5, "now"),
        ("2-HIGH", 4, "soon"),
        ("3-MEDIUM", 3, "soon"),
        ("4-NOT SPECIFIED", 2, None),
        ("5-LOW", 1, "later"),
    ]
    priorities = rows_table(spark, rows, "name string, weight int, label string")
    orders = table(spark, sf_dir, "orders")
    # Five rows, written above.
    return orders.join(
        F.broadcast(priorities), orders.o_orderpriority == priorities.name
    ).drop("name")


@query("""
SELECT 1 AS load, FALSE AS existed, count(*) AS added FROM events WHERE ts < TIMESTAMP '2024-01-20'
UNION ALL
SELECT 2, TRUE, count(*) FROM events WHERE ts >= TIMESTAMP '2024-01-20'
""")
def first_load_vs_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The probe for the target decides: everything is loaded, then only what is new."""
    events = table(spark, sf_dir, "events")
    staged = events.withColumns(
        {N.ROW_HASH: fingerprint(events.columns), N.INGESTED_ON: F.lit("2024-02-01")}
    )
    history = HistoryTable(spark, new_work_path(spark, "events"))
    batches = (
        staged.filter(F.col("ts") < F.lit("2024-01-20").cast("timestamp_ntz")),
        staged.filter(F.col("ts") >= F.lit("2024-01-15").cast("timestamp_ntz")),
    )
    loads = [
        (number, history.exists(), history.insert_unseen(batch))
        for number, batch in enumerate(batches, start=1)
    ]
    return spark.createDataFrame(loads, "load int, existed boolean, added bigint")


@query("SELECT * FROM lineitem")
def append_first_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = AppendTable(spark, new_work_path(spark, "lineitem"))
    stored.append(table(spark, sf_dir, "lineitem"))
    return stored.read()


@query("""
SELECT c_custkey, c_name, c_nationkey, c_acctbal, upper(c_mktsegment) AS c_mktsegment,
       c_acctbal < 0 AS in_debt
FROM customer
""")
def overwrite_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table replaced by something computed from itself."""
    stored = CurrentTable(spark, new_work_path(spark, "customer"))
    stored.overwrite(table(spark, sf_dir, "customer"))
    before = stored.read()
    stored.overwrite(before.withColumn("in_debt", F.col("c_acctbal") < 0))
    return stored.read()


@query("""
SELECT c_custkey AS party, c_name AS name, CAST(NULL AS DOUBLE) AS balance FROM customer
UNION ALL
SELECT s_suppkey, s_name, s_acctbal FROM supplier
""")
def schema_evolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second append brings a column; earlier rows read as null there."""
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("party"), F.col("c_name").alias("name")
    )
    suppliers = table(spark, sf_dir, "supplier").select(
        F.col("s_acctbal").alias("balance"),
        F.col("s_suppkey").alias("party"),
        F.col("s_name").alias("name"),
    )
    stored = AppendTable(spark, new_work_path(spark, "parties"))
    stored.append(customers)
    stored.append(suppliers)
    return stored.read()
