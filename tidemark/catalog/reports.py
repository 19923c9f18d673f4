"""Reports: daily variation, rankings, indicators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import names as N
from tidemark.catalog.registry import query, table
from tidemark.operators import latest_per_key
from tidemark.plans import gold
from tidemark.session import new_work_path, written
from tidemark.sources import CurrentTable, HistoryTable


DAILY_SQL = """
WITH days AS (
  SELECT event_type, CAST(ts AS DATE) AS day, arg_min(value, (ts, event_id)) AS opened,
         arg_max(value, (ts, event_id)) AS closed, min(value) AS lowest, max(value) AS highest,
         count(*) AS readings
  FROM events GROUP BY ALL
)
SELECT *, closed - opened AS change_in_day,
       closed - lag(closed) OVER w AS change_from_previous,
       (closed - lag(closed) OVER w) / nullif(lag(closed) OVER w, 0) AS relative_change
FROM days WINDOW w AS (PARTITION BY event_type ORDER BY day)
"""


@query(DAILY_SQL)
def daily_variation(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return gold.daily_variation(events, ["event_type"], "ts", "value", ["event_id"])


@query(DAILY_SQL)
def daily_variation_refreshed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same kept up to date: three releases that all touch every day, a refresh after
    each, which reads the new release alone and merges it into the stored days."""
    root = new_work_path(spark, "daily")
    history, states = HistoryTable(spark, f"{root}/history"), CurrentTable(spark, f"{root}/states")
    events = table(spark, sf_dir, "events").withColumn(N.INGESTED_ON, F.lit("2024-02-01"))
    for turn in range(3):
        history.append(events.where(F.col("event_id") % 3 == turn))
        gold.refresh_daily_states(history, states, ["event_type"], "ts", "value", ["event_id"])
    return gold.variation_of_states(states.read(), ["event_type"])


LATEST_ORDER_SQL = """
latest AS (
  SELECT * FROM orders
  QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1
)
"""


def _latest_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_per_key(
        table(spark, sf_dir, "orders"), "o_custkey", "o_orderdate", ["o_orderkey"]
    )


@query(f"""
WITH {LATEST_ORDER_SQL}
SELECT o_custkey, o_totalprice, rank() OVER (ORDER BY o_totalprice DESC) AS rank,
       dense_rank() OVER (ORDER BY o_totalprice DESC) AS dense_rank
FROM latest
""")
def rank_by_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    latest = _latest_orders(spark, sf_dir).select("o_custkey", "o_totalprice")
    # Written, since ranking looks at its input twice.
    return gold.rank_by_value(written(latest, new_work_path(spark, "latest")), "o_totalprice")


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, l_quantity,
       rank() OVER (ORDER BY l_quantity DESC) AS rank,
       dense_rank() OVER (ORDER BY l_quantity DESC) AS dense_rank
FROM lineitem
""")
def rank_with_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Few distinct values, each held by many rows."""
    lines = table(spark, sf_dir, "lineitem")
    return gold.rank_by_value(
        lines.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity"), "l_quantity"
    )


@query("""
WITH priced AS (
  SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber % 2 = 0 THEN NULL WHEN l_orderkey % 3 = 0 THEN 30000.0
         ELSE l_extendedprice END::DOUBLE AS price FROM lineitem
)
SELECT *, CASE WHEN price IS NOT NULL THEN rank() OVER (ORDER BY price DESC NULLS LAST) END AS rank,
       CASE WHEN price IS NOT NULL THEN dense_rank() OVER (ORDER BY price DESC NULLS LAST) END AS dense_rank
FROM priced
""")
def rank_with_hot_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the rows without a value, and one value on a third of the others."""
    price = F.when(F.col("l_linenumber") % 2 == 0, None).when(F.col("l_orderkey") % 3 == 0, 30000.0)
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", price.otherwise(F.col("l_extendedprice")).cast("double").alias("price")
    )
    return gold.rank_by_value(lines, "price")


@query(f"""
WITH {LATEST_ORDER_SQL}
SELECT o_custkey, o_totalprice,
       CAST(row_number() OVER (ORDER BY o_totalprice DESC, o_custkey) AS INTEGER) AS position
FROM latest ORDER BY o_totalprice DESC, o_custkey LIMIT 10
""")
def top_by_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    latest = _latest_orders(spark, sf_dir).select("o_custkey", "o_totalprice")
    return gold.top_by_value(latest, "o_totalprice", 10, ["o_custkey"])


@query("""
WITH groups AS (
  SELECT c_mktsegment, count(*) AS members, sum(CAST(c_acctbal AS DECIMAL(18, 2))) AS total,
         min(c_acctbal) AS lowest, max(c_acctbal) AS highest
  FROM customer GROUP BY c_mktsegment
)
SELECT c_mktsegment, members, CAST(total AS DOUBLE) AS total, lowest, highest,
       CAST(total AS DOUBLE) / members AS mean,
       CAST(total AS DOUBLE) / (SELECT CAST(sum(total) AS DOUBLE) FROM groups) AS share
FROM groups
""")
def segment_indicators(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Money as decimals: their sum does not depend on the order of the rows.
    customers = table(spark, sf_dir, "customer").withColumn(
        "c_acctbal", F.col("c_acctbal").cast("decimal(18, 2)")
    )
    found = gold.segment_indicators(customers, "c_mktsegment", "c_acctbal")
    exact = {c: F.col(c).cast("double") for c in ("total", "lowest", "highest")}
    return found.withColumns(exact)
