"""Latest rows, change detection and merges."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.catalog.registry import query, table
from tidemark.catalog.scenarios import ORDER_STATES_SQL, order_states
from tidemark.functions import fingerprint
from tidemark.operators import (
    changed_rows as rows_that_changed,
    insert_only,
    latest_per_key as latest_rows,
    merge_actions as actions_of_merge,
    merge_metrics as metrics_of_merge,
    union_evolving,
    unseen_rows,
    upsert,
)


@query("""
SELECT * FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1
""")
def latest_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_rows(table(spark, sf_dir, "events"), "user_id", "ts", ["event_id"])


@query("""
SELECT * FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1
""")
def latest_order_per_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_rows(
        table(spark, sf_dir, "orders"), "o_custkey", "o_orderdate", ["o_orderkey"]
    )


@query(f"WITH {ORDER_STATES_SQL} SELECT * FROM changed")
def changed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    current, latest = order_states(spark, sf_dir)
    return rows_that_changed(latest, current)


def _event_batches(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """A history up to day 20, and a stage that starts on day 15."""
    events = table(spark, sf_dir, "events")
    hashed = events.withColumn("hash_columns", fingerprint(events.columns))
    until = hashed.filter(F.col("ts") < F.lit("2024-01-20").cast("timestamp_ntz"))
    since = hashed.filter(F.col("ts") >= F.lit("2024-01-15").cast("timestamp_ntz"))
    return until, since


@query("""
SELECT *, sha256(concat_ws('||', event_id, ts, user_id, event_type, value, props)) AS hash_columns,
       CASE WHEN ts < TIMESTAMP '2024-01-20' THEN 'history' ELSE 'stage' END AS origin
FROM events
""")
def merge_insert_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    history, stage = _event_batches(spark, sf_dir)
    return insert_only(
        history.withColumn("origin", F.lit("history")), stage.withColumn("origin", F.lit("stage"))
    )


@query("""
WITH hashed AS (
  SELECT d.*, sha256(concat_ws('||', text, lang, source)) AS hash_columns FROM documents d
)
SELECT * FROM hashed
WHERE hash_columns NOT IN (SELECT hash_columns FROM hashed JOIN labels USING (doc_id))
""")
def merge_insert_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents whose content no labelled document has; copies all stay."""
    documents = table(spark, sf_dir, "documents")
    hashed = documents.withColumn("hash_columns", fingerprint(["text", "lang", "source"]))
    labelled = hashed.join(table(spark, sf_dir, "labels").select("doc_id"), "doc_id", "left_semi")
    return unseen_rows(hashed, labelled)


@query("""
WITH hashed AS (
  SELECT sha256(concat_ws('||', text, lang, source)) AS hash_columns FROM documents
  WHERE doc_id NOT IN (SELECT doc_id FROM labels)
)
SELECT DISTINCT hash_columns FROM hashed WHERE hash_columns NOT IN (
  SELECT sha256(concat_ws('||', text, lang, source)) FROM documents JOIN labels USING (doc_id))
""")
def merge_insert_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with each content taken once."""
    documents = table(spark, sf_dir, "documents")
    hashed = documents.withColumn("hash_columns", fingerprint(["text", "lang", "source"]))
    labels = table(spark, sf_dir, "labels").select("doc_id")
    labelled = hashed.join(labels, "doc_id", "left_semi")
    others = hashed.join(labels, "doc_id", "left_anti")
    return unseen_rows(others, labelled, distinct=True).select("hash_columns")


@query("""
SELECT (SELECT count(*) FROM events WHERE ts < TIMESTAMP '2024-01-20') AS rows_before,
       (SELECT count(*) FROM events) AS rows_after,
       (SELECT count(*) FROM events WHERE ts >= TIMESTAMP '2024-01-20') AS records_processed
""")
def records_processed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows before and after an insert-only merge, and their difference, in one pass."""
    history, stage = _event_batches(spark, sf_dir)
    merged = union_evolving(
        history.select(F.lit(0).alias("added")),
        unseen_rows(stage, history).select(F.lit(1).alias("added")),
    )
    return merged.agg(
        (F.count(F.lit(1)) - F.sum("added")).alias("rows_before"),
        F.count(F.lit(1)).alias("rows_after"),
        F.sum("added").alias("records_processed"),
    )


@query(f"""
WITH {ORDER_STATES_SQL}
SELECT *, 'kept' AS origin FROM current
WHERE hash_chave NOT IN (SELECT hash_chave FROM changed)
UNION ALL
SELECT *, 'source' AS origin FROM changed
""")
def merge_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    current, latest = order_states(spark, sf_dir)
    changed = rows_that_changed(latest, current)
    return upsert(
        current.withColumn("origin", F.lit("kept")), changed.withColumn("origin", F.lit("source"))
    )


@query(f"""
WITH {ORDER_STATES_SQL}
SELECT coalesce(t.hash_chave, s.hash_chave) AS hash_chave,
       CASE WHEN t.hash_chave IS NULL THEN 'INSERT' WHEN s.hash_chave IS NULL THEN 'COPY'
            ELSE 'UPDATE' END AS action
FROM current t FULL JOIN changed s ON t.hash_chave = s.hash_chave
""")
def merge_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    current, latest = order_states(spark, sf_dir)
    return actions_of_merge(current, rows_that_changed(latest, current))


@query(f"""
WITH {ORDER_STATES_SQL}
SELECT count(s.hash_chave) AS source_rows,
       count(*) FILTER (WHERE t.hash_chave IS NULL) AS inserted,
       count(*) FILTER (WHERE t.hash_chave = s.hash_chave) AS updated,
       count(*) FILTER (WHERE s.hash_chave IS NULL) AS copied,
       count(*) AS rows_after
FROM current t FULL JOIN changed s ON t.hash_chave = s.hash_chave
""")
def merge_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    current, latest = order_states(spark, sf_dir)
    return metrics_of_merge(current, rows_that_changed(latest, current))


@query("""
SELECT 'history' AS origin, event_id, ts, user_id, event_type, value, props FROM events
WHERE ts < TIMESTAMP '2024-01-20'
UNION ALL
SELECT 'stage', event_id, ts, user_id, event_type, value, props FROM events
WHERE ts >= TIMESTAMP '2024-01-15'
""")
def history_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    history, stage = _event_batches(spark, sf_dir)
    return union_evolving(
        history.withColumn("origin", F.lit("history")), stage.withColumn("origin", F.lit("stage"))
    ).drop("hash_columns")


@query("""
SELECT 'events' AS table_name, count(*) AS row_count FROM events
UNION ALL SELECT 'orders', count(*) FROM orders
UNION ALL SELECT 'lineitem', count(*) FROM lineitem
""")
def row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = [
        table(spark, sf_dir, name).agg(
            F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("row_count")
        )
        for name in ("events", "orders", "lineitem")
    ]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


@query("SELECT * FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")
def preview_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first rows, in an order that makes them always the same ones."""
    orders = table(spark, sf_dir, "orders")
    return orders.orderBy(F.desc("o_totalprice"), "o_orderkey").limit(20)
