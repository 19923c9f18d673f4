"""Projections, filters and scalar functions."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.catalog.registry import query, table
from tidemark.catalog.scenarios import ORDER_KEYS
from tidemark.functions import (
    clean_strings as cleaned,
    day_stamp_of,
    empty_to_null as null_if_empty,
    file_stamp_of,
    fingerprint,
    parse_instant,
    second_stamp_of,
)
from tidemark.operators import RunContext, add_control_columns, replace_run_columns

RUN = RunContext("events", "logs/events", started=datetime(2025, 6, 21, 16, 27, 36))
REFRESH = RunContext("events", "logs/current/events", started=datetime(2025, 6, 21, 16, 30, 55))


@query("SELECT event_id, ts, user_id, event_type, value FROM events")
def drop_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").drop("props", "roi")


@query("""
SELECT *, 'logs/events_20250621_162736' AS key_log_file_path,
       '2025-06-21 16:27:36' AS dt_atualizacao, '2025-06-21' AS dt_ingestao,
       'landing/events.json' AS nm_arquivo_origem,
       sha256(concat_ws('||', user_id)) AS hash_chave,
       sha256(concat_ws('||', event_id, ts, user_id, event_type, value, props)) AS hash_columns
FROM events
""")
def control_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return add_control_columns(
        table(spark, sf_dir, "events"), "user_id", RUN, "landing/events.json"
    )


@query("""
SELECT *, sha256(concat_ws('||', user_id)) AS hash_chave,
       sha256(concat_ws('||', event_id, ts, user_id, event_type, value, props)) AS hash_columns,
       'logs/current/events_20250621_163055' AS key_log_file_path,
       '2025-06-21 16:30:55' AS dt_atualizacao, '2025-06-21' AS dt_ingestao,
       'history/events' AS nm_arquivo_origem
FROM events
""")
def replaced_control_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    staged = add_control_columns(
        table(spark, sf_dir, "events"), "user_id", RUN, "landing/events.json"
    )
    return replace_run_columns(staged, REFRESH, "history/events")


@query("""
SELECT o_orderkey, sha256(concat_ws('||', o_custkey, o_orderpriority)) AS hash_chave FROM orders
""")
def hash_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return orders.select("o_orderkey", fingerprint(ORDER_KEYS).alias("hash_chave"))


@query("""
SELECT doc_id, sha256(concat_ws('||', doc_id, text, lang, source, n_chars)) AS hash_columns
FROM documents
""")
def hash_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return documents.select("doc_id", fingerprint(documents.columns).alias("hash_columns"))


@query("""
SELECT conv_id, turn,
       sha256(concat_ws('||', coalesce(CAST(conv_id AS VARCHAR), '<null>'),
              coalesce(CAST(turn AS VARCHAR), '<null>'), coalesce(nullif(role, 'user'), '<null>'),
              coalesce(text, '<null>'))) AS hash_columns
FROM conversations
""")
def hash_row_null_token(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    gaps = turns.withColumn("role", F.nullif("role", F.lit("user")))
    return gaps.select(
        "conv_id",
        "turn",
        fingerprint(["conv_id", "turn", "role", "text"], null_token="<null>").alias(
            "hash_columns"
        ),
    )


@query("""
SELECT event_id, ts AS parsed,
       CASE WHEN event_type = 'error' THEN NULL ELSE ts END AS parsed_or_null
FROM events
""")
def cast_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    text = F.col("ts").cast("string")
    damaged = F.when(F.col("event_type") == "error", F.col("event_type")).otherwise(text)
    return events.select(
        "event_id",
        parse_instant(text).alias("parsed"),
        parse_instant(damaged).alias("parsed_or_null"),
    )


@query("""
SELECT event_id, nullif(replace(event_type, 'error', ''), '') AS event_type FROM events
""")
def empty_to_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    blanked = F.replace("event_type", F.lit("error"), F.lit(""))
    return events.select("event_id", null_if_empty(blanked).alias("event_type"))


# Spark upper-cases the sharp s to two letters, DuckDB leaves it.
@query("""
SELECT doc_id, trim(upper(replace(nullif(text, ''), 'ß', 'SS')), ' ') AS text,
       trim(upper(nullif(lang, '')), ' ') AS lang, source, n_chars
FROM documents
""")
def clean_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaned(table(spark, sf_dir, "documents"), exclude=["source"])


@query("""
SELECT c_custkey, upper(c_name) AS c_name, c_nationkey, c_acctbal,
       CASE WHEN c_mktsegment = 'BUILDING' THEN '' WHEN c_mktsegment = 'MACHINERY' THEN NULL
            ELSE c_mktsegment END AS c_mktsegment
FROM customer
""")
def clean_strings_blanks(spark: SparkSession, sf_dir: str) -> DataFrame:
    segment = F.col("c_mktsegment")
    untidy = (
        F.when(segment == "BUILDING", F.lit("   "))
        .when(segment == "MACHINERY", F.lit(""))
        .otherwise(F.concat(F.lit("  "), F.lower(segment), F.lit(" ")))
    )
    return cleaned(table(spark, sf_dir, "customer").withColumn("c_mktsegment", untidy))


@query("""
SELECT event_id, strftime(ts, '%Y%m%d_%H%M%S') AS file_stamp,
       strftime(ts, '%Y-%m-%d %H:%M:%S') AS second_stamp, strftime(ts, '%Y-%m-%d') AS day_stamp
FROM events
""")
def run_clock_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id",
        file_stamp_of(F.col("ts")).alias("file_stamp"),
        second_stamp_of(F.col("ts")).alias("second_stamp"),
        day_stamp_of(F.col("ts")).alias("day_stamp"),
    )
