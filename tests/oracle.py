"""Compare a registered query with its SQL in DuckDB.

``python tests/oracle.py [folder] [name ...]`` checks and times them all.
"""

from __future__ import annotations

import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry_points

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def expected_rows(sf_dir: str, sql: str) -> pd.DataFrame:
    with duckdb.connect() as connection:
        connection.execute("SET TimeZone = 'UTC'")
        for name in TABLES:
            connection.execute(
                f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')"
            )
        return connection.execute(sql).df()


def canonical(df: pd.DataFrame) -> pd.DataFrame:
    """Columns by name, values as text, rows in order."""
    df = df[sorted(df.columns)].copy()
    for name in df.columns:
        column = df[name]
        if pd.api.types.is_float_dtype(column):
            df[name] = column.map(lambda v: "null" if pd.isna(v) else repr(float(v)))
        elif pd.api.types.is_datetime64_any_dtype(column):
            df[name] = column.map(lambda v: "null" if pd.isna(v) else pd.Timestamp(v).isoformat())
        else:
            df[name] = column.map(_text)
    return df.sort_values(list(df.columns)).reset_index(drop=True)


def _text(value: object) -> str:
    if value is None or value is pd.NaT or (isinstance(value, float) and pd.isna(value)):
        return "null"
    if hasattr(value, "isoformat"):
        return pd.Timestamp(value).isoformat()
    return str(value)


def differences(spark, name: str, sf_dir: str) -> str:
    """Empty when the query and its SQL agree, else what differs."""
    found = canonical(entry_points.queries()[name](spark, sf_dir).toPandas())
    wanted = canonical(expected_rows(sf_dir, entry_points.oracle_sql()[name]))
    if list(found.columns) != list(wanted.columns):
        return f"columns {list(found.columns)} instead of {list(wanted.columns)}"
    if len(found) != len(wanted):
        return f"{len(found)} rows instead of {len(wanted)}"
    for column in found.columns:
        unequal = found[column] != wanted[column]
        if unequal.any():
            at = unequal.idxmax()
            return (
                f"{unequal.sum()} of {len(found)} rows differ in {column}, "
                f"such as {found.loc[at].to_dict()} for {wanted.loc[at].to_dict()}"
            )
    return "" if len(found) else "no rows on either side"


def main(arguments: list[str]) -> int:
    from tidemark.session import build_session

    sf_dir = arguments[0] if arguments else "/root/testdata/sf0.01"
    names = arguments[1:] or list(entry_points.queries())
    spark = build_session(
        master="local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    failed = 0
    for name in names:
        started = time.time()
        try:
            problem = differences(spark, name, sf_dir)
        except Exception as error:  # report and go on with the others
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += bool(problem)
        print(f"{time.time() - started:6.1f} s  {name}: {problem[:1500] or 'equal'}", flush=True)
    spark.stop()
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
