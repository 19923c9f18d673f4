"""Registered queries over the shared test tables, each with the SQL it equals."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its name, with its SQL if there is one."""

    def add(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql is not None:
            SQL[function.__name__] = sql
        return function

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class StagedClock:
    """A clock that goes on by ``step`` with each look, or stands still until it is set:
    results do not depend on today."""

    def __init__(self, at: datetime, step: timedelta = timedelta(0)) -> None:
        self.at, self.step = at, step

    def __call__(self) -> datetime:
        self.at += self.step
        return self.at
