"""Latest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import names as N
from tidemark.functions.clock import parse_instant
from tidemark.functions.hashing import quoted, require_columns

_POSITION = "__position"

_ORDERABLE = (T.AtomicType, T.StructType, T.ArrayType)


def sortable_columns(df: DataFrame) -> list[str]:
    """Columns of types that have an order (and a hash), all but maps and variants."""
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, _ORDERABLE)
        and "map<" not in f.dataType.simpleString()
        and "variant" not in f.dataType.simpleString()
    ]


def total_order(df: DataFrame, first: Sequence[str] = ()) -> list[Column]:
    """Descending order over ``first`` and then every other column that sorts.

    Rows that still tie are equal in all those columns, so it does not matter
    which of them is taken.
    """
    rest = [c for c in sortable_columns(df) if c not in first]
    return [F.desc(quoted(c)) for c in [*first, *rest]]


def latest_per_key(
    df: DataFrame,
    keys: str | Sequence[str],
    recency: str | Column,
    ties: Sequence[str | Column],
) -> DataFrame:
    """The most recent row of each key; null recency counts as oldest.

    ``ties`` orders rows of equal recency, names in descending order. Spark
    plans the filter as a group limit that leaves one row per key and map task
    before the shuffle, so a crowded key costs no more than the others.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    if not ties:
        raise ValueError("give at least one tie-breaker, or the result is not reproducible")
    require_columns(df, keys)
    newest_first = [recency.desc() if isinstance(recency, Column) else F.desc(quoted(recency))]
    newest_first += [t if isinstance(t, Column) else F.desc(quoted(t)) for t in ties]
    window = Window.partitionBy(*[F.col(quoted(k)) for k in keys]).orderBy(*newest_first)
    return (
        df.withColumn(_POSITION, F.row_number().over(window))
        .filter(F.col(_POSITION) == 1)
        .drop(_POSITION)
    )


def latest_versions(history: DataFrame) -> DataFrame:
    """The newest version of each key of a history table.

    Run starts have whole seconds: of equal ones the later release counts, where the
    frame has its number, and only then the digest.
    """
    recency = parse_instant(F.col(N.UPDATED_AT))
    first = [c for c in (N.RELEASE, N.ROW_HASH) if c in history.columns]
    newest = latest_per_key(history, N.KEY_HASH, recency, total_order(history, first))
    return newest.drop(N.RELEASE)
