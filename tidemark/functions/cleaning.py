"""String cleaning for the current table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.hashing import quoted, require_columns


def empty_to_null(value: Column) -> Column:
    """Null where the string is exactly empty; blanks stay."""
    return F.nullif(value, F.lit(""))


def clean_string(value: Column) -> Column:
    """Empty becomes null, the rest is upper-cased and loses outer spaces.

    The test for empty comes before the trim, so a string of blanks ends up
    empty rather than null. Only spaces are trimmed, not tabs or line ends.
    """
    return F.trim(F.upper(empty_to_null(value)))


def string_columns(
    df: DataFrame, include: Sequence[str] | None = None, exclude: Sequence[str] = ()
) -> list[str]:
    """String columns of the frame, in order, less the excluded ones."""
    if include is not None:
        require_columns(df, include)
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.StringType)
        and f.name not in exclude
        and (include is None or f.name in include)
    ]


def clean_strings(
    df: DataFrame, include: Sequence[str] | None = None, exclude: Sequence[str] = ()
) -> DataFrame:
    """Clean every string column in one projection."""
    chosen = string_columns(df, include, exclude)
    return df.withColumns({c: clean_string(F.col(quoted(c))) for c in chosen})
