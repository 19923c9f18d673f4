"""Fingerprints of business keys and of whole rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.names import HASH_BITS, HASH_SEPARATOR


def quoted(name: str) -> str:
    """Column reference that survives dots and spaces in the name."""
    return "`" + name.replace("`", "``") + "`"


def whole_as_integer(column: Column) -> Column:
    """The text of a double, whole numbers without a point as a column of longs had them."""
    integer = column.cast("bigint")
    return F.when(integer.cast("double") == column, integer.cast("string")).otherwise(column.cast("string"))


def fingerprint(
    columns: Sequence[str], null_token: str | None = None, widened: Sequence[str] = ()
) -> Column:
    """SHA-2 hex digest of the columns joined by the fixed separator.

    ``concat_ws`` leaves nulls out, so ``(a, null, b)`` and ``(a, b, null)`` get
    the same digest and an all-null row that of the empty string. Stored digests
    rely on it; pass ``null_token`` to keep the positions apart in new tables.
    Columns in ``widened`` held whole numbers before they held fractions: a whole number
    gets the text it had then, so that a value that stays keeps its digest.
    """
    if not columns:
        raise ValueError("a fingerprint needs at least one column")
    parts = [
        whole_as_integer(F.col(quoted(c))) if c in widened else F.col(quoted(c)) for c in columns
    ]
    if null_token is not None:
        parts = [F.coalesce(p.cast("string"), F.lit(null_token)) for p in parts]
    return F.sha2(F.concat_ws(HASH_SEPARATOR, *parts), HASH_BITS)


def digest_bytes(name: str) -> Column:
    """A digest column as bytes, half as many as its hex text has; other text as its own bytes."""
    column = F.col(quoted(name))
    hexadecimal = F.when(F.length(column) == HASH_BITS // 4, F.unhex(column))
    return F.coalesce(hexadecimal, column.cast("string").cast("binary"))


def parse_keys(keys: str | Sequence[str]) -> list[str]:
    """Key columns from a list or a comma-separated argument."""
    names = keys.split(",") if isinstance(keys, str) else list(keys)
    names = [n.strip() for n in names]
    if not names or not all(names):
        raise ValueError(f"empty key column name in {keys!r}")
    return names


def require_columns(df: DataFrame, names: Sequence[str], what: str = "input") -> None:
    """Fail at once, by name, rather than deep inside a plan."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"{what} has no column {missing}; it has {df.columns}")
