"""Schema evolution: new columns go to the tail, absent ones read as null."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.hashing import quoted


def union_evolving(first: DataFrame, second: DataFrame) -> DataFrame:
    """Union by name with the columns of ``first``, then those only in ``second``."""
    return first.unionByName(second, allowMissingColumns=True)


def as_nullable(kind: T.DataType) -> T.DataType:
    """The type with nulls allowed throughout, as files give it back."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, as_nullable(f.dataType), True) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(as_nullable(kind.elementType), True)
    if isinstance(kind, T.MapType):
        return T.MapType(as_nullable(kind.keyType), as_nullable(kind.valueType), True)
    return kind


def _widens(stored: T.DataType, incoming: T.DataType) -> bool:
    return isinstance(stored, T.LongType) and isinstance(incoming, T.DoubleType)


def merged_schema(
    stored: T.StructType, incoming: T.StructType, widen: bool = False
) -> T.StructType:
    """The stored fields in their order, then the incoming ones that are new.

    With ``widen``, a column of whole numbers to which fractions arrive becomes one of
    doubles. Any other change of type is an error: its text form inside the row digests
    would change as well.
    """
    stored, incoming = as_nullable(stored), as_nullable(incoming)
    types = {f.name: f.dataType for f in stored.fields}
    for field in incoming.fields:
        old = types.get(field.name, field.dataType)
        if widen and _widens(old, field.dataType):
            types[field.name] = field.dataType
        elif old != field.dataType:
            raise ValueError(
                f"column {field.name} is stored as {old.simpleString()}, "
                f"but arrives as {field.dataType.simpleString()}"
            )
    added = [f for f in incoming.fields if f.name not in types]
    return T.StructType(
        [T.StructField(f.name, types.get(f.name, f.dataType), True) for f in [*stored.fields, *added]]
    )


def widened_columns(versions: Sequence[T.StructType]) -> list[str]:
    """Columns that the last of ``versions`` of a schema has as doubles and an earlier one as longs."""
    return [
        f.name
        for f in versions[-1].fields
        if any(f.name in v.names and _widens(v[f.name].dataType, f.dataType) for v in versions)
    ]


def as_stored(incoming: T.StructType, stored: T.StructType) -> T.StructType:
    """The incoming fields, those that the stored type holds without loss under that type.

    Whole numbers fit a stored double, and everything a stored string. A column without
    any value is inferred as a string; it fits every type. Other changes stay as they are.
    """
    types = {f.name: f.dataType for f in stored.fields}

    def fitted(field: T.StructField) -> T.DataType:
        wanted = types.get(field.name, field.dataType)
        widens = isinstance(field.dataType, T.LongType) and isinstance(wanted, T.DoubleType)
        text = isinstance(wanted, T.StringType) and isinstance(field.dataType, T.AtomicType)
        empty = isinstance(field.dataType, (T.StringType, T.NullType))
        return wanted if widens or text or empty else field.dataType

    return T.StructType([T.StructField(f.name, fitted(f), True) for f in incoming.fields])


def align(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` with exactly the columns and types of ``schema``, absent ones as null."""
    have = {f.name: f.dataType for f in df.schema.fields}

    def fitted(field: T.StructField) -> Column:
        if field.name not in have:
            return F.lit(None).cast(field.dataType).alias(field.name)
        column = F.col(quoted(field.name))
        same = as_nullable(have[field.name]) == as_nullable(field.dataType)
        return column if same else column.cast(field.dataType).alias(field.name)

    return df.select(*[fitted(f) for f in schema.fields])
