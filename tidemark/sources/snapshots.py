"""Landed snapshots: JSON files that list every entity at one moment."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import names as N
from tidemark.operators.evolve import as_stored

#: Column with the text of a record that does not parse.
BAD_RECORD = "tidemark_bad_record"
_INFERRED_BAD = "_corrupt_record"


def read_json_snapshot(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType | str | None = None,
    multi_line: bool = True,
    drop: Sequence[str] = N.DROPPED_ON_READ,
    provenance: bool = False,
    stored: T.StructType | None = None,
) -> DataFrame:
    """Snapshot file, or files, as a frame.

    ``multi_line`` files hold one JSON array each and are read by one task per
    file; land large snapshots as many files or as JSON lines, which split.
    Give a ``schema``, in alphabetical order of its columns: without one Spark
    reads the data an extra time, and a column that is integral in one snapshot
    and fractional in another changes its type and so every row digest.
    A file that does not parse fails the read. ``provenance`` adds the file each
    row came from as the source-name column. Without a schema, ``stored`` gives the types
    of columns that an earlier snapshot has fixed, where these hold the new values
    without loss; a string column whose values do not parse as such fails the read.
    """
    reader = spark.read.option("multiLine", multi_line).option("mode", "FAILFAST")
    if schema is not None:
        reader = reader.schema(schema)
    paths = [path] if isinstance(path, str) else list(path)
    df = reader.json(paths)
    if schema is None and stored is not None:
        fitted = as_stored(df.schema, stored)
        if fitted != df.schema:
            df = reader.schema(fitted).json(paths)
    kept = [c for c in df.columns if c not in drop]
    columns = [F.col(f"`{c}`") for c in kept]
    if provenance:
        columns.append(F.col("_metadata.file_path").alias(N.SOURCE_NAME))
    return df.select(*columns)


def read_json_records(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType | str | None = None,
    multi_line: bool = True,
    drop: Sequence[str] = N.DROPPED_ON_READ,
    stored: T.StructType | None = None,
) -> DataFrame:
    """Every record of the files, those that do not parse as well: the columns, the file it
    came from, and in ``BAD_RECORD`` the text of a record that does not parse, else null.

    A record is an object of the array that a ``multi_line`` file holds, or a line. A file
    that is no array and no object is one bad record, and so is an element that is null. A
    record is bad if it is broken or if a value does not fit its column. Without a
    ``schema``, types are inferred and give way to those of ``stored``.
    """
    paths = [path] if isinstance(path, str) else list(path)
    if schema is None:
        found = spark.read.option("multiLine", multi_line).json(paths).schema
        found = T.StructType([f for f in found.fields if f.name != _INFERRED_BAD])
        schema = as_stored(found, stored or T.StructType())
    elif isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    texts = spark.read.text(paths, wholetext=multi_line).select(
        F.col("value"), F.col("_metadata.file_path").alias(N.SOURCE_NAME)
    )
    texts = texts.where(F.col("value").rlike(r"\S"))
    if multi_line:
        elements = F.from_json("value", "array<string>", {"mode": "PERMISSIVE"})
        whole = F.array("value")
        texts = texts.select(F.explode(F.coalesce(elements, whole)).alias("value"), N.SOURCE_NAME)
    asked = T.StructType([*schema.fields, T.StructField(BAD_RECORD, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD_RECORD}
    parsed = texts.select("value", N.SOURCE_NAME, F.from_json("value", asked, options).alias("record"))
    nothing = F.when(F.col("value").isNull() | F.col("record").isNull(), F.coalesce("value", F.lit("null")))
    return parsed.select(
        *[F.col(f"record.`{f.name}`") for f in schema.fields if f.name not in drop],
        N.SOURCE_NAME,
        F.coalesce(F.col(f"record.{BAD_RECORD}"), nothing).alias(BAD_RECORD),
    )


def literal_table(
    spark: SparkSession, rows: Sequence[Sequence], schema: T.StructType | str
) -> DataFrame:
    """A few rows written in the program, with an explicit schema."""
    return spark.createDataFrame(list(rows), schema)
