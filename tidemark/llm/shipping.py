"""Python functions on Arrow batches, with this library on every executor."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

import tidemark

_shipped: set[str] = set()


def ship_library(spark: SparkSession) -> None:
    """Hand the library's modules to Spark, which brings them to the executors."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(tidemark.__file__).parent
    # Only the driver reads this file; Spark serves it to the executors.
    path = os.path.join(tempfile.mkdtemp(prefix="tidemark-"), "tidemark_modules.zip")
    with zipfile.ZipFile(path, "w") as modules:
        for module in sorted(root.rglob("*.py")):
            modules.write(module, module.relative_to(root.parent))
    context.addPyFile(path)
    _shipped.add(context.applicationId)


def map_arrow(
    df: DataFrame,
    run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
    schema: StructType | str,
) -> DataFrame:
    ship_library(df.sparkSession)
    return df.mapInArrow(run, schema)
