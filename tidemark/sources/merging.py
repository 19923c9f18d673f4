"""Catalog tables whose format has row-level operations, as targets of Spark's own MERGE."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import names as N
from tidemark.functions.hashing import quoted, require_columns
from tidemark.session import work_path, written
from tidemark.sources.tables import UpsertCounts

_SOURCE = "changed_rows"


class MergeTable:
    """A table of a catalog in the place of a ``CurrentTable``. It has to exist."""

    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark, self.name = spark, name

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def merge(self, changed: DataFrame, on: str = N.KEY_HASH, evolve: bool = True) -> UpsertCounts:
        """Update the keys in ``changed``, insert those that are new; rows without a key are new.

        The changed rows are computed once and written, and counted against the keys of the
        table before the merge: a writer in between is not in the counts. Several rows of
        one key fail in the merge. ``evolve`` adds new columns, where the format can.
        """
        require_columns(changed, [on], "changed rows")
        with work_path(self.spark, "merge") as work:
            source = written(changed, work)
            keys = source.select(quoted(on))
            before = self.read()
            arriving, total = keys.count(), before.count()
            updated = before.select(quoted(on)).join(keys, on, "left_semi").count()
            if arriving:
                same = F.col(f"{self.name}.{quoted(on)}") == F.col(f"{_SOURCE}.{quoted(on)}")
                merge = source.alias(_SOURCE).mergeInto(self.name, same)
                merge = merge.withSchemaEvolution() if evolve else merge
                merge.whenMatched().updateAll().whenNotMatched().insertAll().merge()
        return UpsertCounts(arriving - updated, updated, total - updated)
