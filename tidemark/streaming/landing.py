"""Follow the landing folder: each new snapshot file is ingested once."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark import names as N
from tidemark.plans.jobs import Layers, ingest_snapshot, refresh_current
from tidemark.sources.tables import HistoryTable


def parent_folder(path: Column) -> Column:
    """The name of the folder that a file is in, for snapshots that are folders of files."""
    return F.element_at(F.split(path, "/"), -2)


def follow_landing(
    spark: SparkSession,
    layers: Layers,
    keys: str | Sequence[str],
    schema: T.StructType | str,
    checkpoint: str,
    clock: Callable[[], datetime] = datetime.now,
    multi_line: bool = True,
    refresh: bool = True,
    trigger: dict | None = None,
    files_per_batch: int | None = None,
    snapshot_of: Callable[[Column], Column] | None = None,
    **ingest_options,
) -> StreamingQuery:
    """Ingest the files that land in ``layers.stage``, oldest first.

    By default every file is a snapshot of its own and the query ends when all
    files present are done; ``trigger={"processingTime": "1 hour"}`` keeps it
    running. The checkpoint remembers the files, so nothing has to be renamed.

    ``snapshot_of`` is for snapshots of several files: it makes the name of the snapshot from
    the path of a file, ``parent_folder`` for example. Snapshots are taken in the order of
    their names; each is one release of the history, followed by one refresh. Land a folder
    under another place and move it in whole. ``files_per_batch`` alone makes one snapshot of
    so many files; of two versions of a key in it the larger row digest counts.

    A release remembers the batch and snapshot it came with, so a batch that is repeated
    after a failure goes on where it stopped.
    """
    per_batch = files_per_batch or (None if snapshot_of else 1)
    reader = (
        spark.readStream.schema(schema).option("multiLine", multi_line).option("mode", "FAILFAST")
    )
    if per_batch:
        reader = reader.option("maxFilesPerTrigger", per_batch)
    if snapshot_of:
        reader = reader.option("recursiveFileLookup", True)
    landed = reader.json(layers.stage).withColumn(N.SOURCE_NAME, F.col("_metadata.file_path"))

    def take(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        key = f"{checkpoint}#{number}"
        units = [(key, batch)]
        if snapshot_of:
            name = snapshot_of(F.col(N.SOURCE_NAME))
            # A name for each snapshot that has landed since.
            names = batch.agg(F.sort_array(F.collect_set(name))).first()[0]
            units = [(f"{key}/{n}", batch.where(name == n)) for n in names]
        for unit, rows in units:
            if not HistoryTable(session, layers.history).has_batch(unit):
                ingest_snapshot(session, rows, layers, keys, clock, batch=unit, **ingest_options)
            if refresh:
                refresh_current(session, layers, clock)

    return (
        landed.writeStream.foreachBatch(take)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
