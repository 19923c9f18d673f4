"""Session settings the jobs are written for, and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    # Runtime re-planning: broadcast only what measured small, coalesce small
    # shuffle partitions, split skewed ones.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A snapshot too large to broadcast, up to 4 million digests, still becomes a Bloom
    # filter of 8 MB on the scan of the history it is merged into.
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "128m",
    "spark.sql.optimizer.runtime.bloomFilter.expectedNumItems": "4000000",
    # Run clocks and landed instants carry no zone.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.compression.codec": "zstd",
}


def build_session(app: str = "tidemark", master: str | None = None, **settings: str) -> SparkSession:
    """A session with the settings above; cluster sizing is left to spark-submit."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in {**SETTINGS, **settings}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


_local_work_dir: str | None = None


def work_dir(spark: SparkSession) -> str:
    """Folder all executors share: ``spark.checkpoint.dir`` of the session.

    Where the setting is missing, a local session gets its own temporary
    folder; on a cluster that would not be shared, so it is an error there.
    """
    global _local_work_dir
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if _local_work_dir is None:
        _local_work_dir = tempfile.mkdtemp(prefix="tidemark-")
    return _local_work_dir


def new_work_path(spark: SparkSession, label: str) -> str:
    """A path under the shared work folder that nothing uses yet."""
    return f"{work_dir(spark)}/{label}-{uuid.uuid4().hex}"


@contextmanager
def work_path(spark: SparkSession, label: str) -> Iterator[str]:
    """A new work path that is removed when the block ends, however it ends."""
    path = new_work_path(spark, label)
    try:
        yield path
    finally:
        remove_path(spark, path)


def written(df: DataFrame, path: str) -> DataFrame:
    """``df`` computed now, as a table at ``path``.

    What is built on it starts from files that outlive executors, and the
    planner knows their size.
    """
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a work path of this job."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    configuration = spark._jsparkSession.sessionState().newHadoopConf()
    place.getFileSystem(configuration).delete(place, True)
