"""Change detection and merges, written as joins, unions and aggregates.

Keys are compared with ``=``, so null keys never match, as in SQL MERGE.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.hashing import digest_bytes, quoted, require_columns
from tidemark.names import KEY_HASH, ROW_HASH
from tidemark.operators.evolve import union_evolving
from tidemark.session import new_work_path, written

ACTION = "action"
INSERT, UPDATE, COPY = "INSERT", "UPDATE", "COPY"
_DIGEST, _IN_SOURCE = "__digest", "__in_source"


def changed_rows(latest: DataFrame, current: DataFrame, on: str = ROW_HASH) -> DataFrame:
    """Rows of ``latest`` whose row digest occurs nowhere in ``current``.

    The digests of ``current`` are first cut down to those of ``latest``: there the
    small side is on the right, so that few news are broadcast to a large table and
    only digests in common go on. Write ``latest`` first where it is costly, since it is
    used twice. Both frames hold one row per key, so neither side is crowded.
    """
    require_columns(latest, [on], "latest rows")
    require_columns(current, [on], "current table")
    known = current.select(on).join(latest.select(on), on, "left_semi")
    return latest.join(known, on, "left_anti").select(latest.columns)


def unseen_rows(
    stage: DataFrame,
    history: DataFrame,
    on: str = ROW_HASH,
    distinct: bool = False,
    work: str | None = None,
) -> DataFrame:
    """Rows of ``stage`` whose digest the whole ``history`` has never held.

    A value that returns to an old state is therefore not new, and copies inside
    one batch are all kept unless ``distinct`` is set.

    ``stage`` is computed once and written to ``work`` (by default a path under the
    shared work folder), which is when this function returns: a frame that would give
    other values the second time is merged as it was the first time. The history's
    digests are cut down to those of the written rows, and these leave the rows out;
    both joins compare 32 bytes, not 64 letters.
    The planner knows the size of the written files, so a small snapshot is broadcast and
    never shuffles a large history. For a larger one, up to the limit that the session
    sets, it makes a Bloom filter of the snapshot's digests and puts it on the scan of
    the history, so that only digests that may be known are shuffled. A digest with many
    copies makes a skewed join, which adaptive execution splits.
    """
    require_columns(stage, [on], "stage")
    require_columns(history, [on], "history")
    if distinct:
        stage = stage.dropDuplicates([on])
    staged = written(stage, work or new_work_path(stage.sparkSession, "stage"))
    # The comparison holds for every digest; a filter is what the planner makes a Bloom filter of.
    asked = staged.where(F.col(quoted(on)) >= "").select(digest_bytes(on).alias(_DIGEST))
    known = history.select(digest_bytes(on).alias(_DIGEST)).join(asked, _DIGEST, "left_semi").distinct()
    return staged.join(known, digest_bytes(on) == known[_DIGEST], "left_anti").select(stage.columns)


def insert_only(history: DataFrame, stage: DataFrame, on: str = ROW_HASH, **options) -> DataFrame:
    """The history after an insert-only merge of ``stage``."""
    return union_evolving(history, unseen_rows(stage, history, on, **options))


def upsert(target: DataFrame, source: DataFrame, on: str = KEY_HASH) -> DataFrame:
    """The target after update-all of matched keys and insert-all of the others.

    ``target`` and ``source`` hold one row per key. There is no recency test and
    no delete: keys missing from ``source`` stay as they are. Only the keys of
    ``source`` are joined, so a small source never shuffles the target.
    """
    require_columns(target, [on], "target")
    require_columns(source, [on], "source")
    kept = target.join(source.select(on), on, "left_anti").select(target.columns)
    return union_evolving(kept, source)


def _source_keys(source: DataFrame, on: str) -> DataFrame:
    """The keys of ``source``, written, so that the planner knows how few they are."""
    return written(source.select(on), new_work_path(source.sparkSession, "keys"))


def merge_actions(target: DataFrame, source: DataFrame, on: str = KEY_HASH) -> DataFrame:
    """What an upsert does with each key: INSERT, UPDATE or COPY.

    The keys of ``source`` are written and brought to the target, whose rows stay where
    they are unless those keys are too many to broadcast.
    """
    keys = _source_keys(source, on)
    marked = target.select(on).join(keys.withColumn(_IN_SOURCE, F.lit(True)), on, "left")
    of_target = marked.select(on, F.when(F.col(_IN_SOURCE), UPDATE).otherwise(COPY).alias(ACTION))
    met = target.select(on).join(keys, on, "left_semi")
    return of_target.unionByName(keys.join(met, on, "left_anti").withColumn(ACTION, F.lit(INSERT)))


def merge_metrics(target: DataFrame, source: DataFrame, on: str = KEY_HASH) -> DataFrame:
    """One row of counts: source rows, inserted, updated, copied, rows after.

    One scan of the target counts its rows and those whose key is in ``source``; the other
    counts follow. Like ``upsert``, this takes one row per key on both sides.
    """
    keys = _source_keys(source, on)
    arriving = keys.agg(F.count(F.lit(1))).scalar()
    marked = target.select(on).join(keys.withColumn(_IN_SOURCE, F.lit(True)), on, "left")
    seen = marked.agg(F.count(F.lit(1)).alias("before"), F.count(_IN_SOURCE).alias("updated"))
    before, updated = F.col("before"), F.col("updated")
    return seen.select(
        arriving.alias("source_rows"),
        (arriving - updated).alias("inserted"),
        updated,
        (before - updated).alias("copied"),
        (before + arriving - updated).alias("rows_after"),
    )
