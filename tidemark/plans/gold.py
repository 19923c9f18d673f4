"""Reports over the tables: daily variation, rankings, indicators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import names as N
from tidemark.functions.hashing import fingerprint, quoted
from tidemark.operators.latest import sortable_columns
from tidemark.session import new_work_path, work_path, written
from tidemark.sources.tables import CurrentTable, HistoryTable, UpsertCounts

_INSTANT, _PART, _FIRST, _VALUE = "__instant", "__part", "__first", "__value"


_STATES = ("opened", "closed", "lowest", "highest", "readings")


def daily_states(
    df: DataFrame, keys: Sequence[str], instant: str, value: str, ties: Sequence[str] = ()
) -> DataFrame:
    """Per key and day what later readings of the day can be merged into.

    ``opened`` and ``closed`` hold the first and the last reading beside its moment.
    """
    reading = F.struct(
        F.struct(F.col(quoted(instant)).alias("at"), *[F.col(quoted(t)) for t in ties]).alias("moment"),
        F.col(quoted(value)).alias("value"),
    )
    return df.groupBy(*keys, F.to_date(instant).alias("day")).agg(
        F.min_by(reading, reading["moment"]).alias("opened"),
        F.max_by(reading, reading["moment"]).alias("closed"),
        F.min(value).alias("lowest"),
        F.max(value).alias("highest"),
        F.count(F.lit(1)).alias("readings"),
    )


def merged_states(states: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One state for each key and day that has several."""
    return states.groupBy(*keys, "day").agg(
        F.min_by("opened", "opened.moment").alias("opened"),
        F.max_by("closed", "closed.moment").alias("closed"),
        F.min("lowest").alias("lowest"),
        F.max("highest").alias("highest"),
        F.sum("readings").alias("readings"),
    )


def variation_of_states(states: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Opening, closing, lowest and highest values of each day, and their changes."""
    days = states.withColumns({c: F.col(f"{c}.value") for c in ("opened", "closed")})
    previous = F.lag("closed").over(Window.partitionBy(*keys).orderBy("day"))
    return days.select(
        *keys,
        "day",
        *_STATES,
        (F.col("closed") - F.col("opened")).alias("change_in_day"),
        (F.col("closed") - previous).alias("change_from_previous"),
        ((F.col("closed") - previous) / F.nullif(previous, F.lit(0.0))).alias("relative_change"),
    )


def daily_variation(
    df: DataFrame, keys: Sequence[str], instant: str, value: str, ties: Sequence[str] = ()
) -> DataFrame:
    """Per key and day: opening, closing, lowest and highest value, and changes.

    Opening and closing values come from an aggregation, so a day of any size is
    reduced before the shuffle; only the daily rows of a key are put in order.
    """
    return variation_of_states(daily_states(df, keys, instant, value, ties), keys)


def refresh_daily_states(
    history: HistoryTable,
    states: CurrentTable,
    keys: Sequence[str],
    instant: str | Column,
    value: str,
    ties: Sequence[str] = (),
) -> UpsertCounts:
    """Bring the stored daily states up to the history, reading only its new releases.

    The new rows are reduced to states; only the stored states of the same keys and days
    are merged with these and replaced, and the order in which releases come does not
    matter. The states remember the release of the history they were made from, so a
    refresh without news changes nothing. Read them with ``variation_of_states``.
    """
    last = states.last_release()
    news, release = history.read_after(last.source if last else 0)
    if isinstance(instant, Column):
        news, instant = news.withColumn(_INSTANT, instant), _INSTANT
    fresh = daily_states(news, keys, instant, value, ties)
    id_ = fingerprint([*keys, "day"], null_token="\0").alias(N.KEY_HASH)
    fresh = fresh.select(id_, "*")
    if last is None:
        return states.upsert(fresh, unique=True, source=release)
    with work_path(states.spark, "states") as work:
        # Written: it is joined and merged.
        fresh = written(fresh, work)
        touched = states.read().join(fresh.select(N.KEY_HASH), N.KEY_HASH, "left_semi")
        merged = merged_states(touched.unionByName(fresh), [N.KEY_HASH, *keys])
        return states.upsert(merged, unique=True, source=release)


def top_by_value(df: DataFrame, value: str, count: int, ties: Sequence[str]) -> DataFrame:
    """The ``count`` rows with the largest value, with their positions."""
    order = [F.desc(quoted(value)), *[F.asc(quoted(t)) for t in ties]]
    best = df.filter(F.col(quoted(value)).isNotNull()).orderBy(*order).limit(count)
    # At most ``count`` rows reach this window.
    return best.withColumn("position", F.row_number().over(Window.orderBy(*order)))


def _with_local_ranks(ordered: DataFrame, value: str) -> DataFrame:
    """Rows of sorted partitions with the number of the partition, the place of the first row
    of their value in it, and how many distinct values come before."""
    schema = T.StructType([*ordered.schema.fields, *(T.StructField(c, T.LongType()) for c in (_PART, _FIRST, _VALUE))])
    floating = isinstance(ordered.schema[value].dataType, T.FractionalType) and not isinstance(
        ordered.schema[value].dataType, T.DecimalType
    )

    # Everything inside, so that executors need no module of this library.
    def run(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        from pyspark import TaskContext

        part, rows, first, number, last = TaskContext.get().partitionId(), 0, 0, -1, None
        for batch in batches:
            if not batch.num_rows:
                continue
            column = batch.column(value)
            if last is not None:
                column = pa.concat_arrays([last, column])
            same = pc.equal(column[1:], column[:-1])
            if floating:
                same = pc.or_(same, pc.and_(pc.is_nan(column[1:]), pc.is_nan(column[:-1])))
            new = np.ones(batch.num_rows, bool)
            new[0 if last is not None else 1 :] = ~same.to_numpy(zero_copy_only=False)
            at = np.arange(rows, rows + batch.num_rows)
            firsts = np.maximum.accumulate(np.where(new, at, first))
            numbers = number + np.cumsum(new)
            added = [np.full(batch.num_rows, part), firsts, numbers]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *(pa.array(a, pa.int64()) for a in added)], schema.names
            )
            last = batch.column(value)[-1:]
            rows, first, number = rows + batch.num_rows, int(firsts[-1]), int(numbers[-1])

    return ordered.mapInArrow(run, schema)


def rank_by_value(df: DataFrame, value: str, bands: int | None = None) -> DataFrame:
    """Every row with its ``rank`` and ``dense_rank`` by descending value.

    A window over the whole table would be one task. Instead the rows are dealt into
    ``bands`` ranges of (value, hash of the row), as many as there are shuffle partitions
    by default, and sorted in each: a value that many rows have spreads over several
    ranges. Each range ranks its rows and is written to the work folder; the sizes of the
    ranges before, one row for each range, are added. There is no join by value. Where the
    ranges are cut does not change the result; rows that are equal throughout stay in one.
    Rows without a value get null ranks and are not moved. ``df`` is computed twice, once
    for a sample of where to cut: write it first where that is costly.
    """
    spark = df.sparkSession
    bands = bands or int(spark.conf.get("spark.sql.shuffle.partitions"))
    if bands < 2:
        raise ValueError("ranking needs at least two bands")
    present = F.col(quoted(value)).isNotNull()
    hashed = [F.col(quoted(c)) for c in sortable_columns(df)]
    ordered = (
        df.filter(present)
        .repartitionByRange(bands, F.desc(quoted(value)), F.xxhash64(*hashed))
        .sortWithinPartitions(F.desc(quoted(value)))
    )
    local = written(_with_local_ranks(ordered, value), new_work_path(spark, "ranges"))
    ranges = local.groupBy(_PART).agg(
        F.count(F.lit(1)).alias("rows"),
        (F.max(_VALUE) + 1).alias("values"),
        F.max(_FIRST).alias("last_first"),
        F.max(quoted(value)).alias("top"),
        F.min(quoted(value)).alias("bottom"),
    )
    # One row for each range from here on, at most ``bands``.
    in_order = Window.orderBy(_PART)
    earlier = in_order.rowsBetween(Window.unboundedPreceding, -1)
    goes_on = F.coalesce(F.col("top").eqNullSafe(F.lag("bottom").over(in_order)), F.lit(False))
    placed = ranges.withColumns(
        {
            "goes_on": goes_on & (F.row_number().over(in_order) > 1),
            "before": F.coalesce(F.sum("rows").over(earlier), F.lit(0)),
        }
    )
    # Where the last value of a range begins, unless it began in an earlier one.
    begins = F.when((F.col("values") > 1) | ~F.col("goes_on"), F.col("before") + F.col("last_first"))
    new = F.col("values") - F.col("goes_on").cast("long")
    above = placed.withColumns({"begins": begins, "new": new}).select(
        _PART,
        "before",
        F.when(F.col("goes_on"), F.last("begins", ignorenulls=True).over(earlier)).otherwise(F.col("before")).alias("top_at"),
        (F.coalesce(F.sum("new").over(earlier), F.lit(0)) - F.col("goes_on").cast("long")).alias("values_above"),
    )
    at = F.when(F.col(_FIRST) == 0, F.col("top_at")).otherwise(F.col("before") + F.col(_FIRST))
    columns = [F.col(quoted(c)) for c in df.columns]
    ranked = local.join(F.broadcast(above), _PART).select(
        *columns, (at + 1).alias("rank"), (F.col("values_above") + F.col(_VALUE) + 1).alias("dense_rank")
    )
    none = F.lit(None).cast("long")
    return ranked.unionByName(
        df.filter(~present).select(*columns, none.alias("rank"), none.alias("dense_rank"))
    )


def segment_indicators(df: DataFrame, segment: str | Sequence[str], value: str) -> DataFrame:
    """Per segment: members, total, mean, extremes and share of the whole.

    The share of a total of zero is null.
    """
    segments = [segment] if isinstance(segment, str) else list(segment)
    groups = df.groupBy(*segments).agg(
        F.count(F.lit(1)).alias("members"),
        F.sum(value).alias("total"),
        F.min(value).alias("lowest"),
        F.max(value).alias("highest"),
    )
    whole: Column = groups.agg(F.sum("total")).scalar()
    return groups.select(
        "*",
        (F.col("total").cast("double") / F.col("members")).alias("mean"),
        F.try_divide(F.col("total").cast("double"), whole.cast("double")).alias("share"),
    )
