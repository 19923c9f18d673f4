"""Mixing sources to target weights in blocks of words.

The words of a source are one long line, its texts in a pseudorandom order, cut into
blocks of fixed length. Each output shard draws how many of its slots go to each source
from a multinomial distribution; the n-th slot of a source is filled with the block that
a keyed permutation of the source's block numbers gives for n, starting over when all
are used. Slots join blocks by their number.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.shipping import map_arrow
from tidemark.session import new_work_path, written

BLOCK_WORDS = 64
OUTPUT_SHARDS = 256
#: Groups of a source whose texts are put in order together.
STRANDS = 1024
#: No source is passed more often than this.
MOST_PASSES = 3
SEED = 20_240_229
#: A whole copy of a text, in the units in which copies are added up.
ONE = 1 << 20
#: Parts of a size class whose texts are put in order together.
PARTS = 16

WORD = "[^\\x20\\x09-\\x0D]+"


def targets(sizes: DataFrame) -> DataFrame:
    """``source, source_size`` with ``target``: the words that each source should give.

    Sources by code point, null last, weigh 1, 2, 3 and again; targets add up to all
    words unless each is at its limit of three times its source. What a limit cuts off
    goes to the others by weight, until none is above: the sources that end at their
    limit are those with the smallest limit for their weight, so sums along that order
    give the level at which the others share the rest.
    """
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))
    everything = Window.partitionBy()
    by_level = Window.orderBy("level", F.col("source").isNull(), F.col("source").cast("binary"))
    so_far = by_level.rowsBetween(Window.unboundedPreceding, -1)
    weighed = sizes.withColumn("weight", ((F.row_number().over(by_name) - 1) % 3 + 1).cast("double")).withColumn(
        "most", MOST_PASSES * F.col("source_size").cast("double")
    )
    ranked = (
        weighed.withColumn("level", F.col("most") / F.col("weight"))
        .withColumn("all_words", F.sum("source_size").over(everything).cast("double"))
        .withColumn("all_weight", F.sum("weight").over(everything))
        .withColumn("cut_before", F.coalesce(F.sum("most").over(so_far), F.lit(0.0)))
        .withColumn("weight_before", F.coalesce(F.sum("weight").over(so_far), F.lit(0.0)))
        .withColumn(
            "share", (F.col("all_words") - F.col("cut_before")) / (F.col("all_weight") - F.col("weight_before"))
        )
        # The share grows along the order while sources are cut, and falls after that.
        .withColumn("cut", F.col("level") <= F.col("share"))
    )
    free = F.max(F.when(~F.col("cut"), F.col("share"))).over(everything)
    return ranked.withColumn("free", free).select(
        "source",
        "source_size",
        F.when(F.col("cut"), F.col("most")).otherwise(F.col("weight") * F.col("free")).alias("target"),
    )


def shard_draws(quotas: np.ndarray, shards: int, seed: int) -> np.ndarray:
    """Slots of each source (columns) in each shard (rows): multinomial draws by the
    sources' shares, each from a stream of its own."""
    total = int(quotas.sum())
    draws = np.zeros((shards, len(quotas)), np.int64)
    for shard in range(shards):
        slots = total * (shard + 1) // shards - total * shard // shards
        if slots:
            rng = np.random.Generator(np.random.Philox(key=[seed, shard]))
            draws[shard] = rng.multinomial(slots, quotas / total)
    return draws


def settled(draws: np.ndarray, quotas: np.ndarray) -> np.ndarray:
    """The draws of all shards (rows), with what a source has drawn beyond its quota given,
    from the last shards on, to those that have drawn too little."""
    draws = draws.copy()
    excess = draws.sum(axis=0) - quotas
    for shard in range(len(draws) - 1, -1, -1):
        if not excess.any():
            break
        back = np.minimum(draws[shard], np.maximum(excess, 0))
        need = np.maximum(-excess, 0)
        ends = np.minimum(np.cumsum(need), back.sum())
        given = np.diff(ends, prepend=0)
        draws[shard] += given - back
        excess += given - back
    return draws


def permuted(index: np.ndarray, size: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Keyed permutations: entry i is the image of ``index[i]`` below ``size[i]``.

    A four-round Feistel network on the next power of four, walked until the image is in
    range; in the mean under four steps.
    """
    out = index.astype(np.uint64)
    bits = np.maximum(1, np.ceil(np.log2(np.maximum(size, 2)) / 2)).astype(np.uint64)
    mask = (np.uint64(1) << bits) - np.uint64(1)
    todo = np.arange(len(out))
    while len(todo):
        b, m, k = bits[todo], mask[todo], key[todo]
        left, right = out[todo] >> b, out[todo] & m
        for turn in range(4):
            h = (right + k + np.uint64(turn * 0x9E3779B97F4A7C15 % (1 << 64))) * np.uint64(0xBF58476D1CE4E5B9)
            h = (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
            left, right = right, left ^ ((h >> np.uint64(32)) & m)
        out[todo] = left << b | right
        todo = todo[out[todo] >= size[todo].astype(np.uint64)]
    return out.astype(np.int64)


def _source_key(number: np.ndarray, lap: np.ndarray, seed: int) -> np.ndarray:
    h = (number.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)) ^ np.uint64(seed)
    return (h + lap.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)


#: Slots of one row that a task works out at once.
_AT_ONCE = 1 << 16
#: Sources whose draws are made together.
SOURCES = 1024


def _drawn(batches: Iterator[pa.RecordBatch], shards: int, seed: int) -> Iterator[pa.RecordBatch]:
    """Ranges of slots from the quotas of a group of sources.

    Counts of the groups in each shard come first, from the totals of all groups, and are
    the same in every task; a group's counts are then shared out among its own sources, which
    together makes the multinomial draw over all sources.
    """
    for batch in batches:
        for row in batch.to_pylist():
            quotas = np.array([s["slots"] for s in row["sources"]], np.int64)
            totals = np.array([t["total"] for t in row["totals"]], np.int64)
            if not quotas.sum():
                continue
            if len(totals) == 1:
                draws = shard_draws(quotas, shards, seed)
            else:
                own = [t["part"] for t in row["totals"]].index(row["part"])
                counts = settled(shard_draws(totals, shards, seed), totals)[:, own]
                draws = np.zeros((shards, len(quotas)), np.int64)
                for shard, slots in enumerate(counts.tolist()):
                    rng = np.random.Generator(np.random.Philox(key=[seed + row["part"] + 1, shard]))
                    draws[shard] = rng.multinomial(slots, quotas / quotas.sum())
            draws = settled(draws, quotas)
            firsts = np.cumsum(draws, axis=0) - draws
            shard, source = np.nonzero(draws)
            count, first = draws[shard, source], firsts[shard, source]
            pieces = -(-count // _AT_ONCE)
            turn = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            shard, source, count, first = (np.repeat(x, pieces) for x in (shard, source, count, first))
            number, blocks = (np.array([s[c] for s in row["sources"]], np.int64)[source] for c in ("number", "blocks"))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(number.astype(np.int32)), pa.array(shard.astype(np.int32)),
                    pa.array(first + turn * _AT_ONCE), pa.array(np.minimum(count - turn * _AT_ONCE, _AT_ONCE)),
                    pa.array(blocks),
                ],
                ["number", "shard", "first", "count", "blocks"],
            )


def _slot_blocks(batches: Iterator[pa.RecordBatch], seed: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for number, shard, first, count, blocks in zip(*(c.to_pylist() for c in batch.columns)):
            slot = np.arange(first, first + count, dtype=np.int64)
            lap, index = slot // blocks, slot % blocks
            key = _source_key(np.full(len(slot), number), lap, seed)
            block = permuted(index, np.full(len(slot), blocks), key)
            own = [np.full(len(slot), number, np.int32), np.full(len(slot), shard, np.int32)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c) for c in (*own, slot, block)], ["number", "shard", "slot", "block"]
            )


def _slots(quotas: DataFrame, shards: int, seed: int) -> DataFrame:
    """The output slots of written ``quotas`` (number, slots, blocks), one row each."""
    spark = quotas.sparkSession
    part = F.floor(F.col("number") / SOURCES).alias("part")
    groups = quotas.groupBy(part).agg(
        F.sort_array(F.collect_list(F.struct("number", "slots", "blocks"))).alias("sources"),  # at most SOURCES
        F.sum("slots").alias("total"),
    )
    totals = groups.agg(F.sort_array(F.collect_list(F.struct("part", "total")))).scalar()
    drawn = groups.repartition("part").select("part", "sources", totals.alias("totals")).transform(
        map_arrow,
        lambda batches: _drawn(batches, shards, seed),
        "number int, shard int, first long, count long, blocks long",
    )
    # A number of tasks that adaptive execution leaves alone: a row here is many there.
    slots = quotas.agg(F.sum("slots")).first()[0] or 0
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), slots >> 20)
    return drawn.repartition(tasks, "number", "shard", "first").transform(
        map_arrow,
        lambda batches: _slot_blocks(batches, seed),
        "number int, shard int, slot long, block long",
    )


def mix_plan(
    df: DataFrame,
    id_: str = "doc_id",
    text: str = "text",
    source: str = "source",
    block: int = BLOCK_WORDS,
    shards: int = OUTPUT_SHARDS,
    seed: int = SEED,
) -> tuple[DataFrame, DataFrame]:
    """The two parts of a mix: pieces and slots.

    ``pieces`` are the words of a text that lie in one block: number (of the source),
    block, words, with id, source, ``size`` (words), ``source_size`` and ``target`` of the
    text, of which entry and copy make a key. ``slots`` are the output: number, shard,
    slot, block.

    Equal (source, id, size) are one entry with copies, laid out one after the other.
    Null ids, sources and texts are values like others (a null text has no words); texts
    without words have one piece of no words. An empty table makes empty parts. Draws are
    made in tasks, from the written quotas of ``SOURCES`` sources at a time; nothing of a
    row for each source reaches the driver.
    """
    spark = df.sparkSession
    counted = (
        df.select(
            F.col(id_).alias("id"),
            F.col(source).alias("source"),
            F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(WORD)).cast("long").alias("size"),
        )
        .groupBy("source", "id", "size")
        .agg(F.count("*").alias("copies"))
        .withColumn("place", F.xxhash64(F.lit(seed), "id", "size"))
    )
    counted = written(counted, new_work_path(spark, "mix-entries"))
    sizes = counted.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("source_size"))
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))
    blocks_of = F.ceil(F.col("source_size") / block).cast("long")
    asked = F.rint(F.coalesce("target", F.lit(0.0)) / F.greatest("source_size", F.lit(1)) * F.col("blocks"))
    # One row for each source from here on.
    quotas = (
        targets(sizes)
        .withColumns({"number": F.row_number().over(by_name) - 1, "blocks": blocks_of})
        .withColumn("slots", F.least(asked.cast("long"), MOST_PASSES * F.col("blocks")))
        .withColumnRenamed("source", "name")
    )
    quotas = written(quotas, new_work_path(spark, "mix-quotas"))
    known = quotas.select("number", "name", "source_size", "target")
    slots = _slots(quotas.select("number", "slots", "blocks"), shards, seed)
    strand = F.pmod("place", F.lit(STRANDS)).cast("int")
    entries = counted.join(known, F.col("source").eqNullSafe(F.col("name"))).select(
        F.xxhash64("source", "id", "size").alias("entry"),
        "id", "source", "size", "copies", "place", "number", "source_size", "target", strand.alias("strand"),
    )
    words = F.col("size") * F.col("copies")
    before = Window.partitionBy("number").orderBy("strand").rowsBetween(Window.unboundedPreceding, -1)
    strands = (
        entries.groupBy("number", "strand").agg(F.sum(words).alias("strand_words"))
        .withColumn("strand_first", F.coalesce(F.sum("strand_words").over(before), F.lit(0)))
        .select(F.col("number").alias("s_number"), F.col("strand").alias("s_strand"), "strand_first")
    )
    inside = Window.partitionBy("number", "strand").orderBy("place", "id", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = (
        entries.withColumn("inside", F.coalesce(F.sum(words).over(inside), F.lit(0)))
        .join(strands, (F.col("number") == F.col("s_number")) & (F.col("strand") == F.col("s_strand")))
        .withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))
        .withColumn("first", F.col("strand_first") + F.col("inside") + F.col("copy") * F.col("size"))
    )
    last = F.col("first") + F.col("size")
    # Texts without words go to many block numbers that no source has.
    no_block = -1 - F.pmod("place", F.lit(STRANDS))
    blocks = F.when(
        F.col("size") > 0,
        F.sequence(F.floor(F.col("first") / block), F.floor((last - 1) / block)),
    ).otherwise(F.array(no_block))
    pieces = placed.withColumn("block", F.explode(blocks)).select(
        "entry", "id", "source", "size", "source_size", "target", "copy", "number", "block",
        F.when(
            F.col("size") > 0,
            F.least(last, (F.col("block") + 1) * block) - F.greatest(F.col("first"), F.col("block") * block),
        ).otherwise(F.lit(0)).alias("words"),
    )
    return pieces, slots


def mix_sources(df: DataFrame, id_: str = "doc_id", **how) -> DataFrame:
    """A row for each row of ``df``: id, source, ``size``, ``source_size``, ``target`` and
    ``taken``, the words of it that the mix takes, repeats counted.

    Parameters and treatment of odd rows as in ``mix_plan``.
    """
    pieces, slots = mix_plan(df, id_, **how)
    # Spark cannot know how many slots a task makes, and would broadcast them.
    times = slots.groupBy("number", "block").agg(F.count("*").alias("times"))
    return (
        pieces.join(times.hint("merge"), ["number", "block"], "left")
        .groupBy("entry", "copy", "id", "source", "size", "source_size", "target")
        .agg(F.sum(F.col("words") * F.coalesce("times", F.lit(0))).alias("taken"))
        .select(F.col("id").alias(id_), "source", "size", "source_size", "target", "taken")
    )


def mixed_documents(
    df: DataFrame,
    id_: str = "doc_id",
    text: str = "text",
    source: str = "source",
    seed: int = SEED,
    **how,
) -> DataFrame:
    """The rows of ``df`` as often as the mix takes them: words taken over words, rounded
    so that each source keeps its target whatever the length of its texts.

    A source's texts stand in a row by size class; a text spans its mean number of copies
    there, and has as many copies as grid points of distance one fall into its span
    (systematic sampling). So a source is off by about one text, and so is each class.
    Rows of equal id, source and size share a span; each takes the part that a hash of its
    text picks, so only wholly equal rows are rounded alike. Rows without words, null texts
    among them, are not taken; null ids and sources are values like others. An empty table
    stays empty; other columns are kept, whatever their names.
    """
    spark = df.sparkSession
    kind, part = F.floor(8 * F.log2("mix_size")).cast("int"), F.pmod(F.xxhash64(F.lit(seed), "mix_id", "mix_size"), F.lit(PARTS))
    per_entry = (
        mix_sources(df, id_, text=text, source=source, seed=seed, **how)
        .groupBy(id_, "source", "size")
        .agg(F.sum("taken").alias("taken"), F.count("*").alias("rows"))
        .where("taken > 0")
        .select(
            F.col(id_).alias("mix_id"),
            F.col("source").alias("mix_source"),
            F.col("size").alias("mix_size"),
            "rows",
            # Whole numbers, whose sums do not depend on their order.
            F.round(F.col("taken") / (F.col("size") * F.col("rows")) * ONE).cast("long").alias("mean"),
        )
        .withColumns({"kind": kind, "part": part.cast("int")})
    )
    per_entry = written(per_entry, new_work_path(spark, "mix-copies"))
    span = F.col("mean") * F.col("rows")
    before = Window.partitionBy("s_source").orderBy("s_kind", "s_part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = (
        per_entry.groupBy(F.col("mix_source").alias("s_source"), F.col("kind").alias("s_kind"), F.col("part").alias("s_part"))
        .agg(F.sum(span).alias("part_span"))
        .withColumn("part_first", F.coalesce(F.sum("part_span").over(before), F.lit(0)))
    )
    inside = (
        Window.partitionBy("mix_source", "kind", "part")
        .orderBy("mix_size", F.xxhash64(F.lit(seed), "mix_id"), "mix_id")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    grid = F.pmod(F.xxhash64(F.lit("copies"), F.lit(seed), "mix_source"), F.lit(ONE))
    placed = (
        per_entry.withColumn("inside", F.coalesce(F.sum(span).over(inside), F.lit(0)))
        .join(
            firsts,
            F.col("mix_source").eqNullSafe(F.col("s_source"))
            & (F.col("kind") == F.col("s_kind"))
            & (F.col("part") == F.col("s_part")),
        )
        .select("mix_id", "mix_source", "mix_size", "rows", "mean", (F.col("part_first") + F.col("inside") + grid).alias("first"))
    )
    size = F.regexp_count(F.coalesce(F.col(f"`{text}`"), F.lit("")), F.lit(WORD)).cast("long")
    # The rows as they are, in one column, so that their names meet no others.
    rows = df.select(
        F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("row"),
        F.col(f"`{id_}`").alias("own_id"),
        F.col(f"`{source}`").alias("own_source"),
        size.alias("own_size"),
        F.xxhash64(F.col(f"`{text}`")).alias("own_hash"),
    )
    own = F.col("first") + F.pmod("own_hash", F.col("rows")) * F.col("mean")
    times = F.floor((own + F.col("mean")) / ONE) - F.floor(own / ONE)
    return (
        rows.join(
            placed,
            F.col("own_id").eqNullSafe(F.col("mix_id"))
            & F.col("own_source").eqNullSafe(F.col("mix_source"))
            & (F.col("own_size") == F.col("mix_size")),
        )
        .select("row", F.explode(F.array_repeat(F.lit(1), times.cast("int"))))
        .select("row.*")
    )
