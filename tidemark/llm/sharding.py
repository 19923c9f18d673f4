"""Sharding by a consistent-hash ring with virtual nodes and bounded loads.

A ring of equal arcs carries the virtual nodes of all shards. A key belongs to the next
virtual node clockwise from its arc; once that shard is full, the rest of the arc's keys
go on clockwise to the next shard with room. Capacities add up to the number of rows, so
counts differ by one at most. Everything is DataFrame expressions: rows are only counted
by arc, and the walk around the ring folds over one array with an entry for each arc,
whose number is a parameter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

SHARDS = 8
VIRTUAL_NODES = 64
ARCS = 4096


def ring_position(value: Column) -> Column:
    """A number below 2**32, the same in every engine that has MD5."""
    return F.conv(F.substring(F.md5(value), 1, 8), 16, 10).cast("long")


def arc_of(value: Column, arcs: int) -> Column:
    return F.floor(ring_position(value) * arcs / (1 << 32)).cast("int")


def walks(spark, shards: int, nodes: int, arcs: int) -> DataFrame:
    """For each arc the shards in the order a key of it meets them: arc, walk.

    It depends on the parameters alone. Where virtual nodes share an arc, the smaller
    shard comes first.
    """
    node = spark.range(shards * nodes).select(
        (F.col("id") % shards).cast("int").alias("shard"),
        F.floor(F.col("id") / shards).cast("int").alias("copy"),
    )
    placed = node.select(
        "shard", arc_of(F.concat_ws("/", F.lit("node"), "shard", "copy"), arcs).alias("at")
    ).groupBy("shard").agg(F.array_sort(F.collect_set("at")).alias("ats"))
    distance = F.transform(
        "nodes",
        lambda n: F.struct(
            F.array_min(F.transform(n["ats"], lambda a: F.pmod(a - F.col("arc"), F.lit(arcs)))).alias("far"),
            n["shard"].alias("shard"),
        ),
    )
    nodes_row = placed.agg(F.collect_list(F.struct("shard", "ats")).alias("nodes"))
    return (
        spark.range(arcs)
        .select(F.col("id").cast("int").alias("arc"))
        .join(F.broadcast(nodes_row))  # one row, of a size that the parameters set
        .select("arc", F.transform(F.array_sort(distance), lambda s: s["shard"]).alias("walk"))
    )


def _dealt(arcs: Column, shards: int) -> Column:
    """Fold over the arcs (struct arc, walk, n) in ring order: the stretches of each arc.

    A stretch is arc, from, to (ranks inside the arc), shard, slot (of its first key).
    """
    total = F.aggregate(arcs, F.lit(0).cast("long"), lambda sum_, a: sum_ + a["n"])
    room = F.transform(
        F.sequence(F.lit(0), F.lit(shards - 1)),
        lambda s: F.floor(total / shards).cast("long") + (s < total % shards).cast("long"),
    )
    start = F.struct(
        room.alias("room"),
        F.transform(room, lambda _: F.lit(0).cast("long")).alias("used"),
        F.array().cast("array<struct<arc:int,from:bigint,to:bigint,shard:int,slot:bigint>>").alias("out"),
    )

    def walk_arc(state: Column, arc: Column) -> Column:
        before = F.struct(
            state["room"].alias("room"), state["used"].alias("used"), state["out"].alias("out"),
            F.lit(0).cast("long").alias("done"),
        )

        def visit(s: Column, shard: Column) -> Column:
            free = F.element_at(s["room"], shard + 1) - F.element_at(s["used"], shard + 1)
            take = F.least(free, arc["n"] - s["done"])
            stretch = F.struct(
                arc["arc"].alias("arc"), s["done"].alias("from"), (s["done"] + take).alias("to"),
                shard.alias("shard"), F.element_at(s["used"], shard + 1).alias("slot"),
            )
            return F.struct(
                s["room"].alias("room"),
                F.transform(s["used"], lambda u, i: F.when(i == shard, u + take).otherwise(u)).alias("used"),
                F.when(take > 0, F.concat(s["out"], F.array(stretch))).otherwise(s["out"]).alias("out"),
                (s["done"] + take).alias("done"),
            )

        after = F.aggregate(arc["walk"], before, visit)
        return F.struct(after["room"].alias("room"), after["used"].alias("used"), after["out"].alias("out"))

    return F.aggregate(arcs, start, walk_arc, lambda s: s["out"])


def shard_rows(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    shards: int = SHARDS,
    nodes: int = VIRTUAL_NODES,
    arcs: int = ARCS,
) -> DataFrame:
    """A row for each row of ``df``: key, ``size``, ``text_crc32``, ``shard``, ``slot``.

    ``size`` is the text's UTF-8 bytes plus one, ``text_crc32`` its checksum (null text:
    empty). Shard counts differ by one at most; slots of a shard run from 0 without gaps.
    Keys in an arc go in the order of their ring positions, then key, size, checksum; a
    null key stands for one key of its own. Equal rows are one entry with a count until
    they get their slots, so a key that a third of all rows repeat makes no large group;
    which of them gets which slot makes no difference. An empty table gives none. Extra
    columns are not read.
    """
    content = F.coalesce(F.col(text), F.lit(""))
    entry = (
        df.select(
            F.col(key).alias("key"),
            (F.octet_length(content) + 1).cast("long").alias("size"),
            F.crc32(F.encode(content, "UTF-8")).alias("text_crc32"),
        )
        .groupBy("key", "size", "text_crc32")
        .agg(F.count("*").alias("copies"))
        .withColumn("at", ring_position(F.concat(F.lit("key/"), F.coalesce(F.col("key").cast("string"), F.lit("null")))))
        .withColumn("arc", F.floor(F.col("at") * arcs / (1 << 32)).cast("int"))
    )
    per_arc = entry.groupBy("arc").agg(F.sum("copies").alias("n"))
    ring = walks(df.sparkSession, shards, nodes, arcs)
    all_arcs = F.array_sort(F.collect_list(F.struct("arc", "walk", "n")))
    stretches = (
        per_arc.join(F.broadcast(ring), "arc")  # as many rows as arcs
        .agg(_dealt(all_arcs, shards).alias("out"))
        .select(F.explode("out").alias("s"))
        .select(F.col("s.arc").alias("s_arc"), "s.from", "s.to", F.col("s.shard").alias("shard"), F.col("s.slot").alias("base"))
    )
    order = Window.partitionBy("arc").orderBy("at", "key", "size", "text_crc32")
    ranked = entry.withColumn("end", F.sum("copies").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    begin = F.col("end") - F.col("copies")
    return (
        ranked.join(
            F.broadcast(stretches),  # at most arcs + shards rows
            (F.col("arc") == F.col("s_arc")) & (begin < F.col("to")) & (F.col("end") > F.col("from")),
        )
        .withColumn("rank", F.explode(F.sequence(F.greatest(begin, F.col("from")), F.least(F.col("end"), F.col("to")) - 1)))
        .select(
            F.col("key").alias(key), "size", "text_crc32", "shard",
            (F.col("base") + F.col("rank") - F.col("from")).alias("slot"),
        )
    )
