"""Near-duplicate texts by an inverted join of MinHash signatures.

Each text with a shingle set of its own is posted under every pair of signature
coordinate and value. A pair of sets that is similar enough shares all but few
coordinates, so it shares one of the rarest of each (prefix), and only those lists are
merged; the long lists are skipped, since the rest of the coordinates is counted by
comparing two short sketches. Pairs above the match threshold make candidate groups, and
inside those every link is confirmed on the full sets.

Lists and groups are cut into blocks, so that a task holds two blocks however large a
list is, and hands on at most one link for each member.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import rolling
from tidemark.llm.batches import slices, utf8
from tidemark.llm.components import components
from tidemark.llm.shipping import map_arrow
from tidemark.session import new_work_path, written

SHINGLE = 5
#: Two sets are linked if 100 * shared >= SIMILARITY * united.
SIMILARITY = 85
#: Coordinates of a signature.
COORDINATES = 64
#: Chance with which a pair at the wanted similarity may share too few coordinates.
MISSED = 1e-6
#: Members of a list or group that are held as one block, and their shingles.
BLOCK = 256
BLOCK_SHINGLES = 400_000



def matches_for(similarity: int) -> int:
    """Coordinates that a pair has to share: as many as a pair at ``similarity`` percent
    fails to share with a chance of at most ``MISSED``.

    Each coordinate agrees with the chance of the similarity. A smaller similarity that
    passes is turned down on the full sets.
    """
    chance, below = similarity / 100, 0.0
    for matches in range(COORDINATES + 1):
        below += comb(COORDINATES, matches) * chance**matches * (1 - chance) ** (COORDINATES - matches)
        if below > MISSED:
            break
    if not 0 < similarity <= 100 or matches < 1:
        raise ValueError(f"{COORDINATES} coordinates cannot find pairs at a similarity of {similarity} percent")
    return matches


_RNG = np.random.Generator(np.random.Philox(20_221_103))
_FLIP = _RNG.integers(0, 1 << 64, COORDINATES, np.uint64)
_TIMES = _RNG.integers(0, 1 << 64, COORDINATES, np.uint64) | np.uint64(1)
_PLACE = _RNG.integers(0, 1 << 64, COORDINATES, np.uint64)


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> Iterator[np.ndarray]:
    """The sorted shingle hashes of each text of a slice; A-Z count as a-z."""
    data = rolling.lowered(data)
    words = rolling.Words(data, offsets)
    hashes = rolling.word_hashes(data, words)
    full = rolling.grams(hashes, SHINGLE)
    short = {n: rolling.grams(hashes, n) ^ np.uint64(n) for n in range(1, SHINGLE)}
    for first, count in zip(words.first.tolist(), words.per_doc.tolist()):
        if count >= SHINGLE:
            yield np.unique(full[first : first + count - SHINGLE + 1])
        elif count:
            yield short[count][first : first + 1]
        else:
            yield full[:0]


def set_key(shingles: np.ndarray) -> bytes:
    """128 bits that equal sets have in common."""
    one = rolling.mixed(shingles + np.uint64(rolling.BASE)).sum(dtype=np.uint64)
    two = np.bitwise_xor.reduce(rolling.mixed(shingles ^ np.uint64(rolling.STEP)), initial=np.uint64(0))
    return one.tobytes() + two.tobytes()


def signature(shingles: np.ndarray) -> np.ndarray:
    """The smallest value of each hash function, told apart by coordinate."""
    least = np.full(COORDINATES, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), 8192):
        part = (shingles[at : at + 8192, None] ^ _FLIP) * _TIMES
        np.minimum(least, part.min(axis=0), out=least)
    return rolling.mixed(least ^ _PLACE)


def signatures(df: DataFrame, id_: str, text: str) -> DataFrame:
    """``id, n_shingles, set_key, tokens, sketch`` for each row of ``df``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                sizes, keys, tokens = [], [], []
                for shingles in shingle_sets(*utf8(part.column("text"))):
                    sizes.append(len(shingles))
                    keys.append(set_key(shingles) if len(shingles) else None)
                    tokens.append(signature(shingles))
                every = np.stack(tokens)
                sketch = every.astype(np.uint16)
                flat = pa.array(every.view(np.int64).ravel())
                ends = pa.array(np.arange(len(every) + 1, dtype=np.int32) * COORDINATES)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("id"),
                        pa.array(sizes, pa.int64()),
                        pa.array(keys, pa.binary()),
                        pa.ListArray.from_arrays(ends, flat),
                        pa.array([s.tobytes() for s in sketch], pa.binary()),
                    ],
                    ["id", "n_shingles", "set_key", "tokens", "sketch"],
                )

    return df.select(F.col(id_).cast("long").alias("id"), F.col(text).alias("text")).transform(
            map_arrow,
        run, "id long, n_shingles long, set_key binary, tokens array<long>, sketch binary"
    )


def _pairs_of_blocks(df: DataFrame, keys: list[str], blocks: Column, member: Column) -> DataFrame:
    """Each row once for every block that its own is compared with: columns i, j, side."""
    block = F.pmod(F.xxhash64(member), blocks)
    return (
        df.withColumn("own", block)
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
        .withColumn("i", F.least("own", "other"))
        .withColumn("j", F.greatest("own", "other"))
        .withColumn("side", F.when(F.col("i") == F.col("j"), F.lit(-1)).otherwise((F.col("own") > F.col("other")).cast("int")))
        .drop("own", "other")
        .repartition(*keys, "i", "j")
        .sortWithinPartitions(*keys, "i", "j", "side")
    )


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str], most: int) -> Iterator[pa.Table]:
    """Whole groups of equal ``keys`` from sorted batches, many to a table."""
    held: list[pa.Table] = []
    rows = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(pa.Table.from_batches([batch]))
        rows += batch.num_rows
        if rows < most:
            continue
        table = pa.concat_tables(held).combine_chunks()
        last = _starts(table, keys)[-1]
        if last:
            yield table.slice(0, last)
        held, rows = [table.slice(last)], table.num_rows - last
    if held:
        yield pa.concat_tables(held).combine_chunks()


def _starts(table: pa.Table, keys: list[str]) -> np.ndarray:
    new = np.zeros(table.num_rows, bool)
    new[:1] = True
    for key in keys:
        column = table.column(key).to_numpy()
        new[1:] |= column[1:] != column[:-1]
    return np.flatnonzero(new)


def _settle(parent: np.ndarray) -> np.ndarray:
    while True:
        above = parent[parent]
        if (above == parent).all():
            return parent
        parent = above


def _listed_together(batches: Iterator[pa.RecordBatch], matches: int) -> Iterator[pa.RecordBatch]:
    """Links of members of one list whose sketches match often enough.

    Members already in one local group are not compared, so links are a forest.
    """
    keys = ["token", "i", "j"]
    for table in _groups(batches, keys, 20_000):
        starts = _starts(table, keys)
        group = np.zeros(table.num_rows, np.int64)
        group[starts] = 1
        group = np.cumsum(group)
        side = table.column("side").to_numpy()
        member = table.column("member").to_numpy()
        sketch = np.frombuffer(b"".join(table.column("sketch").to_pylist()), np.uint16).reshape(-1, COORDINATES)
        parent = np.arange(table.num_rows)
        longest = int(np.diff(np.append(starts, table.num_rows)).max())
        rows = np.arange(table.num_rows)
        for away in range(1, longest):
            rows = rows[rows + away < table.num_rows]
            rows = rows[group[rows] == group[rows + away]]
            todo = rows[(parent[rows] != parent[rows + away]) & ((side[rows] < 0) | (side[rows] != side[rows + away]))]
            same = (sketch[todo] == sketch[todo + away]).sum(axis=1) >= matches
            for a in todo[same].tolist():
                x, y = a, a + away
                while parent[x] != x:
                    x = parent[x]
                while parent[y] != y:
                    y = parent[y]
                parent[max(x, y)] = min(x, y)
            if same.any():
                parent = _settle(parent)
        linked = np.flatnonzero(parent != np.arange(table.num_rows))
        a, b = _forest(member[linked], member[parent[linked]])
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what (a, b) connect: each member with the smallest of its group,
    so that lists of the same members make the same links."""
    members, flat = np.unique(np.concatenate((a, b)), return_inverse=True)
    x, y = flat[: len(a)], flat[len(a) :]
    root = np.arange(len(members))
    while True:
        least = root.copy()
        np.minimum.at(least, root[x], root[y])
        np.minimum.at(least, root[y], root[x])
        least = _settle(least)
        if (least[root] == root).all():
            break
        root = least[root]
    moved = np.flatnonzero(root != np.arange(len(members)))
    return members[moved], members[root[moved]]


def _sets_of(df: DataFrame, kept: list[str]) -> DataFrame:
    """``df`` (with text and set_key) with the sets of its texts where they have that key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            for part in slices(batch, "text"):
                keys = part.column("set_key").to_pylist()
                nodes = part.column("node").to_pylist()
                right, sets = [], list(shingle_sets(*utf8(part.column("text"))))
                for i, held in enumerate(sets):
                    # Repeated rows come one after the other, and one is enough.
                    if set_key(held) == keys[i] and (nodes[i], keys[i]) != last:
                        last = nodes[i], keys[i]
                        right.append(i)
                own = part.select(kept).take(pa.array(right, pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [*own.columns, pa.array([sets[i].tobytes() for i in right], pa.binary())],
                    [*kept, "shingles"],
                )

    schema = df.select(*kept).schema.add("shingles", "binary")
    return df.select(*kept, *({"set_key", "text"} - set(kept))).transform(map_arrow, run, schema)


def shared_counts(sets: list[np.ndarray]) -> np.ndarray:
    """How many shingles each two of ``sets`` share, by products of 0/1 matrices."""
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    often = times > 1
    number = np.cumsum(often) - 1
    keep = often[column]
    row, column = row[keep], number[column[keep]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    total = np.zeros((len(sets), len(sets)), np.float64)
    width = 4096
    for at in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        a, b = np.searchsorted(column, (at, at + width))
        holds = np.zeros((len(sets), width), np.float32)
        holds[row[a:b], column[a:b] - at] = 1
        total += holds @ holds.T
    total[np.diag_indices(len(sets))] = [len(s) for s in sets]
    return total.astype(np.int64)


def linked_groups(sets: list[np.ndarray], side: np.ndarray, similarity: int) -> np.ndarray:
    """For each set the first of those it is linked with, over any number of links.

    Sets of one side (0 or 1) are not compared, those of side -1 all are.
    """
    sizes = np.array([len(s) for s in sets])
    shared = shared_counts(sets)
    links = 100 * shared >= similarity * (sizes[:, None] + sizes - shared)
    links &= (side[:, None] < 0) | (side[:, None] != side)
    np.fill_diagonal(links, True)
    label = np.arange(len(sets))
    while True:
        least = np.where(links, label, len(sets)).min(axis=1)
        if (least == label).all():
            return label
        label = least


def _confirmed(batches: Iterator[pa.RecordBatch], similarity: int) -> Iterator[pa.RecordBatch]:
    keys = ["label", "i", "j"]
    for table in _groups(batches, keys, 2_000):
        starts = _starts(table, keys).tolist()
        node, side = table.column("node").to_numpy(), table.column("side").to_numpy()
        held = table.column("shingles")
        a, b = [], []
        for first, end in zip(starts, [*starts[1:], table.num_rows]):
            if end - first < 2:
                continue
            sets = [np.frombuffer(held[i].as_py(), np.uint64) for i in range(first, end)]
            label = linked_groups(sets, side[first:end], similarity)
            linked = np.flatnonzero(label != np.arange(end - first))
            a.append(node[first + linked])
            b.append(node[first + label[linked]])
        if a:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], ["a", "b"]
            )


def candidate_links(classes: DataFrame, matches: int) -> DataFrame:
    """Links (a, b) that connect all sets whose signatures agree in ``matches`` coordinates.

    ``classes``: member, tokens, sketch.
    """
    spark = classes.sparkSession
    posted = classes.select("member", F.explode("tokens").alias("token"))
    shared = posted.groupBy("token").agg(F.count("*").alias("df")).where("df > 1").select(
        F.col("token").alias("list"), "df"
    )
    # Tokens that nobody shares come first in a member's order and fill up its prefix.
    prefix = COORDINATES - matches + 1
    rarest = F.slice("lists", F.lit(1), F.greatest(F.lit(0), F.lit(prefix - COORDINATES) + F.size("lists")))
    lists = (
        posted.join(shared, F.col("token") == F.col("list"))
        .groupBy("member")
        .agg(F.array_sort(F.collect_list(F.struct("df", "token"))).alias("lists"))  # at most 64
        .select(F.col("member").alias("listed"), F.explode(rarest).alias("l"))
    )
    rows = lists.join(classes.select("member", "sketch"), F.col("listed") == F.col("member")).select(
        "member", "sketch", F.col("l.token").alias("token"), F.col("l.df").alias("df")
    )
    pairs = _pairs_of_blocks(rows, ["token"], F.ceil(F.col("df") / BLOCK), F.col("member"))
    found = pairs.select("token", "i", "j", "side", "member", "sketch").transform(
        map_arrow, lambda batches: _listed_together(batches, matches), "a long, b long"
    )
    return written(found, new_work_path(spark, "candidates"))


def near_duplicates(
    df: DataFrame, id_: str = "doc_id", text: str = "text", similarity: int = SIMILARITY
) -> DataFrame:
    """A row for each row of ``df``: id, ``n_shingles``, ``component_id``, ``kept``.

    ``n_shingles`` is the size of the text's set of distinct 5-word shingles (fewer words
    make one shingle, none an empty set, which is linked with nothing; null texts have
    none). ``component_id`` is the smallest id reachable over links, ``kept`` whether it
    is the row's own.

    Ids are integers. Rows that repeat an id are one node: both texts' links hold for
    both, and both rows are kept or not. A row without an id is linked with nothing, has
    no component and is kept. Texts are compared whole, equal sets only once. An empty
    table gives none; extra columns are not read. A similarity so low that signatures
    cannot find its pairs is refused.
    """
    spark = df.sparkSession
    matches = matches_for(similarity)
    signed = written(signatures(df, id_, text), new_work_path(spark, "signatures"))
    known = signed.where("n_shingles > 0 AND id IS NOT NULL")
    classes = known.groupBy("set_key").agg(
        F.min("id").alias("node"),
        F.count("*").alias("rows"),
        F.first("n_shingles").alias("n_shingles"),
        F.first("tokens").alias("tokens"),
        F.first("sketch").alias("sketch"),
    )
    # A member is a class; its number comes from the key, since ids may repeat. Should two
    # share a number, they are candidates together and told apart by key and node.
    classes = written(classes.withColumn("member", F.xxhash64("set_key")), new_work_path(spark, "classes"))
    groups = written(components(candidate_links(classes, matches)), new_work_path(spark, "groups"))
    grouped = groups.unionAll(groups.select("component", "component").distinct())
    sized = grouped.toDF("m", "label").join(
        classes.select("member", "node", "set_key", "n_shingles"), F.col("m") == F.col("member")
    )
    per_group = sized.groupBy("label").agg(
        F.greatest(
            F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("n_shingles") / BLOCK_SHINGLES)
        ).alias("blocks")
    ).select(F.col("label").alias("of"), "blocks")
    wanted = written(
        sized.join(per_group, F.col("label") == F.col("of")).select("label", "node", "set_key", "blocks"),
        new_work_path(spark, "members"),
    )
    # Members grow with the texts, so both sides are dealt out by id at every size.
    texts = df.select(F.col(id_).cast("long").alias("id"), F.col(text).alias("text")).join(
        wanted.hint("merge"), F.col("id") == F.col("node")
    )
    sets = _sets_of(texts, ["label", "node", "blocks"])
    pairs = _pairs_of_blocks(sets, ["label"], F.col("blocks"), F.col("node"))
    links = pairs.select("label", "i", "j", "side", "node", "shingles").transform(
            map_arrow,
        lambda batches: _confirmed(batches, similarity), "a long, b long"
    )
    # Rows that repeat an id join the classes they are in.
    repeated = known.groupBy("id").agg(F.count_distinct("set_key").alias("keys")).where("keys > 1").select(
        F.col("id").alias("again")
    )
    through = (
        known.join(repeated, F.col("id") == F.col("again"))
        .join(classes.select(F.col("set_key").alias("key"), "node"), F.col("set_key") == F.col("key"))
        .select(F.col("id").alias("a"), F.col("node").alias("b"))
    )
    reached = components(links.unionAll(through))
    # Only classes with more than their own first row say anything new about a row.
    told = (
        classes.select("set_key", "node", "rows")
        .join(reached.toDF("reached", "component"), F.col("node") == F.col("reached"), "left")
        .where("rows > 1 OR component IS NOT NULL")
        .select(F.col("set_key").alias("key"), F.coalesce("component", "node").alias("component"))
    )
    own_key = F.when(F.col("n_shingles") > 0, F.col("set_key")).otherwise(F.encode(F.col("id").cast("string"), "UTF-8"))
    component = F.when(F.col("id").isNotNull() & (F.col("n_shingles") > 0), F.coalesce("component", "id")).otherwise(F.col("id"))
    return (
        signed.select("id", "n_shingles", own_key.alias("set_key"))
        .join(told, F.col("set_key") == F.col("key"), "left")
        .select(F.col("id").alias(id_), "n_shingles", component.alias("component_id"))
        .withColumn("kept", F.col(id_).eqNullSafe(F.col("component_id")))
    )
