"""Benchmark passages in documents, by a positional inverted index.

The index stores, for every term of the items and every block of documents, the places of
the term in the block. A window of item words is looked up from its rarest terms: their
lists, each shifted by the term's offset in the item, are intersected, and what is left are
alignments of the item with the block. Those few are checked against the lists of all terms:
a place at the very word is a phrase match, one a few words off a proximity match.

Nothing of the documents but the lists of item terms is shuffled, and no list is longer
than a block.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import rolling
from tidemark.llm.batches import slices, utf8
from tidemark.llm.shipping import map_arrow
from tidemark.session import new_work_path, written

#: Words of a window; an item with fewer is one window.
WINDOW = 10
#: A proximity match has every word of a window at most so far from its place.
SLOP = 3
#: Terms of a window whose lists are intersected first.
RAREST = 3
#: Windows of one piece of an item; a longer item makes several.
PIECE = 256
#: Places in one row of the index.
LIST = 2048
#: Bits of the filter of item terms that the indexing tasks hold.
FILTER_BITS = 1 << 20
#: Blocks that share one part of a term's list in joins.
SPREAD = 64

_BYTES = np.zeros(256, bool)
_BYTES[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_PATTERN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_POSTING, _BLOCK, _DOCUMENT = range(3)
_INDEX = pa.schema(
    [
        ("kind", pa.int32()), ("block", pa.int64()), ("term", pa.string()), ("n", pa.int64()),
        ("places", pa.binary()), ("number", pa.int32()), ("id", pa.int64()),
    ]
)
_INDEX_SQL = "kind int, block long, term string, n long, places binary, number int, id long"


@dataclass(frozen=True)
class Index:
    """``postings``: term, block, n, places (binary, 32 bits each, in order). ``blocks``:
    block, firsts (binary, the place of each document's first word). ``documents``: block,
    number, id, n_words. ``gap`` places lie between documents."""

    postings: DataFrame
    blocks: DataFrame
    documents: DataFrame
    gap: int


def words_of(text: Column) -> Column:
    """Words of a text with A-Z lowered, none for null."""
    lowered = F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER)
    return F.regexp_extract_all(lowered, F.lit(_PATTERN), F.lit(0))


def pieces_of(items: DataFrame, id_: str, text: str) -> DataFrame:
    """Items cut into pieces of at most ``PIECE`` windows: piece, item, size (of a window), words.

    Written, since the numbers of the pieces have to stay the same.
    """
    read = items.select(
        F.col(f"`{id_}`").cast("string").alias("item"), words_of(F.col(f"`{text}`")).alias("all")
    ).where(F.size("all") > 0)
    size = F.least(F.size("all"), F.lit(WINDOW))
    last = F.floor((F.size("all") - size) / PIECE).cast("int")
    pieces = (
        read.select("item", "all", size.alias("size"), F.explode(F.sequence(F.lit(0), last)).alias("turn"))
        .select(
            F.monotonically_increasing_id().alias("piece"),
            "item",
            "size",
            F.slice("all", F.col("turn") * PIECE + 1, F.col("size") + PIECE - 1).alias("words"),
        )
    )
    return written(pieces, new_work_path(items.sparkSession, "pieces"))


def term_filter(terms: DataFrame) -> np.ndarray:
    """Which checksums, cut to ``FILTER_BITS``, the terms have; a bitmap of that fixed size."""
    bit = F.pmod(F.crc32(F.col("term").cast("binary")), F.lit(FILTER_BITS)) + 1
    maps = (
        terms.select(F.bitmap_bucket_number(bit).alias("part"), F.bitmap_bit_position(bit).alias("at"))
        .groupBy("part")
        .agg(F.bitmap_construct_agg("at").alias("bits"))
    )
    held = np.zeros(FILTER_BITS, bool)
    for part, bits in maps.collect():
        found = np.unpackbits(np.frombuffer(bits, np.uint8), bitorder="little").astype(bool)
        held[(part - 1) * len(found) : part * len(found)] = found
    return held


def build_index(df: DataFrame, terms: DataFrame, id_: str, text: str, slop: int = SLOP) -> Index:
    """The positional index of ``df`` over ``terms`` (column ``term``), written to the work folder.

    Terms that share a checksum with one of ``terms`` may be in it as well. A null text has
    no words; every row is a document of its own, whatever its id.
    """
    held = term_filter(terms)
    # Words of two documents are never within reach of one window.
    gap = 2 * slop + 2

    def rows(count: int, kind: int, **columns: object) -> pa.RecordBatch:
        columns["kind"] = np.full(count, kind, np.int32)
        arrays = [
            pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(count, f.type)
            for f in _INDEX
        ]
        return pa.RecordBatch.from_arrays(arrays, schema=_INDEX)

    def index(part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        data, offsets = utf8(part.column("text"))
        data = rolling.lowered(data)
        words = rolling.Words(data, offsets, _BYTES)
        numbers, dictionary = rolling.numbered(data, words.starts, words.ends)
        block = part.column("row")[0].as_py()
        docs = np.arange(part.num_rows)
        firsts = (words.first[:-1] + gap * docs).astype("<i4")
        yield rows(part.num_rows, _DOCUMENT, block=np.full(part.num_rows, block), n=words.per_doc,
                   number=docs, id=part.column("id"))
        yield rows(1, _BLOCK, block=[block], places=[firsts.tobytes()])
        names = dictionary.to_pylist()
        wanted = np.array([held[crc32(name) % FILTER_BITS] for name in names], bool)
        at = np.flatnonzero(wanted[numbers]) if len(names) else np.zeros(0, np.int64)
        at = at[np.argsort(numbers[at], kind="stable")]
        places = (at + gap * words.doc[at]).astype("<i4")
        owner = numbers[at]
        starts = np.flatnonzero(np.diff(owner, prepend=-1))
        for chunk in range(0, len(starts), 4096):
            term, lists = [], []
            ends = np.append(starts[1:], len(owner))[chunk : chunk + 4096]
            for a, b in zip(starts[chunk : chunk + 4096].tolist(), ends.tolist()):
                for c in range(a, b, LIST):
                    term.append(names[owner[a]].decode())
                    lists.append(places[c : min(b, c + LIST)].tobytes())
            yield rows(len(term), _POSTING, block=np.full(len(term), block), term=term,
                       n=[len(x) // 4 for x in lists], places=lists)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                yield from index(part)

    texts = df.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(f"`{id_}`").cast("long").alias("id"),
        F.col(f"`{text}`").alias("text"),
    )
    stored = written(map_arrow(texts, run, _INDEX_SQL), new_work_path(df.sparkSession, "index"))
    of = stored.where
    return Index(
        of(F.col("kind") == _POSTING).select("term", "block", "n", "places"),
        of(F.col("kind") == _BLOCK).select("block", F.col("places").alias("firsts")),
        of(F.col("kind") == _DOCUMENT).select("block", "number", "id", F.col("n").alias("n_words")),
        gap,
    )


def rarest_terms(pieces: DataFrame, terms: DataFrame, counts: DataFrame) -> DataFrame:
    """The rarest terms of each window, by piece and term: ``uses``, the groups of offsets
    whose lists have to meet, and the term's own offset in each.

    Windows with a term that no document has are left out.
    """
    entry = F.struct("at", "count", "term")
    entries = (
        terms.join(counts, "term", "left")
        .groupBy("piece", "size")
        .agg(F.sort_array(F.collect_list(entry)).alias("entries"))
    )

    def rarest(start: Column) -> Column:
        window = F.slice("entries", start + 1, F.col("size"))
        order = F.transform(window, lambda e: F.struct(e["count"].alias("count"), e["at"].alias("at"), e["term"].alias("term")))
        some = F.slice(F.sort_array(order), 1, RAREST)
        return F.when(F.forall(window, lambda e: e["count"].isNotNull()), some)

    windows = entries.select(
        "piece",
        F.explode(
            F.array_distinct(F.transform(F.sequence(F.lit(0), F.size("entries") - F.col("size")), rarest))
        ).alias("anchors"),
    ).where(F.col("anchors").isNotNull())
    group = F.array_join(F.transform("anchors", lambda a: a["at"].cast("string")), ",")
    return (
        windows.select("piece", group.alias("offsets"), F.explode("anchors").alias("anchor"))
        .select("piece", "offsets", "anchor.at", "anchor.term")
        .groupBy("piece", "term")
        .agg(F.collect_list(F.struct("at", "offsets")).alias("uses"))
    )


def _alignments(slop: int):
    """Where the lists of a window's rarest terms meet, each shifted by its offset."""
    reach = np.arange(-slop, slop + 1)

    def of(lists: list[dict]) -> np.ndarray:
        places: dict[int, list[np.ndarray]] = {}
        groups: set[str] = set()
        for entry in lists:
            own = np.frombuffer(entry["places"], "<i4").astype(np.int64)
            for use in entry["uses"]:
                places.setdefault(use["at"], []).append(own)
                groups.add(use["offsets"])
        shifted: dict[int, np.ndarray] = {}

        def around(at: int) -> np.ndarray:
            if at not in shifted:
                own = np.concatenate(places[at]) - at
                shifted[at] = np.unique(own[:, None] + reach)
            return shifted[at]

        met = []
        for group in groups:
            offsets = [int(at) for at in group.split(",")]
            if not all(at in places for at in offsets):
                continue
            left, *others = sorted((around(at) for at in offsets), key=len)
            for other in others:
                left = left[other[np.minimum(np.searchsorted(other, left), len(other) - 1)] == left]
            met.append(left)
        return np.unique(np.concatenate(met)) if met else np.zeros(0, np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, found = [], []
            for i, lists in enumerate(batch.column("lists")):
                met = of(lists.as_py())
                if len(met):
                    kept.append(i)
                    found.append(met.astype("<i4").tobytes())
            own = batch.take(pa.array(kept, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [own.column("piece"), own.column("block"), pa.array(found, pa.binary())],
                ["piece", "block", "alignments"],
            )

    return run


def _check(slop: int):
    """Which alignments have the term at its places, and which near them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            exact, near = [], []
            columns = (batch.column(c).to_pylist() for c in ("ats", "alignments", "places"))
            for ats, alignments, places in zip(*columns):
                own = np.frombuffer(places, "<i4").astype(np.int64)
                wanted = (np.frombuffer(alignments, "<i4").astype(np.int64)[:, None] + np.array(ats)).ravel()
                after = np.searchsorted(own, wanted)
                right = np.abs(own[np.minimum(after, len(own) - 1)] - wanted)
                distance = np.minimum(right, np.abs(own[np.maximum(after - 1, 0)] - wanted))
                exact.append(np.packbits(distance == 0).tobytes())
                near.append(np.packbits(distance <= slop).tobytes())
            names = ["piece", "block", "item", "size", "length", "alignments", "ats"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), pa.array(exact, pa.binary()), pa.array(near, pa.binary())],
                [*names, "exact", "near"],
            )

    return run


def _spans(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends of the stretches of true values."""
    steps = np.diff(inside.astype(np.int8), prepend=0, append=0)
    return np.flatnonzero(steps == 1), np.flatnonzero(steps == -1)


def _matches(slop: int, gap: int):
    """Windows that are whole at an alignment, as stretches of words of one document."""

    def of(row: dict) -> Iterator[tuple[int, int, int, bool]]:
        firsts = np.frombuffer(row["firsts"], "<i4").astype(np.int64)
        alignments = np.frombuffer(row["alignments"], "<i4").astype(np.int64)
        for kind in ("exact", "near"):
            held = np.zeros((len(alignments), row["length"]), bool)
            for term in row["terms"]:
                bits = np.unpackbits(np.frombuffer(term[kind], np.uint8), count=len(alignments) * len(term["ats"]))
                held[:, term["ats"]] |= bits.reshape(len(alignments), -1).astype(bool)
            sums = np.zeros((len(alignments), row["length"] + 1), np.int64)
            np.cumsum(held, axis=1, out=sums[:, 1:])
            whole = sums[:, row["size"] :] - sums[:, : -row["size"]] == row["size"]
            which, start = np.nonzero(whole)
            if not len(which):
                continue
            # Windows of one document, from the first to the last word that is covered.
            begins = np.sort(alignments[which] + start)
            low = int(begins[0])
            covered = np.zeros(int(begins[-1]) - low + row["size"] + 1, np.int64)
            np.add.at(covered, begins - low, 1)
            np.add.at(covered, begins - low + row["size"], -1)
            for a, b in zip(*_spans(np.cumsum(covered) > 0)):
                first, last = int(a) + low, int(b) + low
                number = int(np.searchsorted(firsts, first + slop, "right")) - 1
                yield number, max(first - int(firsts[number]), 0), last - int(firsts[number]), kind == "exact"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for row in batch.to_pylist():
                found += [(row["block"], *match[:1], row["item"], *match[1:]) for match in of(row)]
            block, number, item, start, stop, exact = zip(*found) if found else [()] * 6
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(block, pa.int64()), pa.array(number, pa.int32()), pa.array(item, pa.string()),
                    pa.array(start, pa.int64()), pa.array(stop, pa.int64()), pa.array(exact, pa.bool_()),
                ],
                ["block", "number", "item", "start", "stop", "exact"],
            )

    return run


def find_passages(index: Index, pieces: DataFrame, slop: int = SLOP) -> DataFrame:
    """``block, number, item, start, stop, exact``: words from ``start`` up to ``stop`` of a
    document that windows of an item cover, with the very words in a row (``exact``), or
    with each word at most ``slop`` off its place."""
    spark = pieces.sparkSession
    terms = pieces.select("piece", "item", "size", F.size("words").alias("length"), F.posexplode("words").alias("at", "term"))
    counts = index.postings.groupBy("term").agg(F.sum("n").alias("count"))
    parts = index.blocks.count() // SPREAD + 1
    part = F.pmod(F.xxhash64("block"), F.lit(parts)).alias("part")
    every_part = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1))).alias("part")
    # Written, so that the planner knows their size.
    rarest = written(rarest_terms(pieces, terms, counts), new_work_path(spark, "rarest"))
    postings = index.postings.select("*", part)
    lists = rarest.select("*", every_part).join(postings, ["term", "part"])
    met = (
        lists.groupBy("piece", "block")
        .agg(F.collect_list(F.struct("uses", "places")).alias("lists"))
        .transform(map_arrow, _alignments(slop), "piece long, block long, alignments binary")
    )
    met = written(met, new_work_path(spark, "alignments"))
    by_term = terms.groupBy("piece", "item", "size", "length", "term").agg(F.collect_list("at").alias("ats"))
    wanted = met.select("*", part).join(by_term.select("*", every_part), ["piece", "part"])
    checked = (
        wanted.drop("part")
        .join(index.postings.drop("n"), ["term", "block"])
        .select("piece", "block", "item", "size", "length", "alignments", "ats", "places")
        .transform(
            map_arrow,
            _check(slop),
            "piece long, block long, item string, size int, length int, alignments binary, "
            "ats array<int>, exact binary, near binary",
        )
    )
    return (
        checked.groupBy("piece", "block", "item", "size", "length")
        .agg(F.first("alignments").alias("alignments"), F.collect_list(F.struct("ats", "exact", "near")).alias("terms"))
        .join(index.blocks, "block")
        .transform(
            map_arrow,
            _matches(slop, index.gap),
            "block long, number int, item string, start long, stop long, exact boolean",
        )
    )


def decontaminate(
    df: DataFrame,
    items: DataFrame,
    id_: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    slop: int = SLOP,
) -> DataFrame:
    """Per row of ``df``: ``id, n_words, n_hit, items, near_items``.

    ``n_hit`` counts words inside phrase matches of windows, ``items`` lists the items they
    are of and ``near_items`` those of proximity matches, as sorted strings, each once. A
    null text, of a document or an item, has no words and matches nothing; an item without
    an id has its words counted but is in no list; repeated items count once, repeated
    documents each. Texts and items are read whole, however long. Without items nothing is
    hit; without documents the result is empty. Other columns are not read.
    """
    pieces = pieces_of(items, item_id, item_text)
    index = build_index(df, pieces.select(F.explode("words").alias("term")), id_, text, slop)
    # Written: it is read for the words and for the items.
    matches = written(find_passages(index, pieces, slop), new_work_path(df.sparkSession, "matches"))
    in_order = Window.partitionBy("block", "number").orderBy("start", "stop")
    before = F.max("stop").over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    exact = F.col("exact")
    words = matches.where(exact).select("block", "number", "start", "stop", before.alias("before"))
    new = F.greatest(F.col("stop") - F.greatest("start", F.coalesce("before", F.lit(0))), F.lit(0))
    hit = words.groupBy("block", "number").agg(F.sum(new).alias("n_hit"))
    named = matches.select("block", "number", "item", "exact").distinct().groupBy("block", "number").agg(
        F.sort_array(F.collect_set(F.when(exact, F.col("item")))).alias("items"),
        F.sort_array(F.collect_set(F.when(~exact, F.col("item")))).alias("near_items"),
    )
    none = F.array().cast("array<string>")
    return (
        index.documents.join(named.join(hit, ["block", "number"], "left"), ["block", "number"], "left")
        .select(
            "id",
            "n_words",
            F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
            F.coalesce("items", none).alias("items"),
            F.coalesce("near_items", none).alias("near_items"),
        )
    )
