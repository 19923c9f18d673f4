"""Runs: stretches of words that repeat with a period, four times or more.

Scale-tiled: periods are taken by octave, P/2 to P. A document is cut into tiles that
overlap by a few of their largest period, longer tiles for longer periods, and each tile is
solved alone. In a tile, every P-th word is a boundary. A run of the octave is long enough
to hold a boundary with P/2 equal word pairs on its right, and the Z-functions at that
boundary, forward and backward, give for every period how far its words keep repeating.
What a tile finds is a fragment: the stretch of a run that it could see. Fragments are
shuffled by document and period and stitched where they overlap.

Words are compared by exact numbers. Hashes only choose the boundaries that are looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import rolling
from tidemark.llm.batches import slices, utf8
from tidemark.llm.shipping import map_arrow
from tidemark.session import new_work_path, written

#: A run has this many words and this many periods at least.
LEAST_WORDS, LEAST_PERIODS = 6, 4
#: Words of the smallest tiles, and how many of its largest period a tile holds.
TILE, PERIODS_A_TILE = 4096, 8
#: Periods by which a tile reaches into the next: a run that leaves either one with less
#: than 1.5 periods in sight is whole in the other.
OVERLAP = 3

_FINISHED, _TEXT, _TILE, _FRAGMENT = range(4)
_SOLVED = pa.schema(
    [
        ("row", pa.int64()), ("kind", pa.int32()), ("id", pa.int64()), ("n", pa.int64()),
        ("collapsed", pa.string()), ("text", pa.string()),
        ("at", pa.int64()), ("low", pa.int64()), ("high", pa.int64()), ("last", pa.bool_()),
        ("words", pa.binary()), ("period", pa.int64()), ("start", pa.int64()), ("stop", pa.int64()),
    ]
)
_SOLVED_SQL = (
    "row long, kind int, id long, n long, collapsed string, text string, at long, low long, "
    "high long, last boolean, words binary, period long, start long, stop long"
)
_FRAGMENTS_SQL = "row long, period long, start long, stop long"
RUN = "struct<start: bigint, period: bigint, length: bigint>"


@lru_cache(maxsize=4096)
def _prime_factors(q: int) -> tuple[int, ...]:
    found, p = [], 2
    while p * p <= q:
        if q % p == 0:
            found.append(p)
            while q % p == 0:
                q //= p
        p += 1
    return tuple(found + [q] * (q > 1))


def z_function(values: list[int], count: int) -> list[int]:
    """For each of the first ``count`` places: how many values from there on equal the first ones."""
    size = len(values)
    z = [0] * min(count, size)
    if z:
        z[0] = size
    left = right = 0
    for i in range(1, len(z)):
        length = min(right - i, z[i - left]) if i < right else 0
        while i + length < size and values[length] == values[i + length]:
            length += 1
        z[i] = length
        if i + length > right:
            left, right = i, i + length
    return z


def _extents(words: np.ndarray, c: int, top: int, low: int, high: int) -> Iterator[tuple[int, int, int]]:
    """For each period of the octave below ``top`` whose words repeat at ``c`` for half of
    ``top``: the period and the equal pairs around ``c``, at most two of ``top`` each way.

    ``low`` and ``high`` bound the document. Periods that a smaller one explains are left out.
    """
    ahead = words[c : min(high, c + 3 * top)].tolist()
    forward = z_function(ahead, top)
    wanted = [q for q in range(top // 2, min(top, len(forward))) if forward[q] >= top // 2]
    wanted = [
        q for q in wanted if not any(forward[q // r] >= q - q // r for r in _prime_factors(q))
    ]
    if not wanted:
        return
    behind = words[max(low, c - 2 * top) : c][::-1].tolist()
    around = words[max(low, c - 2 * top) : min(high, c + top - 1)][::-1].tolist()
    # Reversed, the words before c + q begin ``shift - q`` after those before c + top - 1.
    both = [*behind, -1, *around]
    backward = z_function(both, len(both))
    shift = len(behind) + 1 + min(high, c + top - 1) - c
    for q in wanted:
        yield q, c - min(backward[shift - q], len(behind)), c + min(forward[q], 2 * top)


def _boundaries(hashes: np.ndarray, top: int, explained: list[tuple[int, int]]) -> np.ndarray:
    """Places at multiples of ``top`` that may have a new period of the octave below it.

    ``hashes`` cover half of ``top`` words each. Where a stretch of a smaller period
    reaches over one and a half of ``top``, larger periods are multiples of that one.
    """
    half, rows = top // 2, len(hashes) // top + 1
    grid = np.zeros(rows * top, np.uint64)
    grid[: len(hashes)] = hashes
    grid = grid.reshape(rows, top)
    places = np.flatnonzero((grid[:, half:] == grid[:, :1]).any(axis=1)) * top
    places = places[places + half < len(hashes)]
    if not explained or not len(places):
        return places
    known = np.array(sorted(explained))
    reach = np.maximum.accumulate(known[:, 1])
    before = np.searchsorted(known[:, 0], places, "right") - 1
    return places[(before < 0) | (reach[np.maximum(before, 0)] < places + top + half)]


def fragments(
    words: np.ndarray, bounds: np.ndarray, low: int, high: int, left: np.ndarray, right: np.ndarray
) -> list[tuple[int, int, int, int]]:
    """Stretches of equal word pairs a period apart: piece, period, start and stop.

    ``words`` holds pieces one after the other, ``bounds`` where each begins; places count
    from the begin of the piece. Octaves go by the power of two above them, from ``low`` to
    ``high``. A stretch comes whole, as far as its piece shows it; one too short for a run
    only where it touches an end of the piece that is open, by ``left`` and ``right``.
    """
    longest = int(np.diff(bounds).max(initial=0))
    hashes = rolling.mixed(words.astype(np.uint64) + np.uint64(1))
    explained: list[tuple[int, int]] = []
    found = []
    top = 2
    while top <= high and max(LEAST_WORDS, LEAST_PERIODS * top // 2) <= longest:
        if top >= low:
            places = _boundaries(hashes, top, explained)
            pieces = np.searchsorted(bounds, places, "right") - 1
            seen = sorted(
                (piece, *stretch)
                for c, piece in zip(places.tolist(), pieces.tolist())
                for stretch in _extents(words, c, top, int(bounds[piece]), int(bounds[piece + 1]))
            )
            whole: list[list[int]] = []
            for piece, q, start, stop in seen:
                if whole and whole[-1][:2] == [piece, q] and start <= whole[-1][3]:
                    whole[-1][3] = max(whole[-1][3], stop)
                else:
                    whole.append([piece, q, start, stop])
            for piece, q, start, stop in whole:
                explained.append((start, stop + q))
                begin, end = int(bounds[piece]), int(bounds[piece + 1])
                cut = (left[piece] and start == begin) or (right[piece] and stop + q == end)
                if cut or stop - start + q >= max(LEAST_WORDS, LEAST_PERIODS * q):
                    found.append((piece, q, start - begin, stop - begin))
        half = top // 2
        hashes = rolling.mixed(hashes[:-half] * np.uint64(rolling.STEP) + hashes[half:])
        top *= 2
    return found


def tiles(n: int, tile: int) -> Iterator[tuple[int, int, int, int]]:
    """Tiles of a document of ``n`` words: begin, end and the octaves to look for."""
    low, high, size = 2, tile // PERIODS_A_TILE, tile
    while LEAST_PERIODS * low // 2 <= n:
        for begin in range(0, n, size):
            end = min(n, begin + size + OVERLAP * high)
            yield begin, end, low, high
            if end == n:
                break
        low, high, size = high * 2, high * PERIODS_A_TILE, size * PERIODS_A_TILE


def _rows(count: int, **columns: object) -> pa.RecordBatch:
    arrays = [
        pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(count, f.type)
        for f in _SOLVED
    ]
    return pa.RecordBatch.from_arrays(arrays, schema=_SOLVED)


def _finished_text(words: list[bytes], digest: bool) -> str:
    text = b" ".join(words)
    return hashlib.sha256(text).hexdigest() if digest else text.decode()


def _first_pass(tile: int, digest: bool):
    """Documents that are done, texts of the others, fragments of short ones, tiles of long ones."""

    def solve(part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        data, offsets = utf8(part.column("text"))
        words = rolling.Words(data, offsets)
        numbers, _ = rolling.numbered(data, words.starts, words.ends)
        rows, ids = part.column("row").to_pylist(), part.column("id").to_pylist()
        short = words.per_doc <= tile
        own = np.flatnonzero(short)
        bounds = np.concatenate(([0], np.cumsum(words.per_doc[own])))
        closed = np.zeros(len(own), bool)
        mine = numbers[np.repeat(short, words.per_doc)]
        seen = fragments(mine, bounds, 2, 2 * tile, closed, closed)
        seen = [(int(own[piece]), *stretch) for piece, *stretch in seen]
        pending = ~short
        pending[[d for d, *_ in seen]] = True
        buffer, at = data.tobytes(), offsets.tolist()
        done = np.flatnonzero(~pending).tolist()
        yield _rows(
            len(done),
            row=[rows[d] for d in done],
            kind=[_FINISHED] * len(done),
            id=[ids[d] for d in done],
            n=words.per_doc[done],
            collapsed=[_finished_text(buffer[at[d] : at[d + 1]].split(), digest) for d in done],
        )
        for d in np.flatnonzero(pending).tolist():
            yield _rows(
                1, row=[rows[d]], kind=[_TEXT], id=[ids[d]], n=[int(words.per_doc[d])],
                text=[buffer[at[d] : at[d + 1]].decode()],
            )
        yield _rows(
            len(seen),
            row=[rows[d] for d, *_ in seen],
            kind=[_FRAGMENT] * len(seen),
            period=[q for _, q, _, _ in seen],
            start=[start for _, _, start, _ in seen],
            stop=[stop for *_, stop in seen],
        )
        for d in np.flatnonzero(~short).tolist():
            first, n = int(words.first[d]), int(words.per_doc[d])
            for begin, end, low, high in tiles(n, tile):
                yield _rows(
                    1, row=[rows[d]], kind=[_TILE], at=[begin], low=[low], high=[high],
                    last=[end == n],
                    words=[numbers[first + begin : first + end].astype("<i4").tobytes()],
                )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                yield from (rows for rows in solve(part) if rows.num_rows)

    return run


def _solve_tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = []
        for tile in batch.to_pylist():
            words = np.frombuffer(tile["words"], "<i4")
            bounds = np.array([0, len(words)])
            left, right = np.array([tile["at"] > 0]), np.array([not tile["last"]])
            for _, q, start, stop in fragments(words, bounds, tile["low"], tile["high"], left, right):
                found.append((tile["row"], q, start + tile["at"], stop + tile["at"]))
        columns = zip(*found) if found else [()] * 4
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64()) for c in columns], ["row", "period", "start", "stop"]
        )


def stitched(fragments_: DataFrame) -> DataFrame:
    """Fragments of one document and period joined where they overlap: row, start, length, period."""
    in_order = Window.partitionBy("row", "period").orderBy("start", "stop")
    before = F.max("stop").over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    island = F.sum("opens").over(in_order.rowsBetween(Window.unboundedPreceding, 0))
    length = F.max("stop") - F.min("start") + F.col("period")
    return (
        fragments_.withColumn("opens", F.coalesce(F.col("start") > before, F.lit(True)).cast("int"))
        .withColumn("island", island)
        .groupBy("row", "period", "island")
        .agg(F.min("start").alias("start"), length.alias("length"))
        .select("row", "start", "length", "period")
    )


def _collapse(digest: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                collapsed = []
                for text, runs in zip(part.column("text").to_pylist(), part.column("runs").to_pylist()):
                    words = text.encode().split()
                    drop = np.zeros(len(words) + 1, np.int64)
                    for run_ in runs:
                        drop[run_["start"] + run_["period"]] += 1
                        drop[run_["start"] + run_["length"]] -= 1
                    kept = np.flatnonzero(np.cumsum(drop[:-1]) == 0).tolist()
                    collapsed.append(_finished_text([words[i] for i in kept], digest))
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), part.column("n"), part.column("runs"), pa.array(collapsed, pa.string())],
                    ["id", "n", "runs", "collapsed"],
                )

    return run


def find_runs(
    df: DataFrame, id_: str = "doc_id", text: str = "text", tile: int = TILE, digest: bool = False
) -> DataFrame:
    """Per row of ``df``: ``id, n, runs, collapsed``.

    ``n`` counts words; ``runs`` lists every run (start, period and length, in words) by start,
    then period; ``collapsed`` is the words that no run holds after its first period, with a
    blank between them, or with ``digest`` the SHA-256 of that.

    A null, empty or blank text has no words, no runs and collapses to nothing. A row
    without an id is treated like any other, and so is each of repeated rows. Texts are
    taken whole: one of more than ``tile`` words is spread over tasks by its tiles. Runs
    that overlap or lie inside another are all listed. An empty table stays empty; other
    columns of ``df`` are not read, whatever their names.
    """
    if tile < 4 * PERIODS_A_TILE or tile & (tile - 1):
        raise ValueError(f"a tile is a power of two of at least {4 * PERIODS_A_TILE} words")
    spark = df.sparkSession
    texts = df.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(f"`{id_}`").cast("long").alias("id"),
        F.col(f"`{text}`").alias("text"),
    )
    # Written once: rows, tiles and fragments of one attempt belong together.
    solved = written(
        map_arrow(texts, _first_pass(tile, digest), _SOLVED_SQL), new_work_path(spark, "runs")
    )

    def of(kind: int, *columns: str) -> DataFrame:
        return solved.where(F.col("kind") == kind).select(*columns)

    cut = of(_TILE, "row", "at", "low", "high", "last", "words").repartition("row", "low", "at")
    pieces = of(_FRAGMENT, "row", "period", "start", "stop").unionByName(
        map_arrow(cut, _solve_tiles, _FRAGMENTS_SQL)
    )
    enough = F.greatest(F.lit(LEAST_WORDS), LEAST_PERIODS * F.col("period"))
    runs = (
        stitched(pieces)
        .where(F.col("length") >= enough)
        .groupBy("row")
        .agg(F.sort_array(F.collect_list(F.struct("start", "period", "length"))).alias("runs"))
    )
    none = F.array().cast(f"array<{RUN}>")
    pending = of(_TEXT, "row", "id", "n", "text").join(runs, "row", "left")
    pending = pending.select("id", "n", "text", F.coalesce("runs", none).alias("runs"))
    schema = f"id long, n long, runs array<{RUN}>, collapsed string"
    finished = of(_FINISHED, "id", "n", "collapsed").withColumn("runs", none)
    return map_arrow(pending, _collapse(digest), schema).unionByName(finished)

