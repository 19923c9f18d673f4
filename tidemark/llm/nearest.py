"""Nearest neighbours by randomly rotated one-bit codes.

A vector, less the centre of all, is turned by a random rotation and kept as the signs of
its coordinates, its length and one correction: how well the signs stand for it. Short
vectors are turned within a larger space, which gives longer codes and smaller errors.
From packed signs and four bit planes of a query, counting common bits estimates the
inner product, with an error bound; vectors whose smallest possible distance is within
that of the k-th nearest so far are ranked anew by their exact distances.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.shipping import map_arrow
from tidemark.session import new_work_path, written

#: Bytes of query vectors that are sent to the tasks at once.
QUERY_BYTES = 32 << 20
#: Queries, and vectors, of the tiles in which a task makes its estimates.
TILE = 512
#: Bits of a code at least; more dimensions than that get a bit each.
BITS = 512
#: Bits that a coordinate of a query is rounded to.
PLANES = 4
#: Width of the error bound in standard deviations; a true neighbour is missed with a
#: chance of about exp(-width**2 / 2) for each estimate.
WIDTH = 6.0
SEED = 7


def rotation(size: int, bits: int | None = None, seed: int = SEED) -> np.ndarray:
    """A random rotation of ``size`` coordinates padded with zeros to ``bits``, uniform
    over all of them: a matrix of ``bits`` rows and ``size`` columns."""
    turned, upper = np.linalg.qr(np.random.default_rng(seed).standard_normal((bits or size, size)))
    return turned * np.sign(np.diag(upper))


def code_bits(size: int) -> int:
    """Length of the codes: whole words of 64 bits, ``BITS`` at least."""
    return max(BITS, -(-size // 64) * 64)


def usable(df: DataFrame, id_: str, vector: str) -> DataFrame:
    """id and vector (doubles) of the rows that take part: neither null, zero nor holding
    a component that is null or not finite."""
    values = F.transform(F.col(vector), lambda v: v.cast("double"))
    finite = F.forall("vector", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return df.select(F.col(id_).alias("id"), values.alias("vector")).where(
        F.col("id").isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists("vector", lambda v: v != 0)
    )


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def encode_vectors(vectors: DataFrame, centre: np.ndarray, turn: np.ndarray) -> DataFrame:
    """``vectors`` (id, vector) with ``code`` (packed signs), ``length`` (from the centre)
    and ``fit`` (inner product of the unit vector with its code's unit vector)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            away = (_matrix(batch.column("vector")) - centre) @ turn.T
            length = np.sqrt((away * away).sum(axis=1))
            fit = np.abs(away).sum(axis=1) / math.sqrt(away.shape[1]) / np.where(length > 0, length, 1)
            codes = np.packbits(away > 0, axis=1)
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns,
                    pa.array([c.tobytes() for c in codes], pa.binary()),
                    pa.array(length),
                    pa.array(np.where(length > 0, fit, 1.0)),
                ],
                ["id", "vector", "code", "length", "fit"],
            )

    schema = vectors.schema.simpleString()[7:-1]
    return vectors.transform(map_arrow, run, f"{schema}, code binary, length double, fit double")


def exact(vectors: np.ndarray, v: np.ndarray, queries: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Euclidean distances of pairs of columns, squares added in the order of the components."""
    total = np.zeros(len(v))
    for vector, query in zip(vectors, queries):
        total += (vector[v] - query[q]) ** 2
    return np.sqrt(total)


class Estimates:
    """Turned queries as bit planes, and the bounds they give to coded vectors."""

    def __init__(self, turned: np.ndarray, width: float) -> None:
        self.bits = turned.shape[1]
        self.length = np.sqrt((turned * turned).sum(axis=1))
        unit = turned / np.where(self.length > 0, self.length, 1)[:, None]
        self.least = unit.min(axis=1, initial=0)
        self.step = (unit.max(axis=1, initial=0) - self.least) / (2**PLANES - 1)
        scaled = (unit - self.least[:, None]) / np.where(self.step > 0, self.step, 1)[:, None]
        # Rounded up or down by chance, so that errors are independent with a mean of 0.
        whole = np.floor(scaled + np.random.default_rng(SEED).random(unit.shape)).clip(0, 2**PLANES - 1)
        self.total = self.least * self.bits + self.step * whole.sum(axis=1)
        whole = whole.astype(np.uint8)
        self.planes = [np.packbits(whole >> j & 1, axis=1).view(np.uint64) for j in range(PLANES)]
        self.width = width

    def bounds(self, codes: np.ndarray, length: np.ndarray, fit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Estimated and smallest possible squared distances, by query and vector.

        ``codes`` are words of 64 bits, as many for each vector as ``bits`` has.
        """
        ones = np.bitwise_count(codes).sum(axis=1, dtype=np.int64)
        common = np.zeros((len(self.length), len(codes)), np.uint32)
        for j, plane in enumerate(self.planes):
            for w in range(codes.shape[1]):
                common += np.bitwise_count(codes[None, :, w] & plane[:, None, w]).astype(np.uint32) << np.uint32(j)
        held = self.least[:, None] * ones + self.step[:, None] * common
        inner = (2 * held - self.total[:, None]) / (math.sqrt(self.bits) * fit)
        # The code's error, and that of the rounded query: at most half a step.
        spread = (1 - fit * fit).clip(0) / max(self.bits - 1, 1) + (self.step[:, None] / 2) ** 2
        # No inner product of unit vectors is beyond 1.
        near = np.minimum(inner + self.width * np.sqrt(spread) / fit, 1.0)
        both = self.length[:, None] ** 2 + length**2
        scale = 2 * self.length[:, None] * length
        # What rounding may add or take off is small beside the lengths.
        return both - scale * inner, both * (1 - 1e-9) - scale * near


class Best:
    """The ``k`` nearest so far of each query, by exact distance then id."""

    def __init__(self, queries: np.ndarray, k: int) -> None:
        self.queries, self.k = np.ascontiguousarray(queries.T), k
        self.query, self.score, self.id = np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64)
        self.reach = np.full(len(queries), np.inf)  # square of the k-th distance

    def add(self, chosen: np.ndarray, ids: np.ndarray, vectors: np.ndarray) -> None:
        """Rank the pairs marked in ``chosen`` (query by vector) among those so far."""
        q, v = np.nonzero(chosen)
        score = exact(np.ascontiguousarray(vectors.T), v, self.queries, q)
        near = score * score <= self.reach[q]
        if near.any():
            score = np.concatenate((self.score, score[near]))
            q, own = np.concatenate((self.query, q[near])), np.concatenate((self.id, ids[v[near]]))
            order = np.lexsort((own, score, q))
            q = q[order]
            place = np.arange(len(q)) - np.searchsorted(q, q)
            order, place, q = order[place < self.k], place[place < self.k], q[place < self.k]
            self.query, self.score, self.id = q, score[order], own[order]
            last = place == self.k - 1
            self.reach[q[last]] = self.score[last] ** 2 * (1 + 1e-9)


def _search(batches: Iterator[pa.RecordBatch], rows_of, ids, queries, turned, k: int, width: float) -> Iterator[pa.RecordBatch]:
    """The ``k`` nearest of a partition for each query row, by exact distance then id."""
    tiles = []
    for at in range(0, len(ids), TILE):
        own = slice(at, at + TILE)
        tiles.append((ids[own, None], Estimates(turned[own], width), Best(queries[own], k)))
    for batch in batches:
        for at in range(0, batch.num_rows, TILE):
            part = batch.slice(at, TILE)
            own, vectors = part.column("id").to_numpy().astype(np.int64), _matrix(part.column("vector"))
            codes = np.frombuffer(b"".join(part.column("code").to_pylist()), np.uint64).reshape(len(own), -1)
            length, fit = part.column("length").to_numpy(), part.column("fit").to_numpy()
            for asked, estimates, best in tiles:
                likely, low = estimates.bounds(codes, length, fit)
                left = asked != own
                if np.isinf(best.reach).any() and len(own) > k:
                    # The likeliest first: their exact distances rule out most of the others.
                    first = np.argpartition(np.where(left, likely, np.inf), k, axis=1)[:, : k + 1]
                    early = np.zeros_like(left)
                    np.put_along_axis(early, first, True, axis=1)
                    best.add(early & left, own, vectors)
                    left &= ~early
                best.add(left & (low <= best.reach[:, None]), own, vectors)
    for at, (asked, _, best) in zip(range(0, len(ids), TILE), tiles):
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(rows_of[at + best.query]),
                pa.array(asked[best.query, 0]),
                pa.array(best.id),
                pa.array(best.score),
            ],
            ["query_row", "query_id", "id", "score"],
        )


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of the vectors of a partition by dimension, and how many there are."""
    total, n = np.zeros(0), 0
    for batch in batches:
        if batch.num_rows:
            own = _matrix(batch.column("vector"))
            total, n = (total if n else np.zeros(own.shape[1])) + own.sum(axis=0), n + len(own)
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.arange(len(total))), pa.array(total), pa.array(np.full(len(total), n))], ["i", "total", "n"]
    )


def scale_of(largest: float) -> float:
    """The power of two that vectors are multiplied with, so that squares are finite and
    keep their digits; 1 unless components are very large or all very small."""
    exponent = math.frexp(largest)[1]
    return 1.0 if -400 < exponent < 400 else math.ldexp(1.0, max(-1000, min(1000, -exponent)))


def nearest(
    df: DataFrame,
    queries: DataFrame,
    k: int = 10,
    id_: str = "vec_id",
    vector: str = "embedding",
    width: float = WIDTH,
) -> DataFrame:
    """The ``k`` nearest rows of ``df`` for each row of ``queries`` (same columns).

    ``query_id, rank, id, score``: Euclidean distance in double precision, ties to the
    smaller id; a row is never its own neighbour (by id); fewer rows than ``k`` give all.
    Vectors that are null, zero, or hold null or non-finite components take no part, as
    query or as candidate, nor do rows without an id; empty tables give none. All vectors
    must be of one size. Repeated ids are candidates each, and queries each: every query
    row has a list of its own. Extra columns are not read.

    Every row is coded; queries are sent in blocks of ``QUERY_BYTES`` to all codes, one
    block after the other, and each task hands on ``k`` rows for a query.
    """
    spark = df.sparkSession
    base, asked = usable(df, id_, vector), usable(queries, id_, vector)
    largest = base.select(F.max(F.array_max(F.transform("vector", F.abs)))).first()[0]
    if largest is None:
        return spark.createDataFrame([], "query_id long, rank int, id long, score double")
    scale = scale_of(largest)
    if scale != 1:
        base, asked = (
            t.withColumn("vector", F.transform("vector", lambda v: v * scale)) for t in (base, asked)
        )
    sums = base.select("vector").transform(map_arrow, _sums, "i long, total double, n long")
    means = sums.groupBy("i").agg((F.sum("total") / F.sum("n")).alias("mean")).orderBy("i")
    centre = np.array([r["mean"] for r in means.collect()])  # one row for each dimension
    turn = rotation(len(centre), code_bits(len(centre)))
    coded = written(encode_vectors(base, centre, turn), new_work_path(spark, "codes"))
    wanted = written(
        asked.withColumn("query_row", F.monotonically_increasing_id()), new_work_path(spark, "queries")
    )
    each = max(1, QUERY_BYTES // (8 * len(centre)))
    count = max(1, -(-wanted.count() // each))
    path, shape = new_work_path(spark, "found"), "query_row long, query_id long, id long, score double"
    for block in range(count):
        own = wanted.where(F.pmod(F.xxhash64("query_row"), F.lit(count)) == block).toArrow()
        ids = own.column("id").to_numpy().astype(np.int64)
        vectors = _matrix(own.column("vector").combine_chunks()) if len(ids) else np.zeros((0, len(centre)))
        numbers = own.column("query_row").to_numpy()
        sent = spark.sparkContext.broadcast((numbers, ids, vectors, (vectors - centre) @ turn.T))
        found = coded.transform(
            map_arrow, lambda batches, sent=sent: _search(batches, *sent.value, k, width), shape
        )
        found.write.mode("append").parquet(path)
        sent.destroy()  # the block's rows are in files, nothing is computed from it again
    order = Window.partitionBy("query_row").orderBy("score", "id")
    return (
        spark.read.schema(shape).parquet(path)
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "id", (F.col("score") / scale).alias("score"))
    )
