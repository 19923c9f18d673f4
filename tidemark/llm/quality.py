"""Quality by importance resampling: log ratios of hashed n-gram models, Gumbel top-k.

A pair of generative models gives the log weight of a text: 4-grams of bytes, target
texts against all raw text, summed over the text (*form*). A given number of texts is
drawn without replacement, in proportion to their weights: those with the largest log
weights after Gumbel noise.

A second step, which can be left out, is a rule on words (*content*): lower-cased words by
texts that hold them, target against labelled unwanted texts, the least likely word of the
text. With it, form and content are each measured from the level that nearly all held-out
target texts reach, and the smaller counts as log weight. Unless a number is given, as many
texts are drawn as have a weight of zero or more.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import rolling
from tidemark.llm.batches import slices, utf8
from tidemark.llm.shipping import map_arrow
from tidemark.session import new_work_path, written

#: Labelled rows that the models are fitted on at most; half of them set the levels.
LABELLED = 20_000
GRAM = 4
FORM_BUCKETS = 1 << 16
CONTENT_BUCKETS = 1 << 20
#: Share of held-out target texts that may lie below a level.
BELOW = 0.002
#: One unit of the content ratio counts as so many of the form ratio.
CONTENT_SCALE = 10.0
SEED = 11
#: Bytes of text that are counted at once.
SLICE_BYTES = 1 << 20

_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def form_buckets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of each byte 4-gram, and the text it is in."""
    count = max(0, len(data) - GRAM + 1)
    doc = np.repeat(np.arange(len(offsets) - 1, dtype=np.int32), np.diff(offsets))
    inside = doc[:count] == doc[GRAM - 1 :]
    gram = np.zeros(count, np.uint32)
    for j in range(GRAM):
        gram <<= np.uint32(8)
        gram |= data[j : j + count]
    bucket = (gram[inside] * np.uint32(0x9E3779B1)) >> np.uint32(32 - FORM_BUCKETS.bit_length() + 1)
    return bucket.astype(np.int64), doc[:count][inside]


def content_buckets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of each run of letters and digits, and the text it is in."""
    data = rolling.lowered(data)
    words = rolling.Words(np.where(_LETTER[data], data, np.uint8(32)), offsets)
    hashes = rolling.Spans(data).hashes(words.starts, words.ends)
    return (hashes >> np.uint64(44)).astype(np.int64) % CONTENT_BUCKETS, words.doc


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Model 0: raw form, 1: target form, 2: target content, 3: unwanted content."""
    sums = [np.zeros(n, np.int64) for n in (FORM_BUCKETS, FORM_BUCKETS, CONTENT_BUCKETS, CONTENT_BUCKETS)]
    for batch in batches:
        for part in slices(batch, "text", SLICE_BYTES):
            role = part.column("role").to_numpy(zero_copy_only=False)
            data, offsets = utf8(part.column("text"))
            bucket, doc = form_buckets(data, offsets)
            sums[0] += np.bincount(bucket, minlength=FORM_BUCKETS)
            sums[1] += np.bincount(bucket[role[doc] == 1], minlength=FORM_BUCKETS)
            if not (role > 0).any():
                continue
            bucket, doc = content_buckets(data, offsets)
            for model, wanted in ((2, 1), (3, 2)):
                own = role[doc] == wanted
                once = np.unique(doc[own] * CONTENT_BUCKETS + bucket[own]) % CONTENT_BUCKETS
                sums[model] += np.bincount(once, minlength=CONTENT_BUCKETS)
    for model, counts in enumerate(sums):
        found = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(found), model, np.int32)), pa.array(found), pa.array(counts[found])],
            ["model", "bucket", "n"],
        )


def log_ratios(counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Form: log of target over raw share; content: of target over unwanted."""
    raw, target, wanted, unwanted = (c.astype(np.float64) for c in counts)
    scale = target.sum() / max(raw.sum(), 1)
    form = np.log((target + scale) / (target.sum() + scale * FORM_BUCKETS)) - np.log(
        (raw + 1) / (raw.sum() + FORM_BUCKETS)
    ) if target.sum() else np.zeros(FORM_BUCKETS)
    # As many target texts as unwanted ones, so that a word of neither has a ratio of 1.
    share = wanted * (unwanted.sum() / max(wanted.sum(), 1))
    content = np.log((share + 1) / (unwanted + 1)) if wanted.sum() else np.zeros(CONTENT_BUCKETS)
    return form.astype(np.float32), content.astype(np.float32)


def _ratios(batches: Iterator[pa.RecordBatch], form: np.ndarray, content: np.ndarray) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text", SLICE_BYTES):
            data, offsets = utf8(part.column("text"))
            docs = len(offsets) - 1
            bucket, doc = form_buckets(data, offsets)
            total = np.bincount(doc, weights=form[bucket], minlength=docs)
            bucket, doc = content_buckets(data, offsets)
            worst = np.zeros(docs)
            np.minimum.at(worst, doc, content[bucket].astype(np.float64))
            empty = np.diff(offsets) == 0
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("id"),
                    part.column("digest"),
                    pa.array(total, mask=empty),
                    pa.array(worst, mask=empty),
                ],
                ["id", "digest", "form", "content"],
            )


#: Keys are compared in steps of a millionth; this makes them positive.
_STEPS, _SHIFT = 1_000_000, 1 << 53


def gumbel_place(score: str, *by: str) -> Column:
    """``score`` plus Gumbel noise as a whole number that keeps the order.

    The noise depends on the columns ``by`` and the seed only.
    """
    uniform = (F.shiftrightunsigned(F.xxhash64(F.lit(SEED), *by), 11) + 0.5) / float(1 << 53)
    return F.floor((F.col(score) - F.log(-F.log(uniform))) * _STEPS).cast("long") + _SHIFT


def kth_largest(df: DataFrame, place: str, k: int) -> int:
    """The ``k``-th largest of whole numbers below 2**54: three rounds of counting by 18
    bits each, which gather at most as many counts as there are digits."""
    prefix = 0
    for shift in (36, 18, 0):
        own = df.where(F.shiftright(place, shift + 18) == prefix)
        digit = F.pmod(F.shiftright(place, shift), F.lit(1 << 18)).alias("digit")
        counts = own.groupBy(digit).agg(F.count("*").alias("n")).toArrow()
        digits, n = counts.column("digit").to_numpy(), counts.column("n").to_numpy()
        order = np.argsort(-digits)
        sums = np.cumsum(n[order])
        at = int(np.searchsorted(sums, k))
        k -= int(sums[at - 1]) if at else 0
        prefix = prefix << 18 | int(digits[order[at]])
    return prefix


def weigh_quality(
    df: DataFrame,
    labels: DataFrame,
    id_: str = "doc_id",
    text: str = "text",
    labelled: int = LABELLED,
    draw: int | None = None,
    by_words: bool = True,
) -> DataFrame:
    """A row for each row of ``df``: id, ``digest`` of the text, ``form``, ``content``,
    ``log_weight`` and ``kept``.

    ``draw`` is the number of texts to draw, all with a weight if there are no more; by
    default that of weights of zero or more. ``by_words=False`` leaves the rule on words
    out: the log weight is then ``form`` less its level, which no draw of a given number
    depends on.

    ``labels`` (id, quality 0 or 1, toxic 0 or 1) names target texts (1 and 0) and
    unwanted ones (toxic); at most ``labelled`` of its rows, those with the smallest hash
    of the id, are used, half of them to fit and half to set the levels. Counts of raw
    text cover all rows.

    Texts that are null or empty have no weight and are not kept. Without labelled target
    texts all others have weight zero and are kept. Rows with equal id and text are drawn
    alike; ties at the last place are all kept. An empty table gives none. Ids that are
    null or repeated need no labels; labels that repeat an id count once, and null labels
    not at all. Extra columns are not read.
    """
    spark = df.sparkSession
    turn = F.xxhash64(F.lit(SEED), "label_id")
    known = (
        labels.select(F.col(id_).alias("label_id"), "quality", "toxic")
        .where("label_id IS NOT NULL AND quality IS NOT NULL AND toxic IS NOT NULL")
        .groupBy("label_id")
        .agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic"))
        .orderBy(turn)
        .limit(labelled)
        .select(
            "label_id",
            F.when(F.col("toxic") == 1, 2).when(F.col("quality") == 1, 1).otherwise(0).alias("role"),
            (F.pmod(turn, F.lit(2)) == 0).alias("fits"),
        )
    )
    known = written(known, new_work_path(spark, "labelled"))
    base = df.select(F.col(id_).alias("id"), F.col(text).alias("text"))
    fitting = F.broadcast(known.where("fits"))  # at most ``labelled`` rows
    counted = (
        base.join(fitting, F.col("id") == F.col("label_id"), "left")
        .select("text", F.coalesce("role", F.lit(0)).alias("role"))
        .transform(map_arrow, _counts, "model int, bucket long, n long")
        .groupBy("model", "bucket")
        .agg(F.sum("n").alias("n"))
        .toArrow()  # as many rows as buckets
    )
    counts = [np.zeros(n, np.int64) for n in (FORM_BUCKETS, FORM_BUCKETS, CONTENT_BUCKETS, CONTENT_BUCKETS)]
    model, bucket, n = (counted.column(c).to_numpy() for c in ("model", "bucket", "n"))
    for i, own in enumerate(counts):
        own[bucket[model == i]] = n[model == i]
    sent = spark.sparkContext.broadcast(log_ratios(counts))
    rated = written(
        base.select("id", F.xxhash64("text").alias("digest"), "text").transform(
            map_arrow,
            lambda batches: _ratios(batches, *sent.value),
            base.select("id").schema.add("digest", "long").add("form", "double").add("content", "double"),
        ),
        new_work_path(spark, "rated"),
    )
    target = F.broadcast(known.where("role = 1 AND NOT fits"))
    levels = rated.join(target, F.col("id") == F.col("label_id"), "left_semi").agg(
        F.percentile("form", F.lit(BELOW)).alias("form"), F.percentile("content", F.lit(BELOW)).alias("content")
    ).first()
    form, content = (levels[c] or 0.0 for c in ("form", "content"))
    weight = F.col("form") - form
    if by_words:
        weight = F.least(weight, (F.col("content") - content) * CONTENT_SCALE)
    weighed = rated.withColumn("log_weight", weight if counts[1].any() else F.when(F.col("form").isNotNull(), 0.0))
    placed = written(
        weighed.withColumn("place", gumbel_place("log_weight", "id", "digest")), new_work_path(spark, "weights")
    )
    size, weighted = placed.agg(F.count_if(F.col("log_weight") >= 0), F.count("log_weight")).first()
    if draw is not None:
        size = min(max(draw, 0), weighted)
    last = kth_largest(placed, "place", size) if size else 1 << 62
    kept = F.coalesce(F.col("place") >= last, F.lit(False))
    return placed.select(
        F.col("id").alias(id_), "digest", "form", "content", "log_weight", kept.alias("kept")
    )


def keep_quality(df: DataFrame, labels: DataFrame, id_: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """The rows of ``df`` that ``weigh_quality`` keeps, which treats odd rows: of equal rows
    all stay or go. Other columns are kept, whatever their names; an empty table stays empty.
    """
    read = df.select(F.col(f"`{id_}`").alias(id_), F.col(f"`{text}`").alias(text))
    kept = weigh_quality(read, labels, id_, text, **how).where("kept").select(
        F.col(id_).alias("kept_id"), F.col("digest").alias("kept_digest")
    )
    # The rows as they are, in one column, so that their names meet no others.
    rows = df.select(
        F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("row"),
        F.col(f"`{id_}`").alias("own_id"),
        F.xxhash64(F.col(f"`{text}`")).alias("own_digest"),
    )
    own = F.col("own_id").eqNullSafe(F.col("kept_id")) & (F.col("own_digest") == F.col("kept_digest"))
    return rows.join(kept, own, "left_semi").select("row.*")
