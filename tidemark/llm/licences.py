"""License scans: an exact set-similarity join of text blocks with license templates.

Blocks are overlapping stretches of words on a grid, wide enough that any window in which
a template may stand lies whole in one. Tokens are ordered by how rare they are in all
texts, so a block and a template that share enough must share one of their first tokens
(prefix filter), at places that leave enough tokens behind them (positional filter), and
the block must have enough tokens at all (length filter). What remains is counted exactly,
window by window.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.batches import slices
from tidemark.llm.shipping import map_arrow
from tidemark.session import new_work_path, written

#: Fixed values of the contract: phrases whose consecutive words count, and their labels.
BASE_PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

#: Notices whose words a block has to hold, and the labels they give.
TEMPLATES = {
    "this work is licensed under the gnu general public license version 3": "gpl",
    "this program is free software you can redistribute it and or modify it under the terms "
    "of the gnu general public license": "gpl",
    "under the terms of the gnu lesser general public license": "lgpl",
    "under the terms of the gnu affero general public license": "agpl",
    "licensed under the apache license version 2 0": "apache",
    "you may not use this file except in compliance with the license": "apache",
    "permission is hereby granted free of charge to any person obtaining a copy of this "
    "software": "mit",
    "released under the mit license": "mit",
    "redistribution and use in source and binary forms with or without modification are "
    "permitted": "bsd",
    "this work is licensed under a creative commons attribution 4 0 international license": "cc-by",
    "licensed under cc by 4 0": "cc-by",
    "licensed under cc by sa 4 0": "cc-by-sa",
    "licensed under cc by nc 4 0": "cc-by-nc",
    "licensed under cc by nd 4 0": "cc-by-nd",
    "subject to the terms of the mozilla public license": "mpl",
    "this is free and unencumbered software released into the public domain": "unlicense",
    # Whole headers and texts.
    "licensed under the apache license version 2 0 the license you may not use this file except "
    "in compliance with the license you may obtain a copy of the license at http www apache org "
    "licenses license 2 0 unless required by applicable law or agreed to in writing software "
    "distributed under the license is distributed on an as is basis without warranties or "
    "conditions of any kind either express or implied see the license for the specific language "
    "governing permissions and limitations under the license": "apache-header",
    "permission is hereby granted free of charge to any person obtaining a copy of this software "
    "and associated documentation files the software to deal in the software without restriction "
    "including without limitation the rights to use copy modify merge publish distribute "
    "sublicense and or sell copies of the software and to permit persons to whom the software is "
    "furnished to do so subject to the following conditions the above copyright notice and this "
    "permission notice shall be included in all copies or substantial portions of the "
    "software": "mit-text",
    "redistribution and use in source and binary forms with or without modification are permitted "
    "provided that the following conditions are met redistributions of source code must retain the "
    "above copyright notice this list of conditions and the following disclaimer redistributions "
    "in binary form must reproduce the above copyright notice this list of conditions and the "
    "following disclaimer in the documentation and or other materials provided with the "
    "distribution neither the name of the copyright holder nor the names of its contributors may "
    "be used to endorse or promote products derived from this software without specific prior "
    "written permission": "bsd-3-clause",
}
#: Share of a template's distinct words that a block must hold, in percent.
CONTAINMENT = 90
#: Words of a window at least; a longer template has windows of twice its words.
WINDOW = 64

WORD = re.compile(rb"[0-9a-z\x80-\xff]+")  # of UTF-8 in which A-Z are lower-cased


class Templates:
    """What the join needs of the notices; all of it grows with their number alone."""

    def __init__(self, notices: dict[str, str], phrases: dict[str, str], containment: int) -> None:
        self.rows = []  # (words, label, distinct words needed, base, words of a window)
        for texts, share, base in ((phrases, 100, True), (notices, containment, False)):
            for text, label in texts.items():
                words = text.split()
                need = math.ceil(len(set(words)) * share / 100)
                self.rows.append((words, label, need, base, max(WINDOW, 2 * len(words))))
        self.vocabulary = sorted({w for words, *_ in self.rows for w in words})
        widest = max(width for *_, width in self.rows)
        self.stride, self.block = 3 * widest, 4 * widest


def _words(text: str | None) -> list[bytes]:
    return WORD.findall((text or "").encode().lower())


def token_counts(df: DataFrame, text: str, templates: Templates) -> dict[str, int]:
    """How often each word of the templates stands in all texts; one number for each."""
    numbers = {w.encode(): i for i, w in enumerate(templates.vocabulary)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        for batch in batches:
            for value in batch.column(0):
                found.update(map(numbers.get, _words(value.as_py())))
        found.pop(None, None)
        yield pa.RecordBatch.from_pydict(
            {"token": pa.array(found.keys(), pa.int32()), "n": pa.array(found.values(), pa.int64())}
        )

    counted = df.select(text).transform(map_arrow, run, "token int, n long")
    rows = counted.groupBy("token").agg(F.sum("n").alias("n")).collect()  # one for each token
    return {templates.vocabulary[r["token"]]: r["n"] for r in rows}


def most_held(ranks: list[int], own: frozenset[int], width: int) -> int:
    """The most words of ``own`` that one window of ``width`` words of ``ranks`` holds."""
    places = [i for i, r in enumerate(ranks) if r in own]
    inside: Counter = Counter()
    most = end = 0
    for start in places:  # a window that holds most can begin with a word of its own
        while end < len(places) and places[end] < start + width:
            inside[ranks[places[end]]] += 1
            end += 1
        most = max(most, len(inside))
        inside[ranks[start]] -= 1
        if not inside[ranks[start]]:
            del inside[ranks[start]]
    return most


def blocks(df: DataFrame, id_: str, text: str, order: list[str], templates: Templates) -> DataFrame:
    """A row for each text: ``n_words``, and the blocks that hold a word of some template's
    prefix; others hold no template.

    A block is its first word's number and its words as ranks in ``order`` (rarest first),
    -1 for words of no template.
    """
    ranks = {w.encode(): i for i, w in enumerate(order)}
    rank = {w: i for i, w in enumerate(order)}
    prefix = set()
    for words, _, need, *_ in templates.rows:
        own = sorted({rank[w] for w in words})
        prefix.update(own[: len(own) - need + 1])
    stride, size = templates.stride, templates.block
    block = pa.struct([("first", pa.int64()), ("ranks", pa.list_(pa.int32()))])

    def chosen(words: list[bytes]) -> list[dict]:
        known = [ranks.get(w, -1) for w in words]
        numbers = set()
        for i, r in enumerate(known):
            if r in prefix:
                numbers.update(range(max(0, (i - size) // stride + 1), i // stride + 1))
        return [{"first": n * stride, "ranks": known[n * stride : n * stride + size]} for n in sorted(numbers)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                words = [_words(value.as_py()) for value in part.column("text")]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("id"),
                        part.column("digest"),
                        pa.array(map(len, words), pa.int64()),
                        pa.array(map(chosen, words), pa.list_(block)),
                    ],
                    ["id", "digest", "n_words", "blocks"],
                )

    id_type = df.schema[id_].dataType.simpleString()
    return df.select(
        F.col(id_).alias("id"), F.xxhash64(text).alias("digest"), F.col(text).alias("text")
    ).transform(
        map_arrow,
        run,
        f"id {id_type}, digest long, n_words long, blocks array<struct<first:bigint,ranks:array<int>>>",
    )


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``held``, the most words of the template in a window of the block."""
    columns = ("ranks", "own", "width")
    for batch in batches:
        rows = zip(*(batch.column(c).to_pylist() for c in columns))
        held = pa.array([most_held(ranks, frozenset(own), width) for ranks, own, width in rows], pa.int32())
        yield pa.RecordBatch.from_arrays([*batch.columns, held], [*batch.schema.names, "held"])


def matches(found: DataFrame, order: list[str], templates: Templates) -> DataFrame:
    """Blocks joined with the templates they contain: id, digest, first, template parts."""
    spark = found.sparkSession
    rank = {w: i for i, w in enumerate(order)}
    index, whole = [], []
    for number, (words, label, need, base, width) in enumerate(templates.rows):
        own = sorted({rank[w] for w in words})
        phrase = [rank[w] for w in words]
        whole.append((number, label, need, base, own, phrase, width))
        index += [(token, number, i, len(own), need) for i, token in enumerate(own[: len(own) - need + 1])]
    # A few rows for each template; written, so that Spark knows their size and broadcasts
    # them if it is small.
    by_token = written(
        spark.createDataFrame(index, "token int, template int, i int, size int, need int"),
        new_work_path(spark, "licence-index"),
    )
    by_template = written(
        spark.createDataFrame(
            whole,
            "template int, label string, need int, base boolean, own array<int>, phrase array<int>, width int",
        ),
        new_work_path(spark, "licence-templates"),
    )
    tokens = F.array_sort(F.array_distinct(F.filter("ranks", lambda r: r >= 0)))
    block = (
        found.select("id", "digest", F.explode("blocks").alias("b"))
        .select("id", "digest", "b.first", "b.ranks")
        .withColumn("tokens", tokens)
    )
    least = min(need for _, _, need, *_ in templates.rows)
    prefix = F.slice("tokens", F.lit(1), F.greatest(F.lit(0), F.size("tokens") - least + 1))
    candidates = (
        block.select("*", F.posexplode(prefix).alias("j", "token"))
        .join(by_token, "token")
        .where(F.size("tokens") >= F.col("need"))
        .where(F.least(F.col("size") - F.col("i"), F.size("tokens") - F.col("j")) >= F.col("need"))
        .select("id", "digest", "first", "ranks", "tokens", "template")
        .distinct()
    )
    places = F.filter(
        F.sequence(F.lit(0), F.lit(templates.stride - 1)),
        lambda p: F.slice("ranks", p + 1, F.size("phrase")) == F.col("phrase"),
    )
    likely = (
        candidates.join(by_template, "template")
        .where(F.size(F.array_intersect("tokens", "own")) >= F.col("need"))
        .withColumn("places", F.when(F.col("base"), places))
        .where(~F.col("base") | (F.size("places") > 0))
        .select("id", "digest", "first", "label", "need", "base", "places", "ranks", "own", "width")
    )
    schema = f"{likely.schema.simpleString()[7:-1]}, held int"
    return (
        likely.transform(map_arrow, _verified, schema)
        .where(F.col("held") >= F.col("need"))
        .select("id", "digest", "first", "label", "base", "places", (F.col("held") / F.size("own")).alias("share"))
    )


def scan_licences(
    df: DataFrame,
    id_: str = "doc_id",
    text: str = "text",
    notices: dict[str, str] = TEMPLATES,
    phrases: dict[str, str] = BASE_PHRASES,
    containment: int = CONTAINMENT,
) -> DataFrame:
    """A row for each row of ``df``: its id, ``n_words`` and what its text says of licences.

    ``n_base``, ``first_word`` and ``last_word``: places where a phrase's words stand
    consecutively, with their smallest and largest start (null without places).
    ``base_labels`` are the phrases' labels, ``labels`` those and the labels of notices
    that a window of words holds to ``containment`` percent; ``score`` is the largest
    share held, 0 without a match.

    Null and empty texts have no words and no labels. Rows that repeat an id, or have
    none, are told apart by their text; equal rows get equal results, each its own. An
    empty table gives none. Extra columns are not read.
    """
    templates = Templates(notices, phrases, containment)
    counts = token_counts(df, text, templates)
    order = sorted(templates.vocabulary, key=lambda w: (counts.get(w, 0), w))
    # Written once: both the join and the list of all texts start from it.
    path = new_work_path(df.sparkSession, "licence-blocks")
    found = written(blocks(df, id_, text, order, templates), path)
    per_text = (
        matches(found.where(F.size("blocks") > 0).dropDuplicates(["id", "digest"]), order, templates)
        .groupBy("id", "digest")
        .agg(
            F.sum(F.coalesce(F.size("places"), F.lit(0)).cast("long") * F.col("base").cast("long")).alias("n_base"),
            F.min(F.col("first") + F.array_min("places")).cast("long").alias("first_word"),
            F.max(F.col("first") + F.array_max("places")).cast("long").alias("last_word"),
            F.array_sort(F.collect_set(F.when(F.col("base"), F.col("label")))).alias("base_set"),
            F.array_sort(F.collect_set("label")).alias("label_set"),
            F.max("share").alias("score"),
        )
        .select(
            F.col("id").alias("match_id"), F.col("digest").alias("match_digest"),
            "n_base", "first_word", "last_word", "base_set", "label_set", "score",
        )
    )
    listed = found.select("id", "digest", "n_words")
    return listed.join(
        per_text,
        F.col("id").eqNullSafe(F.col("match_id")) & (F.col("digest") == F.col("match_digest")),
        "left",
    ).select(
        F.col("id").alias(id_),
        "n_words",
        F.coalesce("n_base", F.lit(0).cast("long")).alias("n_base"),
        "first_word",
        "last_word",
        F.coalesce(F.array_join("base_set", ","), F.lit("")).alias("base_labels"),
        F.coalesce(F.array_join("label_set", ","), F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )
