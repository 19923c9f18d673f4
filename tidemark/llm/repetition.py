"""Repetition coverage: how much of a text lies inside n-grams and lines it repeats.

Rolling hashes of several lengths are taken in numpy over a whole slice of texts at once.
They start from exact numbers of words, so no spelling of words makes two of them one; a
text's own number goes into each key, so only copies inside one text meet.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import BooleanType, DoubleType, LongType, StructField

from tidemark.llm import rolling
from tidemark.llm.batches import Worker, utf8, with_columns

#: Largest share of a text's word characters in n-grams it has had before, by n, in percent.
GRAM_LIMITS = {5: 25, 7: 22, 10: 20}
#: Largest share of word characters in lines that an earlier line equals, in percent.
LINE_LIMIT = 20
#: The base rule: fewest words, and largest share of words in repeated 3-word windows.
LEAST_WORDS, BASE_WINDOW, BASE_LIMIT = 50, 3, 50

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True


def _in_repeats(words: rolling.Words, hashes: np.ndarray, n: int, first: bool) -> np.ndarray:
    """Which words lie in an ``n``-word window that their text holds twice or more.

    With ``first`` off, the first of equal windows does not count.
    """
    covered = np.zeros(len(hashes) + 1, np.int64)
    keys = rolling.grams(hashes, n)
    inside = np.flatnonzero(words.doc[: len(keys)] == words.doc[n - 1 :][: len(keys)])
    own = rolling.mixed(words.doc[inside].astype(np.uint64) + np.uint64(1))
    often, later = rolling.repeated(keys[inside] + own)
    starts = inside[often if first else later]
    covered[starts] += 1
    covered[starts + n] -= 1
    return np.cumsum(covered[:-1]) > 0


def measures(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """The counts of each text of a slice."""
    docs = len(offsets) - 1
    words = rolling.Words(data, offsets)
    chars = rolling.code_points(data)
    numbers, _ = rolling.numbered(data, words.starts, words.ends)
    hashes = rolling.mixed(numbers.astype(np.uint64) + np.uint64(1))
    sizes = chars[words.ends] - chars[words.starts]
    symbols = np.zeros(len(data) + 1, np.int32)
    np.cumsum(_SYMBOL[data], out=symbols[1:])

    def total(values: np.ndarray, of: np.ndarray = words.doc) -> np.ndarray:
        return np.bincount(of, weights=values, minlength=docs).astype(np.int64)

    out = {
        "n_words": words.per_doc,
        "word_chars": total(sizes),
        "n_symbols": (symbols[offsets[1:]] - symbols[offsets[:-1]]).astype(np.int64),
        "n_repeat_words": total(_in_repeats(words, hashes, BASE_WINDOW, first=True)),
    }
    for n in GRAM_LIMITS:
        out[f"repeat_chars_{n}"] = total(np.where(_in_repeats(words, hashes, n, first=False), sizes, 0))
    breaks = np.flatnonzero(data == 10)
    starts = np.unique(np.concatenate((offsets[:-1], breaks + 1)))
    starts = starts[starts < len(data)]
    ends = np.append(starts[1:], len(data))
    ends = ends - ((ends > starts) & (data[ends - 1] == 10)) if len(starts) else ends
    first_word = np.searchsorted(words.starts, starts)
    last_word = np.searchsorted(words.starts, ends)
    worded = last_word > first_word
    starts, ends = starts[worded], ends[worded]
    line_doc = np.searchsorted(offsets, starts, "right") - 1
    lines, _ = rolling.numbered(data, starts, ends)
    _, later = rolling.repeated(lines.astype(np.int64) * docs + line_doc)
    sums = np.concatenate(([0], np.cumsum(sizes)))
    line_chars = sums[last_word[worded]] - sums[first_word[worded]]
    out["n_dup_lines"] = total(later, line_doc)
    out["dup_line_chars"] = total(np.where(later, line_chars, 0), line_doc)
    return out


def _judge() -> Worker:
    def work(texts: pa.Array) -> list[pa.Array]:
        m = measures(*utf8(texts))
        n_words, chars = m["n_words"], m["word_chars"]
        failed = (n_words < LEAST_WORDS) | (100 * m["n_repeat_words"] > BASE_LIMIT * n_words)
        repeats = 100 * m["dup_line_chars"] > LINE_LIMIT * chars
        most = np.zeros(len(texts))
        for n, limit in GRAM_LIMITS.items():
            repeats |= 100 * m[f"repeat_chars_{n}"] > limit * chars
            most = np.maximum(most, m[f"repeat_chars_{n}"] / np.maximum(chars, 1))
        columns = [m[f.name] for f in COUNTS]
        return [pa.array(c) for c in (*columns, most, failed, ~failed & ~repeats)]

    return work


COUNTS = [
    StructField(name, LongType())
    for name in (
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        *(f"repeat_chars_{n}" for n in GRAM_LIMITS),
        "dup_line_chars",
    )
]
FIELDS = [
    *COUNTS,
    StructField("repeat_share", DoubleType()),
    StructField("base_failed", BooleanType()),
    StructField("kept", BooleanType()),
]


def judge_repetition(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with the counts, the shares and the verdict of the rules on each text.

    ``repeat_share`` is the largest share of word characters inside n-grams of one length
    that the text has had before. ``kept`` is false if the base rule fails or a share is above its limit. A
    null or empty text has no words and fails; texts are measured whole, however long;
    repeated rows are judged each; an empty table stays empty. Columns with the names of
    the results give way.
    """
    return with_columns(df, text, FIELDS, _judge)
