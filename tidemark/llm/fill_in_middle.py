"""Fill-in-the-middle: texts cut at unit boundaries and put in another order.

A unit is a run of ASCII letters or any other single character. The UTF-8 of a slice of
texts is viewed as 64-bit words, eight bytes at once: arithmetic on a word marks, in the
high bit of each byte, whether a unit ends there. The marks of a word are counted, and the
running counts tell which word holds the k-th unit end of a text; the byte inside that
word follows from the prefix counts of its bytes, again in one multiplication.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.batches import slices, utf8
from tidemark.llm.shipping import map_arrow

# ---------------------------------------------------------------------------
# The markers of the three parts.
# ---------------------------------------------------------------------------
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"

#: Of 100 texts so many are turned, and of 100 turned ones so many put the suffix first.
TURNED, SUFFIX_FIRST = 90, 20
PLAIN, PSM, SPM = "plain", "psm", "spm"

_ONES = np.uint64(0x0101010101010101)
_HIGH = np.uint64(0x8080808080808080)
_LOW = ~_HIGH
_CASE = np.uint64(0x2020202020202020)
_FROM_A = np.uint64(0x80 - ord("a")) * _ONES
_PAST_Z = np.uint64(0x80 - ord("z") - 1) * _ONES
_ONE, _SEVEN, _EIGHT, _LAST = np.uint64(1), np.uint64(7), np.uint64(8), np.uint64(56)


def as_words(data: np.ndarray) -> np.ndarray:
    """Bytes as 64-bit words, the first byte lowest; zeros fill the last word and one more."""
    padded = np.zeros((len(data) // 8 + 2) * 8, np.uint8)
    padded[: len(data)] = data
    return padded.view("<u8")


def _of_next_byte(marks: np.ndarray) -> np.ndarray:
    """The mark of each byte's right neighbour, across words."""
    moved = marks >> _EIGHT
    moved[:-1] |= marks[1:] << _LAST
    return moved


def character_marks(words: np.ndarray) -> np.ndarray:
    """The high bit of every byte that begins a character."""
    return ~(words & ~(words << _ONE)) & _HIGH


def unit_ends(words: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The high bit of every byte that ends a unit; a text's last byte always does."""
    lower = (words | _CASE) & _LOW
    letters = (lower + _FROM_A) & ~(lower + _PAST_Z) & ~words & _HIGH
    ends = _of_next_byte(character_marks(words)) & ~(letters & _of_next_byte(letters))
    last = offsets[1:][offsets[1:] > offsets[:-1]] - 1
    np.bitwise_or.at(ends, last >> 3, np.uint64(0x80) << ((last & 7) * 8).astype(np.uint64))
    return ends


class Marks:
    """Ranks and selects over marked bytes."""

    def __init__(self, marks: np.ndarray) -> None:
        self._marks = marks
        self._before = np.zeros(len(marks) + 1, np.int64)
        np.cumsum(np.bitwise_count(marks), out=self._before[1:])

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Marks in the bytes before ``at``."""
        word = at >> 3
        below = (_ONE << ((at & 7) * 8).astype(np.uint64)) - _ONE
        return self._before[word] + np.bitwise_count(self._marks[word] & below)

    def select(self, number: np.ndarray) -> np.ndarray:
        """The byte of the ``number``-th mark, counted from one."""
        word = np.searchsorted(self._before, number, "left") - 1
        rest = (number - self._before[word]).astype(np.uint64)
        # Byte i of the product counts the marks of the bytes up to i; those with fewer
        # marks than the wanted one keep the high bit when their count is taken away.
        counts = (self._marks[word] >> _SEVEN) * _ONES
        fewer = (((rest - _ONE) * _ONES) | _HIGH) - counts
        return word * 8 + np.bitwise_count(fewer & _HIGH)


def cuts(
    data: np.ndarray, offsets: np.ndarray, one: np.ndarray, two: np.ndarray
) -> tuple[np.ndarray, ...]:
    """For each text: its units; where prefix and middle end (bytes from the start of the
    text) if the first cut is after ``one % (units + 1)`` units and the second after
    ``two % (units + 1)``, whichever is smaller first; characters of prefix and middle."""
    words = as_words(data)
    ends, characters = Marks(unit_ends(words, offsets)), Marks(character_marks(words))
    start, stop = offsets[:-1], offsets[1:]
    before = ends.rank(start)
    units = ends.rank(stop) - before
    a, b = one % (units + 1), two % (units + 1)
    at = []
    for taken in (np.minimum(a, b), np.maximum(a, b)):
        cut = start.copy()
        some = taken > 0
        cut[some] = ends.select((before + taken)[some]) + 1
        at.append(cut)
    first, second = at
    chars = [characters.rank(p) for p in (start, first, second)]
    return units, first - start, second - start, chars[1] - chars[0], chars[2] - chars[1]


def _draws(id_: Column, seed: int) -> list[Column]:
    """Four unsigned 32-bit numbers from the SHA-256 of seed and id; no id is an empty one."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(id_.cast("string"), F.lit("")))
    digest = F.sha2(named.cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def _turned(form: str, text: bytes, first: int, second: int) -> bytes:
    head, middle, tail = text[:first], text[first:second], text[second:]
    p, s, m = (mark.encode() for mark in (PREFIX, SUFFIX, MIDDLE))
    if form == PSM:
        return b"".join((p, head, s, tail, m, middle))
    return b"".join((s, tail, p, head, m, middle)) if form == SPM else text


def fill_in_middle(df: DataFrame, id_: str = "doc_id", text: str = "text", seed: int = 1) -> DataFrame:
    """Per row of ``df``: ``id, n, form, prefix_chars, middle_chars, output``.

    Cuts and form follow from the id and ``seed`` alone. A text that holds one of the
    markers stays plain, so that ``restored`` is unambiguous. A null text counts as empty;
    an empty one has no units and stays plain; a row without an id is cut as if its id
    were empty; repeated rows give repeated results; texts are cut whole, however long;
    an empty table stays empty. Other columns of ``df`` are not read, whatever their names.
    """
    one, two, three, four = _draws(F.col(f"`{id_}`"), seed)
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    stays = (whole == "") | (three % 100 >= TURNED)
    for mark in (PREFIX, SUFFIX, MIDDLE):
        stays |= F.contains(whole, F.lit(mark))
    turned = F.when(stays, PLAIN).when(four % 100 < SUFFIX_FIRST, SPM).otherwise(PSM)
    drawn = df.select(
        F.col(f"`{id_}`").cast("long").alias("id"),
        turned.alias("form"),
        one.alias("one"),
        two.alias("two"),
        whole.alias("text"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                data, offsets = utf8(part.column("text"))
                one, two = (part.column(c).to_numpy() for c in ("one", "two"))
                units, first, second, head, middle = cuts(data, offsets, one, two)
                forms = part.column("form").to_pylist()
                buffer, at = data.tobytes(), offsets.tolist()
                output = [
                    _turned(form, buffer[a:b], x, y)
                    for form, a, b, x, y in zip(forms, at, at[1:], first.tolist(), second.tolist())
                ]
                plain = np.array([form == PLAIN for form in forms])
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("id"),
                        pa.array(units),
                        part.column("form"),
                        pa.array(head, mask=plain),
                        pa.array(middle, mask=plain),
                        pa.array(output, pa.binary()).cast(pa.string()),
                    ],
                    ["id", "n", "form", "prefix_chars", "middle_chars", "output"],
                )

    return drawn.transform(
        map_arrow,
        run,
        "id long, n long, form string, prefix_chars long, middle_chars long, output string",
    )


def restored(output: Column, form: Column) -> Column:
    """The text that ``fill_in_middle`` made ``output`` of.

    The first of each marker is the one that was put in: no text that was turned holds
    one, and none can arise where a part meets a marker.
    """

    def between(mark: str, following: str) -> Column:
        return F.substring_index(F.substring_index(output, mark, -1), following, 1)

    middle = F.substring_index(output, MIDDLE, -1)
    psm = F.concat(between(PREFIX, SUFFIX), middle, between(SUFFIX, MIDDLE))
    spm = F.concat(between(PREFIX, MIDDLE), middle, between(SUFFIX, PREFIX))
    return F.when(form == PSM, psm).when(form == SPM, spm).otherwise(output)
