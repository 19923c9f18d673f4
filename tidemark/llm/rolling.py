"""Words, lines and their hashes for a whole slice of texts at once, in numpy."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from xxhash import xxh3_64_intdigest

#: Odd multipliers below 2**64; each is its own hash function, none has a meaning.
BASE = 0x9E3779B97F4A7C15
MIX_1 = 0xBF58476D1CE4E5B9
MIX_2 = 0x94D049BB133111EB
STEP = 0xD6E8FEB86659FD93

_WORD_BYTE = np.ones(256, bool)
_WORD_BYTE[[0x20, *range(0x09, 0x0E)]] = False
_FIRST_BYTE = np.ones(256, bool)
_FIRST_BYTE[0x80:0xC0] = False


@lru_cache(maxsize=2)
def _powers(count: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and its inverse, modulo 2**64, for i below ``count``."""
    both = []
    for base in (BASE, pow(BASE, -1, 1 << 64)):
        powers = np.full(count, base, np.uint64)
        powers[:1] = 1
        both.append(np.multiply.accumulate(powers, out=powers))
    return both[0], both[1]


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit numbers over all bits; different numbers stay different."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(MIX_1)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(MIX_2)
    return h ^ (h >> np.uint64(31))


class Spans:
    """Hashes of byte ranges of one buffer, from the prefix sums of a polynomial.

    Some different texts have equal hashes whatever the multiplier, so these serve only
    where a collision does no harm, such as the buckets of a model.
    """

    def __init__(self, data: np.ndarray) -> None:
        size = 1 << max(20, (len(data) - 1).bit_length())
        powers, self._inverse = _powers(size)
        self._sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[: len(data)], out=self._sums[1:])

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mixed((self._sums[ends] - self._sums[starts]) * self._inverse[starts])


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z as a-z, other bytes as they are."""
    upper = (data >= 65) & (data <= 90)
    return data + (upper.astype(np.uint8) << np.uint8(5))


class Words:
    """The words of a slice of texts: runs of the bytes in ``word_bytes``, by default of
    anything but space and 9 to 13."""

    def __init__(
        self, data: np.ndarray, offsets: np.ndarray, word_bytes: np.ndarray = _WORD_BYTE
    ) -> None:
        word = word_bytes[data]
        before = np.empty(len(data), bool)
        before[:1] = False
        before[1:] = word[:-1]
        inner = offsets[:-1][offsets[:-1] < len(data)]
        before[inner] = False
        self.starts = np.flatnonzero(word & ~before)
        after = np.empty(len(data), bool)
        after[-1:] = False
        after[:-1] = word[1:]
        last = offsets[1:][offsets[1:] > 0] - 1
        after[last] = False
        self.ends = np.flatnonzero(word & ~after) + 1
        self.doc = np.searchsorted(offsets, self.starts, "right") - 1
        self.per_doc = np.bincount(self.doc, minlength=len(offsets) - 1)
        self.first = np.concatenate(([0], np.cumsum(self.per_doc)))


def numbered(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """A number for each of the stretches ``starts`` to ``ends`` of ``data``, the same for
    equal ones and for no others, and the stretches by number. They must not overlap."""
    at = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts, out=at[1:])
    steps = np.zeros(len(data) + 1, np.int8)
    steps[starts] += 1
    steps[ends] -= 1
    held = data[np.cumsum(steps[:-1], dtype=np.int8).astype(bool)]
    binary = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(at), pa.py_buffer(held)]
    )
    encoded = binary.dictionary_encode()
    return encoded.indices.to_numpy(), encoded.dictionary


def word_hashes(data: np.ndarray, words: Words) -> np.ndarray:
    """A 64-bit hash of each word; no choice of letters makes words collide by design."""
    numbers, distinct = numbered(data, words.starts, words.ends)
    hashes = np.array([xxh3_64_intdigest(word) for word in distinct.to_pylist()], np.uint64)
    return hashes[numbers]


def code_points(data: np.ndarray) -> np.ndarray:
    """Prefix sums of the characters that begin at each byte."""
    sums = np.zeros(len(data) + 1, np.int32)
    np.cumsum(_FIRST_BYTE[data], out=sums[1:])
    return sums


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """A hash for each run of ``n`` neighbouring hashes."""
    count = max(0, len(hashes) - n + 1)
    total = np.zeros(count, np.uint64)
    for j in range(n):
        total *= np.uint64(STEP)
        total += hashes[j : j + count]
    return mixed(total)


def repeated(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of ``keys`` occur twice or more, and which occur earlier in the array."""
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    often, later = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    often[order[1:][same]] = True
    often[order[:-1][same]] = True
    later[order[1:][same]] = True
    return often, later
