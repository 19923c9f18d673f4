"""Byte-level BPE: a transducer compiled from merges, and a streaming decoder.

A sequence of tokens is the encoding of its bytes exactly when every two neighbours
are: merging the bytes of both gives these two back. So the encoder is a transducer that
reads bytes and guesses token ends in a trie, keeping a guess only while it fits its
left neighbour. Sets of guesses are its determinised states, made when first met; a
token leaves as soon as all guesses agree on it, after a lookahead that the longest
token bounds. The rest leaves at the end of the piece.
"""

from __future__ import annotations

import base64
import gc
import hashlib
import re
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache, partial
from itertools import chain

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField

from tidemark.llm.batches import Worker, with_columns
from tidemark.llm.shipping import map_arrow

#: Pieces with ids, and states of the transducer, that a worker keeps before it starts over.
KEPT = 250_000
#: Above every rank.
NEVER = 1 << 60

ROOT = 0


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to id from a rank file (base64 and number on each line)."""
    with open(path, "rb") as lines:
        pairs = (line.split() for line in lines if line.strip())
        return {base64.b64decode(token): int(rank) for token, rank in pairs}


def merge_bytes(data: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Apply merges, lowest rank and then leftmost first: what the transducer compiles."""
    parts = [data[i : i + 1] for i in range(len(data))]
    while len(parts) > 1:
        found = [(ranks.get(parts[i] + parts[i + 1], NEVER), i) for i in range(len(parts) - 1)]
        rank, at = min(found)
        if rank == NEVER:
            break
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return [ranks[p] for p in parts]


class MergeTransducer:
    """Encodes pieces of bytes; its states and arcs appear as they are needed."""

    def __init__(self, ranks: dict[bytes, int], most: int = KEPT) -> None:
        self.ranks, self._most = ranks, most
        self.tokens = {rank: token for token, rank in ranks.items()}
        trie: dict[int, int] = {}
        ends: dict[int, int] = {}
        for token, rank in ranks.items():
            node = ROOT
            for byte in token:
                node = trie.setdefault(node << 8 | byte, len(trie) + 1)
            ends[node] = rank
        inner = {key >> 8 for key in trie}
        #: By node and byte: the next node, or ROOT where no longer token goes on, since a
        #: guess there has no future; and the token that ends, or -1.
        self._steps = {
            key: (node if node in inner else ROOT, ends.get(node, -1)) for key, node in trie.items()
        }
        self._spines: dict[int, tuple[list, list, bool]] = {}
        #: By inner node: the first byte, and the lowest rank of a merge that uses this
        #: byte up in one of the tokens below.
        self._openings: dict[int, tuple[bytes, int]] = {}
        for token, rank in ranks.items():
            _, first, exact = self._spine(rank)
            if exact:
                byte_used, node = first[0][1], ROOT
                for byte in token[:-1]:
                    node = self._steps[node << 8 | byte][0]
                    if byte_used < self._openings.get(node, (b"", NEVER + 1))[1]:
                        self._openings[node] = token[:1], byte_used
        self._start_over()

    def _start_over(self) -> None:
        self._pairs: dict[int, bool] = {}
        self._begins: dict[int, bool] = {}
        self._numbers: dict[tuple, int] = {}
        self._states: list[tuple] = []
        self._arcs: dict[int, tuple[int, tuple[int, ...]]] = {}
        self._start = self._number((-1, (((), ROOT),)))

    def _number(self, state: tuple) -> int:
        number = self._numbers.setdefault(state, len(self._states))
        if number == len(self._states):
            self._states.append(state)
        return number

    def _spine(self, token: int) -> tuple[list, list, bool]:
        """Along the right and the left edge of a token's merge tree, from the byte up:
        bytes and the rank of the merge that uses them up; and whether merging the
        token's bytes gives the token back."""
        if token not in self._spines:
            data = self.tokens[token]
            last, first, exact = [(data[-1:], NEVER)], [(data[:1], NEVER)], True
            parts = [data[i : i + 1] for i in range(len(data))]
            while len(parts) > 1:
                rank, at = min(
                    (self.ranks.get(parts[i] + parts[i + 1], NEVER), i) for i in range(len(parts) - 1)
                )
                if rank == NEVER:
                    exact = False
                    break
                joined = parts[at] + parts[at + 1]
                if at + 2 == len(parts):
                    last[-1] = (last[-1][0], rank)
                    last.append((joined, NEVER))
                if at == 0:
                    first[-1] = (first[-1][0], rank)
                    first.append((joined, NEVER))
                parts[at : at + 2] = [joined]
            self._spines[token] = last, first, exact
        return self._spines[token]

    def _fits(self, left: int, right: int) -> bool:
        """Whether ``right`` can follow ``left``; -1 is the start of the piece.

        It cannot if a merge across the border comes before one of its two parts is used
        up by a merge inside its own token.
        """
        _, first, exact = self._spine(right)
        if left < 0 or not exact:
            return exact
        last, _, exact = self._spine(left)
        i = j = 0
        while exact:
            (x, x_used), (y, y_used) = last[i], first[j]
            across = self.ranks.get(x + y, NEVER)
            if across < x_used and across <= y_used and across != NEVER:
                return False
            if x_used == y_used == NEVER:
                return True
            if x_used <= y_used:
                i += 1
            else:
                j += 1
        return False

    def _can_begin(self, left: int, node: int) -> bool:
        """Whether a token below ``node`` may follow ``left``.

        None can if a merge of their first byte with the end of ``left`` comes before
        every merge that uses the byte up inside them.
        """
        if node not in self._openings:
            return False
        byte, used = self._openings[node]
        if left < 0:
            return True
        for part, part_used in self._spine(left)[0]:
            across = self.ranks.get(part + byte, NEVER)
            if across < part_used and across <= used and across != NEVER:
                return False
            if part_used > used or part_used == NEVER:
                break
        return True

    def _arc(self, number: int, byte: int) -> tuple[int, tuple[int, ...]]:
        """The state after ``byte`` and the tokens that are certain from then on."""
        before, guesses = self._states[number]
        step, known, begins = self._steps.get, self._pairs.get, self._begins.get
        after: list[tuple[tuple[int, ...], int]] = []
        for path, node in guesses:
            found = step(node << 8 | byte)
            if found is None:
                continue
            node, token = found
            left = (path[-1] if path else before) << 32
            if node:
                pair = left | node
                open_ = begins(pair)
                if open_ is None:
                    open_ = self._begins[pair] = self._can_begin(left >> 32, node)
                if open_:
                    after.append((path, node))
            if token >= 0:
                pair = left | token
                fits = known(pair)
                if fits is None:
                    fits = self._pairs[pair] = self._fits(left >> 32, token)
                if fits:
                    after.append(((*path, token), ROOT))
        sent: tuple[int, ...] = ()
        while after and after[0][0]:
            token = after[0][0][0]
            for path, _ in after:
                if not path or path[0] != token:
                    break
            else:
                sent += (token,)
                after = [(path[1:], node) for path, node in after]
                continue
            break
        if sent:
            before = sent[-1]
        if all(path for path, _ in after):
            before = -1  # every guess brings its own left neighbour
        return self._number((before, tuple(after))), sent

    def encode(self, piece: bytes) -> tuple[int, ...]:
        """Ids of one piece; a piece that is a token is that token."""
        if (whole := self.ranks.get(piece)) is not None:
            return (whole,)
        if len(self._states) > self._most:
            self._start_over()
        number, sent, arcs = self._start, [], self._arcs
        for byte in piece:
            key = number << 8 | byte
            arc = arcs.get(key)
            if arc is None:
                arc = arcs[key] = self._arc(number, byte)
            number = arc[0]
            if arc[1]:
                sent.extend(arc[1])
        rest = [path for path, node in self._states[number][1] if node == ROOT]
        if len(rest) != 1:  # cannot be with ranks that merges have made
            return tuple(merge_bytes(piece, self.ranks))
        return (*sent, *rest[0])


class PieceIds(dict):
    """Ids by piece of text, made by the transducer when missing."""

    def __init__(self, transducer: MergeTransducer, most: int = KEPT) -> None:
        super().__init__()
        self._encode, self._most = transducer.encode, most

    def __missing__(self, piece: str) -> tuple[int, ...]:
        if len(self) >= self._most:
            self.clear()
        ids = self[piece] = self._encode(piece.encode())
        return ids


class StreamingDecoder:
    """Ids to text, chunk by chunk, never cutting a character.

    The state is the bytes of a character that has begun (at most 3). What is not UTF-8
    becomes U+FFFD, as when all bytes are decoded at once.
    """

    def __init__(self, tokens: dict[int, bytes]) -> None:
        self._token = tokens.__getitem__
        self._begun = b""

    @staticmethod
    def _open_tail(data: bytes) -> int:
        """Bytes at the end that may still become a character."""
        for back in range(1, min(3, len(data)) + 1):
            byte = data[-back]
            if byte & 0xC0 == 0x80:
                continue
            need = 2 if 0xC2 <= byte <= 0xDF else 3 if byte & 0xF0 == 0xE0 else 4
            if byte < 0xC2 or byte > 0xF4 or back >= need:
                return 0
            if back > 1:
                low, high = {0xE0: (0xA0, 0xBF), 0xED: (0x80, 0x9F), 0xF0: (0x90, 0xBF), 0xF4: (0x80, 0x8F)}.get(byte, (0x80, 0xBF))
                if not low <= data[1 - back] <= high:
                    return 0
            return back
        return 0

    def feed(self, ids: Iterable[int]) -> str:
        data = self._begun + b"".join(map(self._token, ids))
        tail = self._open_tail(data)
        self._begun = data[len(data) - tail :]
        return data[: len(data) - tail].decode("utf-8", "replace")

    def finish(self) -> str:
        rest, self._begun = self._begun, b""
        return rest.decode("utf-8", "replace")


def decoded(ids: list[int], tokens: dict[int, bytes], step: int = 65_536) -> Iterator[str]:
    decoder = StreamingDecoder(tokens)
    for at in range(0, len(ids), step):
        yield decoder.feed(ids[at : at + step])
    yield decoder.finish()


def splitter(pattern: str) -> Callable[[str], list[str]]:
    """All matches of ``pattern`` (without groups) in a text.

    A text without characters above U+00FF goes through an equal pattern whose classes
    list their characters below that, which the plain engine runs twice as fast.
    """
    every = regex.compile(pattern).findall
    latin = [chr(i) for i in range(256)]

    def listed(name: str) -> str:
        return "".join(re.escape(c) for c in latin if regex.match(name, c))

    narrow, inside, at = "", False, 0
    while at < len(pattern):
        part = pattern[at : at + 5] if pattern[at : at + 3] == r"\p{" else pattern[at : at + 2]
        if part in (r"\p{L}", r"\p{N}", r"\s"):
            narrow += listed(part) if inside else f"[{listed(part)}]"
        elif part == r"\S" and not inside:
            narrow += "[^" + listed(r"\s") + "]"
        elif pattern[at] == "\\":
            return every
        else:
            part = pattern[at]
            inside = part == "[" or inside and part != "]"
            narrow += part
        at += len(part)
    plain = re.compile(narrow).findall

    def split(text: str) -> list[str]:
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return every(text)
        return plain(text)

    return split


_FIELDS = {
    "ids": (ArrayType(IntegerType()), pa.list_(pa.int32())),
    "n_tokens": (LongType(), pa.int64()),
    "ids_sha256": (StringType(), pa.string()),
    "decoded_sha256": (StringType(), pa.string()),
}


@lru_cache(maxsize=1)
def _piece_ids(vocabulary: str, most: int) -> tuple[PieceIds, dict[int, bytes]]:
    """Kept from task to task of a worker process; what it remembers changes no result."""
    transducer = MergeTransducer(read_ranks(vocabulary), most)
    return PieceIds(transducer, most), transducer.tokens


def _encoder(vocabulary: str, pattern: str, outputs: tuple[str, ...], most: int) -> Worker:
    ids_of, tokens = _piece_ids(vocabulary, most)
    known = ids_of.__getitem__
    digits = {token: str(token) for token in tokens}.__getitem__
    pieces = splitter(pattern)

    def work(texts: pa.Array) -> list[pa.Array]:
        gc.disable()  # the many small tuples form no cycles, and looking for some costs half the time
        try:
            return encoded(texts)
        finally:
            gc.enable()

    def encoded(texts: pa.Array) -> list[pa.Array]:
        rows: dict[str, list] = {name: [] for name in outputs}
        for text in texts:
            ids = list(chain.from_iterable(map(known, pieces(text.as_py() or ""))))
            if "ids" in rows:
                rows["ids"].append(ids)
            if "n_tokens" in rows:
                rows["n_tokens"].append(len(ids))
            if "ids_sha256" in rows:
                rows["ids_sha256"].append(hashlib.sha256(",".join(map(digits, ids)).encode()).hexdigest())
            if "decoded_sha256" in rows:
                digest = hashlib.sha256()
                for part in decoded(ids, tokens):
                    digest.update(part.encode())
                rows["decoded_sha256"].append(digest.hexdigest())
        return [pa.array(rows[name], _FIELDS[name][1]) for name in outputs]

    return work


def encode_texts(
    df: DataFrame,
    vocabulary: str,
    pattern: str,
    text: str = "text",
    outputs: tuple[str, ...] = ("ids", "n_tokens"),
    kept: int = KEPT,
) -> DataFrame:
    """``df`` with the ids of each text and what else of ``outputs`` is asked for.

    ``vocabulary`` is a rank file that every executor has at this path; ``pattern``
    splits a text into the pieces that are encoded each on its own. ``outputs``: ids,
    n_tokens, ids_sha256 (decimal ids joined by commas) and decoded_sha256 (what the
    decoder makes of the ids). Null and empty texts have no ids; rows that repeat are
    encoded each; an empty table stays empty. Columns with the names of outputs give way.
    ``kept`` bounds a worker's memory, about 1 KB each, and changes no result.
    """
    fields = [StructField(name, _FIELDS[name][0]) for name in outputs]
    return with_columns(df, text, fields, partial(_encoder, vocabulary, pattern, outputs, kept))


def _decoder(vocabulary: str) -> Worker:
    tokens = {rank: token for token, rank in read_ranks(vocabulary).items()}
    return lambda ids: [pa.array([None if x.as_py() is None else "".join(decoded(x.as_py(), tokens)) for x in ids], pa.string())]


def decode_ids(df: DataFrame, vocabulary: str, ids: str = "ids", out: str = "text") -> DataFrame:
    """``df`` with the text of each list of ids; null for null."""

    def run(batches: Iterator[pa.RecordBatch], make: Callable = partial(_decoder, vocabulary)) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            own = [batch.column(name) for name in kept]
            yield pa.RecordBatch.from_arrays(own + work(batch.column(ids)), [*kept, out])

    kept = [c for c in df.columns if c.lower() != out.lower()]
    schema = df.select(*(f"`{c}`" for c in kept)).schema.add(out, StringType())
    return df.transform(map_arrow, run, schema)
