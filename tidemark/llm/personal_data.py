"""Personal data: an Aho-Corasick pass finds anchors, small parsers find the edges.

Anchors are at-signs, the ``://`` of schemes, plus signs, digits, and the cue words of
identifiers. Each parser reads only around its anchor, so a text is passed once however
many kinds there are.
"""

from __future__ import annotations

import hashlib
import re
import string
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import (
    ArrayType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from tidemark.llm.batches import Worker, with_columns

#: Kinds in the order that breaks ties of equal starts; the first four are the base.
KINDS = ("email", "ip", "card", "phone", "url", "account", "secret")
BASE_KINDS = KINDS[:4]

#: Words before an identifier, by the kind of what follows.
CUES = {
    "account": ("account", "acct", "iban", "passport", "ssn", "username", "user id", "userid", "login"),
    "secret": ("token", "secret", "password", "passwd", "api key", "api_key", "apikey", "api-key"),
}

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL_PART = frozenset(string.ascii_letters + string.digits + "._%+-")
IP = re.compile(r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
DIGITS = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
HANDLE = re.compile(r"@[A-Za-z][A-Za-z0-9_]{2,29}(?![A-Za-z0-9_@.-])")
SCHEME = re.compile(r"[A-Za-z+.-]*[A-Za-z]")
#: A link that names a person: credentials before its host.
LINK = re.compile(r"://[^\s/@:]+(?::[^\s/@]*)?@[^\s\"'<>]+")
LABELLED = re.compile(r"[\x20\t]*(?:[:=#]|(?:no|number|is)\b\.?:?)[\x20\t]*[\"']?([A-Za-z0-9_+/=.-]{4,})")

#: What goes on over single blanks and hyphens: the groups of an IBAN, or of digits.
IBAN = re.compile(r"[A-Za-z]{2}[0-9]{2}(?:[\x20-]?[A-Za-z0-9]){11,30}")
#: A date after the number is none of its groups.
GROUPED = re.compile(r"[0-9]+(?:[\x20-](?![0-9]{4}-[0-9]{2}-[0-9]{2}(?![0-9]))[0-9]+)+(?![A-Za-z0-9_])")
#: A secret of letters alone: set by a sign, and the last of its line or in quotes.
SET = re.compile(r"[\x20\t]*[:=][\x20\t]*(?:\"[A-Za-z_+/=.-]{8,}\"|'[A-Za-z_+/=.-]{8,}'|[A-Za-z_+/=.-]{8,}(?=[\x20\t]*(?:[,;\r\n]|$)))")
LABEL = re.compile(r"[\x20\t]*(?:[:=#]|(?:no|number|is)\b\.?:?)[\x20\t]*[\"']?", re.ASCII | re.IGNORECASE)
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)

Span = tuple[int, int, str]


def luhn(digits: str) -> bool:
    doubled = (int(d) * 2 for d in digits[-2::-2])
    return (sum(map(int, digits[-1::-2])) + sum(d // 10 + d % 10 for d in doubled)) % 10 == 0


def iban_end(text: str, at: int) -> int:
    """Where the IBAN that starts at ``at`` ends, or -1: the longest run of its letters and
    digits, to the end of a group, whose check digits hold (mod 97)."""
    match = IBAN.match(text, at)
    end = match.end() if match else -1
    while match and end > at:
        number = text[at:end].replace(" ", "").replace("-", "").upper()
        if len(number) < 15:
            break
        if not text[end : end + 1].isalnum() and int("".join(str(int(c, 36)) for c in number[4:] + number[:4])) % 97 == 1:
            return end
        end -= 1
        while text[end - 1] in " -":
            end -= 1
    return -1


def account_end(text: str, at: int) -> int:
    """Where the account number that starts at ``at`` ends if it is in groups, or -1."""
    end = iban_end(text, at)
    if end < 0 and (match := GROUPED.match(text, at)) and sum(c in "0123456789" for c in match[0]) >= 4:
        end = match.end()
    return end


def anchors() -> ahocorasick.Automaton:
    """At-signs, schemes, plus signs, digits, and cues, for texts in which A-Z are lowered."""
    found = ahocorasick.Automaton()
    for sign in ("@", "://", "+", *"0123456789"):
        found.add_word(sign, (sign, len(sign)))
    for kind, words in CUES.items():
        for word in words:
            found.add_word(word, (kind, len(word)))
    found.make_automaton()
    return found


def _word_before(text: str, at: int) -> bool:
    return at > 0 and (text[at - 1].isalnum() or text[at - 1] == "_")


def spans_of(text: str, automaton: ahocorasick.Automaton) -> list[Span]:
    """All spans of ``text`` by start, then kind; offsets count code points."""
    found: list[Span] = []
    email_end = ip_end = digits_end = 0
    for last, (sign, size) in automaton.iter(text.translate(LOWER)):
        at = last + 1 - size
        if sign == "@":
            if at < email_end:
                continue
            start = at
            while start > email_end and text[start - 1] in LOCAL_PART:
                start -= 1
            match = EMAIL.match(text, start) if start < at else None
            if match:
                email_end = match.end()
                found.append((start, email_end, "email"))
            elif not _word_before(text, at) and (match := HANDLE.match(text, at)):
                found.append((at, match.end(), "account"))
        elif sign == "+":
            match = PHONE.match(text, at)
            if match and 9 <= sum(c in "0123456789" for c in match[0]) <= 15:
                found.append((at, match.end(), "phone"))
        elif sign == "://":
            start = at
            while start > 0 and (text[start - 1].isalpha() and text[start - 1].isascii() or text[start - 1] in "+.-"):
                start -= 1
            match = LINK.match(text, at)
            if match and start < at and SCHEME.fullmatch(text, start, at):
                found.append((start, match.end(), "url"))
        elif size == 1:  # a digit
            if at >= digits_end:
                match = DIGITS.match(text, at)
                digits_end = match.end() if match else at + 1
                if match and match.end() - at >= 12:
                    number = match[0].replace(" ", "").replace("-", "")
                    if 12 <= len(number) <= 19 and luhn(number):
                        found.append((at, digits_end, "card"))
            if at >= ip_end and (at == 0 or text[at - 1] not in "0123456789"):
                match = IP.match(text, at)
                if match:
                    ip_end = match.end()
                    if all(len(d := p.lstrip("0") or "0") <= 3 and int(d) <= 255 for p in match[0].split(".")):
                        found.append((at, ip_end, "ip"))
        elif not _word_before(text, at):
            if sign == "account" and (label := LABEL.match(text, last + 1)):
                end = account_end(text, label.end())
                if end > 0:
                    found.append((label.end(), end, sign))
                    continue
            match = LABELLED.match(text, last + 1)
            value = match[1].rstrip(".") if match else ""
            if len(value) < (8 if sign == "secret" else 4):
                continue
            if any(c in "0123456789" for c in value) or sign == "secret" and SET.match(text, last + 1):
                found.append((match.start(1), match.start(1) + len(value), sign))
    rank = {kind: i for i, kind in enumerate(KINDS)}
    return sorted(set(found), key=lambda span: (span[0], rank[span[2]], span[1]))


def redacted(text: str, spans: list[Span]) -> str:
    """``text`` with every span, or run of spans that overlap, as the kind of its first."""
    parts, at = [], 0
    for start, end, kind in spans:
        if start >= at:
            parts += [text[at:start], f"<{kind.upper()}>"]
        at = max(at, end)
    return "".join(parts) + text[at:]


def listed(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


SPAN_TYPE = StructType(
    [
        StructField("kind", StringType()),
        StructField("start", IntegerType()),
        StructField("end", IntegerType()),
    ]
)
_ARROW_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])
_FIELDS = {
    **{f"n_{kind}": (LongType(), pa.int64()) for kind in KINDS},
    "base_sha256": (StringType(), pa.string()),
    "spans": (StringType(), pa.string()),
    "span_list": (ArrayType(SPAN_TYPE), pa.list_(_ARROW_SPAN)),
    "redacted": (StringType(), pa.string()),
}


def _finder(outputs: tuple[str, ...]) -> Worker:
    automaton = anchors()

    def value(name: str, text: str | None, spans: list[Span]) -> object:
        if name == "spans":
            return listed(spans)
        if name == "base_sha256":
            base = listed([s for s in spans if s[2] in BASE_KINDS])
            return hashlib.sha256(base.encode()).hexdigest()
        if name == "span_list":
            return [{"kind": kind, "start": start, "end": end} for start, end, kind in spans]
        if name == "redacted":
            return None if text is None else redacted(text, spans)
        return sum(kind == name[2:] for _, _, kind in spans)

    def work(texts: pa.Array) -> list[pa.Array]:
        rows: Iterator = (x.as_py() for x in texts)
        found = [(text, spans_of(text, automaton) if text else []) for text in rows]
        return [
            pa.array([value(name, *row) for row in found], _FIELDS[name][1]) for name in outputs
        ]

    return work


def find_personal_data(
    df: DataFrame, text: str = "text", outputs: tuple[str, ...] = ("span_list", "redacted")
) -> DataFrame:
    """``df`` with what ``outputs`` asks for of the personal data in each text.

    ``span_list`` has kind, start and end (code points, end exclusive) by start and then
    kind, ``spans`` the same as text, ``redacted`` the text with each span as ``<KIND>``,
    ``n_<kind>`` a count, ``base_sha256`` a digest of the base kinds. A null text counts
    as empty and stays null when redacted; repeated rows are searched each; a text of any
    length is searched whole; an empty table stays empty. Columns with the names of
    outputs give way.
    """
    fields = [StructField(name, _FIELDS[name][0]) for name in outputs]

    def worker() -> Worker:
        return _finder(outputs)

    return with_columns(df, text, fields, worker)
