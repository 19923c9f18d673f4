from tidemark.functions.cleaning import clean_string, clean_strings, empty_to_null, string_columns
from tidemark.functions.clock import (
    day_stamp,
    day_stamp_of,
    file_stamp,
    file_stamp_of,
    parse_instant,
    second_stamp,
    second_stamp_of,
)
from tidemark.functions.hashing import fingerprint, parse_keys, quoted, require_columns

__all__ = [
    "clean_string",
    "clean_strings",
    "day_stamp",
    "day_stamp_of",
    "empty_to_null",
    "file_stamp",
    "file_stamp_of",
    "fingerprint",
    "parse_instant",
    "parse_keys",
    "quoted",
    "require_columns",
    "second_stamp",
    "second_stamp_of",
    "string_columns",
]
