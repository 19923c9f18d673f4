from tidemark.sources.merging import MergeTable
from tidemark.sources.releases import ConcurrentWriteError, Release, path_exists
from tidemark.sources.snapshots import (
    BAD_RECORD,
    literal_table,
    read_json_records,
    read_json_snapshot,
)
from tidemark.sources.tables import (
    AppendTable,
    CurrentTable,
    HistoryTable,
    StoredTable,
    UpsertCounts,
    counted,
    one_row,
    write_counted,
)

__all__ = [
    "BAD_RECORD",
    "AppendTable",
    "ConcurrentWriteError",
    "CurrentTable",
    "HistoryTable",
    "MergeTable",
    "Release",
    "StoredTable",
    "UpsertCounts",
    "counted",
    "literal_table",
    "one_row",
    "path_exists",
    "read_json_records",
    "read_json_snapshot",
    "write_counted",
]
