from tidemark.catalog import columns, merges, reports, runs, stored
from tidemark.catalog.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL", "columns", "merges", "reports", "runs", "stored"]
