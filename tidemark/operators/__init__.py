from tidemark.operators.changes import (
    changed_rows,
    insert_only,
    merge_actions,
    merge_metrics,
    unseen_rows,
    upsert,
)
from tidemark.operators.control import (
    RunContext,
    add_control_columns,
    lineage,
    replace_run_columns,
)
from tidemark.operators.evolve import align, merged_schema, union_evolving
from tidemark.operators.latest import latest_per_key, latest_versions, total_order

__all__ = [
    "RunContext",
    "add_control_columns",
    "align",
    "changed_rows",
    "insert_only",
    "latest_per_key",
    "latest_versions",
    "lineage",
    "merge_actions",
    "merge_metrics",
    "merged_schema",
    "replace_run_columns",
    "total_order",
    "union_evolving",
    "unseen_rows",
    "upsert",
]
