from tidemark.plans.gold import (
    daily_states,
    daily_variation,
    merged_states,
    rank_by_value,
    refresh_daily_states,
    segment_indicators,
    top_by_value,
    variation_of_states,
)
from tidemark.plans.jobs import (
    Layers,
    ingest_snapshot,
    refresh_current,
    run_chain,
)
from tidemark.plans.run_log import (
    RunRecord,
    audited,
    ingest_record,
    read_run_log,
    refresh_record,
    typed_run_log,
)

__all__ = [
    "Layers",
    "RunRecord",
    "audited",
    "daily_states",
    "daily_variation",
    "ingest_record",
    "ingest_snapshot",
    "merged_states",
    "rank_by_value",
    "read_run_log",
    "refresh_current",
    "refresh_daily_states",
    "refresh_record",
    "run_chain",
    "segment_indicators",
    "top_by_value",
    "typed_run_log",
    "variation_of_states",
]
