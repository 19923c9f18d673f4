"""Control columns: which run wrote a row, when, from what, and its digests."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import names as N
from tidemark.functions.clock import day_stamp, file_stamp, second_stamp
from tidemark.functions.hashing import fingerprint, parse_keys, quoted, require_columns
from tidemark.session import new_work_path, written

#: Runs whose rows are dealt out to several tasks; the table of these is broadcast.
SPLIT_RUNS = 10_000
_RUN, _SHARES, _SHARE, _COPY = "__run", "__shares", "__share", "__copy"


@dataclass(frozen=True)
class RunContext:
    """Identity and clock of one run. ``log_path`` and the start make its id."""

    process: str
    log_path: str
    clock: Callable[[], datetime] = datetime.now
    started: datetime = field(default=None)  # type: ignore[assignment]

    def __post_init__(self) -> None:
        if self.started is None:
            object.__setattr__(self, "started", self.clock())

    @property
    def run_id(self) -> str:
        return f"{self.log_path}_{file_stamp(self.started)}"

    @property
    def updated_at(self) -> str:
        return second_stamp(self.started)

    @property
    def ingested_on(self) -> str:
        return day_stamp(self.started)

    def now(self) -> str:
        return second_stamp(self.clock())


def _run_columns(run: RunContext, source: str | Column) -> dict[str, Column]:
    return {
        N.RUN_ID: F.lit(run.run_id),
        N.UPDATED_AT: F.lit(run.updated_at),
        N.INGESTED_ON: F.lit(run.ingested_on),
        N.SOURCE_NAME: source if isinstance(source, Column) else F.lit(source),
    }


def add_control_columns(
    df: DataFrame,
    keys: str | Sequence[str],
    run: RunContext,
    source: str | Column,
    null_token: str | None = None,
    widened: Sequence[str] = (),
) -> DataFrame:
    """``df`` plus the run columns and the digests of its key and of its row.

    The row digest covers every column but the control columns, in the order of
    the frame, so the order has to be the same for every snapshot. ``widened`` names
    columns that the table held as whole numbers before fractions arrived.
    """
    keys = parse_keys(keys)
    require_columns(df, keys, "snapshot")
    values = [c for c in df.columns if c not in N.CONTROL_COLUMNS]
    run_columns = _run_columns(run, source)
    return df.select(
        *[F.col(f"`{c}`") for c in values],
        *[value.alias(name) for name, value in run_columns.items()],
        fingerprint(keys, null_token, widened).alias(N.KEY_HASH),
        fingerprint(values, null_token, widened).alias(N.ROW_HASH),
    )


def replace_run_columns(df: DataFrame, run: RunContext, source: str | Column) -> DataFrame:
    """Drop the run columns and add this run's at the tail; digests stay."""
    kept = [F.col(quoted(c)) for c in df.columns if c not in N.RUN_COLUMNS]
    return df.select(*kept, *[value.alias(name) for name, value in _run_columns(run, source).items()])


def lineage(rows: DataFrame, runs: DataFrame, split_rows: int = 1_000_000) -> DataFrame:
    """Rows joined to the audit row of the run that wrote them.

    A run may have written nearly all rows. The rows of each run are counted; those of a run
    with more than ``split_rows`` are dealt out by a hash of the row, and its audit row is
    copied once for each share, so that no task of the join gets more. The counts of split
    runs, at most ``SPLIT_RUNS``, are all that is broadcast.
    """
    require_columns(rows, [N.RUN_ID], "rows")
    written_by = rows.groupBy(F.col(N.RUN_ID).alias(_RUN)).agg(F.count(F.lit(1)).alias(_SHARES))
    counts = written(written_by, new_work_path(rows.sparkSession, "run-rows"))
    total = counts.agg(F.sum(_SHARES)).first()[0] or 0
    most = max(split_rows, -(-total // SPLIT_RUNS))
    shares = F.ceil(F.col(_SHARES) / most).alias(_SHARES)
    # Runs with more than ``most`` of the rows: at most SPLIT_RUNS.
    split = counts.where(F.col(_SHARES) > most).select(_RUN, shares)
    if not split.head(1):
        return rows.join(runs, rows[N.RUN_ID] == runs[N.LOG_ID], "inner")
    one = F.coalesce(F.col(_SHARES), F.lit(1))
    dealt = rows.join(F.broadcast(split), F.col(N.RUN_ID) == F.col(_RUN), "left").select(
        *[rows[quoted(c)] for c in rows.columns],
        F.pmod(F.xxhash64(*[rows[quoted(c)] for c in rows.columns]), one).alias(_SHARE),
    )
    copied = runs.join(F.broadcast(split), F.col(N.LOG_ID) == F.col(_RUN), "left").select(
        *[runs[quoted(c)] for c in runs.columns],
        F.explode(F.sequence(F.lit(0).cast("bigint"), one - 1)).alias(_COPY),
    )
    same = (F.col(N.RUN_ID) == F.col(N.LOG_ID)) & (F.col(_SHARE) == F.col(_COPY))
    return dealt.join(copied, same, "inner").drop(_SHARE, _COPY)
