"""The two jobs and their chain: snapshot into history, history into current."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import names as N
from tidemark.functions.cleaning import clean_strings
from tidemark.functions.hashing import require_columns
from tidemark.operators.changes import changed_rows
from tidemark.operators.control import RunContext, add_control_columns, replace_run_columns
from tidemark.operators.latest import latest_versions
from tidemark.plans.run_log import audited, ingest_record, refresh_record
from tidemark.sources.merging import MergeTable
from tidemark.sources.snapshots import BAD_RECORD, read_json_records, read_json_snapshot
from tidemark.session import work_path, written
from tidemark.sources.tables import AppendTable, CurrentTable, HistoryTable

Clock = Callable[[], datetime]


@dataclass(frozen=True)
class Layers:
    """Where the tables of one process live."""

    process: str
    stage: str
    history: str
    current: str
    ingest_log: str
    refresh_log: str
    quarantine: str = ""

    @classmethod
    def under(cls, root: str, process: str) -> Layers:
        root = root.rstrip("/")
        return cls(
            process,
            stage=f"{root}/{N.STAGE_FOLDER}/{process}",
            history=f"{root}/{N.HISTORY_FOLDER}/{process}",
            current=f"{root}/{N.CURRENT_FOLDER}/{process}",
            ingest_log=f"{root}/{N.INGEST_LOG_FOLDER}/{process}",
            refresh_log=f"{root}/{N.REFRESH_LOG_FOLDER}/{process}",
            quarantine=f"{root}/{N.QUARANTINE_FOLDER}/{process}",
        )


def ingest_snapshot(
    spark: SparkSession,
    source: str | Sequence[str] | DataFrame,
    layers: Layers,
    keys: str | Sequence[str],
    clock: Clock = datetime.now,
    schema: T.StructType | str | None = None,
    multi_line: bool = True,
    source_name: str | None = None,
    drop: Sequence[str] = N.DROPPED_ON_READ,
    compare: str = "history",
    distinct: bool = False,
    null_token: str | None = None,
    evolve: bool = True,
    bad_records: str = "fail",
    batch: str | None = None,
) -> dict[str, str]:
    """Add the new rows of one snapshot to the history; returns the log row.

    ``source`` is a path of JSON files, several paths, or a frame; columns named in
    ``drop`` are left out. Files without a ``schema`` are read with the types that the
    history has, where these hold the values; a column of whole numbers to which fractions
    arrive becomes one of doubles, and digests of values that stay do not change. The source
    is computed once: a first load writes it to the table, a merge to the shared work
    folder, from where its digests and rows are read.

    A record that does not parse fails the run. With ``bad_records="quarantine"`` the files
    are parsed once to the work folder, the good records go on, the text of the others is
    kept in the quarantine table with run and file, and the log says how many there were.
    ``batch`` names what the rows came with, for ``HistoryTable.has_batch``.
    """
    if bad_records not in ("fail", "quarantine"):
        raise ValueError(f"bad_records is 'fail' or 'quarantine', not {bad_records!r}")
    run = RunContext(layers.process, layers.ingest_log, clock)
    is_frame = isinstance(source, DataFrame)
    if is_frame:
        origin = source_name or layers.stage
    else:
        origin = source_name or (source if isinstance(source, str) else ",".join(source))
    record = ingest_record(run, origin, layers.history)
    with audited(spark, record), work_path(spark, "records") as work:
        with record.step("create_session"):
            history = HistoryTable(spark, layers.history)
        with record.step("reading_file"):
            bad = None
            stored = history.schema() if schema is None and not is_frame else None
            if is_frame:
                snapshot = source.drop(*drop)
            elif bad_records == "fail":
                snapshot = read_json_snapshot(
                    spark, source, schema, multi_line, drop, source_name is None, stored
                )
            else:
                records = read_json_records(spark, source, schema, multi_line, drop, stored)
                records = written(records, work)
                bad = records.where(F.col(BAD_RECORD).isNotNull()).select(N.SOURCE_NAME, BAD_RECORD)
                snapshot = records.where(F.col(BAD_RECORD).isNull()).drop(BAD_RECORD)
                snapshot = snapshot.drop(N.SOURCE_NAME) if source_name else snapshot
        with record.step("add_control_columns"):
            named = N.SOURCE_NAME in snapshot.columns and source_name is None
            name = F.col(N.SOURCE_NAME) if named else origin
            widened = history.widened(snapshot.schema)
            staged = add_control_columns(snapshot, keys, run, name, null_token, widened)
        with record.step("merge_delta"):
            added = history.insert_unseen(
                staged,
                compare,
                distinct,
                evolve,
                day=run.ingested_on,
                moment=run.updated_at,
                batch=batch,
            )
            if bad is not None and bad.head(1):
                kept = replace_run_columns(bad, run, F.col(N.SOURCE_NAME))
                found = AppendTable(spark, layers.quarantine).append(kept)
                record.note = f"{found} bad records in {layers.quarantine}"
        record.update(records_processed=added)
    return record.values


def refresh_current(
    spark: SparkSession,
    layers: Layers,
    clock: Clock = datetime.now,
    incremental: bool = True,
    exclude: Sequence[str] = (),
    evolve: bool = True,
    merge_into: str | None = None,
) -> dict[str, str]:
    """Bring the current table up to the history; returns the log row.

    The current table knows which release of the history it was made from. An
    ``incremental`` refresh reads only the later ones, as long as runs came in
    time order: a key without a later row still has the newest row it had. After
    a run with an earlier clock it reads the whole history. A refresh with any change
    writes the whole current table anew.

    ``merge_into`` names a catalog table that takes the changes by Spark's own MERGE in the
    place of the stored one. Its format has to support row-level operations. It does not
    know its release of the history, which is read whole.
    """
    run = RunContext(layers.process, layers.refresh_log, clock)
    record = refresh_record(run, layers.history, merge_into or layers.current)
    with audited(spark, record, N.REFRESH_SUCCEEDED_MESSAGE, N.REFRESH_FAILED_PREFIX):
        current = CurrentTable(spark, layers.current)
        merged = MergeTable(spark, merge_into) if merge_into else None
        with record.step("bronze_reading"):
            known = None if merged else current.last_release()
            seen = known.source if known and incremental else None
            history, release = HistoryTable(spark, layers.history).read_news(seen)
            require_columns(history, N.CONTROL_COLUMNS, "history")
        with record.step("filter_data"):
            latest = latest_versions(history)
        with work_path(spark, "news") as news:
            with record.step("filter_new_data"):
                target = merged.read() if merged else current.find()
                changed = latest if target is None else changed_rows(written(latest, news), target)
            with record.step("transform_strings"):
                cleaned = clean_strings(changed, exclude=[*N.CONTROL_COLUMNS, *exclude])
            with record.step("add_column_log"):
                values = [c for c in cleaned.columns if c not in N.CONTROL_COLUMNS]
                ordered = cleaned.select(*[F.col(f"`{c}`") for c in values], *N.HASH_COLUMNS)
                stamped = replace_run_columns(ordered, run, layers.history)
            with record.step("update_delta_silver"):
                # One row per key: the latest of each.
                if merged:
                    counts = merged.merge(stamped, evolve=evolve)
                else:
                    counts = current.upsert(stamped, unique=True, evolve=evolve, source=release)
        record.update(records_inserted=counts.inserted, records_updated=counts.updated)
    return record.values


def run_chain(
    spark: SparkSession,
    sources: Iterable[str | Sequence[str] | DataFrame],
    layers: Layers,
    keys: str | Sequence[str],
    clock: Clock = datetime.now,
    incremental: bool = True,
    **ingest_options,
) -> list[dict[str, str]]:
    """For each snapshot in time order: ingest it, then refresh the current table."""
    records = []
    for source in sources:
        records.append(ingest_snapshot(spark, source, layers, keys, clock, **ingest_options))
        records.append(refresh_current(spark, layers, clock, incremental))
    return records
