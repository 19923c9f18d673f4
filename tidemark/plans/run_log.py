"""Run audit: one all-string row per run, whatever its outcome."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import names as N
from tidemark.functions.clock import parse_instant
from tidemark.operators.control import RunContext
from tidemark.sources.releases import path_exists
from tidemark.sources.tables import one_row


class RunRecord:
    """Values of one log row, filled in while the run proceeds."""

    def __init__(self, run: RunContext, columns: Sequence[str], message: str, **values: str) -> None:
        self.run = run
        self.columns = tuple(columns)
        self.message = message
        #: What a run that succeeds has to say in place of the usual message.
        self.note = ""
        self.values = dict.fromkeys(columns, "")
        self.update(
            id_log_file_path=run.run_id,
            start_time_script=run.updated_at,
            status=N.STARTED,
            **values,
        )

    def update(self, **values: object) -> None:
        unknown = set(values) - set(self.columns)
        if unknown:
            raise ValueError(f"the log has no column {sorted(unknown)}")
        self.values.update({name: str(value) for name, value in values.items()})

    @contextmanager
    def step(self, name: str) -> Iterator[None]:
        """Stamp the start of a step and, if it succeeds, its end."""
        self.update(**{f"start_{name}": self.run.now()})
        yield
        self.update(**{f"end_{name}": self.run.now()})

    def close(self, status: str, message: str = "") -> None:
        self.update(
            status=status, end_time_script=self.run.now(), **{self.message: message}
        )

    def to_frame(self, spark: SparkSession) -> DataFrame:
        return one_row(spark, **{c: F.lit(self.values[c]) for c in self.columns})


def ingest_record(run: RunContext, input_path: str, output_path: str) -> RunRecord:
    return RunRecord(
        run,
        N.INGEST_LOG_COLUMNS,
        "msg_erro",
        process_name=N.INGEST_PROCESS_PREFIX + run.process,
        input_path=input_path,
        output_path=output_path,
        records_processed="0",
    )


def refresh_record(run: RunContext, input_path: str, output_path: str) -> RunRecord:
    return RunRecord(
        run,
        N.REFRESH_LOG_COLUMNS,
        "msg",
        process_name=N.REFRESH_PROCESS_PREFIX + run.process,
        date_run=run.ingested_on,
        input_path=input_path,
        output_path=output_path,
        records_inserted="0",
        records_updated="0",
    )


@contextmanager
def audited(
    spark: SparkSession, record: RunRecord, success: str = "", failure_prefix: str = ""
) -> Iterator[RunRecord]:
    """Run the block and append its log row, also when the block fails.

    ``FileExistsError`` says there was nothing to do and ends the run as
    skipped; any other error is logged and raised again.
    """
    try:
        yield record
        record.close(N.SUCCEEDED, record.note or success)
    except FileExistsError as reason:
        record.close(N.SKIPPED, str(reason))
    except Exception as error:
        record.close(N.FAILED, failure_prefix + str(error))
        raise
    finally:
        record.to_frame(spark).write.mode("append").parquet(record.run.log_path)


def read_run_log(spark: SparkSession, log_path: str) -> DataFrame | None:
    """All runs of one log, None before the first; a file per run, all of one schema."""
    if not path_exists(spark, log_path):
        return None
    return spark.read.option("mergeSchema", False).parquet(log_path)


def typed_run_log(log: DataFrame) -> DataFrame:
    """The log with instants and counts in their own types instead of strings."""
    typed = {}
    for name in log.columns:
        if name.startswith(("start_", "end_")):
            typed[name] = parse_instant(F.col(name))
        elif name.startswith("records_"):
            typed[name] = F.col(name).try_cast("bigint")
        elif name == "date_run":
            typed[name] = F.col(name).try_cast("date")
    return log.withColumns(typed)
