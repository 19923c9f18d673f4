"""Stored tables: files in a folder, and a list of what has been released.

Each write fills folders of its own and ends with one file in the ``releases``
folder of the table, named by its number: every folder the table now consists of, with
the schema it was written under, and how many rows there are. Readers need the newest of
these alone. So a write that was cut short stays unseen, a table is never overwritten
while it is being read, and no file footers are read to find the schema. The file is
written under another name and moved into place unless there is one already: of two writers
that start from one release the second fails, and neither touches the files of the other.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import names as N
from tidemark.functions.hashing import quoted, require_columns
from tidemark.operators.changes import unseen_rows
from tidemark.operators.evolve import align, merged_schema, union_evolving, widened_columns
from tidemark.operators.latest import latest_versions
from tidemark.session import remove_path, work_path
from tidemark.sources.releases import (
    NOTHING,
    ConcurrentWriteError,
    Part,
    Release,
    newest_release,
    path_exists,
    publish_text,
    release_file,
)

_ATTEMPT = "tidemark_attempt"
_PLACES = [T.StructField(N.RELEASE, T.LongType()), T.StructField(_ATTEMPT, T.StringType())]


def one_row(spark: SparkSession, **values: Column) -> DataFrame:
    """A row of literals, made without a Python worker."""
    return spark.range(0, 1, 1, 1).select(*[v.alias(name) for name, v in values.items()])


def counted(df: DataFrame, seen: Observation, constants: Mapping[str, str]) -> DataFrame:
    """``df`` with its rows counted into ``seen``, ``constants`` set above that.

    A constant below the count would hide from the planner, which would sort the
    rows of a partitioned write by it.
    """
    watched = df.drop(*constants).observe(seen, F.count(F.lit(1)).alias("rows"))
    return watched.select(
        *[
            F.lit(constants[c]).alias(c) if c in constants else F.col(quoted(c))
            for c in df.columns
        ]
    )


def write_counted(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    partition_by: tuple[str, ...] = (),
    constants: Mapping[str, str] | None = None,
) -> int:
    """Write ``df`` and return the number of rows written, in one pass.

    The count is taken in the stage that writes, where Spark counts each task
    once however often it has to be run again. ``constants`` names columns that
    hold one known text throughout.
    """
    seen = Observation()
    rows = counted(df, seen, constants or {})
    # Static: all that an earlier attempt left in the folder goes, whatever the
    # session prefers.
    (
        rows.write.format(fmt)
        .mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .partitionBy(*partition_by)
        .save(path)
    )
    return int(seen.get["rows"])


class StoredTable:
    """What the table kinds below share."""

    partition_by: tuple[str, ...] = ()

    def __init__(self, spark: SparkSession, path: str, fmt: str = "parquet") -> None:
        self.spark = spark
        self.path = path.rstrip("/")
        self.fmt = fmt

    def _last(self) -> Release:
        return newest_release(self.spark, f"{self.path}/releases")

    def last_release(self) -> Release | None:
        """The newest release that can be read, or None where nothing has been released."""
        last = self._last()
        return last if last.release else None

    def exists(self) -> bool:
        return self.last_release() is not None

    def schema(self) -> T.StructType | None:
        """Columns and types without a job; none where there is no table."""
        last = self.last_release()
        return None if last is None else last.schema()

    def find(self) -> DataFrame | None:
        """The table, or None where there is none yet."""
        last = self.last_release()
        return None if last is None else self._read_release(last)

    def read(self) -> DataFrame:
        found = self.find()
        if found is None:
            raise FileNotFoundError(f"no table at {self.path}")
        return found

    def _read_release(self, release: Release) -> DataFrame:
        return self._read_parts(release, release.parts)

    def _read_parts(
        self, release: Release, parts: Iterable[Part], places: list[T.StructField] | None = None
    ) -> DataFrame:
        """``parts`` under the newest schema, each read with the types it was written with."""
        newest = release.schema()
        whole = T.StructType([*newest.fields, *(places or [])])
        alike: dict[str, list[str]] = {}
        for part in parts:
            stored = {f.name: f.dataType for f in release.schema(part.schema).fields}
            fields = [T.StructField(f.name, stored.get(f.name, f.dataType)) for f in newest.fields]
            written_as = T.StructType([*fields, *(places or [])])
            alike.setdefault(written_as.json(), []).append(f"{self.path}/{part.path}")
        if not alike:
            return self.spark.createDataFrame([], whole)
        reader = self.spark.read.format(self.fmt).option("basePath", f"{self.path}/data")
        groups = [
            # The reader moves partition columns to the tail, so put them back in their places.
            align(reader.schema(T.StructType.fromJson(json.loads(own))).load(paths), whole)
            for own, paths in alike.items()
        ]
        return reduce(union_evolving, groups)

    def _release(self, release: Release, own: Iterable[Part]) -> None:
        file = release_file(f"{self.path}/releases", release.release)
        try:
            publish_text(self.spark, file, release.text())
        except Exception as error:
            if not path_exists(self.spark, file):
                raise
            for part in own:
                remove_path(self.spark, f"{self.path}/{part.path}")
            raise ConcurrentWriteError(
                f"release {release.release} of {self.path} was made by another writer"
            ) from error


def _attempt() -> str:
    return uuid.uuid4().hex[:12]


class AppendTable(StoredTable):
    """A table that only grows."""

    def append(self, df: DataFrame, evolve: bool = True) -> int:
        """Add the rows of ``df``; columns new to the table go to its tail.

        With ``evolve`` off, columns the table lacks are left out.
        """
        return self._append(df, self._last(), evolve)

    def create(self, df: DataFrame) -> int:
        """First load that insists on being the first."""
        last = self._last()
        if last.release:
            raise FileExistsError(f"there already is a table at {self.path}")
        return self._append(df, last, True)

    def _append(
        self,
        df: DataFrame,
        last: Release | None,
        evolve: bool,
        constants: Mapping[str, str] | None = None,
        moment: str | None = None,
        batch: str | None = None,
    ) -> int:
        last = last or NOTHING
        schema = merged_schema(last.schema(), df.schema, widen=evolve)
        if last.release and not evolve:
            require_columns(df, last.schema().names, "appended rows")
            schema = last.schema()
        schemas = last.schemas if schema.json() in last.schemas[-1:] else (*last.schemas, schema.json())
        number = last.following
        path = f"data/{N.RELEASE}={number}/{_ATTEMPT}={_attempt()}"
        added = write_counted(
            align(df, schema), f"{self.path}/{path}", self.fmt, self.partition_by, constants
        )
        if added or not last.release:
            part = Part(path, number, len(schemas) - 1, moment, batch)
            self._release(Release(number, last.rows + added, schemas, (*last.parts, part)), [part])
        else:
            remove_path(self.spark, f"{self.path}/{path}")
        return added

    def _read_release(self, release: Release, after: int = 0, numbered: bool = False) -> DataFrame:
        """Rows of the releases above ``after``, from their folders alone.

        ``numbered`` adds the release of each row.
        """
        names = release.schema().names
        later = [p for p in release.parts if p.release > after]
        return self._read_parts(release, later, _PLACES).select([*names, N.RELEASE] if numbered else names)


class HistoryTable(AppendTable):
    """Every distinct version of every row ever seen, by day of ingestion."""

    partition_by = (N.INGESTED_ON,)

    def read(self, since: str | None = None) -> DataFrame:
        """The history, or the days from ``since`` on, which prunes the scan."""
        history = super().read()
        return history if since is None else history.filter(F.col(N.INGESTED_ON) >= since)

    def read_news(self, seen: int | None) -> tuple[DataFrame, int]:
        """What a reader who knows the releases up to ``seen`` still has to see.

        These are the later releases if each of their runs started after all
        those seen; otherwise an older version may have come in late, and it is
        the whole history. Also gives the number of the newest release.
        """
        last = self.last_release()
        if last is None:
            raise FileNotFoundError(f"no table at {self.path}")
        moments = [(p.release > (seen or 0), p.moment) for p in last.parts]
        known = [m for late, m in moments if not late]
        in_order = None not in [m for _, m in moments] and all(
            late <= m for late in known for new, m in moments if new
        )
        return self._read_release(last, seen or 0 if in_order else 0, numbered=True), last.release

    def read_after(self, seen: int) -> tuple[DataFrame, int]:
        """The rows of the releases after ``seen``, and the number of the newest."""
        last = self.last_release()
        if last is None:
            raise FileNotFoundError(f"no table at {self.path}")
        return self._read_release(last, seen), last.release

    def has_batch(self, batch: str) -> bool:
        """Whether a release came with this batch."""
        last = self.last_release()
        return last is not None and any(p.batch == batch for p in last.parts)

    def widened(self, incoming: T.StructType) -> list[str]:
        """Columns that ``incoming`` has as fractions and that held whole numbers at first."""
        last = self._last()
        return widened_columns([*(last.schema(i) for i in range(len(last.schemas))), incoming])

    def insert_unseen(
        self,
        stage: DataFrame,
        compare: str = "history",
        distinct: bool = False,
        evolve: bool = True,
        day: str | None = None,
        moment: str | None = None,
        batch: str | None = None,
    ) -> int:
        """Append the rows that are new; on the first load, all of them.

        ``day`` and ``moment`` say that these are the day of ingestion and the
        run start in every row; ``batch`` names what the rows came with.

        ``compare="history"`` takes a row for known if any version ever had its
        digest; ``compare="latest"`` only if the newest version of its key has,
        so that a value returning to an old state is recorded again.
        """
        if compare not in ("history", "latest"):
            raise ValueError(f"compare is 'history' or 'latest', not {compare!r}")
        last = self._last()
        constants = {} if day is None else {N.INGESTED_ON: day}
        if not last.release:
            first = stage.dropDuplicates([N.ROW_HASH]) if distinct else stage
            return self._append(first, last, True, constants, moment, batch)
        known = self._read_release(last, numbered=compare == "latest")
        if compare == "latest":
            known = latest_versions(known)
        with work_path(self.spark, "stage") as work:
            fresh = unseen_rows(stage, known, distinct=distinct, work=work)
            # Few rows from many tasks: let adaptive execution size the files.
            return self._append(fresh.hint("rebalance"), last, evolve, constants, moment, batch)


@dataclass(frozen=True)
class UpsertCounts:
    inserted: int
    updated: int
    copied: int


class CurrentTable(StoredTable):
    """One row per key. Each upsert writes a new release beside the last one."""

    def overwrite(self, df: DataFrame, on: str = N.KEY_HASH) -> int:
        """Make ``df`` the table, with the schema of ``df``."""
        return self._replace(df, self._last())

    def _replace(self, df: DataFrame, last: Release, source: int | None = None) -> int:
        number = last.following
        schema = merged_schema(T.StructType(), df.schema)
        part = Part(f"data/{number}-{_attempt()}/changed", number, 0)
        rows = write_counted(df, f"{self.path}/{part.path}", self.fmt)
        self._release(Release(number, rows, (schema.json(),), (part,), source), [part])
        return rows

    def upsert(
        self,
        changed: DataFrame,
        on: str = N.KEY_HASH,
        unique: bool = False,
        evolve: bool = True,
        source: int | None = None,
    ) -> UpsertCounts:
        """Update the keys in ``changed``, insert those that are new.

        The changed rows are computed once and written; their keys, read back
        from those files, then pick the rows of the last release to keep. The
        planner knows the size of the files, so the keys are broadcast exactly
        when they are small. ``unique`` vouches for one row per key;
        ``source`` is the release of the history the rows come from.
        """
        require_columns(changed, [on], "changed rows")
        last = self._last()
        if not last.release:
            if not unique:
                self._require_unique(changed, on)
            return UpsertCounts(self._replace(changed, last, source), 0, 0)
        stored = last.schema()
        schema = merged_schema(stored, changed.schema, widen=evolve)
        if not evolve:
            require_columns(changed, stored.names, "changed rows")
            schema = stored
        number = last.following
        folder = f"data/{number}-{_attempt()}"
        parts = tuple(Part(f"{folder}/{side}", number, 0) for side in ("changed", "kept"))
        written = write_counted(align(changed, schema), f"{self.path}/{parts[0].path}", self.fmt)
        if written == 0:
            remove_path(self.spark, f"{self.path}/{folder}")
            return UpsertCounts(0, 0, last.rows)
        release = Release(number, written, (schema.json(),), parts, source)
        keys = self._read_parts(release, parts[:1]).select(on)
        if not unique:
            self._require_unique(keys, on)
        rest = align(self._read_release(last).join(keys, on, "left_anti"), schema)
        kept = write_counted(rest, f"{self.path}/{parts[1].path}", self.fmt)
        updated = last.rows - kept
        self._release(replace(release, rows=written + kept), parts)
        return UpsertCounts(written - updated, updated, kept)

    @staticmethod
    def _require_unique(df: DataFrame, on: str) -> None:
        twice = df.groupBy(on).count().filter((F.col("count") > 1) & F.col(on).isNotNull())
        example = twice.take(1)
        if example:
            raise ValueError(f"several source rows have the key {example[0][on]}")
