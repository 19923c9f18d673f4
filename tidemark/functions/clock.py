"""Run clock formats and parsing of stored instants."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark import names as N


def file_stamp(at: datetime) -> str:
    return at.strftime(N.FILE_STAMP_STRFTIME)


def second_stamp(at: datetime) -> str:
    return at.strftime(N.SECOND_STRFTIME)


def day_stamp(at: datetime) -> str:
    return at.strftime(N.DAY_STRFTIME)


def file_stamp_of(instant: Column) -> Column:
    return F.date_format(instant, N.FILE_STAMP_PATTERN)


def second_stamp_of(instant: Column) -> Column:
    return F.date_format(instant, N.SECOND_PATTERN)


def day_stamp_of(instant: Column) -> Column:
    return F.date_format(instant, N.DAY_PATTERN)


def parse_instant(text: Column, to: str = "timestamp_ntz") -> Column:
    """Instant of a stored string, null where it is none (also in ANSI mode).

    Stored clocks carry no zone, so the default target has none either and the
    result does not depend on the session zone; ``to="timestamp"`` gives the
    zoned type.
    """
    return text.try_cast(to)
