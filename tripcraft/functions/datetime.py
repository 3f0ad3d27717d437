"""Date-time expressions.

Event text is parsed with the ``try_`` forms: under ANSI mode a plain cast or
``to_timestamp`` would fail the whole job on one bad record.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tripcraft.schemas import DATE_PATTERN, DATETIME_PATTERN, TIME_OF_DAY_PATTERN


def to_ntz(c: Column) -> Column:
    """Wall-clock timestamp without zone (the session zone is UTC)."""
    return c.cast("timestamp_ntz")


def parse_datetime_text(c: Column) -> Column:
    """``yyyy-M-d H:m:s`` text to a timestamp; null when it does not match."""
    return to_ntz(F.try_to_timestamp(c, F.lit(DATETIME_PATTERN)))


def parse_date_text(c: Column) -> Column:
    """``yyyy-M-d`` text (date only) to a date; null when it does not match."""
    return F.try_to_date(c, DATE_PATTERN)


def time_of_day(c: Column) -> Column:
    """``HH:mm:ss`` text of a timestamp column."""
    return F.date_format(c, TIME_OF_DAY_PATTERN)
