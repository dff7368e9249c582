"""Timestamp parsing and parts.

Under ANSI mode (default since Spark 4) ``to_timestamp`` raises on bad input;
the ``try_`` forms return null instead, which is what a filter over dirty
input wants.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed formats of the inputs (values that must stay as they are).
ACCESS_LOG_TIME_FORMAT = "dd/MMM/yyyy:HH:mm:ss"  # [26/Feb/2023:04:15:21]
DAY_FIRST_DATE_FORMAT = "dd/MM/yyyy"  # 26/02/2023
DOTTED_DATE_FORMAT = "yyyy.M.d"  # 2023.2.6


def parse_time(col: Column | str, fmt: str | None = None) -> Column:
    """String -> timestamp_ntz; null on text that does not parse.

    With a pattern the text is parsed with an explicit UTC offset appended and
    read back as the UTC wall clock, so the result never depends on the
    session zone (a local time inside a DST gap would otherwise move an hour).
    """
    c = F.col(col) if isinstance(col, str) else col
    if fmt is None:
        return c.try_cast("timestamp_ntz")
    return instant_to_ntz(F.try_to_timestamp(F.concat(c, F.lit(" +00:00")), F.lit(f"{fmt} xxx")))


def as_time(col: Column | str, fmt: str | None = None) -> Column:
    """Timestamp columns pass through; strings are parsed with ``fmt``."""
    c = F.col(col) if isinstance(col, str) else col
    return c if fmt is None else parse_time(c, fmt)


def year_of(col: Column | str, fmt: str | None = None) -> Column:
    return F.year(as_time(col, fmt))


def month_of(col: Column | str, fmt: str | None = None) -> Column:
    return F.month(as_time(col, fmt))


def hour_minute(col: Column | str) -> tuple[Column, Column]:
    """Hour and minute of a time as ints (truncating it to the hour or
    minute first changes neither, and needs no zone)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.hour(c).cast("int").alias("hour"), F.minute(c).cast("int").alias("minute")


def _ntz_epoch() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def ntz_to_instant(col: Column | str) -> Column:
    """timestamp_ntz -> TIMESTAMP whose UTC reading is the same wall clock.

    Streaming watermarks need TIMESTAMP; ``cast('timestamp')`` would read the
    wall clock in the session zone (shifting hour windows by its offset and
    breaking at DST changes). Counting microseconds from the epoch does not
    depend on any zone.
    """
    c = F.col(col) if isinstance(col, str) else col
    return F.timestamp_micros(F.timestamp_diff("MICROSECOND", _ntz_epoch(), c))


def instant_to_ntz(col: Column | str) -> Column:
    """Inverse of ``ntz_to_instant``: the UTC wall clock of an instant as timestamp_ntz."""
    c = F.col(col) if isinstance(col, str) else col
    return F.timestamp_add("MICROSECOND", F.unix_micros(c), _ntz_epoch())
