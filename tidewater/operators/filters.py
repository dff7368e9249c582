"""Filters (F1-F11). Simple comparisons on scan columns reach Parquet as
``PushedFilters`` (row-group skipping); equality / range on a partition column
becomes ``PartitionFilters`` (directory pruning)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.functions.strings import strip_chars
from tidewater.functions.temporal import year_of


def where_equal(df: DataFrame, **equals) -> DataFrame:
    """conjunction of ``col == value``."""
    cond = None
    for col, value in equals.items():
        term = F.col(col) == F.lit(value)
        cond = term if cond is None else cond & term
    return df if cond is None else df.filter(cond)


def where_prefix(df: DataFrame, col: str, prefix: str) -> DataFrame:
    """``startswith`` (pushed to Parquet as StringStartsWith)."""
    return df.filter(F.col(col).startswith(prefix))


def where_prefix_contains(df: DataFrame, col: str, prefix: str, fragment: str, strip: str = '"') -> DataFrame:
    """after removing ``strip`` characters, starts with ``prefix`` and contains ``fragment``."""
    cleaned = strip_chars(col, strip)
    return df.filter(cleaned.startswith(prefix) & cleaned.contains(fragment))


def where_above(df: DataFrame, col: str, threshold: int, cast: str | None = None, whole: bool = False) -> DataFrame:
    """``int(x) > n``. Text is cast, a value that does not cast is dropped
    instead of failing. For a number column (``whole``), ``int(x) > n`` is ``x >=
    n + 1`` (``n`` not negative), which reaches Parquet as a pushed filter."""
    if whole:
        return df.filter(F.col(col) >= F.lit(threshold + 1))
    c = F.col(col) if cast is None else F.col(col).try_cast(cast)
    return df.filter(c > F.lit(threshold))


def where_between(df: DataFrame, col: str, low, high) -> DataFrame:
    """``low <= col <= high``; on a partition column this prunes directories."""
    return df.filter((F.col(col) >= F.lit(low)) & (F.col(col) <= F.lit(high)))


def where_not_null(df: DataFrame, *cols: str) -> DataFrame:
    """F7."""
    return df.dropna(how="any", subset=list(cols))


def guarded_length_above(col: str, transform: Callable[[Column], Column], min_len: int) -> Column:
    """F8: ``name IS NOT NULL AND length(f(name)) > n`` with a guaranteed order:
    SQL does not promise left-to-right evaluation of AND, CASE WHEN does."""
    c = F.col(col)
    return F.when(c.isNotNull(), F.length(transform(c)) > F.lit(min_len)).otherwise(F.lit(False))


def where_year(df: DataFrame, col: str, year: int, fmt: str | None = None) -> DataFrame:
    """year of a timestamp (or of a string parsed with ``fmt``) equals ``year``.

    For a timestamp column the equivalent range predicate is pushed to the scan.
    """
    if fmt is None:
        start = F.lit(f"{year}-01-01 00:00:00").cast("timestamp_ntz")
        end = F.lit(f"{year + 1}-01-01 00:00:00").cast("timestamp_ntz")
        c = F.col(col).cast("timestamp_ntz")
        return df.filter((c >= start) & (c < end))
    return df.filter(year_of(col, fmt) == F.lit(year))


def distinct_rows(df: DataFrame, *cols: str) -> DataFrame:
    """``distinct`` (hash aggregate with a partial, map-side step)."""
    return (df.select(*cols) if cols else df).distinct()
