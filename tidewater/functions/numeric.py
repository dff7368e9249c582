"""Exact sums and means for fixed-point values held in doubles (prices, latencies).

A double sum depends on the order rows arrive in, which differs between runs,
retried tasks and engines. Summing the values as integer units (cents for
``scale=2``) in a long is exact and order-free, and stays on primitive longs
(a DECIMAL(38) sum goes through BigDecimal and costs ~4x more). The mean is
then one IEEE division of exact operands, so every engine and every re-run
gives the same double. Limit: |sum| < 9.2e18 units; beyond it the sum raises
an overflow error under ANSI mode instead of returning a wrong value.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def units(col: Column | str, scale: int = 2) -> Column:
    """A fixed-point value in units of 10**-scale (a long). A value with more
    decimals is an error, never cut."""
    c = F.col(col) if isinstance(col, str) else col
    finer = F.raise_error(F.concat(F.lit(f"more than {scale} decimals: "), c.cast("string"))).cast("long")
    return F.when(F.round(c, scale) == c, F.round(c * (10**scale)).cast("long")).when(c.isNotNull(), finer)


def is_finer(col: Column | str, scale: int = 2) -> Column:
    """Whether a value has more decimals than ``scale`` or is no finite number."""
    c = F.col(col) if isinstance(col, str) else col
    whole = F.round(c, scale) == c
    return F.coalesce(~whole | F.isnan(c) | (F.abs(c) == float("inf")), F.lit(False))


def units_or_null(col: Column | str, scale: int = 2) -> Column:
    """``units`` for endless input: a value that ``is_finer`` gives null instead of an
    error, which would fail a stream again at each restart. Count them beside it."""
    c = F.col(col) if isinstance(col, str) else col
    return F.when(~is_finer(c, scale), F.round(c * (10**scale)).cast("long"))


def unit_sum(col: Column | str, scale: int = 2) -> Column:
    """Exact sum of a fixed-point column, in units of 10**-scale (a long)."""
    return F.sum(units(col, scale))


def exact_sum(col: Column | str, scale: int = 2) -> Column:
    """Exact sum of a fixed-point column as a double: the same in any order of the rows."""
    return unit_sum(col, scale).cast("double") / 10**scale


def exact_mean(col: Column | str, scale: int = 2) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return unit_sum(c, scale).cast("double") / (F.count(c) * (10**scale))
