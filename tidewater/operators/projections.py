"""Projections (P1-P8). Narrow: no shuffle, fused into one codegen stage."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.functions.strings import split_on


def select_sorted(df: DataFrame) -> DataFrame:
    """All columns in name order (the catalog's output layout)."""
    return df.select(*sorted(df.columns))


def with_quotient(df: DataFrame, col: str, divisor: float, out: str) -> DataFrame:
    """True division to a new column (``latency / 1000 AS latency_seconds``)."""
    return df.withColumn(out, F.col(col) / F.lit(divisor))


def with_powers(df: DataFrame, col: str, powers: Sequence[int] = (2, 3), prefix: str | None = None) -> DataFrame:
    """``[v, v**2, v**3]`` as columns (exact multiplication, not pow())."""
    base = F.col(col)
    prefix = prefix or col
    out = df
    for p in powers:
        expr = base
        for _ in range(p - 1):
            expr = expr * base
        out = out.withColumn(f"{prefix}_pow{p}", expr)
    return out


def with_constant(df: DataFrame, name: str, value) -> DataFrame:
    """``withColumn(name, lit(value))``."""
    return df.withColumn(name, F.lit(value))


def rename_and_drop(df: DataFrame, renames: Mapping[str, str], drop: Sequence[str] = ()) -> DataFrame:
    """P5: ``withColumnsRenamed`` + ``drop``."""
    return df.withColumnsRenamed(dict(renames)).drop(*drop)


def explode_split(df: DataFrame, col: str, out: str, sep: str = " ", keep: Sequence[str] = ()) -> DataFrame:
    """``flatMap(line.split(sep))`` — one row per piece, empty pieces kept."""
    return df.select(*keep, F.explode(split_on(col, sep)).alias(out))


def expand(df: DataFrame, struct_col: str, keep: Sequence[str] = ()) -> DataFrame:
    """``select("s.*")``."""
    return df.select(*keep, f"{struct_col}.*")
