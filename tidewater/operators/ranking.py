"""Sorts, top-k and rank within a partition."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def sort_by(df: DataFrame, *cols: str | Column) -> DataFrame:
    """A cluster-side sort (range-partitioned), never a driver-side sort."""
    return df.orderBy(*cols)


def top_k(df: DataFrame, k: int, *order: Column) -> DataFrame:
    """``orderBy(...).limit(k)`` -> TakeOrderedAndProject: each task keeps
    only its own k best rows, so nothing but k rows per task is shuffled.
    Give a total order (add a unique tie-breaker) for a stable answer."""
    return df.orderBy(*order).limit(k)


def rank_first(df: DataFrame, partition: Sequence[str], order: Sequence[Column], rank_col: str = "rank") -> DataFrame:
    """Rows with ``rank() == 1`` per partition (ties kept, unlike row_number).

    Meant for input that is already aggregated per (partition, item), where
    a partition holds one row per distinct item.
    """
    w = Window.partitionBy(*partition).orderBy(*order)
    return df.withColumn(rank_col, F.rank().over(w)).filter(F.col(rank_col) == 1)
