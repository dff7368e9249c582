"""Aggregations.

DataFrame aggregates run as partial (map-side) + final hash aggregates, so the
reference's reduceByKey / groupByKey distinction disappears: a hot key is
combined inside each map task before the shuffle.

Where the reference gathered a group into one list (groupByKey -> list,
collect_set) the result here is the same multiset in relational form — one row
per (group, member) with its multiplicity and the group totals — so no single
row, task or driver ever has to hold a whole group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, NumericType

from tidewater.functions.numeric import exact_mean
from tidewater.functions.strings import split_on


def count_by(df: DataFrame, keys: Sequence[str | Column], name: str = "count") -> DataFrame:
    """Rows per key."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def word_count(lines: DataFrame, text_col: str = "value", sep: str = " ", word: str = "word") -> DataFrame:
    """A1: split on one literal separator (case and punctuation kept), count per word."""
    words = lines.select(F.explode(split_on(text_col, sep)).alias(word))
    return count_by(words, [word])


def min_max_mean(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    names: tuple[str, str, str] = ("max_value", "min_value", "mean_value"),
    exact_scale: int | None = None,
) -> DataFrame:
    """A5: max / min / mean of one column per group.

    ``exact_scale``: the values are fixed-point with that many decimals; the
    mean is then computed from an exact decimal sum (order-independent).
    """
    mx, mn, mean = names
    mean_expr = F.avg(value) if exact_scale is None else exact_mean(value, exact_scale)
    return df.groupBy(*keys).agg(F.max(value).alias(mx), F.min(value).alias(mn), mean_expr.alias(mean))


def mean_of_numeric(df: DataFrame, keys: Sequence[str], prefix: str = "avg_", exact_scale: int | None = None) -> DataFrame:
    """A10: ``groupby(keys).mean()`` — mean of every numeric non-key column.

    With ``exact_scale`` the floating columns (fixed-point values) are averaged
    through an exact decimal sum; integer columns are exact already.
    """
    fields = [f for f in df.schema.fields if isinstance(f.dataType, NumericType) and f.name not in keys]

    def mean(f):
        if exact_scale is not None and isinstance(f.dataType, (DoubleType, FloatType)):
            return exact_mean(f.name, exact_scale)
        return F.avg(f.name)

    return df.groupBy(*keys).agg(*[mean(f).alias(f"{prefix}{f.name}") for f in fields])


def member_multiset(df: DataFrame, keys: Sequence[str], member: str, name: str = "occurrences") -> DataFrame:
    """A4: the grouped list ((k1, k2) -> [m, m, ...]) with duplicates kept, as
    (k1, k2, m, occurrences) rows."""
    return df.groupBy(*keys, member).agg(F.count(F.lit(1)).alias(name))


def distinct_members(
    df: DataFrame,
    keys: Sequence[str],
    member: str,
    member_rows: str = "member_rows",
    group_rows: str = "group_rows",
    group_distinct: str = "group_distinct",
) -> DataFrame:
    """``collect_set(member)`` + ``count(member)`` per group, as one row per
    distinct (group, member) carrying the group's totals.

    ``count(member)`` is not distinct (as in the reference); the distinct count
    is an extra column. A group with null keys is a group; one whose members are
    all null has one row with a null member and zero counts. Both sides of the
    final join are pre-aggregated; the totals are one row per group.
    """
    pairs = df.groupBy(*keys, member).agg(F.count(member).alias(member_rows))
    totals = pairs.groupBy(*[F.col(k).alias(f"__{k}") for k in keys]).agg(
        F.sum(member_rows).cast("long").alias(group_rows), F.count(member).alias(group_distinct)
    )
    same = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]
    cond = same[0]
    for c in same[1:]:
        cond = cond & c
    joined = pairs.join(totals, cond).drop(*[f"__{k}" for k in keys])
    # a null member beside others adds nothing to the set
    return joined.filter(F.col(member).isNotNull() | (F.col(group_distinct) == 0))


def global_count(df: DataFrame, name: str = "rows") -> DataFrame:
    """``count()`` as a one-row DataFrame (no driver round trip)."""
    return df.agg(F.count(F.lit(1)).alias(name))


def keep_latest(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Newest row per key by ``order`` (make it a total order per key; nulls are
    older than anything).

    A rank of which only the first is asked for: Spark limits each key to its newest
    row in the map tasks too (``WindowGroupLimit``), so a key with a third of all
    rows is one row per map task in the shuffle, and whole rows need not be packed
    into aggregation buffers."""
    newest = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in order])
    return df.withColumn("__rank", F.row_number().over(newest)).filter("__rank = 1").drop("__rank")
