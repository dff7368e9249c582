"""Partitioning operators (R1-R5) and partition reports.

Reports aggregate per partition / per file; they never glom() or collect rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def repartition_to(df: DataFrame, n: int | None = None, *cols: str) -> DataFrame:
    """Round-robin to n, hash by columns, or n by columns."""
    if n is None:
        return df.repartition(*cols)
    return df.repartition(n, *cols)


def coalesce_to(df: DataFrame, n: int) -> DataFrame:
    """R2: narrow merge of partitions. It also lowers the parallelism of every
    narrow step before it, so put it after the wide work (or use repartition)."""
    return df.coalesce(n)


def hash_partition_id(col: str | Column, n: int) -> Column:
    """Partition of a value under Spark's hash partitioning: ``pmod(hash(x), n)``.

    ``hash(x) % n`` can be negative (hash('Science') % 3 = -1); pmod is not.
    """
    c = F.col(col) if isinstance(col, str) else col
    return F.pmod(F.hash(c), F.lit(n))


def position_partition_id(col: str | Column, values: Sequence, n: int) -> Column:
    """partition = index of the value in a fixed list, modulo n.

    Values not in the list get null here; ``custom_partition`` sends them to
    partition 0 (the reference raised ValueError on them).
    """
    c = F.col(col) if isinstance(col, str) else col
    idx = F.array_position(F.array(*[F.lit(v) for v in values]), c)  # 1-based, 0 = absent
    return F.when(idx > 0, F.pmod(idx - 1, F.lit(n))).cast("int")


def custom_partition(df: DataFrame, col: str, values: Sequence, n: int, id_col: str = "partition_id") -> DataFrame:
    """Place each row in the partition its key maps to (``repartitionById``)."""
    with_id = df.withColumn(id_col, F.coalesce(position_partition_id(col, values, n), F.lit(0)))
    return with_id.repartitionById(n, id_col)


def partition_profile(df: DataFrame, value_col: str | None = None) -> DataFrame:
    """Rows per physical partition (and min / max of a column) — the skew report."""
    pid = F.spark_partition_id().alias("partition")
    aggs = [F.count(F.lit(1)).alias("rows")]
    if value_col:
        aggs += [F.min(value_col).alias("min_value"), F.max(value_col).alias("max_value")]
    return df.select(pid, *([value_col] if value_col else [])).groupBy("partition").agg(*aggs)


def file_profile(df: DataFrame, *keys: str) -> DataFrame:
    """K5 report: files and rows per value of ``keys`` in a table read from
    files (small-file check: files = tasks x values without a rebalance)."""
    per_file = df.select(*keys, F.input_file_name().alias("file")).groupBy(*keys, "file").agg(
        F.count(F.lit(1)).alias("file_rows")
    )
    return per_file.groupBy(*keys).agg(F.count(F.lit(1)).alias("files"), F.sum("file_rows").cast("long").alias("rows"))


def co_partitioned_join(left: DataFrame, right: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Both sides shuffled alike on ``key`` and merged. The exchanges are the
    planner's own, so AQE can split a partition that a hot key makes large
    (after an explicit ``repartition`` it can't)."""
    return left.hint("merge").join(right, key, how)
