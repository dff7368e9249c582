"""K5: how many files a partitioned write makes, and packing small files into larger ones.

A task writes one file per partition value it holds, so ``partitionBy`` after ``n``
tasks makes up to ``n`` files per value, and ``bucketBy`` up to ``n`` per bucket.
``write_by_task`` fixes the tasks by a column, which makes the number of files a
property of the data; ``file_report`` counts files and rows per value.

``compact`` packs the files of each value, in the order of their names, into bins: a
bin is closed when the files before it fill a multiple of the target. Each bin is
read and written by one task, as one file; bins are bounded by the target (and one
file), whatever the size of the value, so a hot value is many bins. The plan is a
window over the list of files, which is metadata; the rows follow their file's bin.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewater.session import shared_path

BIN = "bin"


def write_by_task(df: DataFrame, task: Column, tasks: int, partition_cols: Sequence[str], name: str = "by-task") -> str:
    """K5: ``df`` written by ``tasks`` tasks, each row by the task that ``task`` names
    (0 to ``tasks - 1``), below one folder per partition value; returns the path."""
    path = shared_path(df.sparkSession, "tables", name)
    placed = df.withColumn("__task", task.cast("int")).repartitionById(tasks, "__task").drop("__task")
    placed.write.partitionBy(*partition_cols).parquet(path)
    return path


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """The table's rows with the file and the file's bytes."""
    return spark.read.parquet(path).select("*", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("file_bytes"))


def file_list(spark: SparkSession, path: str, partition_cols: Sequence[str]) -> DataFrame:
    """A row per file: partition values, file, rows, bytes."""
    return read_files(spark, path).groupBy(*partition_cols, "file").agg(F.count(F.lit(1)).alias("file_rows"), F.max("file_bytes").alias("file_bytes"))


def file_report(spark: SparkSession, path: str, partition_cols: Sequence[str]) -> DataFrame:
    """K5 report: files and rows per partition value."""
    files = file_list(spark, path, partition_cols)
    return files.groupBy(*partition_cols).agg(F.count(F.lit(1)).alias("files"), F.sum("file_rows").cast("long").alias("rows"))


def bins(files: DataFrame, partition_cols: Sequence[str], target: int, measure: str = "file_bytes") -> DataFrame:
    """``files`` with the ``bin`` of each within its partition value."""
    before = Window.partitionBy(*partition_cols).orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    filled = F.coalesce(F.sum(measure).over(before), F.lit(0))
    return files.withColumn(BIN, F.floor(filled / F.lit(target)).cast("int"))


def compact(spark: SparkSession, path: str, partition_cols: Sequence[str], target: int, measure: str = "file_bytes", name: str = "compacted") -> str:
    """The table at ``path`` rewritten with one file per bin; returns the new path
    (the old files stay until the caller removes them)."""
    packed = bins(file_list(spark, path, partition_cols), partition_cols, target, measure).select(F.col("file").alias("__file"), BIN)
    rows = read_files(spark, path).drop("file_bytes")
    out = shared_path(spark, "tables", name)
    placed = rows.join(packed, F.col("file") == F.col("__file")).drop("file", "__file")
    placed.repartition(*partition_cols, BIN).write.partitionBy(*partition_cols, BIN).parquet(out)
    return out
