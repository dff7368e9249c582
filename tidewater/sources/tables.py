"""Parquet table scans (S9), catalog / view registration (S10, S14), range source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Parquet scan. Naming the columns here keeps ReadSchema minimal even
    before Catalyst's own pruning, and documents what each operator needs."""
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """``read.format("parquet").load(path)``."""
    return spark.read.format("parquet").load(path)


def register_views(spark: SparkSession, sf_dir: str, names=TABLES) -> None:
    """Expose the tables to SQL under their own names."""
    for name in names:
        read_table(spark, sf_dir, name).createOrReplaceTempView(name)


def read_catalog_table(spark: SparkSession, name: str) -> DataFrame:
    """``spark.table(name)`` — works for temp views and catalog tables."""
    return spark.table(name)


def number_range(spark: SparkSession, n: int, column: str = "id") -> DataFrame:
    """``range(n)`` as a one-column DataFrame (split into partitions by Spark)."""
    return spark.range(n).toDF(column)
