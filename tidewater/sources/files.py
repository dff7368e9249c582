"""File readers with declared schemas.

Library code declares schemas: inference costs a full extra pass over the
input (one more job) and gives unstable types. ``infer_*`` variants exist for
interactive use only.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """One row per line, column ``value``. Globs (S3) are accepted."""
    return spark.read.text(path)


def read_delimited(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: StructType | str,
    sep: str = ",",
    header: bool = False,
) -> DataFrame:
    """Delimited text with a declared schema.

    A real CSV reader honours quotes (a quoted title with a comma stays whole,
    unlike ``line.split(",")``), and blank fields become null instead of ''.
    """
    return (
        spark.read.schema(schema)
        .option("sep", sep)
        .option("header", header)
        .option("mode", "PERMISSIVE")
        .csv(path)
    )


def infer_csv(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    """Header + inferred schema (one extra job to sample the file)."""
    return spark.read.option("header", header).option("inferSchema", True).csv(path)


def read_json_lines(spark: SparkSession, path: str | Sequence[str], schema: StructType | str) -> DataFrame:
    """JSON lines with a declared schema (arrays, maps, timestamps)."""
    return spark.read.schema(schema).json(path)


def infer_json(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines with an inferred schema (ints become bigint, columns sorted)."""
    return spark.read.json(path)


def rows_to_frame(spark: SparkSession, rows: Iterable, schema: StructType | str | Sequence[str]) -> DataFrame:
    """Small in-memory rows (tests and fixtures only)."""
    rows = list(rows)
    if isinstance(schema, (list, tuple)):
        return spark.createDataFrame(rows).toDF(*schema)
    return spark.createDataFrame(rows, schema)
