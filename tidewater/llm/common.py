"""Helpers shared by the training-data operators.

The operators take any DataFrame with the columns they name and keep all other
columns; a column they add replaces an input column of the same name. Columns
they need on the way carry the prefix ``__tw_``, so they clash with nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.session import shared_path

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_LOWER = ASCII_UPPER.lower()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z only; other letters keep their code points."""
    return F.translate(text, ASCII_UPPER, ASCII_LOWER)


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def materialise(df: DataFrame, kind: str) -> DataFrame:
    """Write ``df`` as a table below the cluster's shared folder and read it back.

    Cuts the lineage for iterative work and for results that several branches
    use; the files are in shared storage, so a lost executor loses nothing."""
    path = shared_path(df.sparkSession, "llm", kind)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def slices(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """Arrow batches in parts of at most ``rows`` rows, so that few texts are
    Python objects at a time; buffers no longer used go back to the system."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
        del batch
        pa.default_memory_pool().release_unused()


def array_slices(values: pa.Array, rows: int = 256) -> Iterator[list]:
    """The values of an Arrow array as Python objects, some at a time."""
    for at in range(0, len(values), rows):
        yield values.slice(at, rows).to_pylist()
