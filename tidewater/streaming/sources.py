"""Streaming sources (ST1-ST6).

A file source tracks which files it has processed in its checkpoint, so a
restarted query (lost driver or executors) resumes without loss or repeats.
Sockets (the reference's source) keep nothing and cannot replay, so they are
re-aimed to directory sources with the same ``value: string`` shape.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidewater.sources.tables import table_path


def table_stream(
    spark: SparkSession,
    sf_dir: str,
    name: str,
    schema: StructType | None = None,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """A table as a stream. A table stored as a folder of part files streams
    that folder; a table stored as one ``<name>.parquet`` file (the TESTDATA
    layout) streams its parent folder with a file-name filter, since a file
    source watches folders.

    All files that are there go into one micro-batch unless the caller gives a
    limit. Files come in the order of their times, not of the events in them,
    so with a watermark a limit makes rows late that were not late before."""
    path = table_path(sf_dir, name)
    reader = _reader(spark, max_files_per_trigger).schema(schema or spark.read.parquet(path).schema)
    if _is_file(spark, path):
        return reader.option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)
    return reader.parquet(path)


def _is_file(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` is one file, by its file system's own answer (no listing)."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return fs.getFileStatus(hadoop_path).isFile()


def _reader(spark: SparkSession, max_files_per_trigger: int | None):
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader


def text_stream(spark: SparkSession, directory: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """ST1/ST2: new text files in a folder, one row per line (``value``)."""
    return _reader(spark, max_files_per_trigger).text(directory)


def csv_stream(
    spark: SparkSession, directory: str, schema: StructType | str, header: bool = False, max_files_per_trigger: int | None = None
) -> DataFrame:
    """ST3: CSV files with a declared schema."""
    return _reader(spark, max_files_per_trigger).schema(schema).option("header", header).csv(directory)


def json_stream(
    spark: SparkSession, directory: str, schema: StructType | str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """ST4: JSON-lines files with a declared schema."""
    return _reader(spark, max_files_per_trigger).schema(schema).json(directory)


def parse_json_lines(lines: DataFrame, schema: StructType | str, source: str = "value") -> DataFrame:
    """ST6: ``from_json(value, schema)`` then expand the struct."""
    return lines.select(F.from_json(F.col(source), schema).alias("r")).select("r.*")


def parse_csv_lines(lines: DataFrame, schema: str, source: str = "value") -> DataFrame:
    """ST5: one ``from_csv`` instead of six ``split().getItem(i)``."""
    return lines.select(F.from_csv(F.col(source), schema).alias("r")).select("r.*")
