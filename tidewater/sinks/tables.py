"""Writers and table layout (K1-K4, K6-K8, K10-K12; ``keyed`` has K9, ``evolving`` K13, ``compaction`` the file counts of K5).

Every path is under the shared folder (``spark.checkpoint.dir``), so any
executor can read what another wrote, and a re-run of a stage after an
executor loss finds the same files.

Layout writes go through the ``rebalance`` hint: AQE groups rows of a
partition / bucket value into the same task as far as it can, but splits a
value that is too large over several tasks (several files) instead of letting
one task write a third of the table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from tidewater.session import shared_path, unique_name


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", partition_by: Sequence[str] = ()) -> str:
    """K1: ``write.format("parquet").mode(mode).save(path)``."""
    writer = df.write.format("parquet").mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
    return path


# Text formats write timestamps with millisecond precision unless told otherwise;
# these patterns keep the full microseconds (readers parse them by default).
FULL_PRECISION = {
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
}


def make_folder(spark: SparkSession, path: str) -> str:
    """An existing, possibly empty folder, in whatever store the path names."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).mkdirs(hadoop_path)
    return path


def write_text_table(df: DataFrame, path: str, fmt: str = "csv", header: bool = False, mode: str = "overwrite") -> str:
    """CSV / JSON write that loses no timestamp precision (K2 and the text-format sources)."""
    writer = df.write.mode(mode).options(**FULL_PRECISION)
    if fmt == "csv":
        writer = writer.option("header", header)
    getattr(writer, fmt)(path)
    return path


def parquet_roundtrip(spark: SparkSession, df: DataFrame, name: str = "roundtrip") -> DataFrame:
    """K1: write as parquet below the shared folder and read it back."""
    path = write_parquet(df, shared_path(spark, "tables", name))
    return spark.read.format("parquet").load(path)


def create_table_as(
    spark: SparkSession,
    name: str,
    select_sql: str,
    partitioned_by: Sequence[str] = (),
    location: str | None = None,
) -> DataFrame:
    """K3/K4: ``CREATE TABLE t USING parquet [PARTITIONED BY (..)] LOCATION .. AS SELECT ..``."""
    location = location or shared_path(spark, "tables", name)
    part = f"PARTITIONED BY ({', '.join(partitioned_by)})" if partitioned_by else ""
    quoted = location.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE TABLE {name} USING parquet {part} LOCATION '{quoted}' AS {select_sql}")
    return spark.table(name)


def save_partitioned(
    spark: SparkSession,
    df: DataFrame,
    partition_cols: Sequence[str],
    name: str | None = None,
    max_records_per_file: int | None = None,
) -> DataFrame:
    """K5: ``partitionBy(cols).saveAsTable`` — one folder per value.

    Without a shuffle on the partition columns each task writes one file per
    value it holds (files = tasks x values); the rebalance brings that down to
    about one file per value, more only for values too large for one task.
    """
    name = name or unique_name("partitioned")
    writer = df.hint("rebalance", *partition_cols).write.mode("overwrite").format("parquet")
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    writer.partitionBy(*partition_cols).option("path", shared_path(spark, "tables", name)).saveAsTable(name)
    return spark.table(name)


def save_bucketed(
    spark: SparkSession,
    df: DataFrame,
    buckets: int,
    bucket_cols: Sequence[str],
    sort_cols: Sequence[str] = (),
    partition_cols: Sequence[str] = (),
    name: str | None = None,
) -> DataFrame:
    """K6/K7/K8: ``bucketBy(n, cols)[.sortBy(cols)][.partitionBy(cols)].saveAsTable``.

    Bucket = pmod(murmur3(cols), n), the same function a shuffle uses, so two
    tables bucketed alike on the join key join without an Exchange (J11).
    """
    name = name or unique_name("bucketed")
    # rebalance into exactly `buckets` hash partitions on the bucket columns:
    # the shuffle hash equals the bucket function, so each task writes one
    # bucket (one file); AQE still splits a bucket that is too large.
    balanced = (
        df.hint("rebalance", *partition_cols, *bucket_cols)
        if partition_cols
        else df.hint("rebalance", buckets, *bucket_cols)
    )
    writer = (
        balanced.write.mode("overwrite")
        .format("parquet")
        .bucketBy(buckets, *bucket_cols)
    )
    if sort_cols:
        writer = writer.sortBy(*sort_cols)
    if partition_cols:
        writer = writer.partitionBy(*partition_cols)
    writer.option("path", shared_path(spark, "tables", name)).saveAsTable(name)
    return spark.table(name)


def save_table(spark: SparkSession, df: DataFrame, name: str, mode: str = "overwrite") -> DataFrame:
    """``saveAsTable`` (parquet, data below the shared folder)."""
    df.write.mode(mode).format("parquet").option("path", shared_path(spark, "tables", name)).saveAsTable(name)
    return spark.table(name)


def create_database(spark: SparkSession, db: str) -> None:
    """K11."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}")


def drop_table(spark: SparkSession, name: str) -> None:
    """K11."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def schema_profile(spark: SparkSession, df: DataFrame) -> DataFrame:
    """(column, type, nullable) of a DataFrame — metadata, not data."""
    rows = [(f.name, f.dataType.simpleString(), f.nullable) for f in df.schema.fields]
    return spark.createDataFrame(rows, "column string, type string, nullable boolean")


def describe_extended(spark: SparkSession, name: str) -> DataFrame:
    """Columns and details (location, provider, partitions, buckets) of a catalog table."""
    return spark.sql(f"DESCRIBE EXTENDED {name}")
