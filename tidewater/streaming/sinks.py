"""Streaming sinks and runners (ST9, ST10, ST16-ST18, K2).

Every run ends (``availableNow``: process what is there, then stop) and keeps
its checkpoint and output below the shared folder, so a restarted run resumes
exactly once. Results are read back from the written files — nothing is held
in driver memory (no memory sink, no console sink).

* append   -> parquet file sink (exactly-once through its own commit log)
* update   -> ``foreachBatch`` writing each micro-batch's rows to
  ``epoch=<batch id>`` (overwrite, so a replayed batch rewrites the same
  folder); reading keeps, per key, the row of the latest epoch
* complete -> ``foreachBatch`` overwriting the one result, as each micro-batch
  brings all of it

Output folders exist before a query starts, so an input without rows gives an
empty result, and a failing read is an error.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tidewater.operators.aggregates import keep_latest
from tidewater.session import parallelism, shared_path
from tidewater.sinks.manifest import commit_text, names_in, read_text
from tidewater.sinks.tables import make_folder, write_text_table


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
ROCKSDB_CONF = "spark.sql.streaming.stateStore.rocksdb"


def disk_state_session(spark: SparkSession) -> SparkSession:
    """A session whose streams keep their state on disk (RocksDB), for queries
    whose state no watermark bounds. It is a session of its own, so queries
    started from ``spark`` keep their setting.

    A join keeps one store a partition, not four; a commit writes the changes, not
    the files, which are uploaded in the background; and a write doesn't look up first
    whether its key is there, which served only a metric, the number of rows in state."""
    own = spark.newSession()
    own.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    own.conf.set("spark.sql.streaming.join.stateFormatVersion", "3")
    own.conf.set(f"{ROCKSDB_CONF}.changelogCheckpointing.enabled", "true")
    own.conf.set(f"{ROCKSDB_CONF}.trackTotalNumberOfRows", "false")
    own.conf.set("spark.sql.shuffle.partitions", str(parallelism(spark)))
    return own


def _locations(spark: SparkSession, name: str, location: str | None) -> tuple[str, str]:
    """(output, checkpoint). A stable ``location`` lets a restarted run resume
    from its checkpoint; without one each run gets fresh folders."""
    if location:
        return f"{location.rstrip('/')}/out", f"{location.rstrip('/')}/checkpoint"
    return shared_path(spark, "streams", f"{name}-out"), shared_path(spark, "streams", f"{name}-ckpt")


def _finish(query) -> None:
    query.awaitTermination()
    if query.exception() is not None:  # pragma: no cover - surfaced by awaitTermination
        raise query.exception()


def run_append(stream: DataFrame, name: str, location: str | None = None) -> DataFrame:
    """ST16 append: file sink, read back as a batch DataFrame."""
    spark = stream.sparkSession
    out, ckpt = _locations(spark, name, location)
    q = (
        stream.writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", ckpt)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    _finish(q)
    return spark.read.schema(stream.schema).parquet(out)


def start_append(stream: DataFrame, name: str, processing_time: str = "2 seconds"):
    """ST17: a continuous append query on a processing-time trigger (the
    reference's ``trigger(processingTime="2 seconds")``). Returns the running
    query and the output path; the caller stops it."""
    spark = stream.sparkSession
    out = shared_path(spark, "streams", f"{name}-out")
    q = (
        stream.writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", shared_path(spark, "streams", f"{name}-ckpt"))
        .outputMode("append")
        .trigger(processingTime=processing_time)
        .start()
    )
    return q, out


def run_interval(stream: DataFrame, name: str, processing_time: str = "1 second") -> DataFrame:
    """ST17 / ST18: the input that is there so far through a query on a processing-time
    trigger and a file sink (which stands in for the console), then stopped; its rows."""
    query, out = start_append(stream, name, processing_time)
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    return stream.sparkSession.read.schema(stream.schema).parquet(out)


def _run_batches(stream: DataFrame, write: Callable[[DataFrame, int], None], ckpt: str, mode: str = "append") -> None:
    q = (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", ckpt)
        .outputMode(mode)
        .trigger(availableNow=True)
        .start()
    )
    _finish(q)


def run_epochs(stream: DataFrame, name: str, location: str | None = None) -> DataFrame:
    """Run to the end in update mode; every micro-batch's output rows are kept
    with their ``epoch`` (batch id) — the change log of the result."""
    spark = stream.sparkSession
    out, ckpt = _locations(spark, name, location)
    make_folder(spark, out)
    _run_batches(stream, lambda batch, epoch_id: batch.write.mode("overwrite").parquet(f"{out}/epoch={epoch_id}"), ckpt, "update")
    return spark.read.schema(StructType([*stream.schema.fields, StructField("epoch", LongType())])).parquet(out)


def run_complete(stream: DataFrame, name: str, location: str | None = None) -> DataFrame:
    """Run to the end in complete mode; the last micro-batch's output is the result."""
    spark = stream.sparkSession
    out, ckpt = _locations(spark, name, location)
    make_folder(spark, out)
    _run_batches(stream, lambda batch, epoch_id: batch.write.mode("overwrite").parquet(out), ckpt, "complete")
    return spark.read.schema(stream.schema).parquet(out)


def run_keyed(
    stream: DataFrame, name: str, keys: Sequence[str], mode: str = "update", location: str | None = None
) -> DataFrame:
    """ST16 update / complete: the latest row per key."""
    if mode == "complete":
        return run_complete(stream, name, location)
    return keep_latest(run_epochs(stream, name, location), list(keys), ["epoch"]).select(*stream.columns)


def run_per_batch(stream: DataFrame, name: str, per_batch: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """ST9: apply a batch transformation to each micro-batch separately (not
    stateful: a key seen in two batches gives two rows); ``batch_id`` added."""
    spark = stream.sparkSession
    out = make_folder(spark, shared_path(spark, "streams", f"{name}-out"))

    def with_id(batch: DataFrame, epoch_id: int) -> DataFrame:
        return per_batch(batch).withColumn("batch_id", F.lit(epoch_id).cast("long"))

    _run_batches(
        stream,
        lambda batch, epoch_id: with_id(batch, epoch_id).write.mode("overwrite").parquet(f"{out}/epoch={epoch_id}"),
        shared_path(spark, "streams", f"{name}-ckpt"),
    )
    # the result's columns, also when there was no batch
    schema = with_id(spark.createDataFrame([], stream.schema), 0).schema
    return spark.read.schema(schema).parquet(out).select(*schema.names)


def write_json_per_batch(stream: DataFrame, name: str, location: str | None = None) -> str:
    """K2/ST10: each non-empty micro-batch to its own JSON folder, committed in a log.

    A batch writes ``data/<id>-<unique>`` and then the log entry ``log/<id>``, one
    rename that names the folder. Readers follow the log, so they see whole batches
    only: what a run left behind that died while writing is named by no entry, and
    the replay of its batch is visible once. A replay of a batch that did commit
    (the run died after the log entry, before the stream's own) changes nothing.
    The batch is evaluated once; a batch without rows gets an entry without folder."""
    spark = stream.sparkSession
    if location:
        out, ckpt = f"{location.rstrip('/')}/out", f"{location.rstrip('/')}/checkpoint"
    else:
        out, ckpt = shared_path(spark, "streams", f"{name}-json"), shared_path(spark, "streams", f"{name}-ckpt")
    make_folder(spark, f"{out}/log")

    def write_epoch(batch: DataFrame, epoch_id: int) -> None:
        entry = f"{epoch_id:012d}"
        if entry in names_in(spark, f"{out}/log"):
            return
        folder, seen = f"{entry}-{uuid.uuid4().hex[:12]}", Observation()
        write_text_table(batch.observe(seen, F.count(F.lit(1)).alias("rows")), f"{out}/data/{folder}", "json")
        rows = seen.get["rows"]
        commit_text(spark, f"{out}/log/{entry}", json.dumps({"batch": epoch_id, "rows": rows, "folder": folder if rows else None}))

    _run_batches(stream, write_epoch, ckpt)
    return out


def batch_log(spark: SparkSession, out: str) -> list[dict]:
    """The committed batches, in order: number, rows, folder."""
    return [json.loads(read_text(spark, f"{out}/log/{n}")) for n in names_in(spark, f"{out}/log") if n.isdigit()]


def read_json_batches(spark: SparkSession, out: str, schema) -> DataFrame:
    """The rows of all committed batches."""
    folders = [f"{out}/data/{e['folder']}" for e in batch_log(spark, out) if e["folder"]]
    return spark.read.schema(schema).json(folders) if folders else spark.createDataFrame([], schema)


def record_arrivals(stream: DataFrame, name: str, clock: Column | None = None, location: str | None = None) -> DataFrame:
    """ST14: an append-only log of the stream's rows with their ``arrival`` time.

    The time is taken once, when a row first comes in (``clock``, by default the
    micro-batch's time), and written with the row. Whatever counts by arrival reads
    the log, so running it again, or again after a failure, gives the same windows."""
    stamped = stream.withColumn("arrival", F.current_timestamp() if clock is None else clock)
    return run_append(stamped, name, location)
