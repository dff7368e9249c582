"""Event-time and processing-time windows (ST11-ST15).

State per window is kept by Spark per shuffle partition and checkpointed; a
watermark lets Spark drop windows that can no longer change, which bounds
state on an endless stream.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

from tidewater.functions.temporal import instant_to_ntz, ntz_to_instant


def is_ntz(df: DataFrame, col: str) -> bool:
    return isinstance(df.schema[col].dataType, TimestampNTZType)


def with_event_time(stream: DataFrame, col: str) -> DataFrame:
    """Watermarks need TIMESTAMP; tables hold timestamp_ntz. The conversion
    keeps the wall clock as UTC, independent of the session zone, so windows
    align to wall-clock hours and minutes."""
    return stream.withColumn(col, ntz_to_instant(col)) if is_ntz(stream, col) else stream


def windowed_sum(
    stream: DataFrame,
    time_col: str,
    value: str | Column,
    duration: str,
    slide: str | None = None,
    keys: Sequence[str] = (),
    watermark: str | None = None,
    out: str = "total",
    ntz_output: bool = True,
) -> DataFrame:
    """ST11/ST12/ST13/ST15: ``groupBy(window(time, duration[, slide]), keys).agg(sum)``
    with the window as flat ``start`` / ``end`` columns.

    With ``watermark`` the time column is converted to TIMESTAMP first and the
    window bounds are converted back to timestamp_ntz on output.
    """
    s = stream
    was_ntz = is_ntz(stream, time_col)
    if watermark:
        s = with_event_time(s, time_col).withWatermark(time_col, watermark)
    v = F.col(value) if isinstance(value, str) else value
    w = F.window(F.col(time_col), duration, slide) if slide else F.window(F.col(time_col), duration)
    agg = s.groupBy(w.alias("w"), *keys).agg(F.sum(v).alias(out))
    start, end = F.col("w.start"), F.col("w.end")
    if watermark and ntz_output and was_ntz:
        start, end = instant_to_ntz(start), instant_to_ntz(end)
    return agg.select(start.alias("start"), end.alias("end"), *keys, out)


def windowed_totals(stream: DataFrame, time_col: str, value: Column, duration: str, rows: str = "rows", out: str = "total") -> DataFrame:
    """ST14 over recorded arrival times: rows and sum per window."""
    agg = stream.groupBy(F.window(time_col, duration).alias("w")).agg(F.count(F.lit(1)).alias(rows), F.sum(value).alias(out))
    return agg.select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), rows, out)


def processing_time_sum(stream: DataFrame, value: Column, duration: str, out: str = "total") -> DataFrame:
    """ST14: window over the arrival time (``current_timestamp()``, fixed per micro-batch)."""
    stamped = stream.select(value.alias("__v"), F.current_timestamp().alias("processing_time"))
    agg = stamped.groupBy(F.window("processing_time", duration).alias("w")).agg(F.sum("__v").alias(out))
    return agg.select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), out)


def top_item_per_window(
    stream: DataFrame,
    time_col: str,
    item_col: str,
    value: str | Column,
    duration: str,
    watermark: str,
    out: str = "total",
) -> DataFrame:
    """ST13 + W1 on a stream: per event-time window, the item with the largest
    summed value (ties -> the greatest item).

    Ranking is refused on streams, so the top item comes from a second
    aggregation over the first one's windows (``max_by``); Spark chains the two
    stateful operators under one watermark in append mode, so each window is
    written once, when it is closed. State stays bounded by the watermark.
    """
    was_ntz = is_ntz(stream, time_col)
    s = with_event_time(stream, time_col).withWatermark(time_col, watermark)
    per_item = s.groupBy(F.window(F.col(time_col), duration).alias("w"), F.col(item_col)).agg(F.sum(value).alias(out))
    best = F.struct(F.col(out), F.col(item_col))
    top = per_item.groupBy("w").agg(F.max_by(best, best).alias("best"))
    bound = instant_to_ntz if was_ntz else (lambda c: c)
    return top.select(
        bound(F.col("w.start")).alias("start"),
        bound(F.col("w.end")).alias("end"),
        F.col(f"best.{item_col}").alias(item_col),
        F.col(f"best.{out}").alias(out),
    )
