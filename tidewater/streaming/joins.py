"""Stream joins (ST19-ST21).

stream-static: the static side is re-read per micro-batch, nothing is kept.
stream-stream: both sides are buffered in state until they can no longer
match. Without watermarks that state grows without bound (only inner joins
are allowed then); with watermarks on both sides and a time-range condition
Spark can drop old rows, and left / right / full outer joins become possible
(the null-padded row is emitted once the watermark passes its time bound).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.operators.joins import SALT, replicate_one_side, salt_many_side
from tidewater.streaming.windows import with_event_time


def stream_static_join(stream: DataFrame, static: DataFrame, on: Column | str, how: str = "inner") -> DataFrame:
    """ST20: inner / left (stream on the left) joins against a static table."""
    return stream.join(static, on, how)


def stream_stream_join(
    left: DataFrame,
    right: DataFrame,
    on: Column,
    how: str = "inner",
    left_time: str | None = None,
    right_time: str | None = None,
    left_watermark: str | None = None,
    right_watermark: str | None = None,
    within: str | None = None,
    salt_buckets: int | None = None,
) -> DataFrame:
    """ST21: join two streams. With ``within`` (e.g. '2 hours') the right event
    time must lie in [left time, left time + within], which lets the watermarks
    bound the state.

    ``salt_buckets``: for a key-to-many join (``left`` has one row per key,
    ``right`` many), spread each key's ``right`` rows over that many salts and
    replicate ``left`` per salt, so a hot key's state and work are split over
    several partitions (streaming joins get no AQE skew handling). Inner joins
    only; the salt columns are dropped from the output."""
    if salt_buckets and how != "inner":
        raise ValueError("salted stream joins are inner joins")
    cond = on
    if salt_buckets:
        # left = the one side (replicated per salt), right = the many side (spread)
        left = replicate_one_side(left, salt_buckets).withColumnRenamed(SALT, "__salt_l")
        right = salt_many_side(right, salt_buckets).withColumnRenamed(SALT, "__salt_r")
        cond = cond & (left["__salt_l"] == right["__salt_r"])
    if left_watermark:
        left = with_event_time(left, left_time).withWatermark(left_time, left_watermark)
    if right_watermark:
        right = with_event_time(right, right_time).withWatermark(right_time, right_watermark)
    if within:
        cond = cond & (right[right_time] >= left[left_time]) & (
            right[right_time] <= left[left_time] + F.expr(f"INTERVAL {within}")
        )
    out = left.join(right, cond, how)
    return out.drop("__salt_l", "__salt_r") if salt_buckets else out
