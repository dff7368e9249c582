"""J11 with a hot key: bucketed tables whose join needs no Exchange and no giant bucket.

A bucket holds all rows of its keys, so a key with a third of all rows makes one
task of a bucketed join as long as a third of the job. Here both tables are bucketed
by the key and a salt. The salt of the many side is 0, except for hot keys (more rows
than an average bucket: fewer keys than there are buckets), whose rows are spread over
as many salts as the key would fill buckets. The one side holds a hot key's rows once
per salt. Equal (key, salt) then meet in equal buckets of both tables, each many-side
row meets the one side's rows once, and a hot key is read by several tasks.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.session import parallelism, unique_name
from tidewater.sinks.tables import parquet_roundtrip, save_bucketed

SALT_COL = "salt"


@dataclass(frozen=True)
class BucketedPair:
    many: DataFrame
    one: DataFrame
    key: str
    buckets: int

    def join(self, how: str = "inner") -> DataFrame:
        """Inner, left or left semi / anti join of the many side with the one side."""
        if how not in ("inner", "left", "left_semi", "left_anti"):
            raise ValueError("rows of the one side are repeated per salt, so the many side must decide")
        # a merge join keeps both sides' buckets; the planner would broadcast a small side
        return self.many.hint("merge").join(self.one, [self.key, SALT_COL], how).drop(SALT_COL)


def hot_keys(many: DataFrame, key: str, buckets: int) -> DataFrame:
    """``key`` and ``salts`` of the keys with more rows than an average bucket."""
    counts = many.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    average = F.col("total") / F.lit(buckets)
    total = many.agg(F.count(F.lit(1)).alias("t")).scalar()
    found = counts.withColumn("total", total).filter(F.col("n") > average)
    return found.select(F.col(key).alias("__hot"), F.ceil(F.col("n") / average).cast("int").alias("__salts"))


def save_bucketed_pair(
    many: DataFrame, one: DataFrame, key: str, buckets: int | None = None, spread: Sequence[str] | None = None, name: str = "pair"
) -> BucketedPair:
    """Both tables bucketed by ``key`` and salt. ``spread``: the columns whose hash
    tells the many side's rows of a key apart (all, if not given)."""
    spark = many.sparkSession
    buckets = buckets or parallelism(spark)
    # fewer rows than buckets, counted once and kept
    hot = parquet_roundtrip(spark, hot_keys(many, key, buckets), "hot-keys")

    def with_hot(df: DataFrame) -> DataFrame:
        return df.join(hot, F.col(key) == F.col("__hot"), "left")

    salt: Column = F.coalesce(F.pmod(F.xxhash64(F.lit(SALT_COL), *(spread or many.columns)), F.col("__salts")).cast("int"), F.lit(0))
    salted = with_hot(many).withColumn(SALT_COL, salt).select(*many.columns, SALT_COL)
    salts = F.sequence(F.lit(0), F.coalesce(F.col("__salts"), F.lit(1)) - 1)
    copied = with_hot(one).withColumn(SALT_COL, F.explode(salts)).select(*one.columns, SALT_COL)
    by = [key, SALT_COL]
    return BucketedPair(
        save_bucketed(spark, salted, buckets, by, by, name=unique_name(f"{name}_many")),
        save_bucketed(spark, copied, buckets, by, by, name=unique_name(f"{name}_one")),
        key, buckets,
    )

