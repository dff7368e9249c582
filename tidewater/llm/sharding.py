"""Sharding by proportional stratified interleaving.

Rows are shuffled within their source by a seeded hash and ranked; the row of
rank ``r`` among the ``n`` rows of its source has the fractional rank ``(2r - 1)
/ 2n``. All rows sorted by fractional rank interleave the sources in proportion,
and cutting that order into equal runs gives shards whose row counts are at
most one apart and which all hold the mixture of the whole.

No source and no order is put into one task. The rank within a source is the
number of its rows in lower hash ranges (from a table of counts per source and
range) plus the rank within the row's own range; so a source with a third of
all rows is spread over all ranges. The place in the total order is made
likewise from ranges of the fractional rank, whose counts follow from the
sources' row counts alone. Rows move twice, once for each of the two ranks, with
the columns the caller goes on to use: a text that isn't used later stays behind.

Defined cases: null is a source of its own; rows may repeat; null text has 0
bytes; with fewer rows than shards some shards stay empty; an empty table gives
an empty result; other columns stay, except one named like a result column.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.common import materialise, text_or_empty
from tidewater.session import parallelism

RANGES_PER_PARTITION = 4


def _range_bits(docs: DataFrame) -> int:
    """Enough hash ranges for some per task of a shuffle."""
    return max(4, (RANGES_PER_PARTITION * parallelism(docs.sparkSession) - 1).bit_length())


def assign_shards(docs: DataFrame, shards: int, seed: int = 0) -> DataFrame:
    """``docs`` with ``shard`` (from 0) and ``slot`` (its gapless place in the shard, from 0)."""
    bits = _range_bits(docs)
    ranges = 1 << bits
    keyed = docs.drop("shard", "slot").withColumns(
        {
            "__tw_source": F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit("n")),
            "__tw_hash": F.xxhash64(F.lit(seed), F.col("doc_id").cast("string"), F.col("source").cast("string"), text_or_empty()),
        }
    ).withColumn("__tw_range", F.shiftrightunsigned("__tw_hash", 64 - bits).cast("int"))

    counts = materialise(keyed.groupBy("__tw_source", "__tw_range").agg(F.count(F.lit(1)).alias("__tw_n")), "source-ranges")
    before = Window.partitionBy("__tw_source").orderBy("__tw_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "__tw_source", "__tw_range",
        F.coalesce(F.sum("__tw_n").over(before), F.lit(0)).alias("__tw_before"),
        F.sum("__tw_n").over(Window.partitionBy("__tw_source")).alias("__tw_rows"),
    )
    within = Window.partitionBy("__tw_source", "__tw_range").orderBy("__tw_hash", "doc_id")
    ranked = (
        keyed.join(offsets, ["__tw_source", "__tw_range"])
        .withColumn("__tw_rank", F.col("__tw_before") + F.row_number().over(within))
        # floor(fractional rank * ranges), in whole numbers
        .withColumn("__tw_place", F.expr(f"((2 * __tw_rank - 1) * {ranges}) div (2 * __tw_rows)"))
    )

    # rows of a source with a place below j: (2r - 1) * ranges < 2 * n * j
    below = lambda j: f"((((2 * n * ({j}) - 1) div {ranges}) + 1) div 2)"
    per_source = counts.groupBy("__tw_source").agg(F.sum("__tw_n").alias("n"))
    by_rank = per_source.filter(F.col("n") < ranges).select(
        F.explode(F.expr(f"transform(sequence(1L, n), r -> ((2 * r - 1) * {ranges}) div (2 * n))")).alias("__tw_place"), F.lit(1).cast("long").alias("c")
    )
    by_place = per_source.filter(F.col("n") >= ranges).select("n", F.explode(F.expr(f"sequence(0L, {ranges}L - 1)")).alias("__tw_place"))
    by_place = by_place.select("__tw_place", F.expr(f"{below('__tw_place + 1')} - if(__tw_place = 0, 0, {below('__tw_place')})").alias("c"))
    places = by_rank.unionByName(by_place).groupBy("__tw_place").agg(F.sum("c").alias("c"))
    # as many rows as there are ranges, whatever the size of the table
    starts = places.select("__tw_place", (F.sum("c").over(Window.orderBy("__tw_place")) - F.col("c")).alias("__tw_start"))

    total = counts.agg(F.coalesce(F.sum("__tw_n"), F.lit(0))).scalar()
    order = Window.partitionBy("__tw_place").orderBy((2 * F.col("__tw_rank") - 1) / F.col("__tw_rows"), "__tw_source", "__tw_rank")
    return (
        ranked.join(starts, "__tw_place")
        .withColumns({"__tw_at": F.col("__tw_start") + F.row_number().over(order) - 1, "__tw_total": total})
        .withColumn("shard", F.expr(f"(__tw_at * {shards}) div __tw_total").cast("int"))
        .withColumn("slot", F.expr(f"__tw_at - (shard * __tw_total + {shards - 1}) div {shards}").cast("long"))
        .drop("__tw_source", "__tw_hash", "__tw_range", "__tw_before", "__tw_rows", "__tw_rank", "__tw_place", "__tw_start", "__tw_at", "__tw_total")
    )


def write_shards(assigned: DataFrame, path: str, files_per_shard: int = 1) -> None:
    """One folder per shard; its files hold runs of slots, in order."""
    run = F.pmod(F.col("slot"), F.lit(files_per_shard))
    (
        assigned.repartition(F.col("shard"), run)
        .sortWithinPartitions("shard", run, "slot")
        .write.partitionBy("shard").mode("errorifexists").parquet(path)
    )
