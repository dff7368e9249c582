"""R3 / U4 by weight: keys packed into partitions of like size from counted frequencies.

A partitioner by hash or by a list of keys gives a partition as many rows as its keys
happen to have. ``balanced_partition`` counts the keys first (combined in the map
tasks), then packs: keys with more than a tenth of a partition are *heavy*, at most
ten for each partition, and are cut into pieces of that size; all other keys fall
into ``GROUPS`` hash groups a partition. Pieces and groups, heaviest first, go to the
partition with the fewest rows so far. This plan, some dozens of rows a partition, is
all the driver sees; it is broadcast to the rows, whose one shuffle is that into the
partitions.

A key that is not heavy stays in one partition; the pieces of a heavy one are told
apart by a hash of the columns ``spread`` (all columns, if not given), so a re-run
task places rows alike. Rows that agree in all of them stay together.
"""

from __future__ import annotations

import heapq
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType

from tidewater.session import shared_path

PIECES = 10  # a partition's worth of a heavy key is cut into so many
GROUPS = 16  # hash groups of other keys per partition


def pack(weights: Sequence[tuple[object, float]], bins: int) -> dict[object, int]:
    """Item -> bin: the heaviest first, each into the lightest bin."""
    heap = [(0.0, b) for b in range(bins)]
    placed = {}
    for item, weight in sorted(weights, key=lambda w: (-w[1], str(w[0]))):
        load, b = heapq.heappop(heap)
        placed[item] = b
        heapq.heappush(heap, (load + weight, b))
    return placed


def balanced_partition(df: DataFrame, key: str, partitions: int, spread: Sequence[str] | None = None, id_col: str = "partition_id") -> DataFrame:
    """``df`` in ``partitions`` partitions of like size, with the partition's number."""
    spark = df.sparkSession
    path = shared_path(spark, "tables", "key-counts")
    df.groupBy(F.col(key).alias("key")).agg(F.count(F.lit(1)).alias("n")).write.parquet(path)
    counts = spark.read.parquet(path)
    total = counts.agg(F.sum("n")).first()[0] or 0
    least = max(1.0, total / partitions / PIECES)
    # at most PIECES rows per partition, and GROUPS rows per partition
    heavy = [(r[0], r[1]) for r in counts.filter(F.col("n") > least).collect()]
    group = F.pmod(F.xxhash64("key"), F.lit(GROUPS * partitions)).cast("int")
    light = counts.filter(F.col("n") <= least).groupBy(group.alias("g")).agg(F.sum("n").alias("n")).collect()
    pieces = {k: int(-(-n // least)) for k, n in heavy}
    weights = [(("key", i, p), n / pieces[k]) for i, (k, n) in enumerate(heavy) for p in range(pieces[k])]
    placed = pack(weights + [(("group", r.g), float(r.n)) for r in light], partitions)

    by_key = StructType([StructField("__key", df.schema[key].dataType), StructField("__targets", ArrayType(IntegerType()))])
    heavy_plan = spark.createDataFrame([(k, [placed["key", i, p] for p in range(pieces[k])]) for i, (k, _) in enumerate(heavy)], by_key)
    light_plan = spark.createDataFrame([(r.g, placed["group", r.g]) for r in light], "__g int, __target int")
    slot = F.pmod(F.xxhash64(F.lit("piece"), *(spread or df.columns)), F.size("__targets")).cast("int")
    return (
        df.withColumn("__group", F.pmod(F.xxhash64(key), F.lit(GROUPS * partitions)).cast("int"))
        .join(F.broadcast(heavy_plan), F.col(key).eqNullSafe(F.col("__key")), "left")
        .join(F.broadcast(light_plan), F.col("__group") == F.col("__g"), "left")
        .withColumn(id_col, F.coalesce(F.get("__targets", slot), F.col("__target"), F.lit(0)))
        .drop("__key", "__targets", "__group", "__g", "__target")
        .repartitionById(partitions, id_col)
    )
