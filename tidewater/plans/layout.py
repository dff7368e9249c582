"""Physical layout: partitioned / bucketed tables, pruning, co-location, custom
partitioning (F6, J11, J12, K3-K8, K13, R1-R5, E18).

Each query writes its tables below the shared folder, reads them back through
the catalog and runs the operator on them; plan tests check the layout is
used (PartitionFilters, dynamicpruning, no Exchange for bucketed joins).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.operators import aggregates as agg
from tidewater.operators import filters as flt
from tidewater.operators import partitioning as part_ops
from tidewater.operators.balance import balanced_partition
from tidewater.operators.bloom import bloom_join
from tidewater.plans.registry import register
from tidewater.session import parallelism, unique_name
from tidewater.sinks.compaction import compact, file_report, write_by_task
from tidewater.sinks.hot_buckets import BucketedPair, save_bucketed_pair
from tidewater.sinks.evolving import EvolvingTable, file_path
from tidewater.sinks.tables import (
    create_database,
    create_table_as,
    describe_extended,
    drop_table,
    save_bucketed,
    save_partitioned,
    save_table,
    schema_profile,
)
from tidewater.sources.tables import read_table

# The order priorities in their natural order (the custom
# partitioner's key list).
PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
# Their 32-bit murmur3 hashes with seed 42.
PRIORITY_HASHES = (
    ("1-URGENT", 1331383685), ("2-HIGH", -1608429704), ("3-MEDIUM", -78157334), ("4-NOT SPECIFIED", 1395399286), ("5-LOW", 2000133825),
)


def customer_by_nation(spark: SparkSession, d: str) -> DataFrame:
    """K4: CTAS of customer partitioned by nation (one folder per nation)."""
    view = unique_name("customer_src")
    read_table(spark, d, "customer").createOrReplaceTempView(view)
    return create_table_as(
        spark, unique_name("customer_by_nation"), f"SELECT /*+ REBALANCE(c_nationkey) */ * FROM {view}", partitioned_by=["c_nationkey"]
    )


@register(
    "partition_range_filter",
    """
    SELECT c_custkey, c_nationkey, c_acctbal * 2 AS double_acctbal
    FROM customer WHERE c_nationkey >= 5 AND c_nationkey <= 7
    """,
    ("F6", "K4", "S10"),
)
def partition_range_filter(spark: SparkSession, d: str) -> DataFrame:
    cust = customer_by_nation(spark, d)
    return flt.where_between(cust, "c_nationkey", 5, 7).select(
        "c_custkey", "c_nationkey", (F.col("c_acctbal") * 2).alias("double_acctbal")
    )


@register(
    "join_dpp",
    """
    SELECT c_custkey, c_acctbal, n_name FROM nation JOIN customer ON n_nationkey = c_nationkey
    WHERE n_regionkey = 3
    """,
    ("J12",),
)
def join_dpp(spark: SparkSession, d: str) -> DataFrame:
    """Filter on the small dimension; Spark prunes the fact table's nation
    folders at run time (dynamic partition pruning)."""
    cust = customer_by_nation(spark, d)
    nation = read_table(spark, d, "nation", "n_nationkey", "n_name", "n_regionkey").filter(F.col("n_regionkey") == 3)
    return nation.join(cust, nation["n_nationkey"] == cust["c_nationkey"]).select("c_custkey", "c_acctbal", "n_name")


def bucketed_pair(spark: SparkSession, d: str, buckets: int | None = None) -> tuple[DataFrame, DataFrame]:
    """K6/K8: orders and customer bucketed (and sorted) alike on the customer key,
    as many buckets as the session's shuffle parallelism. One key is always in
    one bucket, that is the feature: a hot key makes a large bucket."""
    buckets = buckets or parallelism(spark)
    orders = save_bucketed(
        spark, read_table(spark, d, "orders", "o_orderkey", "o_custkey", "o_totalprice"), buckets, ["o_custkey"], ["o_custkey"]
    )
    cust = save_bucketed(spark, read_table(spark, d, "customer", "c_custkey", "c_name"), buckets, ["c_custkey"], ["c_custkey"])
    return orders, cust


@register(
    "join_bucketed",
    "SELECT o_orderkey, o_custkey, c_name, o_totalprice FROM orders JOIN customer ON o_custkey = c_custkey",
    ("J11", "K6", "K8"),
)
def join_bucketed(spark: SparkSession, d: str) -> DataFrame:
    orders, cust = bucketed_pair(spark, d)
    return orders.join(cust, orders["o_custkey"] == cust["c_custkey"]).select("o_orderkey", "o_custkey", "c_name", "o_totalprice")


@register(
    "join_bucketed_hot",
    """
    SELECT l_orderkey, l_linenumber, l_suppkey, s_name, l_quantity FROM
      (SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber <= 2 THEN 1 ELSE l_suppkey END AS l_suppkey, l_quantity FROM lineitem)
    LEFT JOIN supplier ON l_suppkey = s_suppkey
    """,
    ("J11", "K6", "K8"),
)
def join_bucketed_hot(spark: SparkSession, d: str) -> DataFrame:
    """A bucketed join without an Exchange in which one supplier has more than a
    third of all lines (the first two of each order): it fills several buckets."""
    return hot_pair(spark, d).join("left").select("l_orderkey", "l_linenumber", "l_suppkey", "s_name", "l_quantity")


def hot_pair(spark: SparkSession, d: str, buckets: int | None = None) -> BucketedPair:
    li = read_table(spark, d, "lineitem", "l_orderkey", "l_linenumber", "l_suppkey", "l_quantity")
    li = li.withColumn("l_suppkey", F.when(F.col("l_linenumber") <= 2, F.lit(1)).otherwise(F.col("l_suppkey")).cast(li.schema["l_suppkey"].dataType))
    suppliers = read_table(spark, d, "supplier", "s_suppkey", "s_name").withColumnRenamed("s_suppkey", "l_suppkey")
    return save_bucketed_pair(li, suppliers, "l_suppkey", buckets, spread=["l_orderkey", "l_linenumber"])


@register(
    "join_bloom",
    """
    SELECT l_orderkey, l_linenumber, l_extendedprice, o_totalprice FROM orders JOIN lineitem ON o_orderkey = l_orderkey
    WHERE o_orderpriority = '1-URGENT' AND o_totalprice > 200000
    """,
    ("J12",),
)
def join_bloom(spark: SparkSession, d: str) -> DataFrame:
    """J12 with a dimension too large to broadcast: a Bloom filter of its filtered
    keys drops most line items in the scan, before the shuffle."""
    li = read_table(spark, d, "lineitem", "l_orderkey", "l_linenumber", "l_extendedprice")
    orders = read_table(spark, d, "orders", "o_orderkey", "o_orderpriority", "o_totalprice")
    wanted = orders.filter((F.col("o_orderpriority") == "1-URGENT") & (F.col("o_totalprice") > 200000)).drop("o_orderpriority")
    return bloom_join(li, wanted, "l_orderkey", "o_orderkey").select("l_orderkey", "l_linenumber", "l_extendedprice", "o_totalprice")


@register(
    "balanced_partition",
    """
    SELECT CAST(8 AS BIGINT) AS partitions, CAST(sum(n) AS BIGINT) AS rows, count(*) AS keys, true AS balanced
    FROM (SELECT CASE WHEN l_linenumber <= 2 THEN 0 ELSE l_suppkey END AS k, count(*) AS n FROM lineitem GROUP BY 1)
    """,
    ("R3", "U4"),
)
def balanced_partition_q(spark: SparkSession, d: str) -> DataFrame:
    """R3 by weight: one key holds more than a third of the rows; the largest of
    eight partitions has at most 1.2 times the mean."""
    li = read_table(spark, d, "lineitem", "l_orderkey", "l_linenumber", "l_suppkey")
    keyed = li.select(F.when(F.col("l_linenumber") <= 2, F.lit(0)).otherwise(F.col("l_suppkey")).alias("k"), "l_orderkey", "l_linenumber")
    placed = balanced_partition(keyed, "k", 8, ["l_orderkey", "l_linenumber"])
    cells = placed.groupBy(F.spark_partition_id().alias("partition"), "k").agg(F.count(F.lit(1)).alias("n"))
    keys = cells.agg(F.count_distinct("k").alias("keys")).scalar()
    sizes = cells.groupBy("partition").agg(F.sum("n").alias("n"))
    return sizes.agg(
        F.count(F.lit(1)).alias("partitions"), F.sum("n").cast("long").alias("rows"), (F.max("n") <= 1.2 * F.avg("n")).alias("balanced")
    ).withColumn("keys", keys)


@register(
    "custom_partition",
    """
    SELECT o_orderpriority,
           CASE o_orderpriority WHEN '1-URGENT' THEN 0 WHEN '2-HIGH' THEN 1 WHEN '3-MEDIUM' THEN 2
                                WHEN '4-NOT SPECIFIED' THEN 0 WHEN '5-LOW' THEN 1 ELSE 0 END AS partition_id,
           CASE o_orderpriority WHEN '1-URGENT' THEN 0 WHEN '2-HIGH' THEN 1 WHEN '3-MEDIUM' THEN 2
                                WHEN '4-NOT SPECIFIED' THEN 0 WHEN '5-LOW' THEN 1 ELSE 0 END AS physical_partition,
           count(*) AS rows
    FROM orders GROUP BY 1, 2, 3
    """,
    ("R3", "U4", "E16"),
)
def custom_partition(spark: SparkSession, d: str) -> DataFrame:
    """Each priority goes to the partition given by its index in the fixed
    list (mod 3), so there are three tasks whatever the size, that is the feature; the report shows the key -> partition mapping and that the
    rows really sit in that physical partition."""
    orders = read_table(spark, d, "orders", "o_orderpriority")
    placed = part_ops.custom_partition(orders, "o_orderpriority", PRIORITIES, 3)
    return placed.groupBy(
        "o_orderpriority", "partition_id", F.spark_partition_id().alias("physical_partition")
    ).agg(F.count(F.lit(1)).alias("rows"))


_PROFILE_SQL = """
SELECT count(*) AS rows, min(o_custkey) AS min_value, max(o_custkey) AS max_value,
       count(DISTINCT o_custkey) AS keys, CAST(1 AS BIGINT) AS most_partitions_per_key FROM orders
"""


def _profile(placed: DataFrame) -> DataFrame:
    """The per-partition report summed up, and how many partitions hold one key."""
    per_key = placed.select("o_custkey", F.spark_partition_id().alias("partition")).distinct().groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    keys = per_key.agg(F.struct(F.count(F.lit(1)).alias("keys"), F.max("n").alias("most_partitions_per_key"))).scalar()
    report = part_ops.partition_profile(placed, "o_custkey")
    total = report.agg(F.sum("rows").alias("rows"), F.min("min_value").alias("min_value"), F.max("max_value").alias("max_value"))
    return total.withColumn("k", keys).select("*", "k.*").drop("k")


@register("partition_profile", _PROFILE_SQL, ("R1", "R4"))
def partition_profile(spark: SparkSession, d: str) -> DataFrame:
    """Rows per partition after hashing orders on the customer key (skew
    report), summed up; each key is in one partition."""
    return _profile(part_ops.repartition_to(read_table(spark, d, "orders", "o_custkey"), parallelism(spark), "o_custkey"))


@register("coalesce_profile", _PROFILE_SQL, ("R2", "R4"))
def coalesce_profile(spark: SparkSession, d: str) -> DataFrame:
    """R2: the session's n hash partitions merged into n / 2 without a shuffle
    (narrow): no row is lost and no key is spread."""
    n = parallelism(spark)
    placed = part_ops.repartition_to(read_table(spark, d, "orders", "o_custkey"), n, "o_custkey")
    return _profile(part_ops.coalesce_to(placed, max(1, n // 2)))


@register(
    "hash_partition",
    """
    SELECT DISTINCT o_orderpriority, h AS hash, CAST(((h % 3) + 3) % 3 AS INTEGER) AS partition
    FROM orders JOIN (VALUES HASHES) v(p, h) ON p = o_orderpriority
    """.replace("HASHES", ", ".join(f"('{p}', {h})" for p, h in PRIORITY_HASHES)),
    ("E18",),
)
def hash_partition(spark: SparkSession, d: str) -> DataFrame:
    """murmur3 hash of each priority and its partition under
    pmod(hash, 3) (never negative, unlike hash % 3)."""
    orders = read_table(spark, d, "orders", "o_orderpriority")
    return orders.select("o_orderpriority").distinct().select(
        "o_orderpriority",
        F.hash("o_orderpriority").alias("hash"),
        part_ops.hash_partition_id("o_orderpriority", 3).alias("partition"),
    )


# the tasks of the write and the rows of a packed file
LAYOUT_TASKS, PACKED_ROWS = 6, 700


@register(
    "layout_file_counts",
    """
    WITH files AS (
      SELECT o_orderpriority, o_orderkey % 6 AS task, count(*) AS n FROM orders GROUP BY ALL),
    packed AS (
      SELECT o_orderpriority, n,
             coalesce(sum(n) OVER (PARTITION BY o_orderpriority ORDER BY task ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) // 700 AS bin
      FROM files)
    SELECT o_orderpriority, CAST(sum(n) AS BIGINT) AS rows, count(*) AS files, count(DISTINCT bin) AS packed_files,
           CAST(sum(n) AS BIGINT) AS packed_rows
    FROM packed GROUP BY o_orderpriority
    """,
    ("K5",),
)
def layout_file_counts(spark: SparkSession, d: str) -> DataFrame:
    """K5 report: the files of a partitioned write by a fixed number of tasks (one
    per task and value), and those left after small ones are packed."""
    orders = read_table(spark, d, "orders", "o_orderkey", "o_orderpriority")
    path = write_by_task(orders, F.col("o_orderkey") % LAYOUT_TASKS, LAYOUT_TASKS, ["o_orderpriority"])
    packed = compact(spark, path, ["o_orderpriority"], PACKED_ROWS, "file_rows")
    after = file_report(spark, packed, ["o_orderpriority"]).withColumnsRenamed({"files": "packed_files", "rows": "packed_rows"})
    return file_report(spark, path, ["o_orderpriority"]).join(after, "o_orderpriority")


@register(
    "layout_partitioned",
    "SELECT o_orderpriority, count(*) AS rows, true AS has_files FROM orders GROUP BY o_orderpriority",
    ("K5",),
)
def layout_partitioned(spark: SparkSession, d: str) -> DataFrame:
    """K5: a partitioned table whose files follow the size (rebalanced by value)."""
    orders = read_table(spark, d, "orders", "o_orderkey", "o_orderpriority")
    report = part_ops.file_profile(save_partitioned(spark, orders, ["o_orderpriority"]), "o_orderpriority")
    return report.select("o_orderpriority", "rows", (F.col("files") >= 1).alias("has_files"))


@register("ctas_plain", "SELECT o_orderkey, o_totalprice FROM orders", ("K3",))
def ctas_plain(spark: SparkSession, d: str) -> DataFrame:
    """K3: a table made by CREATE TABLE .. AS SELECT, without partitions."""
    view = unique_name("orders_src")
    read_table(spark, d, "orders", "o_orderkey", "o_totalprice").createOrReplaceTempView(view)
    return create_table_as(spark, unique_name("orders_copy"), f"SELECT * FROM {view}")


@register(
    "table_metadata",
    """
    SELECT column_name AS col_name,
           CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'VARCHAR' THEN 'string'
                          WHEN 'DOUBLE' THEN 'double' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' ELSE data_type END AS data_type,
           (SELECT count(*) FROM orders) AS rows
    FROM information_schema.columns WHERE table_name = 'orders'
    """,
    ("K10", "K11", "K12"),
)
def table_metadata(spark: SparkSession, d: str) -> DataFrame:
    """A database and a managed table in it, described from the catalog: columns,
    types and the rows the table holds."""
    create_database(spark, "tidewater_tables")
    name = f"tidewater_tables.{unique_name('orders')}"
    drop_table(spark, name)
    rows = save_table(spark, read_table(spark, d, "orders"), name).agg(F.count(F.lit(1)).alias("n")).scalar()
    described = describe_extended(spark, name)
    # the columns come first, then a blank line and the details
    columns = described.join(schema_profile(spark, spark.table(name)), F.col("col_name") == F.col("column"))
    return columns.filter(F.col("data_type") == F.col("type")).select("col_name", "data_type").withColumn("rows", rows)


@register(
    "partitioned_and_bucketed",
    "SELECT o_orderkey, o_custkey, o_orderpriority FROM orders",
    ("K7",),
)
def partitioned_and_bucketed(spark: SparkSession, d: str) -> DataFrame:
    """K7: one folder per priority, in each of them buckets by customer."""
    orders = read_table(spark, d, "orders", "o_orderkey", "o_custkey", "o_orderpriority")
    return save_bucketed(spark, orders, parallelism(spark), ["o_custkey"], ["o_custkey"], ["o_orderpriority"])


@register(
    "co_partitioned_join",
    """
    SELECT o_orderkey, o_custkey, count(*) AS lines
    FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_orderkey, o_custkey
    """,
    ("R5", "R1"),
)
def co_partitioned_join(spark: SparkSession, d: str) -> DataFrame:
    """Lines are counted per order key first (combined in the map tasks, so a
    hot order is a few rows), and that exchange by order key serves the join."""
    orders = read_table(spark, d, "orders", "o_orderkey", "o_custkey")
    li = read_table(spark, d, "lineitem", "l_orderkey").withColumnRenamed("l_orderkey", "o_orderkey")
    lines = agg.count_by(li, ["o_orderkey"], "lines")
    return part_ops.co_partitioned_join(orders, lines, "o_orderkey").select("o_orderkey", "o_custkey", "lines")


CUTOVER = "1998-01-01 00:00:00"


def evolved_orders(spark: SparkSession, d: str) -> EvolvingTable:
    """Orders before the cutover in files clustered by priority and date, those
    after it (and those without a date) in a folder per priority."""
    orders = read_table(spark, d, "orders", "o_orderkey", "o_orderdate", "o_orderpriority")
    cutoff = F.lit(CUTOVER).cast("timestamp_ntz")
    cluster = ["o_orderpriority", "o_orderdate"]
    table = EvolvingTable.create(orders.filter(F.col("o_orderdate") < cutoff), cluster, cluster_by=cluster, name="orders-evolving")
    table.evolve(["o_orderpriority"])
    table.append(orders.filter(F.coalesce(F.col("o_orderdate") >= cutoff, F.lit(True))))
    return table


@register(
    "evolve_partition",
    "SELECT o_orderkey, o_orderdate, o_orderpriority FROM orders WHERE o_orderpriority = '1-URGENT'",
    ("K13", "K10"),
)
def evolve_partition_q(spark: SparkSession, d: str) -> DataFrame:
    """A filter on the new partition column reads only matching files of both layouts."""
    return evolved_orders(spark, d).scan(o_orderpriority=("1-URGENT", "1-URGENT"))


@register(
    "evolve_partition_files",
    """
    SELECT CAST(CASE WHEN o_orderdate < TIMESTAMP '1998-01-01 00:00:00' THEN 0 ELSE 1 END AS BIGINT) AS spec,
           count(*) AS rows, CAST(count(*) FILTER (WHERE o_orderpriority = '1-URGENT') AS BIGINT) AS matching_rows,
           CAST(0 AS BIGINT) AS files_read_in_vain, true AS files_skipped
    FROM orders GROUP BY 1
    """,
    ("K13",),
)
def evolve_partition_files(spark: SparkSession, d: str) -> DataFrame:
    """Per layout: rows in all files, matching rows, files that are read without
    holding a match (none, as the values of a file are neighbours) and whether
    files without a match are skipped."""
    table = evolved_orders(spark, d)
    urgent = {"o_orderpriority": ("1-URGENT", "1-URGENT")}
    read = table.matching_files(**urgent).select("file", F.lit(1).alias("read"))
    held = table.scan(**urgent).groupBy(file_path().alias("file")).agg(F.count(F.lit(1)).alias("matches"))
    files = table.index().join(read, "file", "left").join(held, "file", "left")
    return files.groupBy("spec").agg(
        F.sum("rows").cast("long").alias("rows"),
        F.coalesce(F.sum("matches"), F.lit(0)).cast("long").alias("matching_rows"),
        F.count_if(F.col("read").isNotNull() & F.col("matches").isNull()).alias("files_read_in_vain"),
        (F.count_if(F.col("read").isNull()) > 0).alias("files_skipped"),
    )
