"""J12 with a Bloom filter, J11 with a hot key, R3 by weight: results, plans, spread of work."""

from __future__ import annotations

import contextlib
import io

import pytest
from pyspark.sql import functions as F

from tidewater.operators.balance import balanced_partition, pack
from tidewater.operators.bloom import bloom_filter, bloom_join, might_contain
from tidewater.plans import layout
from tidewater.sinks.hot_buckets import save_bucketed_pair
from tidewater.sources.tables import read_table

from conftest import SF_SMALL


def physical(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@contextlib.contextmanager
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        yield
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("bits", [64, 1 << 10, 1 << 16])
def test_bloom_join_is_exact_whatever_the_filter_lets_through(spark, bits):
    fact = spark.range(5000).select((F.col("id") % 1000).alias("k"), "id").union(spark.createDataFrame([(None, -1)], "k long, id long"))
    dim = spark.range(0, 1200, 7).toDF("d").union(spark.createDataFrame([(None,)], "d long"))
    want = fact.join(dim, F.col("k") == F.col("d"))
    with no_broadcast(spark):
        got = bloom_join(fact, dim, "k", "d", bits)
        assert sorted(got.collect()) == sorted(want.collect())
        passed = fact.filter(might_contain(bloom_filter(dim, "d", bits), F.col("k"), bits)).count()
    # 172 keys: 64 bits are full and let all through, 65,536 bits next to none
    assert passed == 5000 if bits == 64 else want.count() <= passed < (4000 if bits == 1 << 10 else want.count() + 50)


def test_bloom_filter_runs_before_the_shuffle_of_the_fact_table(spark):
    with no_broadcast(spark):
        df = layout.join_bloom(spark, SF_SMALL)
        plan = physical(df)
    tree = plan.split("== Physical Plan ==")[1].split("\n\n")[0]
    fact = tree.split("SortMergeJoin")[1]
    assert "Subquery" in plan and "Generate" not in fact.split("Scan parquet")[0]
    # bottom up: scan, filter with the subquery, exchange
    assert fact.index("Exchange") < fact.index("Filter") < fact.index("Scan parquet")
    li = read_table(spark, SF_SMALL, "lineitem", "l_orderkey")
    dim = read_table(spark, SF_SMALL, "orders").filter("o_orderpriority = '1-URGENT' and o_totalprice > 200000")
    passed = li.filter(might_contain(bloom_filter(dim, "o_orderkey"), F.col("l_orderkey"))).count()
    assert df.count() <= passed < li.count() / 3


def test_bloom_rejects_unequal_types_and_odd_sizes(spark):
    a, b = spark.range(3).toDF("a"), spark.range(3).select(F.col("id").cast("int").alias("b"))
    with pytest.raises(ValueError):
        bloom_join(a, b, "a", "b")
    with pytest.raises(ValueError):
        bloom_filter(a, "a", 100)
    assert bloom_join(a, a.toDF("b").limit(0), "a", "b").count() == 0


def test_hot_bucket_join_has_no_exchange_and_several_tasks(spark):
    pair = layout.hot_pair(spark, SF_SMALL, 16)
    for how in ("inner", "left", "left_semi", "left_anti"):
        assert "Exchange" not in physical(pair.join(how)).split("== Physical Plan ==")[1]
    joined = pair.join("left")
    tasks = joined.filter("l_suppkey = 1").select(F.spark_partition_id().alias("p")).distinct().count()
    assert tasks >= 3  # of some five salts
    li = read_table(spark, SF_SMALL, "lineitem")
    assert joined.count() == li.count() and pair.join("left_anti").count() == 0
    with pytest.raises(ValueError):
        pair.join("full")


def test_hot_bucket_pair_with_null_and_missing_keys(spark):
    many = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 5).when(F.col("id") % 50 == 1, None).otherwise(F.col("id") % 100).alias("k"), "id")
    one = spark.range(0, 90).select(F.col("id").alias("k"), F.concat(F.lit("n"), "id").alias("name")).unionByName(spark.createDataFrame([(5, "again")], "k long, name string"))
    pair = save_bucketed_pair(many, one, "k", 8)
    for how in ("inner", "left"):
        want = many.join(one, "k", how).select("k", "id", "name").collect()
        assert sorted(pair.join(how).select("k", "id", "name").collect(), key=str) == sorted(want, key=str)
    salts = pair.many.groupBy("k").agg(F.count_distinct("salt").alias("n")).filter("n > 1").collect()
    assert [(r.k, r.n) for r in salts] == [(5, 3)]


@pytest.mark.parametrize("partitions", [4, 16])
def test_balanced_partitions_with_a_third_on_one_key(spark, partitions):
    rows = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.concat(F.lit("mid"), F.col("id") % 5)).when(F.col("id") % 1000 != 2, F.col("id").cast("string")).alias("k"), "id"
    )
    placed = balanced_partition(rows, "k", partitions)
    found = placed.select("*", F.spark_partition_id().alias("p")).groupBy("p", "partition_id").count().collect()
    assert sum(r["count"] for r in found) == 60_000 and all(r.p == r.partition_id for r in found) and len(found) == partitions
    assert max(r["count"] for r in found) <= 1.2 * 60_000 / partitions
    # a key without many rows is in one partition
    spread = placed.groupBy("k").agg(F.count_distinct("partition_id").alias("n"), F.count(F.lit(1)).alias("rows")).filter("n > 1").collect()
    assert {r.k for r in spread} <= {"hot", *(f"mid{i}" for i in range(5))} and "hot" in {r.k for r in spread}


def test_balanced_partition_of_nothing_and_packing(spark):
    assert balanced_partition(spark.range(0).toDF("k"), "k", 3).count() == 0
    assert pack([("a", 5), ("b", 3), ("c", 3), ("d", 1)], 2) == {"a": 0, "b": 1, "c": 1, "d": 0}


def test_balanced_partition_shuffles_rows_once(spark):
    rows = spark.range(3000).select(F.when(F.col("id") % 3 > 0, F.col("id") % 50).alias("k"), "id")
    with no_broadcast(spark):  # whatever Spark thinks of the plan's size
        placed = balanced_partition(rows, "k", 4)
        plan = physical(placed).partition("(1)")[0]
        assert "SortMergeJoin" not in plan and plan.count(" Exchange") == 1
        assert {r.k: r["count"] for r in placed.groupBy("k").count().collect()} == {r.k: r["count"] for r in rows.groupBy("k").count().collect()}
