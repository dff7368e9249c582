"""Hot keys: one key holds a third of all rows. The work for it must be split
over several tasks (salting, AQE skew join, rebalanced writes) or combined
map-side before the shuffle — never land whole in one task."""

from __future__ import annotations

import contextlib
import io
import json

import pytest
from pyspark.sql import functions as F

from tidewater.operators import aggregates as agg
from tidewater.operators import joins
from tidewater.sinks.tables import save_partitioned

N = 60_000


@pytest.fixture()
def skewed(spark):
    # key 0 holds a third of the rows; the rest spread over 2,000 keys
    return spark.range(N).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 2000 + 1).alias("k"),
        F.col("id").alias("v"),
    )


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@contextlib.contextmanager
def conf(spark, **settings):
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_salted_join_spreads_hot_key(spark, skewed):
    dim = spark.range(0, 2001).select(F.col("id").alias("k"), F.concat(F.lit("n"), F.col("id")).alias("name"))
    with conf(spark, **{"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}):
        out = joins.salted_join(skewed, dim, ["k"], 8)
        hot_tasks = out.filter("k = 0").select(F.spark_partition_id().alias("p")).distinct().count()
        assert out.count() == N
    assert hot_tasks > 1


def test_aqe_splits_skewed_sort_merge_join(spark, skewed):
    other = spark.range(0, 2001).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    with conf(spark, **settings):
        joined = skewed.join(other, "k")
        assert len(joined.collect()) == N  # runs this DataFrame's own plan
        plan = _plan(joined)  # AQE's final plan after the run
    assert "isFinalPlan=true" in plan and "skew=true" in plan


def test_hot_key_is_combined_map_side(spark, skewed):
    counts = agg.count_by(skewed, ["k"])
    plan = _plan(counts)
    assert "partial_count" in plan
    assert counts.filter("k = 0").first()["count"] == N // 3
    latest = agg.keep_latest(skewed.withColumn("p", F.col("v") * 2), ["k"], ["v"])
    tree = _plan(latest).split("\n\n")[0]
    assert tree.rindex("WindowGroupLimit") > tree.index("Exchange")  # one row of a key per map task
    assert latest.filter("k = 0").first().v == N - 3


def test_rebalanced_partitioned_write_splits_hot_value(spark, skewed):
    with conf(spark, **{"spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
                        "spark.sql.adaptive.coalescePartitions.enabled": "true"}):
        table = save_partitioned(spark, skewed.withColumn("bucket", F.when(F.col("k") == 0, 0).otherwise(1)), ["bucket"])
    files = table.select("bucket", F.input_file_name().alias("f")).distinct().groupBy("bucket").count()
    hot_files = files.filter("bucket = 0").first()["count"]
    assert hot_files > 1
    assert table.count() == N


def test_join_counts_never_materialise_pairs(spark, skewed):
    counts = joins.join_row_counts({"a": skewed.select(F.col("k").alias("id")), "b": skewed.select(F.col("k").alias("id"))},
                                   [("a", "b", "inner")], "id")
    hot = (N // 3) ** 2
    assert counts.first().rows > hot  # 400M pairs for the hot key alone, counted not built
    assert "CartesianProduct" not in _plan(counts)


def test_json_nested_splits_a_hot_conversation_and_counts_repeats(spark, tmp_path):
    from tidewater.plans import formats

    rows = [(1, i, ("user", "assistant")[i % 2]) for i in range(1000)] + [(1, 5, "assistant")] * 300 + [(1, 5, "user"), (2, None, None), (3, 0, "system"), (None, 0, "user")]
    spark.createDataFrame(rows, "conv_id long, turn int, role string").write.parquet(f"{tmp_path}/conversations.parquet")
    got = formats.json_nested(spark, str(tmp_path))
    assert {(r.conv_id, r.turns, r.answers, r.has_system) for r in got.collect()} == {(1, 1301, 800, False), (2, 1, 0, None), (3, 1, 0, True), (None, 1, 0, False)}
    nested = [json.loads(r.value) for r in spark.read.text(list(got.inputFiles())).collect()]
    assert len(nested) > 20 and max(len(x["roles"]) for x in nested) <= formats.TURNS_NESTED


def test_rows_without_a_list_are_dealt_out(spark):
    none, empty, some = F.lit(None).cast("array<int>"), F.array().cast("array<int>"), F.array((F.col("id") % 20).cast("int"), F.lit(99))
    rows = spark.range(8000).select("id", F.when(F.col("id") % 5 == 0, some).when(F.col("id") % 2 == 0, none).otherwise(empty).alias("ids"), F.create_map(F.lit("a"), "id").alias("m"))
    names = spark.range(15).select(F.col("id").cast("int").alias("id"), F.concat(F.lit("n"), F.col("id")).alias("name"))
    off = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16"}
    with conf(spark, **off):
        mapped = joins.ids_to_map(rows, "ids", names, "id", "name", "names").cache()
        sizes = [r["count"] for r in mapped.groupBy(F.spark_partition_id()).count().collect()]
    got = {r.id: r.names for r in mapped.collect()}
    mapped.unpersist()
    assert max(sizes) < 8000 / 6 and mapped.columns == ["id", "m", "names"]
    assert got == {i: {i % 20: f"n{i % 20}"} if i % 5 == 0 and i % 20 < 15 else {} for i in range(8000)}
