"""Physical plans: the layout and hints are actually used (J9-J12, F6, R5, T2,
push-down and pruning)."""

from __future__ import annotations

import contextlib
import io

from tidewater.operators import aggregates as agg
from tidewater.operators import partitioning as part_ops
from tidewater.plans import registry
from tidewater.sources.tables import read_table

from conftest import SF_SMALL


def plan_of(df, mode: str = "formatted") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


Q = registry.queries()


def test_broadcast_hint_used(spark):
    assert "BroadcastHashJoin" in plan_of(Q["join_broadcast"](spark, SF_SMALL))


def test_sort_merge_hint_used(spark):
    assert "SortMergeJoin" in plan_of(Q["join_sort_merge"](spark, SF_SMALL))


def test_bucketed_tables_join_without_shuffle_when_not_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(Q["join_bucketed"](spark, SF_SMALL))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    physical = plan.split("== Physical Plan ==")[-1]
    assert "SortMergeJoin" in physical
    assert "Exchange" not in physical


def test_static_partition_pruning(spark):
    plan = plan_of(Q["partition_range_filter"](spark, SF_SMALL))
    assert "PartitionFilters" in plan and "c_nationkey" in plan.split("PartitionFilters")[1].split("\n")[0]


def test_dynamic_partition_pruning(spark):
    assert "dynamicpruning" in plan_of(Q["join_dpp"](spark, SF_SMALL)).lower()


def test_filter_pushed_to_parquet(spark):
    plan = plan_of(Q["filter_equality"](spark, SF_SMALL))
    assert "PushedFilters: [IsNotNull(c_mktsegment), EqualTo(c_mktsegment,BUILDING)]" in plan


def test_year_filter_pushed_as_range(spark):
    plan = plan_of(Q["filter_year"](spark, SF_SMALL))
    assert "GreaterThanOrEqual(o_orderdate" in plan and "LessThan(o_orderdate" in plan


def test_word_count_reads_only_text_and_combines_map_side(spark):
    plan = plan_of(Q["word_count"](spark, SF_SMALL))
    assert "ReadSchema: struct<text:string>" in plan
    assert "partial_count" in plan


def test_co_partitioned_join_shuffles_once_per_side(spark):
    plan = plan_of(Q["co_partitioned_join"](spark, SF_SMALL), "simple")
    assert plan.count("Exchange hashpartitioning") == 2


def test_top_k_is_take_ordered(spark):
    assert "TakeOrderedAndProject" in plan_of(Q["slowest_top5"](spark, SF_SMALL))


def test_keep_latest_limits_each_key_before_the_shuffle(spark):
    li = read_table(spark, SF_SMALL, "lineitem", "l_partkey", "l_shipdate", "l_orderkey", "l_linenumber")
    plan = plan_of(agg.keep_latest(li, ["l_partkey"], ["l_shipdate", "l_orderkey", "l_linenumber"]))
    tree = plan.split("\n\n")[0]
    assert tree.count("WindowGroupLimit") == 2 and tree.rindex("WindowGroupLimit") > tree.index("Exchange")


def test_no_python_udf_in_builtin_plans(spark):
    for name in ("word_count", "course_scores", "central_catalog", "minute_set", "tolerant_cast"):
        plan = plan_of(Q[name](spark, SF_SMALL))
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan, name


def test_udf_query_is_arrow_batched(spark):
    assert "ArrowEvalPython" in plan_of(Q["udf_prefix_cube"](spark, SF_SMALL))


def test_custom_partition_places_rows_by_id(spark):
    rows = Q["custom_partition"](spark, SF_SMALL).collect()
    assert all(r.partition_id == r.physical_partition for r in rows)


def test_hash_partition_non_negative(spark):
    rows = Q["hash_partition"](spark, SF_SMALL).collect()
    assert rows and all(0 <= r.partition < 3 for r in rows)


def test_layout_one_file_per_value_when_small(spark):
    rows = Q["layout_partitioned"](spark, SF_SMALL).collect()
    assert len(rows) == 5 and all(r.has_files for r in rows)
    assert sum(r.rows for r in rows) == read_table(spark, SF_SMALL, "orders").count()


def test_partition_profile_counts_all_rows(spark):
    (row,) = Q["partition_profile"](spark, SF_SMALL).collect()
    assert row.rows == read_table(spark, SF_SMALL, "orders").count() and row.most_partitions_per_key == 1


def test_coalesce_is_narrow_and_keeps_rows(spark):
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    half = n // 2
    orders = read_table(spark, SF_SMALL, "orders", "o_custkey")
    df = part_ops.partition_profile(part_ops.coalesce_to(part_ops.repartition_to(orders, n, "o_custkey"), half), "o_custkey")
    rows = df.collect()
    assert len(rows) == half
    assert sum(r.rows for r in rows) == read_table(spark, SF_SMALL, "orders").count()
    plan = plan_of(df, "simple")
    assert f"Coalesce {half}" in plan


def test_threshold_reaches_the_scan(spark):
    plan = plan_of(Q["filter_threshold"](spark, SF_SMALL))
    assert "GreaterThanOrEqual(l_quantity,46" in plan


def test_course_scores_shuffles_line_items_once_before_the_users(spark):
    plan = plan_of(Q["course_scores"](spark, SF_SMALL), "simple")
    assert "hashpartitioning(l_orderkey" not in plan or plan.count("hashpartitioning(l_orderkey") == 1
