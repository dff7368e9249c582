"""Files of old and new layouts are skipped by their statistics. K5: file counts and packing."""

from __future__ import annotations

import os
from urllib.parse import unquote

import pytest
from pyspark.sql import functions as F

from tidewater import sinks
from tidewater.plans.layout import CUTOVER, evolved_orders
from tidewater.sinks.compaction import BIN, bins, file_list
from tidewater.sinks.manifest import CommitConflict, commit_text
from tidewater.sources.tables import read_table

from conftest import SF_SMALL


def files_read(df):
    """Paths as the index has them."""
    return {"file:" + unquote(f).removeprefix("file:").replace("///", "/") for f in df.inputFiles()}


def test_a_filter_on_the_new_column_reads_matching_files_of_both_halves(spark):
    table = evolved_orders(spark, SF_SMALL)
    orders = read_table(spark, SF_SMALL, "orders", "o_orderkey", "o_orderdate", "o_orderpriority")
    assert table.specs == [[], ["o_orderpriority"]] and table.scan().count() == orders.count()
    urgent = table.scan(o_orderpriority=("1-URGENT", "1-URGENT"))
    assert sorted(urgent.collect()) == sorted(orders.filter("o_orderpriority = '1-URGENT'").collect())
    index = {r.file.replace('///', '/'): r for r in table.index().collect()}
    read = files_read(urgent)
    for spec in (0, 1):
        of = {f for f, r in index.items() if r.spec == spec}
        holding = {f for f in of if index[f].least_o_orderpriority == "1-URGENT"}
        assert read & of == holding and holding < of
    # two ranges: dates after the cutover lie in new files only
    late = table.scan(o_orderpriority=("1-URGENT", "2-HIGH"), o_orderdate=(CUTOVER, None))
    assert all(index[f].spec == 1 for f in files_read(late))
    assert late.count() == orders.filter(f"o_orderpriority <= '2-HIGH' and o_orderdate >= '{CUTOVER}'").count()


def test_evolving_moves_no_data_and_old_versions_stay(spark):
    rows = spark.range(100).selectExpr("id AS k", "CAST(id % 5 AS int) AS g", "IF(id % 10 = 0, NULL, CAST(id AS double)) AS x")
    table = sinks.EvolvingTable.create(rows, ["k", "x"], cluster_by=["k"])
    before = files_read(table.scan())
    table.evolve(["g"])
    assert files_read(table.scan()) == before
    table.append(rows.withColumn("k", F.col("k") + 100))
    again = sinks.EvolvingTable.open(spark, table.path)
    assert again.scan().count() == 200 and again.scan(0).count() == 100 and before < files_read(again.scan())
    assert again.scan(k=(95, 104)).count() == 10 and again.scan(k=(500, None)).count() == 0
    assert again.scan(x=(None, None)).count() == 180  # a null lies in no range
    assert sum(r.nulls_x for r in again.index().collect()) == 20
    with pytest.raises(ValueError):
        again.scan(g=(1, 1))
    with pytest.raises(CommitConflict):  # a second writer of the same version
        commit_text(spark, f"{table.path}/versions/{2:012d}", "{}")


def test_append_killed_before_the_commit_is_invisible(spark, monkeypatch):
    table = sinks.EvolvingTable.create(spark.range(10).toDF("k"), ["k"])

    def dies(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr("tidewater.sinks.evolving.commit_text", dies)
        with pytest.raises(KeyboardInterrupt):
            table.append(spark.range(5).toDF("k"))
    assert table.scan().count() == 10
    table.append(spark.range(5).toDF("k"))
    assert table.scan().count() == 15


def test_file_counts_before_and_after_packing(spark):
    rows = spark.range(1200).select("id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 40).alias("g"))
    path = sinks.write_by_task(rows, F.col("id") % 6, 6, ["g"])
    model = {r.g: r.n for r in rows.groupBy("g").agg(F.count_distinct(F.col("id") % 6).alias("n")).collect()}
    got = {r.g: (r.files, r.rows) for r in sinks.file_report(spark, path, ["g"]).collect()}
    assert {g: f for g, (f, _) in got.items()} == model and got[0][1] == 420
    packed = sinks.compact(spark, path, ["g"], 100, "file_rows")
    plan = bins(file_list(spark, path, ["g"]), ["g"], 100, "file_rows").groupBy("g").agg(F.count_distinct(BIN).alias("n")).collect()
    after = {r.g: (r.files, r.rows) for r in sinks.file_report(spark, packed, ["g"]).collect()}
    assert {g: f for g, (f, _) in after.items()} == {r.g: r.n for r in plan}
    assert {g: n for g, (_, n) in after.items()} == {g: n for g, (_, n) in got.items()}
    assert after[0][0] > 1 and sum(f for f, _ in after.values()) < sum(f for f, _ in got.values())
    names = [f for d, _, fs in os.walk(packed.removeprefix("file:")) for f in fs if f.endswith(".parquet")]
    assert len(names) == sum(f for f, _ in after.values())
    by_bytes = sinks.file_report(spark, sinks.compact(spark, path, ["g"], 1 << 20), ["g"])
    assert {r.files for r in by_bytes.collect()} == {1}
