"""Readers (S1-S13) and writers / table layout."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from tidewater.functions.temporal import DAY_FIRST_DATE_FORMAT, parse_time
from tidewater.operators import filters as flt
from tidewater.session import shared_path, shared_root, unique_name
from tidewater.sinks import tables as sinks
from tidewater.sources import files
from tidewater.sources.tables import number_range, read_catalog_table, read_table, register_views

from conftest import SF_SMALL


def _write(path: str, text: str) -> str:
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", newline="") as f:
        f.write(text)
    return path


def test_text_lines_and_glob(spark, tmp_dir):
    _write(f"{tmp_dir}/views-1.csv", "14,96\r\n14,97\r\n")
    _write(f"{tmp_dir}/views-2.csv", "13,96\r\n")
    lines = files.read_lines(spark, f"{tmp_dir}/views-*.csv")
    assert lines.count() == 3
    typed = files.read_delimited(spark, f"{tmp_dir}/views-*.csv", "user_id int, chapter_id int")
    assert sorted(tuple(r) for r in typed.collect()) == [(13, 96), (14, 96), (14, 97)]


def test_csv_quotes_and_blanks(spark, tmp_dir):
    # a quoted title with a comma stays whole; blank fields become null
    _write(f"{tmp_dir}/titles.csv", '8,IOS programming\r\n9,"Kubernetes, Docker"\r\n10,\r\n')
    df = files.read_delimited(spark, f"{tmp_dir}/titles.csv", "course_id int, title string")
    got = {r.course_id: r.title for r in df.collect()}
    assert got == {8: "IOS programming", 9: "Kubernetes, Docker", 10: None}


def test_csv_header_declared_and_inferred(spark, tmp_dir):
    _write(f"{tmp_dir}/t.csv", "PassengerId,Survived,Pclass,Sex,Age\n1,0,3,male,22\n2,1,1,female,38\n3,1,1,male,35\n")
    declared = files.read_delimited(
        spark, f"{tmp_dir}/t.csv", "PassengerId int, Survived int, Pclass int, Sex string, Age double", header=True
    )
    inferred = files.infer_csv(spark, f"{tmp_dir}/t.csv")
    assert declared.count() == inferred.count() == 3
    males = flt.where_equal(declared, Pclass=1, Sex="male").filter(F.col("Age") >= 20)
    assert [r.PassengerId for r in males.collect()] == [3]


def test_json_declared_inferred_and_trailing_comma(spark, tmp_dir):
    _write(
        f"{tmp_dir}/promotions.json",
        '{"promotion_id":1,"name":"a","discount_rate":0.3,"start_date":"2023-05-01 00:00:00"},\n'
        '{"promotion_id":2,"name":"b","discount_rate":0.15,"start_date":"2023-03-01 00:00:00"},\n',
    )
    declared = files.read_json_lines(
        spark, f"{tmp_dir}/promotions.json", "promotion_id int, name string, discount_rate float, start_date string"
    )
    assert sorted(r.promotion_id for r in declared.collect()) == [1, 2]
    inferred = files.infer_json(spark, f"{tmp_dir}/promotions.json")
    assert inferred.columns == sorted(inferred.columns)
    _write(f"{tmp_dir}/items.json", '{"item_id":1,"tags":["a","b"],"attrs":{"color":"red"},"ts":1681084800}\n')
    items = files.read_json_lines(spark, f"{tmp_dir}/items.json", "item_id int, tags array<string>, attrs map<string,string>, ts timestamp")
    r = items.first()
    assert r.tags == ["a", "b"] and r.attrs == {"color": "red"}
    assert items.select(F.date_format("ts", "yyyy-MM-dd HH:mm").alias("t")).first().t == "2023-04-10 00:00"


def test_in_memory_rows(spark):
    df = files.rows_to_frame(spark, [("1", "korea", "2")], ["user_id", "visit_country", "visit_count"])
    assert df.columns == ["user_id", "visit_country", "visit_count"]


def test_day_first_date_parse_is_tolerant(spark):
    df = spark.createDataFrame([("26/02/2018",), ("13/13/2018",), ("01/07/2019",)], "CallDate string")
    years = [r.y for r in df.select(F.year(parse_time("CallDate", DAY_FIRST_DATE_FORMAT)).alias("y")).collect()]
    assert years == [2018, None, 2019]
    assert flt.where_year(df, "CallDate", 2018, DAY_FIRST_DATE_FORMAT).count() == 1


def test_range_source_and_views(spark):
    assert number_range(spark, 10).agg(F.sum(F.col("id") * F.col("id"))).first()[0] == 285
    register_views(spark, SF_SMALL, ["nation"])
    assert read_catalog_table(spark, "nation").count() == 25
    assert spark.sql("SELECT count(*) FROM nation").first()[0] == 25


def test_shared_root_is_used(spark):
    root = shared_root(spark)
    assert shared_path(spark, "tables", "x").startswith(root)


def test_ctas_partition_and_bucket_writes(spark):
    view = unique_name("src")
    read_table(spark, SF_SMALL, "customer").createOrReplaceTempView(view)
    plain = sinks.create_table_as(spark, unique_name("ctas"), f"SELECT * FROM {view}")
    assert plain.count() == read_table(spark, SF_SMALL, "customer").count()
    name = unique_name("bucketed_by_segment")
    both = sinks.save_bucketed(
        spark, read_table(spark, SF_SMALL, "customer"), 4, ["c_custkey"], partition_cols=["c_mktsegment"], name=name
    )
    files_per_segment = both.select("c_mktsegment", F.input_file_name().alias("f")).distinct().groupBy("c_mktsegment").count()
    assert all(r["count"] <= 4 for r in files_per_segment.collect())
    desc = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {name}").collect()}
    assert desc.get("Num Buckets") == "4"


def test_database_ddl_schema_profile_and_table(spark):
    sinks.create_database(spark, "tw_catalog")
    name = "tw_catalog." + unique_name("central")
    t = sinks.save_table(spark, read_table(spark, SF_SMALL, "region"), name)
    assert t.count() == 5
    prof = {r.column: (r.type, r.nullable) for r in sinks.schema_profile(spark, t).collect()}
    assert prof["r_regionkey"][0] == "int" and prof["r_name"][0] == "string"
    described = {r.col_name: r.data_type for r in sinks.describe_extended(spark, name).collect()}
    assert described["r_name"] == "string" and described["Provider"] == "parquet" and "Location" in described
    sinks.drop_table(spark, name)
    assert not spark.catalog.tableExists(name)
