"""Column expressions (E1-E23) and small projections (P*), one behaviour each."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidewater.functions import numeric, scoring, strings, structs, temporal
from tidewater.operators import projections
from tidewater.plans.access_log import parse_log_lines


def test_split_keeps_empty_pieces_and_escapes_regex(spark):
    df = spark.createDataFrame([("a  b",), ("x | y|z",)], "s string")
    rows = df.select(strings.split_on("s", " ").alias("sp"), strings.split_on("s", " | ").alias("bar")).collect()
    assert rows[0].sp == ["a", "", "b"]
    assert rows[1].bar == ["x", "y|z"]


def test_string_helpers(spark):
    df = spark.createDataFrame([('  "POST /playbooks HTTP/1.1"  ',), (None,)], "s string")
    r = df.select(
        strings.strip_chars(F.trim("s"), '"').alias("q"),
        strings.first_token(strings.strip_chars(F.trim("s"), '"')).alias("m"),
    ).collect()
    assert r[0].q == "POST /playbooks HTTP/1.1" and r[0].m == "POST"
    assert r[1].q is None and r[1].m is None


def test_access_log_line_parse(spark):
    lines = spark.createDataFrame(
        [('130.31.184.234 | [26/Feb/2023:04:15:21] | "PATCH /users HTTP/1.1" | 400',)], "value string"
    )
    r = parse_log_lines(lines).first()
    assert (r.ip, r.method, r.endpoint, r.status) == ("130.31.184.234", "PATCH", "/users", "400")
    assert r.time == dt.datetime(2023, 2, 26, 4, 15, 21)


def test_time_parts(spark):
    df = spark.createDataFrame([("2023-02-26 04:15:21",), ("not a time",)], "t string")
    r = df.select(temporal.parse_time("t").alias("ts")).select(
        "ts", *temporal.hour_minute("ts"), temporal.month_of("ts").alias("m"), temporal.year_of("ts").alias("y")
    ).collect()
    assert (r[0].hour, r[0].minute, r[0].m, r[0].y) == (4, 15, 2, 2023)
    assert r[1].ts is None
    dotted = spark.createDataFrame([("2023.2.6",)], "d string").select(
        temporal.parse_time("d", temporal.DOTTED_DATE_FORMAT).alias("ts")
    ).first()
    assert dotted.ts == dt.datetime(2023, 2, 6)


def test_band_score(spark):
    df = spark.createDataFrame([(0.95,), (0.9,), (0.6,), (0.5,), (0.3,), (0.25,), (0.1,)], "r double")
    api = [r.p for r in df.select(scoring.band_score("r").alias("p")).collect()]
    assert api == [10, 10, 4, 4, 2, 2, 0]


def test_exact_mean_is_order_free(spark):
    vals = [0.1, 0.2, 0.3, 1e6 + 0.07, 6.55, 39.69875]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    one = df.coalesce(1).agg(numeric.exact_mean("v", 5).alias("m")).first().m
    many = df.repartition(4).agg(numeric.exact_mean("v", 5).alias("m")).first().m
    assert one == many
    assert abs(one - sum(vals) / len(vals)) < 1e-9


def test_exact_mean_refuses_more_decimals_and_keeps_nulls(spark):
    df = spark.createDataFrame([(3.335,), (3.004,), (None,)], "v double")
    with pytest.raises(Exception, match="more than 2 decimals"):
        df.agg(numeric.exact_mean("v", 2).alias("m")).collect()
    assert df.agg(numeric.exact_mean("v", 3).alias("m")).first().m == 3.1695
    assert df.groupBy().agg(F.avg("v").alias("m")).first().m == pytest.approx(3.1695)


def test_json_struct_and_map_text(spark):
    df = spark.createDataFrame([(1, '{"k": 69, "x": "a"}'), (2, "broken")], "id int, props string")
    parsed = df.select("id", structs.parse_json("props", "k INT, x STRING").alias("p"))
    flat = projections.expand(parsed, "p", keep=("id",)).orderBy("id").collect()
    assert (flat[0].k, flat[0].x) == (69, "a") and flat[1].k is None
    m = spark.createDataFrame([({3: "c", 1: "a"},)], "m map<int,string>").select(structs.map_text("m").alias("t")).first()
    assert m.t == "1:a,3:c"


def test_projection_helpers(spark):
    df = spark.createDataFrame([(2, "x")], "n int, s string")
    r = projections.with_powers(df, "n").first()
    assert (r.n_pow2, r.n_pow3) == (4, 8)
    assert projections.select_sorted(df.select("s", "n")).columns == ["n", "s"]
    assert projections.rename_and_drop(df, {"n": "m"}, ["s"]).columns == ["m"]
    assert projections.with_constant(df, "count", 1).first()["count"] == 1
    q = projections.with_quotient(spark.createDataFrame([(61,)], "latency int"), "latency", 1000, "latency_seconds").first()
    assert q.latency_seconds == 0.061
    words = projections.explode_split(spark.createDataFrame([("a b",)], "t string"), "t", "w").collect()
    assert [r.w for r in words] == ["a", "b"]


def test_pattern_parse_ignores_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.createDataFrame([("10/Mar/2024:02:30:00",)], "t string")  # inside New York's DST gap
        got = df.select(temporal.parse_time("t", temporal.ACCESS_LOG_TIME_FORMAT).alias("ts")).first().ts
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == dt.datetime(2024, 3, 10, 2, 30)
