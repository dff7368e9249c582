"""Operators on the reference's own small inputs, against its expected results
(FIXTURES.md §3). Fixture rows below are fixed values copied as data."""

from __future__ import annotations

from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.testing import assertDataFrameEqual

from tidewater.functions import casts, udfs
from tidewater.operators import aggregates as agg
from tidewater.operators import filters as flt
from tidewater.operators import joins
from tidewater.operators import partitioning as part_ops
from tidewater.plans.access_log import filter_status_endpoint_log
from tidewater.plans.catalog import build_catalog, review_stats
from tidewater.plans.course_scores import course_scores
from tidewater.sinks import keyed_upsert

# The three lines of the word-count input.
WORDS = [
    "This blog is exclusive for all the people who are interested in learning one of the trending in current IT industry.",
    "This course is suitable for students, teacher, IT engineer freshers etc..",
    "It talks about the spark with pyhton (pyspark) from beginner till experts.",
]


def test_word_count(spark):
    lines = spark.createDataFrame([(w,) for w in WORDS], "value string")
    wc = agg.word_count(lines, "value")
    assert wc.count() == 37
    assert wc.agg(F.sum("count")).first()[0] == 44
    got = {r["word"]: r["count"] for r in wc.collect()}
    assert got["the"] == 3
    for w in ("IT", "This", "for", "in", "is"):
        assert got[w] == 2


def test_course_scores(spark):
    # fixed values: the in-code test rows of the course-score example
    chapters = spark.createDataFrame(
        [(1, 96), (1, 97), (1, 98), (2, 99)] + [(3, c) for c in range(100, 110)], "course_id int, chapter_id int"
    )
    views = spark.createDataFrame(
        [(14, 96), (14, 97), (13, 96), (13, 96), (13, 96), (14, 99), (13, 100)], "user_id int, chapter_id int"
    )
    titles = spark.createDataFrame(
        [(1, "Flutter programming"), (2, "Marketing 101"), (3, "Apache Spark guide")], "course_id int, title string"
    )
    got = [(r.title, r.score) for r in course_scores(chapters, views, titles).collect()]
    assert got == [("Marketing 101", 10.0), ("Flutter programming", 3.0), ("Apache Spark guide", 0.0)]


def _users(spark):
    visits = spark.createDataFrame([(1, 10), (2, 27), (3, 2), (4, 5), (5, 88), (6, 1), (7, 5)], "user_id int, visits int")
    names = spark.createDataFrame(
        [(1, "Andrew"), (2, "Chris"), (3, "John"), (4, "Bob"), (6, "Ryan"), (7, "Mali"), (8, "Tony")],
        "user_id int, name string",
    )
    return names, visits


def test_user_joins(spark):
    names, visits = _users(spark)
    assert joins.join_on(names, visits, "user_id", "inner").count() == 6
    assert joins.join_on(names, visits, "user_id", "left").count() == 7
    assert joins.join_on(names, visits, "user_id", "right").count() == 7
    assert joins.join_on(names, visits, "user_id", "full").count() == 8
    chris = joins.join_on(names, visits, "user_id").filter(F.col("name") == "Chris").orderBy("user_id").collect()
    assert [(r.user_id, r.visits) for r in chris] == [(2, 27)]


def test_join_row_counts_match_real_joins(spark):
    a = spark.createDataFrame([(1,), (1,), (2,), (None,), (5,)], "id int")
    b = spark.createDataFrame([(1,), (1,), (1,), (3,), (None,)], "id int")
    counts = joins.join_row_counts({"a": a, "b": b}, [("a", "b", h) for h in ("inner", "left", "right", "full_outer")], "id")
    got = {r.join_type: r.rows for r in counts.collect()}
    for how, key in (("inner", "inner"), ("left", "left"), ("right", "right"), ("full", "full_outer")):
        assert got[key] == a.join(b, "id", how).count()


def test_filter_status_and_endpoint(spark):
    df = spark.createDataFrame(
        [
            Row(ip="192.168.100.70", status_code="200", endpoint="/users"),
            Row(ip="192.168.100.71", status_code="400", endpoint="/stocks"),
            Row(ip="90.87.227.59", status_code="500", endpoint="/abcd"),
            Row(ip="100.232.50.8", status_code="400", endpoint="/users"),
        ]
    )
    out = filter_status_endpoint_log(df, "400", "/users")
    assertDataFrameEqual(out, [Row(ip="100.232.50.8", status_code="400", endpoint="/users")])


def test_latency_stats(spark):
    rows = [("GET", "/users", 10), ("GET", "/users", 10), ("POST", "/users", 10), ("POST", "/users", 5),
            ("POST", "/stocks", 0), ("POST", "/stocks", 100)]
    df = spark.createDataFrame(rows, "method string, endpoint string, latency long")
    out = agg.min_max_mean(df, ["method", "endpoint"], "latency", ("max_latency", "min_latency", "mean_latency"))
    assertDataFrameEqual(
        out,
        [
            Row(method="GET", endpoint="/users", max_latency=10, min_latency=10, mean_latency=10.0),
            Row(method="POST", endpoint="/users", max_latency=10, min_latency=5, mean_latency=7.5),
            Row(method="POST", endpoint="/stocks", max_latency=100, min_latency=0, mean_latency=50.0),
        ],
    )


def _udf_rows(spark):
    return spark.createDataFrame([("abc", 1), ("ffff", 2), ("cccc", 3)], "name string, id int")


def test_udf_prefix_cube(spark):
    df = _udf_rows(spark)
    out = df.select(udfs.add_prefix_udf("name").alias("prefix_name"), udfs.cube_udf("id").alias("cube_id"))
    assertDataFrameEqual(out, [Row(prefix_name="prefix_abc", cube_id=1), Row(prefix_name="prefix_ffff", cube_id=8),
                               Row(prefix_name="prefix_cccc", cube_id=27)])
    builtin = df.select(udfs.add_prefix_expr("name").alias("prefix_name"), udfs.cube_expr("id").alias("cube_id"))
    assertDataFrameEqual(out, builtin)


def test_udf_sql_and_guarded_filter(spark):
    udfs.register_sql_udfs(spark)
    _udf_rows(spark).createOrReplaceTempView("udf_test")
    out = spark.sql("SELECT add_prefix(name) AS prefix_name, cube(id) AS cube_id FROM udf_test")
    assert sorted(tuple(r) for r in out.collect()) == [("prefix_abc", 1), ("prefix_cccc", 27), ("prefix_ffff", 8)]
    guarded = _udf_rows(spark).filter(flt.guarded_length_above("name", udfs.add_prefix_expr, 10))
    assert sorted(r.name for r in guarded.collect()) == ["cccc", "ffff"]


def test_tolerant_cast_and_bad_records(spark):
    rows = [("1", "korea", "2"), ("2", "japan", "3"), ("3", "china", "vvvv"), ("4", "japan", "1"),
            ("5", "india", "4"), ("6", "korea", "three")]
    df = spark.createDataFrame(rows).toDF("user_id", "visit_country", "visit_count")
    valid = df.withColumn("visit_count_valid", casts.tolerant_int("visit_count")).orderBy("user_id")
    assert [r.visit_count_valid for r in valid.collect()] == [2, 3, 0, 1, 4, 0]
    assert df.agg(casts.bad_int_count("visit_count").alias("bad")).first().bad == 2


def test_tolerant_cast_edge_cases(spark):
    df = spark.createDataFrame([(" 12",), ("3.",), ("+7",), ("-0",), ("1e3",), ("99999999999",), (None,)], "t string")
    got = [r.v for r in df.select(casts.safe_int("t").alias("v")).collect()]
    assert got == [12, None, 7, 0, None, None, None]


def test_lookup_join(spark):
    # fixed values: the code -> name dictionary and rows of the broadcast example
    lookup = spark.createDataFrame([("10001", "도서"), ("10002", "가구"), ("10003", "전자기기")], "code string, name string")
    rows = [("1", "10001"), ("2", "10003"), ("3", "10001"), ("4", "10003"), ("5", "10002"), ("6", "99999")]
    df = spark.createDataFrame(rows, "id string, category_code string")
    out = joins.lookup(df, "category_code", lookup, "code", "name", "category_name").orderBy("id")
    assert [r.category_name for r in out.collect()] == ["도서", "전자기기", "도서", "전자기기", "가구", None]


def _catalog_inputs(spark):
    # fixed values: the catalog example's JSON inputs (subset of item columns)
    products = spark.createDataFrame(
        [(1, "Iphone14", [2, 3]), (2, "M1 Macbook Pro", [1, 3])], "product_id int, product_name string, category_ids array<int>"
    )
    categories = spark.createDataFrame(
        [(1, "IT 전자기기"), (2, "스마트폰"), (3, "랩탑/노트북")], "category_id int, category_name string"
    )
    reviews = spark.createDataFrame(
        [(1, 1, 5), (2, 1, 4), (3, 1, 2), (4, 1, 1), (5, 2, 5), (6, 2, 4), (7, 2, 2)],
        "review_id int, product_id int, score int",
    )
    items = spark.createDataFrame(
        [(1, 1, 1, 1000000), (2, 1, 1, 1300000), (3, 1, 2, 1300000), (4, 2, 1, 2000000), (5, 2, 1, 2500000)],
        "item_id int, product_id int, seller_id int, price int",
    )
    sellers = spark.createDataFrame([(1, "Apple 공식 리셀러"), (2, "T공식대리점")], "seller_id int, seller_name string")
    return products, categories, reviews, items, sellers


def test_review_stats(spark):
    _, _, reviews, _, _ = _catalog_inputs(spark)
    got = {r.product_id: (round(r.review_mean_score, 4), r.review_count) for r in review_stats(reviews, review_id="review_id").collect()}
    assert got == {1: (3.0, 4), 2: (3.6667, 3)}


def test_category_map_and_catalog(spark):
    products, categories, reviews, items, sellers = _catalog_inputs(spark)
    mapped = joins.ids_to_map(products, "category_ids", categories, "category_id", "category_name", "categories")
    got = {r.product_id: r.categories for r in mapped.collect()}
    assert got == {1: {2: "스마트폰", 3: "랩탑/노트북"}, 2: {1: "IT 전자기기", 3: "랩탑/노트북"}}
    catalog = build_catalog(products, categories, review_stats(reviews, review_id="review_id"), items, sellers)
    assert catalog.count() == 5
    assert catalog.columns == sorted(catalog.columns)


def test_ids_to_map_null_empty_unknown(spark):
    df = spark.createDataFrame([(1, [1, 9]), (2, []), (3, None)], "k int, ids array<int>")
    dim = spark.createDataFrame([(1, "one")], "id int, name string")
    got = {r.k: r.m for r in joins.ids_to_map(df, "ids", dim, "id", "name", "m").collect()}
    assert got == {1: {1: "one"}, 2: {}, 3: {}}


def test_custom_partitioner(spark):
    subjects = ["Math", "English", "Science"]
    df = spark.createDataFrame([(i, subjects[i % 3]) for i in range(30)], "id long, subject string")
    placed = part_ops.custom_partition(df, "subject", subjects, 3)
    rows = placed.select("subject", "partition_id", F.spark_partition_id().alias("pid")).distinct().collect()
    assert {(r.subject, r.partition_id, r.pid) for r in rows} == {("Math", 0, 0), ("English", 1, 1), ("Science", 2, 2)}
    # hash('Science') % 3 is negative; pmod is the real partition id
    h = spark.createDataFrame([("Science",)], "s string").select(
        (F.hash("s") % 3).alias("naive"), part_ops.hash_partition_id("s", 3).alias("pmod")
    ).first()
    assert h.naive == -1 and h.pmod == 2


def test_keyed_upsert_keeps_latest(spark):
    target = spark.createDataFrame([(1, 1, "a"), (2, 1, "b")], "k int, v int, payload string")
    updates = spark.createDataFrame([(1, 2, "a2"), (3, 1, "c")], "k int, v int, payload string")
    out = keyed_upsert(target, updates, ["k"], ["v"])
    assert sorted(tuple(r) for r in out.collect()) == [(1, 2, "a2"), (2, 1, "b"), (3, 1, "c")]


def test_hot_key_distinct_members(spark):
    # one member group holding most rows is pre-aggregated, not gathered
    rows = [("hot", f"u{i % 50}") for i in range(3000)] + [("cold", "u1")]
    df = spark.createDataFrame(rows, "g string, m string")
    out = agg.distinct_members(df, ["g"], "m")
    hot = out.filter(F.col("g") == "hot")
    assert hot.count() == 50
    first = hot.first()
    assert first.group_rows == 3000 and first.group_distinct == 50


def test_salted_join_equals_plain_join_on_hot_key(spark):
    many = spark.createDataFrame([(1 if i % 3 else i, i) for i in range(300)], "k int, v int")
    one = spark.createDataFrame([(k, f"n{k}") for k in range(0, 300, 3)] + [(1, "hot")], "k int, name string")
    for how in ("inner", "left"):
        plain = many.join(one, "k", how)
        salted = joins.salted_join(many, one, ["k"], 8, how)
        assert sorted(map(tuple, plain.select("k", "v", "name").collect())) == sorted(
            map(tuple, salted.select("k", "v", "name").collect())
        )
    spread = joins.salt_many_side(many.filter("k = 1"), 8).select("__salt").distinct().count()
    assert spread > 1


def test_broadcast_is_left_to_statistics(spark):
    small = spark.createDataFrame([(i, "x" * 10) for i in range(100)], "k int, s string")
    big = spark.range(10).withColumnRenamed("id", "k")
    kept = spark.sparkContext._jsc.getPersistentRDDs().size()
    allowed = _plan(joins.broadcast_join(big, small, "k"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        refused = _plan(joins.broadcast_join(big, small, "k"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" not in refused and "BroadcastHashJoin" in allowed
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == kept  # nothing is kept, no job has run


def test_id_arrays_with_several_unknown_null_and_no_ids(spark):
    rows = [(1, "a", [3, 1, 9, None, 3]), (2, "b", None), (3, None, []), (4, "d", [9, None])]
    df = spark.createDataFrame(rows, "id int, name string, ids array<int>")
    dim = spark.createDataFrame([(1, "one"), (3, "three"), (3, "trois"), (5, "five")], "k int, v string")
    got = {r.id: (r.name, r.m) for r in joins.ids_to_map(df, "ids", dim, "k", "v", "m").collect()}
    assert got == {1: ("a", {1: "one", 3: "three"}), 2: ("b", {}), 3: (None, {}), 4: ("d", {})}


def test_sets_keep_groups_without_members_and_with_null_keys(spark):
    rows = [(1, "x"), (1, "x"), (1, None), (None, "y"), (2, None), (2, None)]
    got = agg.distinct_members(spark.createDataFrame(rows, "k int, m string"), ["k"], "m").collect()
    assert {tuple(r) for r in got} == {(1, "x", 2, 2, 1), (None, "y", 1, 1, 1), (2, None, 0, 0, 0)}


def _plan(df) -> str:
    import contextlib
    import io

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def test_full_catalog_with_promotions(spark):
    import datetime as dt

    products, categories, reviews, _, sellers = _catalog_inputs(spark)
    # fixed values: the five items and three promotions of the catalog example (subset of fields per item)
    items = spark.createDataFrame(
        [
            (1, 1, 1, [1], "Iphone14", ["아이폰", "아이폰14", "아이폰 최신"], 1000000, 1681084800, 1683373422,
             {"color": "red", "disk": "64GB", "ram": "8GB"}, True),
            (2, 1, 1, [1], "Iphone14 Pro", ["아이폰", "아이폰14pro", "최신아이폰"], 1300000, 1681344000, 1683373422,
             {"color": "blue", "disk": "128GB", "ram": "16GB"}, True),
            (3, 1, 2, [], "Iphone14 Pro", ["아이폰", "아이폰14pro", "아이폰 14", "Iphone", "Iphone14"], 1300000, 1679100600,
             1683373422, {"color": "blue", "disk": "128GB", "ram": "16GB"}, False),
            (4, 2, 1, [3], "M1 Macbook Pro", ["맥북", "맥북프로", "M1맥북", "Mackbook"], 2000000, 1681084800, 1683373422,
             {"color": "silver", "disk": "512GB", "ram": "16GB"}, True),
            (5, 2, 1, [2], "M1 Macbook Pro", ["Mackbook", "맥북 프로", "맥북", "맥", "MAC"], 2500000, 1681084800, 1683373422,
             {"color": "space grey", "disk": "512GB", "ram": "24GB"}, True),
        ],
        "item_id int, product_id int, seller_id int, promotion_ids array<int>, original_item_title string, "
        "search_tag array<string>, price int, create_ts long, update_ts long, attrs map<string,string>, free_shipping boolean",
    ).select(
        "*",
        F.timestamp_seconds("create_ts").alias("item_create_timestamp"),
        F.timestamp_seconds("update_ts").alias("item_update_timestamp"),
    ).drop("create_ts", "update_ts")
    promotions = spark.createDataFrame(
        [(1, "5월 한정 초특가 할인"), (2, "신학기 프로모션"), (3, "블랙프라이데이 특가")], "promotion_id int, name string"
    )
    catalog = build_catalog(products, categories, review_stats(reviews, review_id="review_id"), items, sellers, promotions)
    assert catalog.count() == 5 and len(catalog.columns) == 16 and catalog.columns == sorted(catalog.columns)
    rows = {r.item_id: r for r in catalog.collect()}
    assert rows[1].promotions == {1: "5월 한정 초특가 할인"} and rows[3].promotions == {}
    assert rows[4].categories == {1: "IT 전자기기", 3: "랩탑/노트북"} and rows[4].seller_name == "Apple 공식 리셀러"
    assert round(rows[5].review_mean_score, 4) == 3.6667 and rows[5].review_count == 3
    assert isinstance(rows[1].item_create_timestamp, dt.datetime)
