"""Single-operator batch queries over the TESTDATA tables (S, P, F, J, A, T, E, U rows
of the inventory). Stand-ins: SURVEY §7.2 / README."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.functions import casts, structs, temporal
from tidewater.functions import udfs
from tidewater.functions.numeric import exact_sum
from tidewater.operators import aggregates as agg
from tidewater.operators import filters as flt
from tidewater.operators import joins, projections, ranking
from tidewater.plans.registry import register
from tidewater.session import unique_name
from tidewater.sinks.tables import parquet_roundtrip
from tidewater.sources.tables import read_parquet, read_table, table_path


# --- A1 / P4 / P7 / E1 / E3: flagship ---------------------------------------------------------

@register(
    "word_count",
    """
    SELECT w AS word, count(*) AS count
    FROM (SELECT unnest(string_split(text, ' ')) AS w FROM documents)
    GROUP BY w
    """,
    ("A1", "P7", "E1", "E3"),
)
def word_count(spark: SparkSession, d: str) -> DataFrame:
    return agg.word_count(read_table(spark, d, "documents", "text"), "text")


# --- scans and projections --------------------------------------------------------------------

@register(
    "scan_parquet",
    "SELECT l_orderkey, l_linenumber, l_quantity, l_shipdate FROM lineitem",
    ("S9",),
)
def scan_parquet(spark: SparkSession, d: str) -> DataFrame:
    return read_parquet(spark, table_path(d, "lineitem")).select("l_orderkey", "l_linenumber", "l_quantity", "l_shipdate")


@register(
    "square_cube",
    """
    SELECT p_partkey, p_size, p_size * p_size AS p_size_pow2, p_size * p_size * p_size AS p_size_pow3
    FROM part
    """,
    ("P3", "E16"),
)
def square_cube(spark: SparkSession, d: str) -> DataFrame:
    return projections.with_powers(read_table(spark, d, "part", "p_partkey", "p_size"), "p_size", (2, 3))


@register("select_sorted_columns", "SELECT * FROM customer", ("P1",))
def select_sorted_columns(spark: SparkSession, d: str) -> DataFrame:
    return projections.select_sorted(read_table(spark, d, "customer"))


@register(
    "unit_convert",
    "SELECT event_id, value, value / 1000 AS latency_seconds FROM events",
    ("P2", "E16"),
)
def unit_convert(spark: SparkSession, d: str) -> DataFrame:
    ev = read_table(spark, d, "events", "event_id", "value")
    return projections.with_quotient(ev, "value", 1000, "latency_seconds")


@register("constant_column", "SELECT c_custkey, c_mktsegment, 1 AS count FROM customer", ("P4",))
def constant_column(spark: SparkSession, d: str) -> DataFrame:
    return projections.with_constant(read_table(spark, d, "customer", "c_custkey", "c_mktsegment"), "count", 1)


@register(
    "rename_drop",
    "SELECT p_partkey AS product_id, p_name AS product_name, p_brand, p_type, p_size FROM part",
    ("P5",),
)
def rename_drop(spark: SparkSession, d: str) -> DataFrame:
    part = read_table(spark, d, "part")
    return projections.rename_and_drop(part, {"p_partkey": "product_id", "p_name": "product_name"}, ["p_retailprice"])


@register(
    "json_expand",
    "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events",
    ("P8", "E19", "E20"),
)
def json_expand(spark: SparkSession, d: str) -> DataFrame:
    ev = read_table(spark, d, "events", "event_id", "props")
    parsed = ev.select("event_id", structs.parse_json("props", "k INT").alias("p"))
    return projections.expand(parsed, "p", keep=["event_id"])


# --- filters ----------------------------------------------------------------------------------

@register(
    "filter_status_endpoint",
    "SELECT event_id, user_id, event_type, value FROM events WHERE event_type = 'error' AND user_id = 7",
    ("F1",),
)
def filter_status_endpoint(spark: SparkSession, d: str) -> DataFrame:
    ev = read_table(spark, d, "events", "event_id", "user_id", "event_type", "value")
    return flt.where_equal(ev, event_type="error", user_id=7)


@register(
    "filter_equality",
    "SELECT c_custkey, c_name FROM customer WHERE c_mktsegment = 'BUILDING'",
    ("F2",),
)
def filter_equality(spark: SparkSession, d: str) -> DataFrame:
    cust = read_table(spark, d, "customer", "c_custkey", "c_name", "c_mktsegment")
    return flt.where_equal(cust, c_mktsegment="BUILDING").drop("c_mktsegment")


@register(
    "filter_prefix",
    "SELECT o_orderkey, o_orderpriority FROM orders WHERE starts_with(o_orderpriority, '2')",
    ("F3", "E6"),
)
def filter_prefix(spark: SparkSession, d: str) -> DataFrame:
    return flt.where_prefix(read_table(spark, d, "orders", "o_orderkey", "o_orderpriority"), "o_orderpriority", "2")


@register(
    "filter_prefix_contains",
    """
    SELECT page_id, url FROM pages
    WHERE starts_with(replace(url, '"', ''), 'https') AND contains(replace(url, '"', ''), '/en/')
    """,
    ("F4", "E5", "E6"),
)
def filter_prefix_contains(spark: SparkSession, d: str) -> DataFrame:
    pages = read_table(spark, d, "pages", "page_id", "url")
    return flt.where_prefix_contains(pages, "url", "https", "/en/")


@register(
    "filter_threshold",
    "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE CAST(trunc(l_quantity) AS BIGINT) > 45",
    ("F5", "E23"),
)
def filter_threshold(spark: SparkSession, d: str) -> DataFrame:
    li = read_table(spark, d, "lineitem", "l_orderkey", "l_linenumber", "l_quantity")
    return flt.where_above(li, "l_quantity", 45, whole=True)


@register(
    "guarded_filter",
    """
    SELECT p_partkey, p_name FROM part
    WHERE CASE WHEN p_name IS NOT NULL THEN length('prefix_' || p_name) > 17 ELSE false END
    """,
    ("F8", "E8", "E9"),
)
def guarded_filter(spark: SparkSession, d: str) -> DataFrame:
    part = read_table(spark, d, "part", "p_partkey", "p_name")
    return part.filter(flt.guarded_length_above("p_name", udfs.add_prefix_expr, 17))


@register(
    "filter_year",
    "SELECT o_orderkey, o_orderdate FROM orders WHERE year(o_orderdate) = 1998",
    ("F9", "E13"),
)
def filter_year(spark: SparkSession, d: str) -> DataFrame:
    return flt.where_year(read_table(spark, d, "orders", "o_orderkey", "o_orderdate"), "o_orderdate", 1998)


@register("distinct_pairs", "SELECT DISTINCT l_partkey, l_suppkey FROM lineitem", ("F10",))
def distinct_pairs(spark: SparkSession, d: str) -> DataFrame:
    return flt.distinct_rows(read_table(spark, d, "lineitem", "l_partkey", "l_suppkey"))


_TOKENS_SQL = "SELECT doc_id, unnest(string_split(text, ' ')) AS token FROM documents"
# int(token) semantics: optional blanks and sign, ASCII digits only ('3.' is not an int)
_INT_SQL = (
    "CASE WHEN regexp_matches(token, '^[\\x00-\\x20]*[+-]?[0-9]+[\\x00-\\x20]*$') "
    "THEN TRY_CAST(regexp_replace(token, '[\\x00-\\x20]', '', 'g') AS INTEGER) END"
)


def _tokens(spark: SparkSession, d: str) -> DataFrame:
    docs = read_table(spark, d, "documents", "doc_id", "text")
    return projections.explode_split(docs, "text", "token", " ", keep=["doc_id"])


@register(
    "tolerant_cast",
    f"""
    SELECT doc_id,
           CAST(sum(coalesce({_INT_SQL}, 0)) AS BIGINT) AS valid_sum,
           CAST(count(*) FILTER (WHERE token IS NOT NULL AND ({_INT_SQL}) IS NULL) AS BIGINT) AS bad_tokens
    FROM ({_TOKENS_SQL}) GROUP BY doc_id
    """,
    ("F11", "E23"),
)
def tolerant_cast(spark: SparkSession, d: str) -> DataFrame:
    return _tokens(spark, d).groupBy("doc_id").agg(
        F.sum(casts.tolerant_int("token")).cast("long").alias("valid_sum"),
        casts.bad_int_count("token").alias("bad_tokens"),
    )


@register(
    "bad_record_count",
    f"""
    SELECT count(*) AS records,
           CAST(count(*) FILTER (WHERE token IS NOT NULL AND ({_INT_SQL}) IS NULL) AS BIGINT) AS bad_records
    FROM ({_TOKENS_SQL})
    """,
    ("A16",),
)
def bad_record_count(spark: SparkSession, d: str) -> DataFrame:
    return _tokens(spark, d).agg(
        F.count(F.lit(1)).alias("records"), casts.bad_int_count("token").alias("bad_records")
    )


# --- joins ------------------------------------------------------------------------------------

# whole tables that don't match completely on either side: labelled documents and embedded ones
_USERS_SQL = """
WITH names AS (SELECT doc_id AS user_id, quality AS name FROM labels),
     visits AS (SELECT vec_id AS user_id, label AS visits FROM embeddings)
SELECT COALESCE(n.user_id, v.user_id) AS user_id, n.name, v.visits
FROM names n {how} JOIN visits v ON n.user_id = v.user_id
"""


def _names_visits(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    names = read_table(spark, d, "labels", "doc_id", "quality").toDF("user_id", "name")
    return names, read_table(spark, d, "embeddings", "vec_id", "label").toDF("user_id", "visits")


def _user_join(how: str):
    def q(spark: SparkSession, d: str) -> DataFrame:
        names, visits = _names_visits(spark, d)
        return joins.join_on(names, visits, "user_id", how)

    return q


for _how, _sql_how, _op in (("inner", "INNER", "J1"), ("left", "LEFT", "J2"), ("right", "RIGHT", "J3"), ("full", "FULL", "J4")):
    register(f"join_{_how}", _USERS_SQL.format(how=_sql_how), (_op,))(_user_join(_how))


@register(
    "join_named_keys",
    """
    SELECT l_orderkey, l_linenumber, p_name, l_quantity
    FROM lineitem JOIN part ON l_partkey = p_partkey
    """,
    ("J6", "ST19"),
)
def join_named_keys(spark: SparkSession, d: str) -> DataFrame:
    li = read_table(spark, d, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    part = read_table(spark, d, "part", "p_partkey", "p_name")
    return joins.join_on(li, part, li["l_partkey"] == part["p_partkey"]).select(
        "l_orderkey", "l_linenumber", "p_name", "l_quantity"
    )


@register(
    "join_filter_sort",
    _USERS_SQL.format(how="INNER").replace("ON n.user_id = v.user_id", "ON n.user_id = v.user_id WHERE n.name = 1"),
    ("J7", "T1"),
)
def join_filter_sort(spark: SparkSession, d: str) -> DataFrame:
    names, visits = _names_visits(spark, d)
    joined = joins.join_on(names, visits, "user_id").filter(F.col("name") == 1)
    return ranking.sort_by(joined, "user_id")


_ID_LISTS_SQL = """
WITH l1 AS (SELECT c_custkey AS id FROM customer),
     l2 AS (SELECT o_custkey AS id FROM orders),
     l3 AS (SELECT user_id AS id FROM events),
     l4 AS (SELECT s_suppkey AS id FROM supplier)
SELECT 'l1-l2' AS pair, 'inner' AS join_type, CAST(count(*) AS BIGINT) AS rows FROM l1 JOIN l2 ON l1.id = l2.id
UNION ALL SELECT 'l3-l4', 'inner', count(*) FROM l3 JOIN l4 ON l3.id = l4.id
UNION ALL SELECT 'l4-l2', 'full_outer', count(*) FROM l4 FULL JOIN l2 ON l4.id = l2.id
UNION ALL SELECT 'l2-l3', 'inner', count(*) FROM l2 JOIN l3 ON l2.id = l3.id
"""


@register("join_counts", _ID_LISTS_SQL, ("J8",))
def join_counts(spark: SparkSession, d: str) -> DataFrame:
    columns = {"l1": ("customer", "c_custkey"), "l2": ("orders", "o_custkey"), "l3": ("events", "user_id"), "l4": ("supplier", "s_suppkey")}
    lists = {name: read_table(spark, d, table, col).select(F.col(col).alias("id")) for name, (table, col) in columns.items()}
    pairs = [("l1", "l2", "inner"), ("l3", "l4", "inner"), ("l4", "l2", "full_outer"), ("l2", "l3", "inner")]
    return joins.join_row_counts(lists, pairs, "id")


@register(
    "join_broadcast",
    "SELECT c_custkey, c_name, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey",
    ("J9",),
)
def join_broadcast(spark: SparkSession, d: str) -> DataFrame:
    cust = read_table(spark, d, "customer", "c_custkey", "c_name", "c_nationkey")
    nation = read_table(spark, d, "nation", "n_nationkey", "n_name")
    return joins.broadcast_join(cust, nation, cust["c_nationkey"] == nation["n_nationkey"]).select(
        "c_custkey", "c_name", "n_name"
    )


@register(
    "join_sort_merge",
    "SELECT o_orderkey, c_name, o_totalprice FROM orders JOIN customer ON o_custkey = c_custkey",
    ("J10",),
)
def join_sort_merge(spark: SparkSession, d: str) -> DataFrame:
    orders = read_table(spark, d, "orders", "o_orderkey", "o_custkey", "o_totalprice")
    cust = read_table(spark, d, "customer", "c_custkey", "c_name")
    return joins.merge_join(orders, cust, orders["o_custkey"] == cust["c_custkey"]).select(
        "o_orderkey", "c_name", "o_totalprice"
    )


@register(
    "lookup_join",
    """
    SELECT s_suppkey, s_nationkey, n_name AS nation_name
    FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey
    """,
    ("J13",),
)
def lookup_join(spark: SparkSession, d: str) -> DataFrame:
    sup = read_table(spark, d, "supplier", "s_suppkey", "s_nationkey")
    nation = read_table(spark, d, "nation", "n_nationkey", "n_name")
    return joins.lookup(sup, "s_nationkey", nation, "n_nationkey", "n_name", "nation_name")


# --- aggregates, sorts, top-k -----------------------------------------------------------------

@register(
    "top_types",
    """
    SELECT o_orderpriority, count(*) AS count FROM orders
    WHERE o_orderpriority IS NOT NULL GROUP BY o_orderpriority ORDER BY count DESC
    """,
    ("A7", "F7", "T1"),
)
def top_types(spark: SparkSession, d: str) -> DataFrame:
    orders = flt.where_not_null(read_table(spark, d, "orders", "o_orderpriority"), "o_orderpriority")
    return agg.count_by(orders, ["o_orderpriority"]).orderBy(F.col("count").desc())


@register(
    "count_by_month",
    """
    SELECT CAST(month(o_orderdate) AS INTEGER) AS month, count(*) AS count
    FROM orders WHERE year(o_orderdate) = 1998 GROUP BY 1 ORDER BY count DESC
    """,
    ("A8", "E13"),
)
def count_by_month(spark: SparkSession, d: str) -> DataFrame:
    orders = flt.where_year(read_table(spark, d, "orders", "o_orderdate"), "o_orderdate", 1998)
    return agg.count_by(orders, [temporal.month_of("o_orderdate").alias("month")]).orderBy(F.col("count").desc())


@register(
    "count_by_place",
    """
    SELECT c_name, count(*) AS count
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    WHERE n_name = 'NATION_7' GROUP BY c_name ORDER BY count DESC
    """,
    ("A9",),
)
def count_by_place(spark: SparkSession, d: str) -> DataFrame:
    nation = read_table(spark, d, "nation", "n_nationkey", "n_name").filter(F.col("n_name") == "NATION_7")
    cust = read_table(spark, d, "customer", "c_custkey", "c_name", "c_nationkey")
    local = cust.join(nation, cust["c_nationkey"] == nation["n_nationkey"])  # nation: broadcast by its statistics
    orders = read_table(spark, d, "orders", "o_custkey")
    placed = orders.join(local, orders["o_custkey"] == local["c_custkey"])
    return agg.count_by(placed, ["c_name"]).orderBy(F.col("count").desc())


@register(
    "slowest_top5",
    """
    SELECT o_orderkey, o_totalprice FROM orders WHERE year(o_orderdate) = 1998
    ORDER BY o_totalprice DESC, o_orderkey LIMIT 5
    """,
    ("T2",),
)
def slowest_top5(spark: SparkSession, d: str) -> DataFrame:
    orders = flt.where_year(read_table(spark, d, "orders", "o_orderkey", "o_totalprice", "o_orderdate"), "o_orderdate", 1998)
    return ranking.top_k(orders.select("o_orderkey", "o_totalprice"), 5, F.col("o_totalprice").desc(), F.col("o_orderkey"))


_MEAN_COLS = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax")


@register(
    "group_mean_all",
    "SELECT l_returnflag, l_linestatus, "
    + ", ".join(f"round(avg({c}), 6) AS avg_{c}" for c in _MEAN_COLS)
    + " FROM lineitem GROUP BY l_returnflag, l_linestatus",
    ("A10",),
)
def group_mean_all(spark: SparkSession, d: str) -> DataFrame:
    # the double columns are declared fixed-point with 2 decimals: exact sums
    means = agg.mean_of_numeric(read_table(spark, d, "lineitem"), ["l_returnflag", "l_linestatus"], exact_scale=2)
    return means.withColumns({f"avg_{c}": F.round(f"avg_{c}", 6) for c in _MEAN_COLS})


@register("global_count", "SELECT count(*) AS rows FROM lineitem", ("A11",))
def global_count(spark: SparkSession, d: str) -> DataFrame:
    return agg.global_count(read_table(spark, d, "lineitem", "l_orderkey"))


@register(
    "count_per_item",
    "SELECT l_partkey, count(*) AS count FROM lineitem GROUP BY l_partkey",
    ("A12",),
)
def count_per_item(spark: SparkSession, d: str) -> DataFrame:
    return agg.count_by(read_table(spark, d, "lineitem", "l_partkey"), ["l_partkey"])


@register(
    "sum_by_date",
    """
    SELECT CAST(ts AS DATE) AS day, round(sum(value), 2) AS total, count(*) AS rows
    FROM events GROUP BY 1
    """,
    ("A15",),
)
def sum_by_date(spark: SparkSession, d: str) -> DataFrame:
    ev = read_table(spark, d, "events", "ts", "value")
    return ev.groupBy(F.to_date("ts").alias("day")).agg(exact_sum("value").alias("total"), F.count(F.lit(1)).alias("rows"))


# --- UDFs -------------------------------------------------------------------------------------

@register(
    "udf_prefix_cube",
    """
    SELECT p_partkey, 'prefix_' || p_name AS prefix_name,
           CAST(p_size AS BIGINT) * p_size * p_size AS cube_size
    FROM part
    """,
    ("U1", "E9"),
)
def udf_prefix_cube(spark: SparkSession, d: str) -> DataFrame:
    part = read_table(spark, d, "part", "p_partkey", "p_name", "p_size")
    return part.select(
        "p_partkey", udfs.add_prefix_udf("p_name").alias("prefix_name"), udfs.cube_udf("p_size").alias("cube_size")
    )


@register(
    "udf_sql",
    """
    SELECT c_custkey, 'prefix_' || c_mktsegment AS prefix_segment,
           CAST(c_nationkey AS BIGINT) * c_nationkey * c_nationkey AS cube_nation
    FROM customer
    """,
    ("U2", "S14"),
)
def udf_sql(spark: SparkSession, d: str) -> DataFrame:
    udfs.register_sql_udfs(spark)
    view = unique_name("customer_udf")
    read_table(spark, d, "customer", "c_custkey", "c_mktsegment", "c_nationkey").createOrReplaceTempView(view)
    return spark.sql(
        f"SELECT c_custkey, add_prefix(c_mktsegment) AS prefix_segment, cube(c_nationkey) AS cube_nation FROM {view}"
    )


# --- K1 / C4 Q5 -------------------------------------------------------------------------------

@register("parquet_roundtrip", "SELECT * FROM orders WHERE year(o_orderdate) = 1998", ("K1", "S9"))
def parquet_roundtrip_q(spark: SparkSession, d: str) -> DataFrame:
    orders = flt.where_year(read_table(spark, d, "orders"), "o_orderdate", 1998)
    return parquet_roundtrip(spark, orders, "orders_1998")

