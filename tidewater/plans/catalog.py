"""Central product catalog (C5; J14, J15, A14, P1, P5, K9, K10).

products (+ category map from their category ids, + review statistics)
joined with items (+ seller name, + promotion map from their promotion ids),
one wide row per item, columns in name order, then written to a keyed table.

Stand-ins (TESTDATA): product = part, its category ids = the brand number of
``p_brand`` ('Brand#17' -> 17), its size (often no brand number: an unknown id)
and a null, with null and empty arrays for two sizes; category dimension = the
distinct brands; item = line item (key ``l_orderkey, l_linenumber``), its
promotion ids = two numbers of which some are unknown, null and empty arrays
for two line numbers; promotion dimension = nation; seller = supplier; review =
line item of the part with ``l_quantity`` as its score.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.functions.numeric import exact_mean
from tidewater.functions.structs import map_text
from tidewater.operators import joins
from tidewater.operators.aggregates import keep_latest
from tidewater.operators.projections import select_sorted
from tidewater.plans.registry import register
from tidewater.sinks.keyed import KeyedTable, keyed_upsert
from tidewater.sources.tables import read_table


def review_stats(reviews: DataFrame, key: str = "product_id", score: str = "score", review_id: str | None = None, exact_scale: int | None = None) -> DataFrame:
    """Mean score and review count per product. ``exact_scale``: the scores
    are declared fixed-point with so many decimals, the mean is then exact."""
    counted = F.count(review_id) if review_id else F.count(F.lit(1))
    mean = F.avg(score) if exact_scale is None else exact_mean(score, exact_scale)
    return reviews.groupBy(key).agg(mean.alias("review_mean_score"), counted.alias("review_count"))


def build_catalog(
    products: DataFrame,
    categories: DataFrame,
    reviews_stats: DataFrame,
    items: DataFrame,
    sellers: DataFrame,
    promotions: DataFrame | None = None,
    promotion_lists: DataFrame | None = None,
) -> DataFrame:
    """products(product_id, product_name, category_ids), categories(category_id, category_name),
    reviews_stats(product_id, ...), items(product_id, seller_id, [promotion_ids], ...),
    sellers(seller_id, seller_name), optional promotions(promotion_id, name)
    -> one row per item, columns sorted by name.

    ``category_ids`` becomes ``categories`` map<id, name> per product and, when
    promotions are given, ``promotion_ids`` becomes ``promotions`` map<id, name>
    per item (unknown ids dropped; null or empty lists give an empty map).
    ``promotion_lists``: as ``lists_of`` of ``ids_to_map``.
    """
    with_categories = joins.ids_to_map(products, "category_ids", categories, "category_id", "category_name", "categories")
    product_level = with_categories.join(reviews_stats, "product_id", "left")
    if promotions is not None:
        items = joins.ids_to_map(items, "promotion_ids", promotions, "promotion_id", "name", "promotions", promotion_lists)
    item_level = items.join(sellers, "seller_id", "left")
    return select_sorted(product_level.join(item_level, "product_id", "inner"))


def _brand_no(col: str = "p_brand"):
    return F.regexp_extract(F.col(col), r"#(\d+)", 1).cast("int")


def _inputs(spark: SparkSession, d: str):
    part = read_table(spark, d, "part", "p_partkey", "p_name", "p_brand", "p_size")
    products = part.select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.when(F.col("p_size") == 2, F.array().cast("array<int>"))
        .when(F.col("p_size") != 1, F.array(_brand_no(), F.col("p_size").cast("int"), F.lit(None).cast("int")))
        .alias("category_ids"),
    )
    categories = part.select(_brand_no().alias("category_id"), F.col("p_brand").alias("category_name")).distinct()
    li = read_table(spark, d, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_shipdate")
    reviews = li.select(F.col("l_partkey").alias("product_id"), F.col("l_quantity").alias("score"))
    items = li.select(
        F.col("l_orderkey").alias("item_order"),
        F.col("l_linenumber").alias("item_line"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("seller_id"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_shipdate").alias("ship_date"),
        F.when(F.col("l_linenumber") == 2, F.array().cast("array<int>"))
        .when(F.col("l_linenumber") != 3, F.array((F.col("l_suppkey") % 40).cast("int"), (F.col("l_partkey") % 30).cast("int")))
        .alias("promotion_ids"),
    )
    sellers = read_table(spark, d, "supplier", "s_suppkey", "s_name").select(
        F.col("s_suppkey").alias("seller_id"), F.col("s_name").alias("seller_name")
    )
    promotions = read_table(spark, d, "nation", "n_nationkey", "n_name").select(
        F.col("n_nationkey").alias("promotion_id"), F.col("n_name").alias("name")
    )
    return products, categories, reviews, items, sellers, promotions


_BRAND_SQL = r"CAST(regexp_extract(p_brand, '#(\d+)', 1) AS INTEGER)"
_CATEGORY_MAP_SQL = f"""
categories AS (SELECT DISTINCT {_BRAND_SQL} AS category_id, p_brand AS category_name FROM part),
product_maps AS (
  SELECT p_partkey AS product_id, any_value(p_name) AS product_name,
         coalesce(string_agg(CAST(category_id AS VARCHAR) || ':' || category_name, ','
                             ORDER BY category_id) FILTER (WHERE category_name IS NOT NULL), '') AS categories
  FROM part LEFT JOIN categories ON p_size NOT IN (1, 2) AND category_id IN ({_BRAND_SQL}, p_size)
  GROUP BY p_partkey)
"""

_REVIEWS_SQL = """
reviews AS (SELECT l_partkey AS product_id, round(avg(l_quantity), 9) AS review_mean_score,
                   count(*) AS review_count FROM lineitem GROUP BY l_partkey)
"""


@register("review_stats", "WITH " + _REVIEWS_SQL + " SELECT * FROM reviews", ("A14",))
def review_stats_q(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(review_stats(_inputs(spark, d)[2], exact_scale=2))


def _rounded(stats: DataFrame) -> DataFrame:
    return stats.withColumn("review_mean_score", F.round("review_mean_score", 9))


@register(
    "array_lookup_map",
    "WITH " + _CATEGORY_MAP_SQL + " SELECT product_id, categories FROM product_maps",
    ("J15", "E21", "U3"),
)
def array_lookup_map(spark: SparkSession, d: str) -> DataFrame:
    products, categories, *_ = _inputs(spark, d)
    mapped = joins.ids_to_map(products, "category_ids", categories, "category_id", "category_name", "categories")
    return mapped.select("product_id", map_text("categories").alias("categories"))


@register(
    "central_catalog",
    "WITH "
    + _CATEGORY_MAP_SQL
    + ", "
    + _REVIEWS_SQL
    + """,
items AS (
  SELECT * FROM lineitem
  QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                             ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) = 1),
item_maps AS (
  SELECT l_orderkey, l_linenumber,
         coalesce(string_agg(CAST(n_nationkey AS VARCHAR) || ':' || n_name, ',' ORDER BY n_nationkey) FILTER (WHERE n_name IS NOT NULL), '') AS promotions
  FROM items LEFT JOIN nation ON l_linenumber NOT IN (2, 3) AND n_nationkey IN (l_suppkey % 40, l_partkey % 30)
  GROUP BY l_orderkey, l_linenumber)
SELECT pm.categories, l_linenumber AS item_line, l_orderkey AS item_order, l_extendedprice AS price,
       pm.product_id, pm.product_name, im.promotions, r.review_count, r.review_mean_score, l_suppkey AS seller_id,
       s_name AS seller_name, l_shipdate AS ship_date
FROM product_maps pm LEFT JOIN reviews r USING (product_id)
JOIN items ON l_partkey = pm.product_id
JOIN item_maps im USING (l_orderkey, l_linenumber)
LEFT JOIN supplier ON l_suppkey = s_suppkey
""",
    ("C5", "J14", "P1", "P5", "K9"),
)
def central_catalog(spark: SparkSession, d: str) -> DataFrame:
    """The catalog, written to a table keyed by item and read back from it."""
    products, categories, reviews, items, sellers, promotions = _inputs(spark, d)
    stats = _rounded(review_stats(reviews, exact_scale=2))
    keys = ["item_order", "item_line"]
    # the stand-in's key repeats: the last shipped row is the item
    latest = keep_latest(items, keys, ["ship_date", "product_id", "seller_id", "price"])
    catalog = build_catalog(products, categories, stats, latest, sellers, promotions, items)
    stored = KeyedTable.create(catalog, keys, ["product_id"], "catalog", unique=True).read()
    return stored.withColumns({c: map_text(c) for c in ("categories", "promotions")})


@register(
    "keyed_upsert",
    """
    SELECT l_partkey, l_orderkey, l_linenumber, l_shipdate, l_quantity FROM lineitem
    QUALIFY row_number() OVER (PARTITION BY l_partkey ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC) = 1
    """,
    ("K9",),
)
def keyed_upsert_q(spark: SparkSession, d: str) -> DataFrame:
    li = read_table(spark, d, "lineitem", "l_partkey", "l_orderkey", "l_linenumber", "l_shipdate", "l_quantity")
    cutoff = F.lit("1998-01-01 00:00:00").cast("timestamp_ntz")
    target = li.filter(F.col("l_shipdate") < cutoff)
    updates = li.filter(F.coalesce(F.col("l_shipdate") >= cutoff, F.lit(True)))  # a row without a date, too
    return keyed_upsert(target, updates, ["l_partkey"], ["l_shipdate", "l_orderkey", "l_linenumber"], "latest_shipment")
