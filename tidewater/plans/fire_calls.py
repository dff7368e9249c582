"""Calls of one year (C4): the year's calls by type (most common first), by
month, per address in one city, the five slowest, and a parquet copy.

Stand-in (TESTDATA): a call = an order; date = ``o_orderdate``, type =
``o_orderpriority``, delay = ``o_totalprice``, address = customer name, city =
the customer's nation. The year filter is a timestamp range pushed to the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.operators import aggregates as agg
from tidewater.operators import filters as flt
from tidewater.plans.registry import register
from tidewater.sources.tables import read_table

YEAR = 1998
CITY = "NATION_7"


def calls_of_year(calls: DataFrame, date_col: str, year: int, fmt: str | None = None) -> DataFrame:
    """The year filter every question starts from (string dates parsed with ``fmt``)."""
    return flt.where_year(calls, date_col, year, fmt)


def types_by_frequency(calls: DataFrame, type_col: str) -> DataFrame:
    """Q1: every call type of the year, most frequent first."""
    return agg.count_by(flt.where_not_null(calls, type_col), [type_col]).orderBy(F.col("count").desc(), type_col)


def calls_per_address(calls: DataFrame, address_col: str) -> DataFrame:
    """Q3: calls per address, most first."""
    return agg.count_by(calls, [address_col]).orderBy(F.col("count").desc(), address_col)


@register(
    "year_top_types",
    f"""
    SELECT o_orderpriority, count(*) AS count FROM orders
    WHERE year(o_orderdate) = {YEAR} AND o_orderpriority IS NOT NULL
    GROUP BY o_orderpriority ORDER BY count DESC, o_orderpriority
    """,
    ("C4", "A7", "F7", "F9"),
)
def year_top_types(spark: SparkSession, d: str) -> DataFrame:
    calls = calls_of_year(read_table(spark, d, "orders", "o_orderdate", "o_orderpriority"), "o_orderdate", YEAR)
    return types_by_frequency(calls, "o_orderpriority")


@register(
    "year_calls_per_address",
    f"""
    SELECT c_name, count(*) AS count
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    WHERE year(o_orderdate) = {YEAR} AND n_name = '{CITY}'
    GROUP BY c_name ORDER BY count DESC, c_name
    """,
    ("C4", "A9", "F2"),
)
def year_calls_per_address(spark: SparkSession, d: str) -> DataFrame:
    calls = calls_of_year(read_table(spark, d, "orders", "o_custkey", "o_orderdate"), "o_orderdate", YEAR)
    nation = read_table(spark, d, "nation", "n_nationkey", "n_name").filter(F.col("n_name") == CITY)
    cust = read_table(spark, d, "customer", "c_custkey", "c_name", "c_nationkey")
    in_city = cust.join(nation, cust["c_nationkey"] == nation["n_nationkey"])  # nation: broadcast by its statistics
    located = calls.join(in_city, calls["o_custkey"] == in_city["c_custkey"])
    return calls_per_address(located, "c_name")
