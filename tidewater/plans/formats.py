"""Text-format sources at table scale (S2-S5, S7, ST2, ST3, ST5).

Spark writes a TESTDATA table as CSV / JSON files below the shared folder (in
many part files), and the reader under test reads them back with a declared
schema; the result must equal the table. This runs the readers over the whole
table, so their work grows with it, and checks quoting, typed parsing of
timestamps and doubles, and glob paths.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.functions.temporal import DAY_FIRST_DATE_FORMAT, instant_to_ntz, month_of
from tidewater.operators import aggregates as agg
from tidewater.plans.access_log import parse_log_lines, render_log_lines
from tidewater.plans.fire_calls import YEAR, calls_of_year
from tidewater.plans.registry import register
from tidewater.session import shared_path, unique_name
from tidewater.sinks.tables import write_text_table
from tidewater.sources import files
from tidewater.sources.tables import read_table
from tidewater.streaming import csv_stream, json_stream, parse_csv_lines, parse_json_lines, run_append, text_stream

EVENTS_SCHEMA = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"
CUSTOMER_SCHEMA = "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING"
ORDERS_SCHEMA = (
    "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
    "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING"
)


def _written(spark: SparkSession, df: DataFrame, fmt: str, name: str, header: bool = False) -> str:
    return write_text_table(df, shared_path(spark, "tables", name), fmt, header)


@register("csv_roundtrip", "SELECT * FROM events", ("S2", "S3", "S4"))
def csv_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """S4 (+ S3 glob, S2 typed positional fields): headerless CSV with a declared schema."""
    path = _written(spark, read_table(spark, d, "events"), "csv", "events_csv")
    return files.read_delimited(spark, f"{path}/part-*.csv", EVENTS_SCHEMA)


@register("csv_header_roundtrip", "SELECT * FROM customer", ("S5",))
def csv_header_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """CSV with a header line and a declared schema."""
    path = _written(spark, read_table(spark, d, "customer"), "csv", "customer_csv", header=True)
    return files.read_delimited(spark, path, CUSTOMER_SCHEMA, header=True)


@register("json_roundtrip", "SELECT * FROM orders", ("S7",))
def json_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """JSON lines with a declared schema (typed timestamps and doubles)."""
    path = _written(spark, read_table(spark, d, "orders"), "json", "orders_json")
    return files.read_json_lines(spark, path, ORDERS_SCHEMA)


@register("stream_csv_source", "SELECT * FROM events", ("ST3",))
def stream_csv_source(spark: SparkSession, d: str) -> DataFrame:
    """ST3: a folder of CSV files as a stream with a declared schema."""
    path = _written(spark, read_table(spark, d, "events"), "csv", "events_csv_stream")
    return run_append(csv_stream(spark, path, EVENTS_SCHEMA), "csv_source")


@register("stream_text_parse", "SELECT * FROM customer", ("ST1", "ST2", "ST5", "S1"))
def stream_text_parse(spark: SparkSession, d: str) -> DataFrame:
    """ST1 + ST2 + ST5: new text files (which stand in for a socket) read as lines, each
    line parsed by ``from_csv``."""
    path = _written(spark, read_table(spark, d, "customer"), "csv", "customer_lines")
    lines = text_stream(spark, path)
    return run_append(parse_csv_lines(lines, CUSTOMER_SCHEMA), "text_parse")


@register(
    "calls_by_month_from_text",
    f"""
    SELECT CAST(month(o_orderdate) AS INTEGER) AS month, count(*) AS count
    FROM orders WHERE year(o_orderdate) = {YEAR} GROUP BY 1
    """,
    ("E12", "F9", "S5", "A8"),
)
def calls_by_month_from_text(spark: SparkSession, d: str) -> DataFrame:
    """Call dates arrive as ``dd/MM/yyyy`` text in a CSV with a header;
    the year filter and the month come from the parsed date (text that does
    not parse is null, not an error)."""
    orders = read_table(spark, d, "orders", "o_orderkey", "o_orderdate").select(
        "o_orderkey", F.date_format("o_orderdate", DAY_FIRST_DATE_FORMAT).alias("CallDate")
    )
    path = _written(spark, orders, "csv", "calls_csv", header=True)
    calls = files.read_delimited(spark, path, "o_orderkey BIGINT, CallDate STRING", header=True)
    in_year = calls_of_year(calls, "CallDate", YEAR, DAY_FIRST_DATE_FORMAT)
    return agg.count_by(in_year, [month_of("CallDate", DAY_FIRST_DATE_FORMAT).alias("month")])


@register(
    "log_file_count_by_method",
    "SELECT upper(event_type) AS method, count(*) AS count FROM events GROUP BY 1",
    ("S1", "S2", "A2"),
)
def log_file_count_by_method(spark: SparkSession, d: str) -> DataFrame:
    """The access log as real text files (written by Spark from ``events``),
    read back line by line with ``read.text``, parsed, counted per method."""
    events = read_table(spark, d, "events", "user_id", "ts", "event_type", "props")
    path = shared_path(spark, "tables", "access_log_text")
    render_log_lines(events).write.mode("overwrite").text(path)
    return agg.count_by(parse_log_lines(files.read_lines(spark, path)), ["method"])



@register("csv_inferred", "SELECT * FROM customer", ("S6",))
def csv_inferred(spark: SparkSession, d: str) -> DataFrame:
    """CSV with a header and an inferred schema."""
    path = _written(spark, read_table(spark, d, "customer"), "csv", "customer_inferred", header=True)
    return files.infer_csv(spark, path)


@register("json_inferred", "SELECT * FROM part", ("S8",))
def json_inferred(spark: SparkSession, d: str) -> DataFrame:
    """JSON lines with an inferred schema."""
    return files.infer_json(spark, _written(spark, read_table(spark, d, "part"), "json", "part_inferred"))


@register("stream_json_source", "SELECT * FROM events", ("ST4",))
def stream_json_source(spark: SparkSession, d: str) -> DataFrame:
    """ST4: a folder of JSON-lines files as a stream with a declared schema."""
    path = _written(spark, read_table(spark, d, "events"), "json", "events_json_stream")
    return run_append(json_stream(spark, path, EVENTS_SCHEMA), "json_source")


@register("stream_json_lines", "SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders", ("ST6",))
def stream_json_lines(spark: SparkSession, d: str) -> DataFrame:
    """ST6: JSON lines read as text from a stream, parsed with a declared schema."""
    orders = read_table(spark, d, "orders", "o_orderkey", "o_orderpriority", "o_totalprice")
    lines = text_stream(spark, _written(spark, orders, "json", "orders_json_lines"))
    parsed = parse_json_lines(lines, "o_orderkey BIGINT, o_orderpriority STRING, o_totalprice DOUBLE")
    return run_append(parsed, "json_lines")


TURNS_NESTED = 100


@register(
    "json_nested",
    """
    SELECT conv_id, count(*) AS turns, count(*) FILTER (WHERE role = 'assistant') AS answers, bool_or(role = 'system') AS has_system,
           TIMESTAMP '1970-01-01' + to_minutes(conv_id) AS at
    FROM conversations GROUP BY conv_id
    """,
    ("S7",),
)
def json_nested(spark: SparkSession, d: str) -> DataFrame:
    """JSON with arrays, a map, a boolean and a time in epoch seconds, written and
    read with a declared schema. A nested row holds the turns of one role among
    ``TURNS_NESTED`` turn numbers, each with its number of rows, so a conversation of
    any length, or with repeated turns, is many small rows."""
    part = F.expr(f"turn div {TURNS_NESTED}").alias("part")
    counted = read_table(spark, d, "conversations", "conv_id", "turn", "role").groupBy("conv_id", "turn", "role").agg(F.count(F.lit(1)).alias("n"))
    entry = F.struct(F.coalesce(F.col("turn").cast("string"), F.lit("")).alias("turn"), "role", "n")
    conv = counted.groupBy("conv_id", part, "role").agg(F.collect_list(entry).alias("e")).select(
        "conv_id",
        F.transform("e", lambda e: e["role"]).alias("roles"),
        F.transform("e", lambda e: e["n"]).alias("times"),
        F.map_from_entries(F.transform("e", lambda e: F.struct(e["turn"], e["role"]))).alias("by_turn"),
        (F.col("role") == "system").alias("has_system"),
    )
    path = _written(spark, conv.withColumn("at", F.col("conv_id") * 60), "json", "conversations_nested")
    schema = "conv_id BIGINT, roles ARRAY<STRING>, times ARRAY<BIGINT>, by_turn MAP<STRING, STRING>, has_system BOOLEAN, at TIMESTAMP"
    back = files.read_json_lines(spark, path, schema)
    total = lambda counts: F.aggregate(counts, F.lit(0).cast("long"), lambda s, n: s + n)
    answers = F.zip_with("roles", "times", lambda r, n: F.when(r == "assistant", n).otherwise(F.lit(0)))
    return back.groupBy("conv_id").agg(
        F.sum(total(F.col("times"))).alias("turns"),
        F.sum(total(answers)).alias("answers"),
        F.bool_or("has_system").alias("has_system"),
        F.min(instant_to_ntz("at")).alias("at"),
    )


@register(
    "cast_timestamp",
    "SELECT event_id, date_trunc('second', ts) AS time, CAST(hour(ts) AS INTEGER) AS hour FROM events",
    ("E11",),
)
def cast_timestamp(spark: SparkSession, d: str) -> DataFrame:
    """Default parse of time text, in SQL text."""
    text = read_table(spark, d, "events", "event_id", "ts").select("event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("t"))
    view = unique_name("time_text")
    text.createOrReplaceTempView(view)
    return spark.sql(f"SELECT event_id, TRY_CAST(t AS TIMESTAMP_NTZ) AS time, hour(TRY_CAST(t AS TIMESTAMP_NTZ)) AS hour FROM {view}")


@register(
    "sql_count_by_alias",
    """
    SELECT CAST(hour(ts) AS INTEGER) AS hour, CAST(minute(ts) AS INTEGER) AS minute, count(*) AS count
    FROM events GROUP BY 1, 2
    """,
    ("A3", "A12"),
)
def sql_count_by_alias(spark: SparkSession, d: str) -> DataFrame:
    """A3 / A12 as SQL text, grouped by select aliases."""
    view = unique_name("events_sql")
    read_table(spark, d, "events", "ts").createOrReplaceTempView(view)
    return spark.sql(f"SELECT hour(ts) AS hour, minute(ts) AS minute, count(*) AS count FROM {view} GROUP BY hour, minute ORDER BY hour, minute")
