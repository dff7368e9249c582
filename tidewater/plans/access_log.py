"""Access-log analysis (C2, C3; A2-A6, F1-F4, S2, E4-E7, E10-E14).

Stand-in input: every ``events`` row becomes one access-log line, derived by
Spark from the table (so the work grows with it):

    <user_id> | [dd/MMM/yyyy:HH:mm:ss] | "<EVENT_TYPE> /<props.k> HTTP/1.1" | <status>

``parse_log_lines`` is the reference's text parser as column expressions:
strip, split on " | ", positional fields, brackets and quotes removed, the
time parsed with its pattern. ``log_frame`` is the typed form of the same log
(the CSV-with-schema variant): ip, timestamp, method, endpoint, status_code,
latency.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.functions.strings import first_token, split_on, strip_chars
from tidewater.functions.temporal import ACCESS_LOG_TIME_FORMAT, hour_minute, parse_time
from tidewater.operators import aggregates as agg
from tidewater.operators import filters as flt
from tidewater.plans.registry import register
from tidewater.sources.tables import read_table

# Fixed values of the log text format.
FIELD_SEP = " | "
PROTOCOL = "HTTP/1.1"


def status_of(event_type: Column) -> Column:
    """Stand-in status code: error -> 404, signup -> 201, anything else -> 200."""
    return F.when(event_type == "error", "404").when(event_type == "signup", "201").otherwise("200")


_STATUS_SQL = "CASE event_type WHEN 'error' THEN '404' WHEN 'signup' THEN '201' ELSE '200' END"
_K_SQL = "json_extract_string(props, '$.k')"


def render_log_lines(events: DataFrame) -> DataFrame:
    """events -> one text line per event (column ``value``)."""
    k = F.get_json_object("props", "$.k")
    request = F.concat(F.lit('"'), F.upper("event_type"), F.lit(" /"), k, F.lit(f' {PROTOCOL}"'))
    when = F.concat(F.lit("["), F.date_format("ts", ACCESS_LOG_TIME_FORMAT), F.lit("]"))
    return events.select(
        F.concat_ws(FIELD_SEP, F.col("user_id").cast("string"), when, request, status_of(F.col("event_type"))).alias("value")
    )


def parse_log_lines(lines: DataFrame, source: str = "value") -> DataFrame:
    """Text line -> ip, time, method, endpoint, status."""
    parts = split_on(F.trim(F.col(source)), FIELD_SEP)
    request = strip_chars(F.get(parts, 2), '"')
    return lines.select(
        F.get(parts, 0).alias("ip"),
        parse_time(strip_chars(F.get(parts, 1), "[]"), ACCESS_LOG_TIME_FORMAT).alias("time"),
        first_token(request).alias("method"),
        F.get(F.split(request, " ", -1), 1).alias("endpoint"),
        F.get(parts, 3).alias("status"),
        request.alias("request"),
    )


def log_frame(events: DataFrame) -> DataFrame:
    """Typed log (the DataFrame / SQL variant of the reference's log analysis)."""
    return events.select(
        F.col("user_id").cast("string").alias("ip"),
        F.col("ts").alias("timestamp"),
        F.upper("event_type").alias("method"),
        F.concat(F.lit("/"), F.get_json_object("props", "$.k")).alias("endpoint"),
        status_of(F.col("event_type")).alias("status_code"),
        F.col("value").alias("latency"),
    )


LOG_CTE_SQL = f"""
WITH logs AS (
  SELECT CAST(user_id AS VARCHAR) AS ip, ts AS timestamp, upper(event_type) AS method,
         '/' || {_K_SQL} AS endpoint, {_STATUS_SQL} AS status_code, value AS latency
  FROM events)
"""

_PARSED_CTE = f"""
WITH parsed AS (
  SELECT CAST(user_id AS VARCHAR) AS ip, date_trunc('second', ts) AS time, upper(event_type) AS method,
         '/' || {_K_SQL} AS endpoint, {_STATUS_SQL} AS status,
         upper(event_type) || ' /' || {_K_SQL} || ' {PROTOCOL}' AS request
  FROM events)
"""


def _parsed(spark: SparkSession, d: str) -> DataFrame:
    events = read_table(spark, d, "events", "user_id", "ts", "event_type", "props")
    return parse_log_lines(render_log_lines(events))


def _logs(spark: SparkSession, d: str) -> DataFrame:
    return log_frame(read_table(spark, d, "events", "user_id", "ts", "event_type", "props", "value"))


@register("log_parse", _PARSED_CTE + "SELECT ip, time, method, endpoint, status, request FROM parsed",
          ("S2", "E2", "E4", "E5", "E7", "E10"))
def log_parse(spark: SparkSession, d: str) -> DataFrame:
    return _parsed(spark, d)


@register(
    "count_by_method",
    _PARSED_CTE + "SELECT method, count(*) AS count FROM parsed GROUP BY method ORDER BY method",
    ("A2", "C2"),
)
def count_by_method(spark: SparkSession, d: str) -> DataFrame:
    return agg.count_by(_parsed(spark, d), ["method"]).orderBy("method")


@register(
    "count_by_minute",
    _PARSED_CTE
    + """SELECT CAST(hour(time) AS INTEGER) AS hour, CAST(minute(time) AS INTEGER) AS minute, count(*) AS count
         FROM parsed GROUP BY 1, 2 ORDER BY 1, 2""",
    ("A3", "E13"),
)
def count_by_minute(spark: SparkSession, d: str) -> DataFrame:
    p = _parsed(spark, d)
    return agg.count_by(p, [F.hour("time").alias("hour"), F.minute("time").alias("minute")]).orderBy("hour", "minute")


@register(
    "log_filter_404",
    _PARSED_CTE + "SELECT ip, time, method, endpoint, status, request FROM parsed WHERE status = '404'",
    ("F2",),
)
def log_filter_404(spark: SparkSession, d: str) -> DataFrame:
    return flt.where_equal(_parsed(spark, d), status="404")


@register(
    "log_filter_2xx",
    _PARSED_CTE + "SELECT ip, time, method, endpoint, status, request FROM parsed WHERE starts_with(status, '2')",
    ("F3",),
)
def log_filter_2xx(spark: SparkSession, d: str) -> DataFrame:
    return flt.where_prefix(_parsed(spark, d), "status", "2")


@register(
    "log_filter_prefix_contains",
    _PARSED_CTE
    + "SELECT ip, time, method, endpoint, status, request FROM parsed "
    "WHERE starts_with(request, 'PURCHASE') AND contains(request, '/4')",
    ("F4",),
)
def log_filter_prefix_contains(spark: SparkSession, d: str) -> DataFrame:
    return flt.where_prefix_contains(_parsed(spark, d), "request", "PURCHASE", "/4")


@register(
    "group_list",
    _PARSED_CTE + "SELECT status, method, ip, count(*) AS occurrences FROM parsed GROUP BY status, method, ip",
    ("A4",),
)
def group_list(spark: SparkSession, d: str) -> DataFrame:
    return agg.member_multiset(_parsed(spark, d), ["status", "method"], "ip")


_STATS_SELECT = """
SELECT method, endpoint, max(latency) AS max_latency, min(latency) AS min_latency, round(avg(latency), 9) AS mean_latency
FROM logs {where} GROUP BY method, endpoint
"""


def _latency_stats(df: DataFrame) -> DataFrame:
    # latencies are declared fixed-point with 2 decimals: exact sums
    names = ("max_latency", "min_latency", "mean_latency")
    stats = agg.min_max_mean(df, ["method", "endpoint"], "latency", names, exact_scale=2)
    return stats.withColumn("mean_latency", F.round("mean_latency", 9))


@register("latency_stats", LOG_CTE_SQL + _STATS_SELECT.format(where=""), ("A5",))
def latency_stats(spark: SparkSession, d: str) -> DataFrame:
    return _latency_stats(_logs(spark, d))


def filter_status_endpoint_log(df: DataFrame, status: str = "404", endpoint: str = "/7") -> DataFrame:
    """F1 on the typed log: ``status_code == s & endpoint == e``."""
    return flt.where_equal(df, status_code=status, endpoint=endpoint)


@register(
    "filtered_latency_stats",
    LOG_CTE_SQL + _STATS_SELECT.format(where="WHERE status_code = '404' AND endpoint = '/7'"),
    ("C3", "F1", "A5"),
)
def filtered_latency_stats(spark: SparkSession, d: str) -> DataFrame:
    return _logs(spark, d).transform(filter_status_endpoint_log).transform(_latency_stats)


@register(
    "minute_set",
    LOG_CTE_SQL
    + """, pairs AS (
        SELECT CAST(hour(timestamp) AS INTEGER) AS hour, CAST(minute(timestamp) AS INTEGER) AS minute, ip,
               count(ip) AS member_rows
        FROM logs GROUP BY 1, 2, 3)
    SELECT hour, minute, ip, member_rows,
           CAST(sum(member_rows) OVER (PARTITION BY hour, minute) AS BIGINT) AS group_rows,
           count(ip) OVER (PARTITION BY hour, minute) AS group_distinct
    FROM pairs""",
    ("A6", "E14"),
)
def minute_set(spark: SparkSession, d: str) -> DataFrame:
    logs = _logs(spark, d)
    hour, minute = hour_minute("timestamp")
    return agg.distinct_members(logs.select(hour, minute, "ip"), ["hour", "minute"], "ip")
