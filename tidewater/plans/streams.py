"""Structured Streaming queries (ST1-ST21) over TESTDATA tables read as streams.

Each query runs to the end of its input (``availableNow``) and returns the
sink's content as a batch DataFrame. Stand-ins: traffic / stock streams =
``events`` (event_type as domain / ticker, value as count / volume), the book
stream = ``orders``, authors = ``customer``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.functions.numeric import exact_sum, is_finer, units_or_null
from tidewater.functions.temporal import instant_to_ntz
from tidewater.operators import ranking
from tidewater.plans.access_log import LOG_CTE_SQL, filter_status_endpoint_log, log_frame
from tidewater.plans.registry import register
from tidewater.session import parallelism, shared_path
from tidewater.sources.tables import read_table
from tidewater.streaming import sinks, sources, windows
from tidewater.streaming.joins import stream_static_join, stream_stream_join


def _events(spark: SparkSession, d: str) -> DataFrame:
    """The events as a stream; values that are not fixed-point with 2 decimals are
    counted in the query's progress (``rejected``) and left out of sums."""
    return sources.table_stream(spark, d, "events").observe("rejected", F.count_if(is_finer("value")).alias("values"))


def _in_full(sums: DataFrame) -> DataFrame:
    """Sums of units as values. Values are declared fixed-point with 2 decimals,
    so totals don't depend on the order in which rows arrive."""
    return sums.withColumn("total", F.col("total") / 100)


_HOUR_SQL = "date_trunc('hour', ts)"
_FIVE_MIN_SQL = "date_trunc('hour', ts) + to_minutes(CAST(minute(ts) // 5 * 5 AS BIGINT))"


@register(
    "stream_tumbling",
    f"""
    SELECT {_HOUR_SQL} AS start, {_HOUR_SQL} + INTERVAL 1 HOUR AS "end", round(sum(value), 2) AS total
    FROM events GROUP BY 1
    """,
    ("ST12", "ST16"),
)
def stream_tumbling(spark: SparkSession, d: str) -> DataFrame:
    agg = windows.windowed_sum(_events(spark, d), "ts", units_or_null("value"), "1 hour")
    out = sinks.run_keyed(agg, "tumbling", ["start"], mode="complete")
    return _in_full(out)


@register(
    "stream_sliding",
    f"""
    SELECT start, start + INTERVAL 2 HOUR AS "end", round(sum(value), 2) AS total
    FROM (SELECT {_HOUR_SQL} AS start, value FROM events
          UNION ALL SELECT {_HOUR_SQL} - INTERVAL 1 HOUR, value FROM events)
    GROUP BY start
    """,
    ("ST11",),
)
def stream_sliding(spark: SparkSession, d: str) -> DataFrame:
    agg = windows.windowed_sum(_events(spark, d), "ts", units_or_null("value"), "2 hours", "1 hour")
    out = sinks.run_keyed(agg, "sliding", ["start"], mode="complete")
    return _in_full(out)


_DOMAIN_HOUR_SQL = f"""
    SELECT {_HOUR_SQL} AS start, {_HOUR_SQL} + INTERVAL 1 HOUR AS "end", event_type AS domain,
           round(sum(value), 2) AS total
    FROM events GROUP BY 1, 3
"""


@register("stream_domain_hour", _DOMAIN_HOUR_SQL, ("ST13", "T4"))
def stream_domain_hour(spark: SparkSession, d: str) -> DataFrame:
    ev = _events(spark, d).withColumnRenamed("event_type", "domain")
    agg = windows.windowed_sum(ev, "ts", units_or_null("value"), "1 hour", keys=["domain"])
    out = sinks.run_keyed(agg, "domain_hour", ["start", "domain"], mode="complete")
    return _in_full(out).orderBy("start", F.col("total").desc())


@register(
    "top_per_hour",
    f"""
    SELECT start, "end", domain, total FROM ({_DOMAIN_HOUR_SQL})
    QUALIFY rank() OVER (PARTITION BY start ORDER BY total DESC) = 1
    """,
    ("W1", "T4"),
)
def top_per_hour(spark: SparkSession, d: str) -> DataFrame:
    """W1 (batch): the domain with the largest hourly total, ties kept (rank)."""
    ev = read_table(spark, d, "events", "ts", "event_type", "value").withColumnRenamed("event_type", "domain")
    hourly = ev.groupBy(F.window("ts", "1 hour").alias("w"), "domain").agg(exact_sum("value").alias("total"))
    flat = hourly.select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), "domain", "total")
    return ranking.rank_first(flat, ["start"], [F.col("total").desc()]).drop("rank")


@register(
    "stream_top_domain",
    f"""
    WITH h AS ({_DOMAIN_HOUR_SQL})
    SELECT start, "end", domain, total FROM h
    WHERE "end" <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE
    QUALIFY row_number() OVER (PARTITION BY start ORDER BY total DESC, domain DESC) = 1
    """,
    ("ST13", "W1", "ST15"),
)
def stream_top_domain(spark: SparkSession, d: str) -> DataFrame:
    """The domain with the most traffic in each hour, on the stream itself:
    chained aggregation in append mode; the hours still open at the end of the
    input (within the 10-minute watermark) are not emitted yet."""
    ev = _events(spark, d).withColumnRenamed("event_type", "domain")
    top = windows.top_item_per_window(ev, "ts", "domain", units_or_null("value"), "1 hour", "10 minutes")
    return _in_full(sinks.run_append(top, "top_domain"))


@register(
    "stream_watermark",
    f"""
    SELECT {_FIVE_MIN_SQL} AS start, {_FIVE_MIN_SQL} + INTERVAL 5 MINUTE AS "end", round(sum(value), 2) AS total
    FROM events GROUP BY 1
    """,
    ("ST15", "ST16"),
)
def stream_watermark(spark: SparkSession, d: str) -> DataFrame:
    """Update mode, 10-minute watermark, 5-minute windows: rows later than the
    watermark are dropped; each micro-batch emits the windows it changed."""
    agg = windows.windowed_sum(_events(spark, d), "ts", units_or_null("value"), "5 minutes", watermark="10 minutes")
    out = sinks.run_keyed(agg, "watermark", ["start"], mode="update")
    return _in_full(out)


@register(
    "stream_append_watermark",
    f"""
    SELECT {_FIVE_MIN_SQL} AS start, {_FIVE_MIN_SQL} + INTERVAL 5 MINUTE AS "end", round(sum(value), 2) AS total
    FROM events GROUP BY 1
    HAVING {_FIVE_MIN_SQL} + INTERVAL 5 MINUTE <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE
    """,
    ("ST15", "ST16"),
)
def stream_append_watermark(spark: SparkSession, d: str) -> DataFrame:
    """Append mode: a window is written once, when the watermark (max event
    time - 10 minutes) has passed its end; the still-open tail is not emitted."""
    agg = windows.windowed_sum(_events(spark, d), "ts", units_or_null("value"), "5 minutes", watermark="10 minutes")
    return _in_full(sinks.run_append(agg, "append_watermark"))


@register(
    "stream_processing_time",
    "SELECT CAST(sum(length(text)) AS BIGINT) AS total_chars FROM documents",
    ("ST14", "E8", "E15"),
)
def stream_processing_time(spark: SparkSession, d: str) -> DataFrame:
    """ST14: characters per 5-second processing-time window; the window split
    depends on arrival time, so the checked result is the total over windows."""
    docs = sources.table_stream(spark, d, "documents")
    agg = windows.processing_time_sum(docs, F.length("text"), "5 seconds", "chars")
    out = sinks.run_keyed(agg, "processing_time", ["start"], mode="complete")
    return out.agg(F.sum("chars").cast("long").alias("total_chars"))


@register(
    "stream_arrival_windows",
    """
    WITH log AS (SELECT event_id, value, ts + to_seconds(CAST(event_id * 7919 % 900 AS BIGINT)) AS arrival FROM events)
    SELECT date_trunc('hour', arrival) + to_minutes(CAST(minute(arrival) // 10 * 10 AS BIGINT)) AS start,
           date_trunc('hour', arrival) + to_minutes(CAST(minute(arrival) // 10 * 10 + 10 AS BIGINT)) AS "end",
           count(*) AS rows, round(sum(value), 2) AS total
    FROM log GROUP BY ALL
    """,
    ("ST14", "ST16"),
)
def stream_arrival_windows(spark: SparkSession, d: str) -> DataFrame:
    """ST14, each window: rows are logged with the time they came in, and a second
    stream over the log counts by that time. The clock of this query lets an event
    arrive up to 15 minutes after its own time; the log then is what counts."""
    events = _events(spark, d).select("event_id", "ts", "value")
    clock = F.col("ts") + F.make_dt_interval(secs=(F.col("event_id") * 7919 % 900).cast("decimal(18,6)"))
    location = shared_path(spark, "streams", "arrivals")
    log = sinks.record_arrivals(events, "arrivals", clock, location)
    logged = spark.readStream.schema(log.schema).parquet(f"{location}/out")
    counted = windows.windowed_totals(logged, "arrival", units_or_null("value"), "10 minutes")
    return _in_full(sinks.run_keyed(counted, "arrival_windows", ["start"], mode="complete"))


@register(
    "stream_json_parse",
    "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events",
    ("ST6", "ST8"),
)
def stream_json_parse(spark: SparkSession, d: str) -> DataFrame:
    ev = _events(spark, d).select("event_id", F.col("props").alias("value"))
    parsed = ev.select("event_id", F.from_json("value", "k INT").alias("r")).select("event_id", "r.*")
    return sinks.run_append(parsed, "json_parse")


@register(
    "stream_filter",
    LOG_CTE_SQL + "SELECT * FROM logs WHERE status_code = '404' AND endpoint = '/7'",
    ("ST7", "F1"),
)
def stream_filter(spark: SparkSession, d: str) -> DataFrame:
    logs = log_frame(_events(spark, d))
    return sinks.run_append(filter_status_endpoint_log(logs), "log_filter")


@register(
    "stream_trigger_interval",
    "SELECT event_id, user_id, event_type FROM events WHERE event_type = 'error'",
    ("ST17", "ST18", "ST7"),
)
def stream_trigger_interval(spark: SparkSession, d: str) -> DataFrame:
    """A query that looks for new files every second, stopped when it has caught up."""
    errors = _events(spark, d).filter("event_type = 'error'").select("event_id", "user_id", "event_type")
    return sinks.run_interval(errors, "trigger_interval", "1 second")


@register(
    "stream_word_split",
    "SELECT conv_id, turn, unnest(string_split(text, ' ')) AS word FROM conversations",
    ("ST8", "P7"),
)
def stream_word_split(spark: SparkSession, d: str) -> DataFrame:
    """ST8. Texts compress well, so a split of the file source may hold very many words;
    the turns, far smaller than their words, are dealt out evenly before the split."""
    conv = sources.table_stream(spark, d, "conversations").select("conv_id", "turn", "text")
    words = conv.repartition(parallelism(spark)).select("conv_id", "turn", F.explode(F.split("text", " ", -1)).alias("word"))
    return sinks.run_append(words, "word_split")


@register(
    "stream_per_batch",
    """
    SELECT CAST(0 AS BIGINT) AS batch_id, event_type, count(*) AS rows, round(sum(value), 2) AS total
    FROM events GROUP BY event_type
    """,
    ("ST9", "A15"),
)
def stream_per_batch(spark: SparkSession, d: str) -> DataFrame:
    """ST9: aggregate each micro-batch on its own (all files of the table make one batch)."""

    def per_batch(batch: DataFrame) -> DataFrame:
        return batch.groupBy("event_type").agg(
            F.count(F.lit(1)).alias("rows"), exact_sum("value").alias("total")
        )

    return sinks.run_per_batch(_events(spark, d), "per_batch", per_batch)


@register(
    "stream_json_sink",
    "SELECT event_id, user_id, event_type, value FROM events",
    ("K2", "ST10"),
)
def stream_json_sink(spark: SparkSession, d: str) -> DataFrame:
    ev = _events(spark, d).select("event_id", "user_id", "event_type", "value")
    out = sinks.write_json_per_batch(ev, "json_sink")
    return sinks.read_json_batches(spark, out, ev.schema)


@register(
    "stream_static_join",
    "SELECT o_orderkey, o_custkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey",
    ("ST20",),
)
def stream_static_join_q(spark: SparkSession, d: str) -> DataFrame:
    orders = sources.table_stream(spark, d, "orders").select("o_orderkey", "o_custkey")
    cust = read_table(spark, d, "customer", "c_custkey", "c_name")
    joined = stream_static_join(orders, cust, orders["o_custkey"] == cust["c_custkey"])
    return sinks.run_append(joined.select("o_orderkey", "o_custkey", "c_name"), "stream_static")


_SIGNUP_CLICKS_SQL = """
WITH signups AS (SELECT event_id AS signup_id, user_id, ts AS signup_time FROM events WHERE event_type = 'signup'),
     clicks AS (SELECT event_id AS click_id, user_id AS click_user, ts AS click_time FROM events WHERE event_type = 'click')
SELECT signup_id, user_id, signup_time, click_id, click_time
FROM signups {how} JOIN clicks
  ON user_id = click_user AND click_time >= signup_time AND click_time <= signup_time + INTERVAL 6 HOUR
{where}
"""


def _signup_clicks(spark: SparkSession, d: str, how: str) -> DataFrame:
    ev = sources.table_stream(spark, d, "events")
    signups = ev.filter("event_type = 'signup'").select(F.col("event_id").alias("signup_id"), "user_id", F.col("ts").alias("signup_time"))
    ev = sources.table_stream(spark, d, "events")
    clicks = ev.filter("event_type = 'click'").select(F.col("event_id").alias("click_id"), F.col("user_id").alias("click_user"), F.col("ts").alias("click_time"))
    joined = stream_stream_join(
        signups, clicks, F.col("user_id") == F.col("click_user"), how,
        "signup_time", "click_time", "10 minutes", "10 minutes", "6 hours",
    )
    if how == "full":
        joined = joined.withColumn("user_id", F.coalesce("user_id", "click_user"))
    out = sinks.run_append(joined.drop("click_user"), f"signup_clicks_{how}")
    return out.withColumns({c: instant_to_ntz(c) for c in ("signup_time", "click_time") if c in out.columns})


@register("stream_stream_join", _SIGNUP_CLICKS_SQL.format(how="INNER", where=""), ("ST21",))
def stream_stream_join_q(spark: SparkSession, d: str) -> DataFrame:
    """Clicks of a user within 6 hours of a sign-up. Watermarks on both sides and
    the time range let Spark drop rows that can't match any more."""
    return _signup_clicks(spark, d, "inner")


@register(
    "stream_stream_left_join",
    _SIGNUP_CLICKS_SQL.format(
        how="LEFT",
        where="""WHERE click_id IS NOT NULL OR signup_time + INTERVAL 6 HOUR <
          (SELECT least(max(ts) FILTER (WHERE event_type = 'signup'), max(ts) FILTER (WHERE event_type = 'click')) FROM events) - INTERVAL 10 MINUTE""",
    ),
    ("ST21",),
)
def stream_stream_left_join_q(spark: SparkSession, d: str) -> DataFrame:
    """Sign-ups without such a click come out with nulls once the watermark has
    passed their range; those still open at the end of the input don't yet."""
    return _signup_clicks(spark, d, "left")


@register(
    "stream_stream_full_join",
    _SIGNUP_CLICKS_SQL.format(
        how="FULL",
        where="""WHERE (signup_id IS NOT NULL AND click_id IS NOT NULL)
          OR (click_id IS NULL AND signup_time + INTERVAL 6 HOUR < (SELECT mark FROM passed))
          OR (signup_id IS NULL AND click_time < (SELECT mark FROM passed))""",
    ).replace(
        "SELECT signup_id, user_id",
        """, passed AS (SELECT least(max(ts) FILTER (WHERE event_type = 'signup'), max(ts) FILTER (WHERE event_type = 'click')) - INTERVAL 10 MINUTE AS mark FROM events)
SELECT signup_id, coalesce(user_id, click_user) AS user_id""",
        1,
    ),
    ("ST21",),
)
def stream_stream_full_join_q(spark: SparkSession, d: str) -> DataFrame:
    """Both sides' rows without a partner come out with nulls once the watermark
    has passed the range in which one could still arrive; state is bounded by it."""
    return _signup_clicks(spark, d, "full")


@register(
    "stream_stream_semi_join",
    """
    WITH signups AS (SELECT event_id AS signup_id, user_id, ts AS signup_time FROM events WHERE event_type = 'signup')
    SELECT signup_id, user_id, signup_time FROM signups
    WHERE EXISTS (SELECT 1 FROM events WHERE event_type = 'click' AND events.user_id = signups.user_id
                  AND ts >= signup_time AND ts <= signup_time + INTERVAL 6 HOUR)
    """,
    ("ST21",),
)
def stream_stream_semi_join_q(spark: SparkSession, d: str) -> DataFrame:
    """Sign-ups followed by a click within 6 hours, each once, as soon as the first
    such click is there."""
    return _signup_clicks(spark, d, "left_semi")


@register(
    "stream_stream_join_unbounded",
    """
    SELECT o_orderkey, l_linenumber, o_custkey, l_quantity
    FROM orders JOIN lineitem ON o_orderkey = l_orderkey
    """,
    ("ST21",),
)
def stream_stream_join_unbounded(spark: SparkSession, d: str) -> DataFrame:
    """The form without watermark: every row of both streams stays in state, so
    state is on disk and grows with the input; use the bounded form on endless
    streams."""
    own = sinks.disk_state_session(spark)
    orders = sources.table_stream(own, d, "orders").select("o_orderkey", "o_custkey")
    li = sources.table_stream(own, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    joined = stream_stream_join(orders, li, orders["o_orderkey"] == li["l_orderkey"])
    return sinks.run_append(joined.select("o_orderkey", "l_linenumber", "o_custkey", "l_quantity"), "stream_stream")


@register(
    "stream_late_rows",
    """
    WITH parts AS (SELECT *, event_id % 3 = 0 AS late FROM events),
         mark AS (SELECT max(ts) - INTERVAL 10 MINUTE AS passed FROM parts WHERE NOT late),
         kept AS (SELECT * FROM parts WHERE NOT late OR date_trunc('hour', ts) + INTERVAL 1 HOUR > (SELECT passed FROM mark))
    SELECT date_trunc('hour', ts) AS start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS "end", count(*) AS rows
    FROM kept GROUP BY 1
    """,
    ("ST15", "ST16"),
)
def stream_late_rows(spark: SparkSession, d: str) -> DataFrame:
    """Late rows under a watermark: two thirds of the events arrive first, the
    other third in a second run that goes on from the same checkpoint. Of these
    late rows only those in windows that the watermark (largest time of the
    first run less 10 minutes) has not passed are counted."""
    events = read_table(spark, d, "events", "event_id", "ts").withColumn("late", F.col("event_id") % 3 == 0)
    arrivals = shared_path(spark, "tables", "event_arrivals")
    location = shared_path(spark, "streams", "late_rows")
    for late in (False, True):
        events.filter(F.col("late") == late).drop("late").write.mode("append").parquet(arrivals)
        stream = spark.readStream.schema(events.drop("late").schema).parquet(arrivals)
        counted = windows.windowed_sum(stream.withColumn("one", F.lit(1)), "ts", "one", "1 hour", watermark="10 minutes", out="rows")
        out = sinks.run_keyed(counted, "late_rows", ["start"], location=location)
    return out
