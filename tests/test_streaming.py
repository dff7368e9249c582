"""Structured Streaming on the reference's small inputs (FIXTURES.md §2-3)."""

from __future__ import annotations

import os
import time

import pytest
from pyspark.errors import AnalysisException, StreamingQueryException
from pyspark.sql import functions as F

from tidewater.functions.temporal import parse_time
from tidewater.plans import streams
from tidewater.streaming import (
    csv_stream,
    json_stream,
    parse_csv_lines,
    run_append,
    run_complete,
    run_epochs,
    run_per_batch,
    stream_static_join,
    stream_stream_join,
    text_stream,
    windowed_sum,
    write_json_per_batch,
)
from tidewater.streaming.sinks import disk_state_session, read_json_batches

# The watermark sample, in file order (time, count).
WATERMARK_SAMPLE = [
    "2023-04-16 09:08:00,1",
    "2023-04-16 08:59:00,1",
    "2023-04-16 08:45:00,1",
    "2023-04-16 08:54:00,1",
    "2023-04-16 08:55:00,1",
    "2023-04-16 09:19:00,1",
    "2023-04-16 09:11:00,1",
    "2023-04-16 09:07:00,1",
    "2023-04-16 09:04:00,1",
]

# Authors and books of the join example.
AUTHORS = [(0, "Richard Dawkins", 0), (1, "Gary Marcus", 1), (2, "Charles Robert Darwin", 2), (3, "Haruki Murakami", 3),
           (4, "Jules", 4), (5, "Denny Lee", 4), (6, "Richard H.Thaler", 5), (7, "Cass R. Sunstein", 5)]
BOOKS = [(0, "The Selfish Gene", 2022), (1, "Kluge", 2008), (2, "On the Origin of Species", 2020), (3, "1Q84", 2019),
         (4, "Learning Spark 2nd Edition", 2021), (5, "Nudge Final Edition", 2021)]


def _one_line_per_file(directory: str, lines: list[str]) -> str:
    os.makedirs(directory, exist_ok=True)
    base = time.time() - 1000
    for i, line in enumerate(lines):
        path = os.path.join(directory, f"part-{i:03d}.txt")
        with open(path, "w") as f:
            f.write(line + "\n")
        os.utime(path, (base + i * 10, base + i * 10))  # file order = arrival order
    return directory


def _parsed(stream):
    parts = F.split("value", ",")
    return stream.select(
        parse_time(F.get(parts, 0)).alias("time"), F.get(parts, 1).cast("long").alias("count")
    )


def _hm(ts) -> str:
    return ts.strftime("%H:%M")


def test_watermark_update_mode_replay(spark, tmp_dir):
    src = _one_line_per_file(f"{tmp_dir}/wm", WATERMARK_SAMPLE)
    stream = _parsed(text_stream(spark, src, max_files_per_trigger=1))
    agg = windowed_sum(stream, "time", "count", "5 minutes", watermark="10 minutes")
    log = run_epochs(agg, "wm_update").collect()
    per_epoch: dict[int, list] = {}
    for r in log:
        per_epoch.setdefault(r.epoch, []).append((_hm(r.start), r.total))
    emitted = [sorted(per_epoch[e]) for e in sorted(per_epoch)]
    assert emitted == [[("09:05", 1)], [("08:55", 1)], [("08:55", 2)], [("09:15", 1)], [("09:10", 1)], [("09:05", 2)]]


def test_watermark_append_mode_emits_only_closed_windows(spark, tmp_dir):
    src = _one_line_per_file(f"{tmp_dir}/wm", WATERMARK_SAMPLE)
    stream = _parsed(text_stream(spark, src, max_files_per_trigger=1))
    agg = windowed_sum(stream, "time", "count", "5 minutes", watermark="10 minutes")
    out = run_append(agg, "wm_append").collect()
    assert [(_hm(r.start), r.total) for r in out] == [("08:55", 2)]


def test_tumbling_and_sliding_complete(spark, tmp_dir):
    src = _one_line_per_file(f"{tmp_dir}/wm", WATERMARK_SAMPLE)
    stream = _parsed(text_stream(spark, src))
    tumbling = run_complete(windowed_sum(stream, "time", "count", "5 minutes"), "tumble")
    got = sorted((_hm(r.start), r.total) for r in tumbling.collect())
    assert got == [("08:45", 1), ("08:50", 1), ("08:55", 2), ("09:00", 1), ("09:05", 2), ("09:10", 1), ("09:15", 1)]
    sliding = run_complete(windowed_sum(stream, "time", "count", "2 hours", "1 hour"), "slide")
    assert sorted((_hm(r.start), r.total) for r in sliding.collect()) == [("07:00", 4), ("08:00", 9), ("09:00", 5)]


def test_append_aggregation_without_watermark_is_refused(spark, tmp_dir):
    src = _one_line_per_file(f"{tmp_dir}/wm", WATERMARK_SAMPLE)
    agg = windowed_sum(_parsed(text_stream(spark, src)), "time", "count", "5 minutes")
    with pytest.raises((AnalysisException, StreamingQueryException)):
        run_append(agg, "refused")


def _json_files(directory: str, rows, fmt) -> str:
    os.makedirs(directory, exist_ok=True)
    with open(os.path.join(directory, "part-0.json"), "w") as f:
        for r in rows:
            f.write(fmt(r) + "\n")
    return directory


def test_static_and_stream_joins(spark, tmp_dir):
    import json

    authors = spark.createDataFrame(AUTHORS, "id long, name string, book_id long")
    books = spark.createDataFrame(BOOKS, "id long, name string, year long")
    assert authors.join(books, authors["book_id"] == books["id"]).count() == 8

    bdir = _json_files(f"{tmp_dir}/books", BOOKS, lambda r: json.dumps({"id": r[0], "name": r[1], "year": r[2]}))
    adir = _json_files(f"{tmp_dir}/authors", AUTHORS, lambda r: json.dumps({"id": r[0], "name": r[1], "book_id": r[2]}))
    sbooks = json_stream(spark, bdir, "id long, name string, year long").withColumnRenamed("name", "title")
    joined = stream_static_join(sbooks, authors, sbooks["id"] == authors["book_id"])
    assert run_append(joined.select("title", "name"), "static_stream").count() == 8

    sauthors = json_stream(spark, adir, "id long, name string, book_id long").withColumnRenamed("id", "author_id")
    ss = stream_stream_join(sauthors, sbooks, sauthors["book_id"] == sbooks["id"])
    assert run_append(ss.select("author_id", "title"), "stream_stream").count() == 8


def test_stream_join_matrix(spark, tmp_dir):
    import json

    bdir = _json_files(f"{tmp_dir}/books", BOOKS, lambda r: json.dumps({"id": r[0], "name": r[1], "year": r[2], "ts": "2023-01-01 00:00:00"}))
    schema = "id long, name string, year long, ts timestamp"
    left = json_stream(spark, bdir, schema)
    right = json_stream(spark, bdir, schema).withColumnRenamed("id", "rid").withColumnRenamed("ts", "rts")
    static = spark.createDataFrame(AUTHORS, "aid long, author string, book_id long")
    # stream-static: full outer is refused
    with pytest.raises((AnalysisException, StreamingQueryException)):
        run_append(left.join(static, left["id"] == static["book_id"], "full"), "m1")
    # stream-stream outer without watermark is refused
    with pytest.raises((AnalysisException, StreamingQueryException)):
        run_append(stream_stream_join(left, right, left["id"] == right["rid"], "left"), "m2")
    # with watermarks on both sides and a time range it runs
    ok = stream_stream_join(left, right, left["id"] == right["rid"], "left", "ts", "rts", "1 hour", "1 hour", "2 hours")
    assert run_append(ok.select("id", "rid"), "m3").count() == len(BOOKS)


def test_json_per_batch_sink_and_csv_stream(spark, tmp_dir):
    src = _one_line_per_file(f"{tmp_dir}/csv", ["130.31.184.234,2023-02-26 04:15:21,PATCH,/users,400,61",
                                                 "28.252.170.12,2023-02-26 04:15:21,GET,/events,401,73"])
    schema = "ip string, timestamp string, method string, endpoint string, status_code string, latency int"
    logs = csv_stream(spark, src, schema, max_files_per_trigger=1)
    out = write_json_per_batch(logs.filter(F.col("status_code") == "400"), "json_sink")
    back = read_json_batches(spark, out, logs.schema)
    assert [r.ip for r in back.collect()] == ["130.31.184.234"]
    parsed = parse_csv_lines(text_stream(spark, src), schema)
    assert run_append(parsed, "from_csv").count() == 2


def test_processing_time_trigger_picks_up_new_files(spark, tmp_dir):
    from tidewater.streaming import start_append

    src = _one_line_per_file(f"{tmp_dir}/live", WATERMARK_SAMPLE[:3])
    q, out = start_append(_parsed(text_stream(spark, src)), "live", "1 second")
    try:
        q.processAllAvailable()
        with open(f"{src}/part-new.txt", "w") as f:
            f.write(WATERMARK_SAMPLE[3] + "\n")
        q.processAllAvailable()
    finally:
        q.stop()
    assert spark.read.parquet(out).count() == 4


def test_stable_location_resumes_from_checkpoint(spark, tmp_dir):
    src = _one_line_per_file(f"{tmp_dir}/resume", WATERMARK_SAMPLE[:2])
    loc = f"{tmp_dir}/resume-sink"
    first = run_append(_parsed(text_stream(spark, src)), "resume", location=loc).count()
    with open(f"{src}/part-late.txt", "w") as f:
        f.write(WATERMARK_SAMPLE[2] + "\n")
    second = run_append(_parsed(text_stream(spark, src)), "resume", location=loc).count()
    assert (first, second) == (2, 3)  # the restart only read the new file


def test_json_line_stream_parse(spark, tmp_dir):
    import json

    from tidewater.streaming import parse_json_lines

    src = _one_line_per_file(f"{tmp_dir}/traffic", [json.dumps({"id": "a", "domain": "x.com", "count": 3, "time": "2023-04-16 09:08:00"})])
    rows = run_append(
        parse_json_lines(text_stream(spark, src), "id string, domain string, count int, time timestamp"), "json_lines"
    ).collect()
    assert [(r.domain, r["count"]) for r in rows] == [("x.com", 3)]


def test_table_stream_reads_a_folder_table(spark, tmp_dir):
    from tidewater.streaming import table_stream

    folder = f"{tmp_dir}/tables"
    spark.range(10).withColumnRenamed("id", "k").repartition(3).write.parquet(f"{folder}/nums.parquet")
    assert run_append(table_stream(spark, folder, "nums"), "folder_table").count() == 10


def test_stream_equals_batch_over_the_same_files(spark):
    from conftest import SF_SMALL

    from tidewater.sources.tables import read_table
    from tidewater.streaming import run_keyed, table_stream

    def hourly(df):
        return windowed_sum(df.select("ts", "event_type", "value"), "ts", "value", "1 hour", keys=["event_type"])

    def rows(df):  # double sums may differ in the last bit with the merge order
        return sorted((r.start, r.end, r.event_type, round(r.total, 6)) for r in df.collect())

    batch = rows(hourly(read_table(spark, SF_SMALL, "events")))
    stream = run_keyed(hourly(table_stream(spark, SF_SMALL, "events")), "same_files", ["start", "event_type"], "complete")
    assert rows(stream) == batch


def test_empty_input_gives_empty_results(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/none")
    stream = _parsed(text_stream(spark, f"{tmp_dir}/none"))
    columns = list(stream.columns)
    for _ in range(2):  # the stream's schema stays as it is
        assert run_epochs(stream, "none_epochs").columns == [*columns, "epoch"]
    assert stream.columns == columns
    per_batch = run_per_batch(stream, "none_batches", lambda b: b.groupBy("count").agg(F.max("time").alias("t")))
    assert per_batch.columns == ["count", "t", "batch_id"] and per_batch.count() == 0
    out = write_json_per_batch(stream, "none_json")
    assert read_json_batches(spark, out, stream.schema).count() == 0
    agg = windowed_sum(stream, "time", "count", "5 minutes")
    assert run_complete(agg, "none_complete").count() == 0


def test_state_on_disk_leaves_other_sessions_alone(spark):
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    assert disk_state_session(spark).conf.get(key) != before and spark.conf.get(key) == before


def test_many_files_in_any_order_make_one_batch(spark, tmp_dir):
    """Thousands of files whose order is not that of the events lose no row under a watermark."""
    import duckdb

    from tidewater.plans import registry

    source = "/root/testdata/sf0.001/events.parquet"
    os.makedirs(f"{tmp_dir}/events.parquet")
    shuffled = spark.read.parquet(source).repartition(3200, F.xxhash64("event_id"))
    shuffled.write.mode("overwrite").parquet(f"{tmp_dir}/events.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{source}')")
    for name in ("stream_watermark", "stream_append_watermark", "stream_top_domain", "stream_per_batch"):
        entry = registry.entries()[name]
        got = sorted(tuple(sorted(map(str, r))) for r in entry.fn(spark, tmp_dir).collect())
        assert got == sorted(tuple(sorted(map(str, r))) for r in con.execute(entry.sql).fetchall())


def test_json_batches_are_seen_whole_or_not_at_all(spark, tmp_dir, monkeypatch):
    from tidewater.streaming import batch_log, sinks

    src, where = f"{tmp_dir}/src", f"{tmp_dir}/json"
    rows = spark.range(40).selectExpr("id AS k", "concat('v', id) AS v")
    rows.coalesce(1).write.parquet(src)
    stream = spark.readStream.schema(rows.schema).parquet(src)
    real = sinks.commit_text

    def dies(*_):
        raise RuntimeError("killed before the log entry")

    monkeypatch.setattr(sinks, "commit_text", dies)
    with pytest.raises(StreamingQueryException):
        write_json_per_batch(stream, "killed", where)
    assert os.listdir(f"{where}/out/data") and read_json_batches(spark, f"{where}/out", rows.schema).count() == 0

    # the replay of the batch is visible once, although the first attempt's files are still there
    monkeypatch.setattr(sinks, "commit_text", real)
    out = write_json_per_batch(stream, "replayed", where)
    assert sorted(read_json_batches(spark, out, rows.schema).collect()) == sorted(rows.collect())
    assert [(e["batch"], e["rows"]) for e in batch_log(spark, out)] == [(0, 40)] and len(os.listdir(f"{out}/data")) == 2

    # more input is a batch of its own; a batch that committed is not written again
    rows.limit(3).coalesce(1).write.mode("append").parquet(src)
    write_json_per_batch(stream, "more", where)
    assert [(e["batch"], e["rows"]) for e in batch_log(spark, out)] == [(0, 40), (1, 3)]
    assert read_json_batches(spark, out, rows.schema).count() == 43


def test_json_batch_without_rows_and_single_evaluation(spark, tmp_dir):
    from tidewater.streaming import batch_log

    seen = spark.sparkContext.accumulator(0)

    def mark(k):
        seen.add(1)
        return k

    src = f"{tmp_dir}/one"
    spark.range(10).coalesce(1).write.parquet(src)
    stream = spark.readStream.schema("id long").parquet(src)
    out = write_json_per_batch(stream.select(F.udf(mark, "long")("id").alias("id")), "once")
    assert seen.value == 10 and read_json_batches(spark, out, "id long").count() == 10
    none = write_json_per_batch(stream.filter("id < 0"), "none")
    assert read_json_batches(spark, none, stream.schema).count() == 0
    assert [e["folder"] for e in batch_log(spark, none)] == [None]


def test_recorded_arrivals_give_the_same_windows_again(spark, tmp_dir):
    from tidewater.streaming import record_arrivals, windows
    from tidewater.streaming.sinks import run_keyed

    src, where = f"{tmp_dir}/in", f"{tmp_dir}/log"
    for k in range(3):  # three runs at three times, one log
        spark.createDataFrame([(k, 10 * k)], "k long, v long").coalesce(1).write.mode("append").parquet(src)
        log = record_arrivals(spark.readStream.schema("k long, v long").parquet(src), "log", location=where)
    assert log.count() == 3 and log.select("arrival").distinct().count() == 3

    def count():
        logged = spark.readStream.schema(log.schema).parquet(f"{where}/out")
        counted = windows.windowed_totals(logged, "arrival", F.col("v"), "1 second")
        return sorted(run_keyed(counted, "again", ["start"], mode="complete").collect())

    first = count()
    assert first == count() and sum(r.rows for r in first) == 3 and sum(r.total for r in first) == 30
    want = log.groupBy(F.window("arrival", "1 second").alias("w")).agg(F.sum("v").alias("t")).select("w.start", "t").collect()
    assert sorted((r.start, r.total) for r in first) == sorted(map(tuple, want))


def test_full_outer_and_semi_joins_drop_their_state(spark, tmp_dir):
    import datetime as dt

    def t(minute):
        return dt.datetime(2024, 1, 1) + dt.timedelta(minutes=minute)

    left = [(1, t(0)), (2, t(5)), (3, t(300))]
    right = [(1, t(10)), (4, t(20)), (1, t(100)), (3, t(305))]
    for name, rows in (("left", left), ("right", right)):
        spark.createDataFrame(rows, f"{name[0]}k long, {name[0]}t timestamp").coalesce(1).write.parquet(f"{tmp_dir}/{name}")

    def joined(how):
        a = spark.readStream.schema("lk long, lt timestamp").parquet(f"{tmp_dir}/left")
        b = spark.readStream.schema("rk long, rt timestamp").parquet(f"{tmp_dir}/right")
        return stream_stream_join(a, b, F.col("lk") == F.col("rk"), how, "lt", "rt", "10 minutes", "10 minutes", "30 minutes")

    full = run_append(joined("full"), "full").select("lk", "rk").collect()
    # (3, 3) match; 2 has no partner; 4 and the late 1 have none; nothing later is open
    assert sorted(((r.lk or 0, r.rk or 0) for r in full)) == [(0, 1), (0, 4), (1, 1), (2, 0), (3, 3)]
    assert sorted(r.lk for r in run_append(joined("left_semi"), "semi").collect()) == [1, 3]


def test_a_value_with_more_decimals_does_not_fail_a_stream(spark, tmp_dir):
    from tidewater.functions.numeric import is_finer, units_or_null

    rows = spark.createDataFrame([(1.25,), (0.1 + 0.2,), (float("nan"),), (float("inf"),), (None,), (3.0,)], "v double")
    got = rows.select(units_or_null("v").alias("u"), is_finer("v").alias("f")).collect()
    assert [r.u for r in got] == [125, None, None, None, None, 300] and [r.f for r in got] == [False, True, True, True, False, False]
    rows.coalesce(1).write.parquet(f"{tmp_dir}/v")
    stream = spark.readStream.schema("v double").parquet(f"{tmp_dir}/v").observe("rejected", F.count_if(is_finer("v")).alias("values"))
    from tidewater.streaming.sinks import run_complete

    total = run_complete(stream.groupBy().agg(F.sum(units_or_null("v")).alias("t")), "sum")
    assert total.first().t == 425


def test_words_of_one_file_are_split_in_several_tasks(spark, tmp_path):
    turns = [(i, t, "user", None if i % 50 == 7 else "" if i % 50 == 8 else f"a {i}  b c{t} ") for i in range(300) for t in (0, None)]
    spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").coalesce(1).write.parquet(f"{tmp_path}/conversations.parquet")
    words = streams.stream_word_split(spark, str(tmp_path))
    want = [(i, t, w) for i, t, _, text in turns if text is not None for w in text.split(" ")]
    assert sorted(map(tuple, words.collect()), key=str) == sorted(want, key=str)
    assert words.select(F.input_file_name()).distinct().count() == 4  # of shuffle_partitions


def test_unbounded_join_goes_on_from_its_checkpoint_with_one_store_a_partition(spark, tmp_path):
    own = disk_state_session(spark)
    for side in ("left", "right"):
        os.makedirs(tmp_path / side)
    a, b = [(1, "a1"), (2, "a2"), (2, "a3"), (None, "a4")], [(2, "b1"), (1, "b2"), (1, "b2"), (None, "b3"), (9, "b4")]
    more = [(9, "a5"), (2, "a6")], [(2, "b5")]
    for rows_a, rows_b in ((a, b), more):
        own.createDataFrame(rows_a, "k long, v string").write.mode("append").parquet(f"{tmp_path}/left")
        own.createDataFrame(rows_b, "j long, w string").write.mode("append").parquet(f"{tmp_path}/right")
        left, right = own.readStream.schema("k long, v string").parquet(f"{tmp_path}/left"), own.readStream.schema("j long, w string").parquet(f"{tmp_path}/right")
        joined = run_append(stream_stream_join(left, right, F.col("k") == F.col("j")).drop("j"), "unbounded", f"{tmp_path}/run")
    want = [(k, v, w) for k, v in a + more[0] for j, w in b + more[1] if k is not None and k == j]
    assert sorted(map(tuple, joined.collect())) == sorted(want)
    stores = {d for part in os.scandir(f"{tmp_path}/run/checkpoint/state/0") if part.name.isdigit() for d in os.listdir(part.path) if d.startswith(("left-", "right-"))}
    assert not stores
