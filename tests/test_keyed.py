"""K9: snapshots, crashes before the commit, growth by linear hashing, touched parts only."""

from __future__ import annotations

import os
import random

import pytest
from pyspark.sql import functions as F

from tidewater.sinks import keyed
from tidewater.sinks.keyed import KeyedTable, part_of, split_sources
from tidewater.sinks.manifest import CommitConflict, commit_text


def table_of(spark, n=500, parts=16, **more):
    rows = spark.range(n).selectExpr("id AS k", "0 AS version", "'old' AS v")
    return KeyedTable.create(rows, ["k"], ["version"], parts=parts, **more)


def updates_of(spark, *rows):
    return spark.createDataFrame(list(rows), "k long, version int, v string")


def values(df):
    return {r.k: r.v for r in df.collect()}


def files(table):
    local = table.path.removeprefix("file:")
    return {f"{d}/{f}" for d, _, names in os.walk(f"{local}/data") for f in names if f.endswith(".parquet")}


def test_upsert_keeps_the_latest_and_old_snapshots(spark):
    table = table_of(spark)
    table.upsert(updates_of(spark, (7, 1, "new"), (7, 2, "newer"), (9, -1, "late"), (900, 0, "more"), (None, 0, "none")))
    got = values(table.read())
    assert len(got) == 502 and (got[7], got[9], got[900], got[8], got[None]) == ("newer", "old", "more", "old", "none")
    assert values(table.read(0)) == {k: "old" for k in range(500)}
    assert values(KeyedTable.open(spark, table.path).read()) == got
    assert table.upsert(updates_of(spark)).version == 1  # nothing to do, no new version
    assert table.versions() == [0, 1]


@pytest.mark.parametrize("parts", [64, 4096])
def test_files_rewritten_follow_the_touched_parts(spark, parts):
    table = table_of(spark, 900, parts, rows_per_part=10**6)
    before, shot = files(table), table.snapshot()
    table.upsert(updates_of(spark, *[(k, 1, "new") for k in (1, 2, 3)]))
    after = table.snapshot()
    moved = {p for p in after.folders if after.folders[p] != shot.folders.get(p)}
    assert before <= files(table)  # the old snapshot stays readable
    assert 1 <= len(moved) <= 3 and len(files(table) - before) <= 3
    assert after.row_count == 900 and values(table.read())[2] == "new"


def test_killed_before_the_commit(spark, monkeypatch):
    table = table_of(spark)
    change = updates_of(spark, (1, 1, "new"))

    def dies(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(keyed, "commit_text", dies)
        with pytest.raises(KeyboardInterrupt):
            table.upsert(change)
    assert values(table.read())[1] == "old" and table.versions() == [0]
    orphans = files(table)
    table.upsert(change)
    assert values(table.read())[1] == "new" and table.versions() == [0, 1]
    # expiry removes what no version names: the orphan, and the part that was rewritten
    assert table.expire(keep=1) and files(table) < orphans | files(table)
    assert values(table.read())[1] == "new" and table.versions() == [1]


def test_of_two_writers_one_fails(spark, monkeypatch):
    table = table_of(spark)
    shot = table.snapshot()
    table.upsert(updates_of(spark, (1, 1, "first")))
    monkeypatch.setattr(table, "snapshot", lambda version=None: shot)  # read before the first one committed
    with pytest.raises(CommitConflict):
        table.upsert(updates_of(spark, (2, 1, "second")))
    monkeypatch.undo()
    got = values(table.read())
    assert got[1] == "first" and got[2] == "old"
    with pytest.raises(CommitConflict):
        commit_text(spark, f"{table.path}/versions/{0:012d}", "{}")


def test_parts_split_one_at_a_time_as_the_table_grows(spark):
    table = table_of(spark, 100, parts=2, rows_per_part=50)
    rnd, want = random.Random(1), {k: "old" for k in range(100)}
    for version in range(1, 6):
        keys = [rnd.randrange(2000) for _ in range(90)]
        shot, before = table.snapshot(), files(table)
        table.upsert(updates_of(spark, *[(k, version, f"v{version}") for k in keys]))
        want |= {k: f"v{version}" for k in keys}
        now = table.snapshot()
        wanted = -(-shot.row_count // 50)
        assert now.parts == max(shot.parts, min(wanted, 2 * shot.parts))  # 90 keys touch every part
        assert len(files(table) - before) <= 2 * shot.parts
        assert values(table.read()) == want and now.row_count == len(want)
    assert table.snapshot().parts > 6 and max(table.snapshot().rows.values()) <= 4 * 50
    # one key: one part is rewritten, and at most one is split
    shot, before = table.snapshot(), files(table)
    table.upsert(updates_of(spark, (5000, 9, "last")))
    assert table.snapshot().parts <= shot.parts + 1 and len(files(table) - before) <= 3


def test_linear_hashing_moves_only_split_parts(spark):
    keys = spark.range(3000)
    for old, new in ((1, 2), (5, 6), (5, 13), (8, 9), (3, 17)):
        placed = keys.select(part_of(["id"], old).alias("p"), part_of(["id"], new).alias("q")).groupBy("p", "q").count().collect()
        sources = split_sources(old, new)
        assert all(0 <= r.p < old and 0 <= r.q < new for r in placed)
        assert all(r.p in sources for r in placed if r.p != r.q) and (new - old > 4 or len(sources) <= new - old)


def test_updates_are_evaluated_once(spark):
    table = table_of(spark)
    seen = spark.sparkContext.accumulator(0)

    def mark(k):
        seen.add(1)
        return k

    marked = updates_of(spark, (1, 1, "new"), (2, 1, "new")).withColumn("k", F.udf(mark, "long")("k"))
    table.upsert(marked)
    assert seen.value == 2


def test_empty_table(spark):
    empty = spark.createDataFrame([], "k long, version int, v string")
    table = KeyedTable.create(empty, ["k"], ["version"])
    assert table.read().columns == ["k", "version", "v"] and table.read().count() == 0
    table.upsert(updates_of(spark, (1, 1, "new")))
    assert values(table.read()) == {1: "new"}


def test_every_written_part_is_a_task_of_its_own(spark):
    table = table_of(spark, 2000, parts=32)
    tasks = lambda names: [os.path.basename(f).split("-")[1] for f in names]
    first = files(table)
    assert len(first) == 32 and len({*tasks(first)}) == 32
    table.upsert(updates_of(spark, *[(k, 1, "new") for k in range(0, 60, 5)]))
    second = files(table) - first
    assert 1 < len(second) < 32 and len({*tasks(second)}) == len(second)
    assert values(table.read()) == {k: "new" if k < 60 and k % 5 == 0 else "old" for k in range(2000)}
