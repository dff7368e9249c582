"""Stratified shards: against a brute-force ranking, counts, mixture, odd tables."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import functions as F

from tidewater.llm.sharding import assign_shards, write_shards

SCHEMA = "doc_id long, text string, source string, slot string"


def _docs(spark):
    rows = [(i, f"text {i}", "hot" if i % 3 == 0 else f"s{i % 7}", "x") for i in range(400)]
    rows += [(None, None, None, None)] * 5 + [(7, "same", "s1", "y")] * 9
    return spark.createDataFrame(rows, SCHEMA), len(rows)


def test_order_matches_a_brute_force_ranking(spark):
    docs, n = _docs(spark)
    got = assign_shards(docs, 24, seed=3).collect()
    assert len(got) == n
    hashed = docs.select("*", F.xxhash64(F.lit(3), F.col("doc_id").cast("string"), "source", F.coalesce("text", F.lit(""))).alias("h")).collect()
    by_source: dict = {}
    for r in hashed:
        by_source.setdefault("n" if r.source is None else "s" + r.source, []).append(r)
    order = []
    for source, rows in by_source.items():
        rows.sort(key=lambda r: (r.h % (1 << 64), r.doc_id or 0))
        order += [((2 * i + 1) / len(rows), source, i, r.doc_id, r.text) for i, r in enumerate(rows)]
    order.sort(key=lambda x: x[:3])
    want = Counter((doc, text, i * 24 // n, i - -(-(i * 24 // n) * n // 24)) for i, (*_, doc, text) in enumerate(order))
    assert Counter((r.doc_id, r.text, r.shard, r.slot) for r in got) == want


def test_row_counts_and_mixture(spark):
    docs, n = _docs(spark)
    rows = assign_shards(docs, 24).collect()
    sizes = Counter(r.shard for r in rows)
    assert max(sizes.values()) - min(sizes.values()) <= 1 and len(sizes) == 24
    for s in sizes:
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sizes[s]))
    hot = Counter(r.shard for r in rows if r.source == "hot")
    share = sum(hot.values()) / n
    assert all(abs(hot[s] - share * sizes[s]) <= 2 for s in sizes)


def test_few_rows_none_and_files(spark, tmp_path):
    few = spark.createDataFrame([(1, "a", "s", "x"), (2, "b", "t", "x")], SCHEMA)
    assert [r.slot for r in assign_shards(few, 24).collect()] == [0, 0]
    assert assign_shards(few.limit(0), 24).collect() == []
    path = str(tmp_path / "shards")
    write_shards(assign_shards(few, 2), path)
    assert sorted((r.doc_id, r.shard) for r in spark.read.parquet(path).collect())[0][0] == 1
