"""Poisson mixing: rates, the distribution, copies, odd sources."""

from __future__ import annotations

import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidewater.llm.mixing import mix_sources, poisson_cdf, source_rates

SCHEMA = "doc_id long, text string, source string, copy int"


def _docs(spark):
    rows = [(i, "x" * (i % 50 + 1), "hot" if i % 3 else f"s{i % 9}", 7) for i in range(3000)]
    return spark.createDataFrame(rows + [(None, None, None, 7)] * 3 + [(5, "", "odd", 7)], SCHEMA)


def test_distribution_function(spark):
    for rate in (0.01, 1.0, 15.9):
        cdf = spark.range(1).select(poisson_cdf(F.lit(rate)).alias("c")).first().c
        p = [math.exp(-rate + k * math.log(rate) - math.lgamma(k + 1)) for k in range(40)]
        assert all(math.isclose(c, sum(p[: k + 1]), rel_tol=1e-12) for k, c in enumerate(cdf[:40]))
        assert math.isclose(cdf[-1], 1.0, rel_tol=1e-12)


def test_rates_meet_the_target_weights(spark):
    rates = {r.source: r for r in source_rates(_docs(spark), {"hot": 0.2, "s0": 0.5}).collect()}
    total = sum(r["size"] for r in rates.values())
    assert math.isclose(rates["hot"].rate * rates["hot"]["size"] / total, 0.2, rel_tol=1e-9)
    assert math.isclose(sum(r.weight for r in rates.values()), 1.0, rel_tol=1e-9)
    assert None in rates
    with pytest.raises(ValueError):
        source_rates(_docs(spark), {"hot": 1.2})


def test_copies(spark):
    docs = _docs(spark)
    out = mix_sources(docs, {"hot": 0.2, "s0": 0.5}, seed=1)
    assert set(out.columns) == {*docs.columns, "rate", "n_copies", "shuffle_key"}
    rows = out.collect()
    rates = {r.source: r.rate for r in source_rates(docs, {"hot": 0.2, "s0": 0.5}).collect()}
    sizes = Counter(r.source for r in docs.collect())
    got = Counter(r.source for r in rows)
    for s in ("hot", "s0", "s3"):
        mean = rates[s] * sizes[s]
        assert abs(got[s] - mean) < 6 * math.sqrt(mean)
    by_doc = {}
    for r in rows:
        if r.doc_id is not None:
            by_doc.setdefault((r.doc_id, r.source, r.text), []).append(r)
    for copies in by_doc.values():
        assert sorted(c.copy for c in copies) == list(range(1, copies[0].n_copies + 1))
    keys = [r.shuffle_key for r in rows if r.doc_id is not None]
    assert len(set(keys)) == len(keys)
    again = mix_sources(docs.repartition(5), {"hot": 0.2, "s0": 0.5}, seed=1).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, rows))
    assert Counter(r.doc_id for r in mix_sources(docs, seed=2).collect()) != Counter(r.doc_id for r in mix_sources(docs, seed=3).collect())


def test_high_rates_are_split_and_empty_tables_stay_empty(spark):
    docs = spark.createDataFrame([(i, "y" * 1000, "big", 0) for i in range(50)] + [(100, "z", "small", 0)], SCHEMA)
    rows = mix_sources(docs, {"small": 0.5}).filter("source = 'small'").collect()
    mean = rows[0].rate
    assert mean > 5000 and abs(len(rows) - mean) < 6 * math.sqrt(mean)
    assert mix_sources(docs.limit(0)).collect() == []
