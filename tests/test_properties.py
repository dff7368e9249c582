"""Property tests: operators that re-formulate a computation for scale must
agree with the plain computation on random inputs (hot keys and nulls included)."""

from __future__ import annotations

from collections import Counter
from fractions import Fraction

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tidewater.functions.numeric import exact_mean
from tidewater.operators import aggregates as agg
from tidewater.operators import joins

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])

keys = st.one_of(st.none(), st.integers(0, 4))  # few keys -> hot keys; nulls never match


@SETTINGS
@given(st.lists(keys, max_size=25), st.lists(keys, max_size=25))
def test_join_counts_equal_pair_counts(spark, left, right):
    a = spark.createDataFrame([(k,) for k in left], "id int")
    b = spark.createDataFrame([(k,) for k in right], "id int")
    got = {r.join_type: r.rows for r in joins.join_row_counts(
        {"a": a, "b": b}, [("a", "b", h) for h in ("inner", "left", "right", "full")], "id").collect()}
    ca, cb = Counter(k for k in left if k is not None), Counter(k for k in right if k is not None)
    inner = sum(ca[k] * cb[k] for k in ca)
    left_only = sum(n for k, n in ca.items() if k not in cb) + left.count(None)
    right_only = sum(n for k, n in cb.items() if k not in ca) + right.count(None)
    assert got == {"inner": inner, "left": inner + left_only, "right": inner + right_only,
                   "full": inner + left_only + right_only}


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 1000)), min_size=1, max_size=30, unique_by=lambda t: t[1]))
def test_keep_latest_equals_python_max(spark, rows):
    df = spark.createDataFrame([(k, v, f"p{v}") for k, v in rows], "k int, v int, payload string")
    got = {r.k: (r.v, r.payload) for r in agg.keep_latest(df, ["k"], ["v"]).collect()}
    want = {}
    for k, v in rows:
        if k not in want or v > want[k][0]:
            want[k] = (v, f"p{v}")
    assert got == want


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 2), st.integers(0, 50)), max_size=40), st.integers(1, 6))
def test_salted_join_equals_plain_join(spark, many_rows, buckets):
    many = spark.createDataFrame(many_rows, "k int, v int")
    one = spark.createDataFrame([(k, f"n{k}") for k in (0, 1)], "k int, name string")
    plain = sorted(tuple(r) for r in many.join(one, "k", "left").select("k", "v", "name").collect())
    salted = sorted(tuple(r) for r in joins.salted_join(many, one, ["k"], buckets, "left").select("k", "v", "name").collect())
    assert plain == salted


@SETTINGS
@given(st.lists(st.integers(-10**9, 10**9), min_size=1, max_size=40))
def test_exact_mean_of_cents(spark, cents):
    df = spark.createDataFrame([(c / 100,) for c in cents], "v double")
    got = df.agg(exact_mean("v", 2).alias("m")).first().m
    assert got == float(Fraction(sum(cents), 100 * len(cents)))
