"""Secret scans: against plain regular expressions, sound trigram queries, plan, odd rows."""

from __future__ import annotations

import contextlib
import io
import random
import re
import time

from hypothesis import given
from hypothesis import strategies as st

from tidewater.llm import secret_scan as ss
from tidewater.llm.trigram_query import ANY, trigram_query

SCHEMA = "doc_id long, text string, secrets string"
HEX = "0123456789abcdef"


def brute(text, rules):
    out = []
    for k, r in enumerate(rules):
        for m in re.finditer(r.pattern, text or "", re.ASCII):
            if len(m.group(r.group)) >= r.least:
                out.append((m.start(), k, m.end(), r.kind))
    return [(kind, s, e) for s, _, e, kind in sorted(out)]


def _texts():
    rnd = random.Random(7)
    pieces = [
        'password = "abcdefgh12"', "PassWd:short", "token==abc=defgh", 'token="secret": "abcdefghij"', "Api_Key : zzzzzzzzzz", "apikey='12345678'",
        "ſecret=abcdefghi", "toKen=abcdefghij", "AKIA" + "A1" * 6, "AKIAAKIA99", "AKIA" + "Z" * 20, "a" * 31, "0f" * 16, "G" + "9" * 33 + "g", "𝒳é", "\x00",
        "-----BEGIN RSA PRIVATE KEY-----", "ghp_" + "a" * 36, "xoxb-1234567890", "AIza" + "x" * 35, "sk_live_" + "9" * 16, "eyJhbGciOiJI.eyJzdWIiOiIx.abcdefghij",
        "https://user:secret@host", "pass word", "secret", "tok", "://", " ", "\n", ",",
    ]
    texts = [None, "", " "] + pieces
    texts += ["".join(rnd.choice(pieces) + rnd.choice(["", " ", "\n"]) for _ in range(rnd.randint(1, 30))) for _ in range(120)]
    return texts + texts[-4:]


def test_matches_plain_expressions(spark):
    texts = _texts()
    docs = spark.createDataFrame([(i % 100, t, str(i)) for i, t in enumerate(texts)], SCHEMA).repartition(3)
    rows = ss.scan_secrets(docs.withColumnRenamed("secrets", "n")).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = brute(texts[int(r.n)], ss.PRODUCTION_RULES)
        assert [(s.kind, s.start, s.end) for s in r.secrets] == want, texts[int(r.n)]


@given(st.lists(st.sampled_from(_texts()[1:31]), max_size=4).map("".join))
def test_queries_lose_no_match(text):
    low = text.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    for r in ss.PRODUCTION_RULES:
        if re.search(r.pattern, text, re.ASCII):
            assert any(all(t in low for t in term) for term in r.query)


def test_queries_by_hand():
    fs = frozenset
    assert trigram_query("abcd") == fs([fs(["abc", "bcd"])])
    assert trigram_query("ab?cd") == fs([fs(["abc", "bcd"]), fs(["acd"])])
    assert all("abc" in t or "xyz" in t for t in trigram_query("(abc|xyz)+q"))
    for loose in ("[0-9a-f]{32,}", "a.b", "ab", "(abc)?", "(abc)*", "abc|.", "[^a]bc", r"\w+", ""):
        assert trigram_query(loose) == ANY, loose
    assert trigram_query(r"abc\w*def") == fs([fs(["abc", "def"])])
    assert [r.kind for r in ss.PRODUCTION_RULES if r.query == ANY] == ["hex"]


def test_only_candidates_are_verified(spark):
    docs = spark.createDataFrame([(1, "a token lies here"), (2, "tok oke ken"), (3, "toke"), (4, None)], "doc_id long, text string")
    rules = [ss.Rule("t", "token")]
    found = ss.candidates(ss.trigram_index(docs, ss.vocabulary(rules)), rules)
    keys = {r.text_key: r.rules for r in found.collect()}
    by_id = {r.doc_id: r.k for r in docs.withColumn("k", ss.text_key()).collect()}
    # document 2 holds the trigrams but no match: a candidate that the expression rejects
    assert keys == {by_id[1]: ["t"], by_id[2]: ["t"]}
    assert {r.doc_id: len(r.secrets) for r in ss.scan_secrets(docs, rules).collect()} == {1: 1, 2: 0, 3: 0, 4: 0}


def test_long_text_of_matches(spark):
    text = "token=abcdefgh " * 70_000  # 1 MB
    start = time.perf_counter()
    row = ss.scan_secrets(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()[0]
    assert [(s.start, s.end) for s in row.secrets] == [(15 * k, 15 * k + 14) for k in range(70_000)]
    assert time.perf_counter() - start < 60


def test_only_built_in_functions(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        ss.scan_secrets(docs).explain()
    assert not re.search("Python|Pandas|InArrow|NestedLoop|Cartesian", buf.getvalue())


def test_empty_table_null_ids_and_clashing_columns(spark):
    docs = spark.createDataFrame([(None, "token=abcdefgh", "old")] * 2, SCHEMA)
    rows = ss.scan_secrets(docs).collect()
    assert [[s.kind for s in r.secrets] for r in rows] == [["assign"], ["assign"]]
    assert ss.scan_secrets(docs.limit(0)).collect() == []
    more = docs.withColumnsRenamed({"secrets": "rules"}).withColumn("text_key", docs["doc_id"])
    assert ss.scan_secrets(more).select("rules", "text_key").collect() == [("old", None)] * 2
