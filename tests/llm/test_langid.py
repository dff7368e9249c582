"""Language ID: accuracy on held-out rows, hierarchy, odd texts and tables."""

from __future__ import annotations

import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewater.llm import langid
from tidewater.llm.langid import UNKNOWN, LanguageModel, fit, held_out, identify


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")


@pytest.fixture(scope="module")
def model(docs):
    return fit(docs.filter(~held_out()), per_language=80)


def test_held_out_accuracy(docs, model):
    assert model.families == {"germanic": ("de", "en"), "romance": ("es", "fr")}
    rows = identify(docs.withColumn("h", held_out()), model).filter("h").collect()
    assert all(zlib.crc32(str(r.doc_id).encode()) % 3 == 1 for r in rows)
    assert sum(r.lang == r.lang_pred for r in rows) / len(rows) >= 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_votes_and_margins_recomputed(docs, model):
    """The rules of the vote, machine by machine, from the fitted weights alone."""
    rows = docs.limit(60).collect()
    got = {r.doc_id: (r.lang_pred, r.score) for r in identify(docs.limit(60), model).collect()}
    for r in rows:
        letters = "".join(c.lower() if c.isalpha() else " " for c in r.text)
        grams = " " + " ".join(letters.split()) + " "
        x = langid.features(r.text)
        assert np.count_nonzero(x) <= 3 * len(grams) and abs(float(x @ x) - 1) < 1e-9
        sure = 1.0
        names, pairs = sorted(model.families), model.family_pairs
        for step in range(2):
            margin = {(p.a, p.b): sum(float(w) * float(v) for w, v in zip(p.weights, x, strict=True) if v) + p.intercept for p in pairs}
            won = {n: sum((m > 0) == (a == n) for (a, b), m in margin.items() if n in (a, b)) for n in names}
            total = {n: sum(m if a == n else -m for (a, b), m in margin.items() if n in (a, b)) for n in names}
            best = sorted(names, key=lambda n: (-won[n], -total[n], n))[0]
            least = min((m if a == best else -m for (a, b), m in margin.items() if best in (a, b)), default=None)
            sure *= 1.0 if least is None else 1 / (1 + math.exp(-2 * max(-20, min(20, least))))
            if step == 0:
                names, pairs = model.families[best], model.language_pairs[best]
        assert got[r.doc_id][0] == best and abs(got[r.doc_id][1] - sure) < 1e-5


def test_machine_reaches_the_optimum():
    """Primal and dual objective of the hinge loss meet, on rows that can't be separated."""
    rng = np.random.default_rng(5)
    dense = np.abs(rng.normal(size=(60, 30)))
    dense /= np.linalg.norm(dense, axis=1)[:, None]
    signs = np.where(rng.random(60) < 0.5, 1.0, -1.0)
    old, langid.ITERATIONS = langid.ITERATIONS, 4000
    try:
        w, intercept = langid.svm([(np.arange(30), row) for row in dense], signs)
    finally:
        langid.ITERATIONS = old
    def primal(w, b):
        return langid.REGULARISATION / 2 * (w @ w + b * b) + np.maximum(0, 1 - signs * (dense @ w[:30] + b)).mean()
    here = primal(w, intercept)
    for _ in range(300):
        step = rng.normal(size=w.shape) * 0.01 * (np.arange(len(w)) < 30)
        assert primal(w + step, intercept + rng.normal() * 0.01) > here - 1e-4


def test_one_job_fits_all_machines_and_labels_are_bounded(spark, docs, model, monkeypatch):
    again = fit(docs.filter(~held_out()), per_language=80)
    pairs = lambda m: [*m.family_pairs, *(p for of in m.language_pairs.values() for p in of)]
    assert all((p.weights == q.weights).all() and p.intercept == q.intercept for p, q in zip(pairs(model), pairs(again), strict=True))
    monkeypatch.setattr(langid, "MOST_LANGUAGES", 3)
    with pytest.raises(ValueError):
        fit(docs)


def test_prediction_reads_the_text_alone(docs, model):
    few = docs.limit(50)
    a = {r.doc_id: (r.lang_pred, r.score) for r in identify(few, model).collect()}
    moved = few.select((F.col("doc_id") + 100_000).alias("doc_id"), "text", F.lit("xx").alias("lang"))
    assert {r.doc_id - 100_000: (r.lang_pred, r.score) for r in identify(moved, model).collect()} == a


def test_odd_texts(spark, model):
    texts = [None, "", "123 !!", "the and of that", "der und die nicht " * 20_000, "𝒳", "日本"]
    rows = identify(spark.createDataFrame([(t, "kept") for t in texts], "text string, lang_pred string"), model).collect()
    assert [r.lang_pred for r in rows[:3]] == [UNKNOWN] * 3
    assert rows[3].lang_pred == "en" and rows[4].lang_pred == "de"
    assert all(r.lang_pred in ("en", "de", "fr", "es") for r in rows[5:])


def test_nothing_or_one_language_to_learn_from(spark, docs):
    none = fit(docs.limit(0))
    assert none == LanguageModel({}, (), {})
    assert {r.lang_pred for r in identify(docs.limit(5), none).collect()} == {UNKNOWN}
    one = fit(docs.filter("lang = 'fr'").limit(5))
    assert {r.lang_pred for r in identify(docs.limit(5), one).collect()} == {"fr"}
    assert identify(docs.limit(0), one).collect() == []
