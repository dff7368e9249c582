"""Language identification by hierarchical discrimination.

The language family is predicted first, then the language within it; both steps
take the votes of linear support vector machines, one for each pair of families
or of languages of a family. Features of a text are its hashed character uni-,
bi- and trigrams over lower-cased letters (any run of other characters is one
blank), scaled to unit length; whole texts are used.

The machines are fitted on a bounded sample: ``SAMPLE_PER_LANGUAGE`` documents of
each language, chosen by a hash of the document among the rows with text and
language (the caller passes only rows it may learn from). All machines are fitted
in one job, each pair in a task of its own from its own languages' part of the
sample (dual coordinate descent on the hinge loss, in a fixed order, so a re-run
gives the same weights). The set of languages is taken to be small, as labels are:
``MOST_LANGUAGES``, more is an error. The fitted weights go to the tasks as one
small array; prediction reads the text alone and needs no shuffle.

Defined cases: null text, or text without a letter, is ``und`` with score 0;
without any row to learn from every text is ``und``; a family of one language
needs no second step; languages outside ``FAMILIES`` are families of their own;
equal votes go to the larger sum of margins, then to the name that sorts first;
an empty table gives an empty result; other columns stay, except one named like
a result column.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.common import array_slices, materialise, slices

UNKNOWN = "und"
SAMPLE_PER_LANGUAGE = 400
BUCKETS = 4096
MOST_LANGUAGES = 200
ITERATIONS = 30
REGULARISATION = 0.001

# Families of languages by ISO 639-1 code.
FAMILIES = {
    "germanic": ("en", "de", "nl", "sv", "da", "no", "is"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca", "gl"),
    "slavic": ("ru", "uk", "pl", "cs", "sk", "bg", "sr", "hr", "sl"),
    "uralic": ("fi", "et", "hu"),
    "baltic": ("lt", "lv"),
    "indic": ("hi", "bn", "ur", "mr", "gu", "pa", "ne"),
    "turkic": ("tr", "az", "kk", "uz"),
}
FAMILY_OF = {lang: family for family, langs in FAMILIES.items() for lang in langs}


def family_of(lang: str) -> str:
    return FAMILY_OF.get(lang, lang)


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Code point -> lower-case letter, or a blank for anything but a letter."""
    points = np.full(0x110000, 32, dtype=np.uint32)
    for c in range(0x110000):
        ch = chr(c)
        if ch.isalpha():
            points[c] = ord(low) if len(low := ch.lower()) == 1 else c
    return points


def features(text: str | None) -> np.ndarray | None:
    """Unit vector of ``BUCKETS`` n-gram counts; None for a text without a letter."""
    codes = np.frombuffer((text or "").encode("utf-32-le", "replace"), dtype=np.uint32)
    codes = _letters()[codes]
    blank = codes == 32
    if blank.all():
        return None
    keep = np.ones(len(codes), dtype=bool)
    keep[1:] = ~(blank[1:] & blank[:-1])
    c = np.concatenate(([32], codes[keep], [32])).astype(np.uint32)
    one = c * np.uint32(2654435761)
    two = one[:-1] ^ (c[1:] * np.uint32(2246822519))
    three = two[:-1] ^ (c[2:] * np.uint32(3266489917))
    counts = np.zeros(BUCKETS)
    for k, h in enumerate((one, two, three)):
        h = (h ^ np.uint32(0x9E3779B9 * (k + 1) & 0xFFFFFFFF)) * np.uint32(668265263)
        counts += np.bincount(h >> np.uint32(20), minlength=BUCKETS)
    return counts / np.sqrt((counts * counts).sum())


@dataclass(frozen=True)
class Pair:
    """A machine that separates ``a`` (positive) from ``b``."""

    a: str
    b: str
    weights: np.ndarray
    intercept: float


@dataclass(frozen=True)
class LanguageModel:
    families: dict[str, tuple[str, ...]]
    family_pairs: tuple[Pair, ...]
    language_pairs: dict[str, tuple[Pair, ...]]

    def predict(self, text: str | None) -> tuple[str, float]:
        x = features(text)
        if x is None or not self.families:
            return UNKNOWN, 0.0
        family, p = _vote(sorted(self.families), self.family_pairs, x)
        lang, q = _vote(self.families[family], self.language_pairs[family], x)
        return lang, round(p * q, 6)


def _vote(names, pairs: tuple[Pair, ...], x: np.ndarray) -> tuple[str, float]:
    """The name most machines vote for, and how sure they are (0 to 1)."""
    votes = dict.fromkeys(names, 0)
    margins = dict.fromkeys(names, 0.0)
    weakest: dict[str, float] = {}
    for pair in pairs:
        m = float(pair.weights @ x) + pair.intercept
        votes[pair.a if m > 0 else pair.b] += 1
        margins[pair.a] += m
        margins[pair.b] -= m
        for name, own in ((pair.a, m), (pair.b, -m)):
            weakest[name] = min(weakest.get(name, np.inf), own)
    best = min(names, key=lambda n: (-votes[n], -margins[n], n))
    if best not in weakest:
        return best, 1.0
    return best, float(1 / (1 + np.exp(-2 * np.clip(weakest[best], -20, 20))))


def training_sample(labelled: DataFrame, per_language: int) -> DataFrame:
    """``lang``, ``text`` and hash ``h`` of at most ``per_language`` rows of each language, by hash."""
    rows = labelled.select(F.col("lang").cast("string").alias("lang"), "text", F.col("doc_id").cast("string").alias("id")).filter(
        F.col("lang").isNotNull() & F.col("text").isNotNull()
    )
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return rows.select("lang", "text", F.lit(0).cast("long").alias("h")).limit(0)
    # rows above the share can't be needed: twice as many as asked for are below it on average
    share = F.lit(0.0)
    for lang, n in sorted(counts.items()):
        share = F.when(F.col("lang") == lang, F.lit(min(1.0, 2 * per_language / n + 50 / n))).otherwise(share)
    order = F.xxhash64("id", "text")
    near = rows.withColumn("h", order).filter(F.pmod("h", F.lit(1 << 30)) < share * (1 << 30))
    first = F.row_number().over(Window.partitionBy("lang").orderBy(F.pmod("h", F.lit(1 << 30)), "h", "text"))
    return near.withColumn("n", first).filter(F.col("n") <= per_language).select("lang", "text", "h")


def svm(rows: Sequence[tuple[np.ndarray, np.ndarray]], signs: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights and intercept of a linear support vector machine with hinge loss, by
    dual coordinate descent. Rows are positions and values of unit vectors."""
    most = 1 / (REGULARISATION * max(1, len(rows)))
    alpha, w, intercept = np.zeros(len(rows)), np.zeros(BUCKETS), 0.0
    shuffled = np.random.default_rng(0)
    for _ in range(ITERATIONS):
        for k in shuffled.permutation(len(rows)):
            (at, x), y, old = rows[k], signs[k], alpha[k]
            slope = y * (w[at] @ x + intercept) - 1
            alpha[k] = min(max(old - slope / 2, 0.0), most)  # unit vectors and the intercept: length 2
            if alpha[k] != old:
                step = (alpha[k] - old) * y
                w[at] += step * x
                intercept += step
    return w, intercept


def _machine(rows: pd.DataFrame) -> pd.DataFrame:
    """The machine of one pair, from its sample rows in a fixed order."""
    rows = rows.sort_values(["lang", "h", "at"], key=lambda c: c.map(bytes) if c.name == "at" else c)
    signs = np.where(rows["positive"], 1.0, -1.0)
    w, intercept = svm([(np.asarray(a), np.asarray(v, dtype=float)) for a, v in zip(rows["at"], rows["x"], strict=True)], signs)
    return pd.DataFrame({"pair": [rows["pair"].iloc[0]], "weights": [w], "intercept": [intercept]})


def fit(labelled: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE) -> LanguageModel:
    """Learns from ``labelled`` (``doc_id``, ``text``, ``lang``)."""

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 64):
            langs, hashes, places, values = [], [], [], []
            for lang, text, h in zip(*(c.to_pylist() for c in part.columns), strict=True):
                x = features(text)
                if x is not None:
                    at = np.flatnonzero(x)
                    langs.append(lang)
                    hashes.append(h)
                    places.append(at.astype(np.int16))
                    values.append(x[at].astype(np.float32))
            columns = [pa.array(langs, pa.string()), pa.array(hashes, pa.int64()), pa.array(places, pa.list_(pa.int16())), pa.array(values, pa.list_(pa.float32()))]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "h", "at", "x"])

    drawn = training_sample(labelled, per_language).mapInArrow(vectors, "lang string, h long, at array<short>, x array<float>")
    sample = materialise(drawn, "language-sample")
    langs = sorted(r["lang"] for r in sample.select("lang").distinct().limit(MOST_LANGUAGES + 1).collect())
    if len(langs) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages: labels are not language codes")
    families: dict[str, tuple[str, ...]] = {}
    for lang in langs:
        families[family_of(lang)] = (*families.get(family_of(lang), ()), lang)
    asked = [(a, families[a], b, families[b]) for a, b in combinations(sorted(families), 2)]
    asked += [(a, (a,), b, (b,)) for of in families.values() for a, b in combinations(of, 2)]
    members = [(k, lang, side == 0) for k, (_, left, _, right) in enumerate(asked) for side, of in enumerate((left, right)) for lang in of]
    pairs = labelled.sparkSession.createDataFrame(members, "pair int, lang string, positive boolean")
    fitted = sample.join(pairs, "lang").groupBy("pair").applyInPandas(_machine, "pair int, weights array<double>, intercept double")
    # one row per machine
    found = {r["pair"]: (np.array(r["weights"]), r["intercept"]) for r in fitted.collect()}
    machines = [Pair(a, b, *found[k]) for k, (a, _, b, _) in enumerate(asked)]
    between = len(families) * (len(families) - 1) // 2
    return LanguageModel(
        families, tuple(machines[:between]), {f: tuple(m for m in machines[between:] if m.a in of and m.b in of) for f, of in families.items()}
    )


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (0 to 1), from ``text`` alone."""

    @F.arrow_udf("lang string, score double")
    def predict(text: pa.Array) -> pa.Array:
        found = [model.predict(t) for part in array_slices(text) for t in part]
        return pa.array([{"lang": lang, "score": score} for lang, score in found], pa.struct([("lang", pa.string()), ("score", pa.float64())]))

    return (
        docs.withColumn("__tw_p", predict(F.col("text").cast("string")))
        .withColumns({"lang_pred": F.col("__tw_p.lang"), "score": F.col("__tw_p.score")})
        .drop("__tw_p")
    )


def held_out():
    """Rows kept from learning: CRC-32 of the id as text, modulo 3, is 1 (a null id counts as empty)."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 3 == 1
