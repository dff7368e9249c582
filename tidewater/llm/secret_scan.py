"""Secret scans: rules are regular expressions, texts are found by a trigram index.

1. The Boolean trigram query of each rule is derived from its expression
   (``trigram_query``): an OR of ANDs of trigrams that every match must hold.
2. ``trigram_index`` is an inverted index of the texts: one posting (trigram,
   text key) for each distinct text and each trigram that some query asks for,
   written to the shared folder. Equal texts share their postings.
3. ``candidates`` intersects postings: a text is a candidate of a rule if all
   trigrams of one of the query's ANDs have a posting for it.
4. ``scan_secrets`` joins the candidates back and runs a rule's expression over
   the whole texts of its candidates only. Rules that demand no trigram (runs of
   hexadecimal digits) scan every text.

Only built-in functions run. The text key is a 64-bit hash: two texts that share
one share their postings, which adds candidates and loses none, and candidates are
verified. The written candidates' size is known when the join is planned: few are
broadcast, many are joined by a shuffle in which a text that a third of the rows
repeat is split (AQE skew join). Rules and queries are bounded parameters.

Matches of a rule are the leftmost ones that don't overlap; one whose ``group``
is shorter than ``least`` characters is dropped afterwards. Starts and ends count
code points, ends are exclusive.

Defined cases: a null text is empty; an empty text has no secret; rows may repeat
ids or be equal, each gets its own result; a very long text with very many matches
costs about their number to the power 1.5; an empty table gives an empty result;
other columns stay, except one named ``secrets``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import ascii_lower, materialise, text_or_empty
from tidewater.llm.trigram_query import ANY, Query, trigram_query


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    group: int = 0  # whose length counts
    least: int = 1

    @property
    def query(self) -> Query:
        return trigram_query(self.pattern)


# The kinds that every scan reports.
BASE_RULES = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 16),
    # the runs of 32 and more of [0-9a-f]+, and no others
    Rule("hex", r"[0-9a-f]{32,}"),
)

# Shapes of credentials that providers publish.
PROVIDER_RULES = (
    Rule("private-key", r"-----BEGIN [A-Z ]{0,24}PRIVATE KEY-----"),
    Rule("code-host", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("maps", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("payment", r"[rs]k_live_[A-Za-z0-9]{16,}"),
    Rule("web-token", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("url-login", r"://[^/\x20:@]{1,64}:[^/\x20:@]{3,64}@"),
)

PRODUCTION_RULES = BASE_RULES + PROVIDER_RULES

MATCHES = "array<struct<gap:int,size:int,part:int>>"


def text_key() -> Column:
    return F.xxhash64(text_or_empty())


def vocabulary(rules: Sequence[Rule]) -> list[str]:
    """The trigrams that the rules' queries ask for."""
    return sorted({t for r in rules for term in r.query for t in term})


def trigram_index(docs: DataFrame, trigrams: Sequence[str]) -> DataFrame:
    """Postings (``trigram``, ``text_key``) of all texts, each once, as a written table."""
    rows = docs.select(text_key().alias("text_key"), ascii_lower(text_or_empty()).alias("text"))
    held = F.array_compact(F.array(*[F.when(F.col("text").contains(t), F.lit(t)) for t in trigrams]).cast("array<string>"))
    postings = rows.select("text_key", F.explode(held).alias("trigram"))
    return materialise(postings.select("trigram", "text_key").distinct(), "trigram-index")


def candidates(index: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """``text_key`` and ``rules`` (the kinds whose query the text's postings meet)."""
    rows = [
        (t, r.kind, k, len(term))
        for r in rules
        for k, term in enumerate(sorted(map(sorted, r.query)))
        for t in term
    ]
    asked = index.sparkSession.createDataFrame(rows, "trigram string, kind string, term int, need int")
    met = index.join(asked, "trigram").groupBy("text_key", "kind", "term", "need").agg(F.count(F.lit(1)).alias("held"))
    return met.filter("held = need").groupBy("text_key").agg(F.collect_set("kind").alias("rules"))


def _bind(value: Column, use) -> Column:
    """``use(value)``, an array, with ``value`` computed once."""
    return F.flatten(F.transform(F.array(value), use))


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0), lambda a, v: a + v)


def running_sums(values: Column) -> Column:
    """For each value the sum of those before it. Sums of parts of about the
    square root of the length keep the work below that of summing every prefix."""

    def of(v: Column) -> Column:
        width = F.ceil(F.sqrt(F.size(v))).cast("int")
        parts = F.transform(F.sequence(F.lit(0), ((F.size(v) - 1) / width).cast("int")), lambda b: _sum(F.slice(v, b * width + 1, width)))
        starts = _bind(parts, lambda p: F.transform(p, lambda _, b: _sum(F.slice(p, F.lit(1), b))))
        return _bind(
            F.struct(starts.alias("starts"), width.alias("width")),
            lambda s: F.transform(v, lambda _, i: F.get(s["starts"], (i / s["width"]).cast("int")) + _sum(F.slice(v, i - i % s["width"] + 1, i % s["width"]))),
        )

    return _bind(values, lambda v: F.when(F.size(v) > 0, of(v)).otherwise(F.array().cast("array<int>")))


def matches(text: Column, rule: Rule) -> Column:
    """The lengths of each match, of its measured part and of the text before it."""
    rx = F.lit(rule.pattern)
    pairs = F.arrays_zip(
        F.regexp_extract_all(text, rx, F.lit(0)).alias("match"),
        F.regexp_extract_all(text, rx, F.lit(rule.group)).alias("part"),
        F.split(text, rule.pattern, -1).alias("before"),
    )
    found = F.transform(
        F.filter(pairs, lambda p: p["match"].isNotNull()),
        lambda p: F.struct(F.length(p["before"]).alias("gap"), F.length(p["match"]).alias("size"), F.length(p["part"]).alias("part")),
    )
    return F.when(text.rlike(rule.pattern), found).otherwise(F.array().cast(MATCHES))


def spans(by_rule: Column) -> Column:
    """Places from lengths: matches and the texts between them alternate."""

    def placed(r: Column) -> Column:
        sums = running_sums(F.transform(r["found"], lambda f: f["gap"] + f["size"]))
        return F.transform(
            F.filter(F.arrays_zip(r["found"].alias("f"), sums.alias("at")), lambda z: z["f"]["part"] >= r["least"]),
            lambda z: F.struct(
                (z["at"] + z["f"]["gap"]).alias("start"),
                r["rank"].alias("rank"),
                (z["at"] + z["f"]["gap"] + z["f"]["size"]).alias("end"),
                r["kind"].alias("kind"),
            ),
        )

    met = F.filter(by_rule, lambda r: F.size(r["found"]) > 0)
    return F.transform(
        F.array_sort(F.flatten(F.transform(met, placed))),
        lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")),
    )


def scan_secrets(docs: DataFrame, rules: Sequence[Rule] = PRODUCTION_RULES) -> DataFrame:
    """``docs`` with ``secrets``: kind, start and end of each match, by start,
    then by the rules' order."""
    indexed = [r for r in rules if r.query != ANY]
    found = materialise(candidates(trigram_index(docs, vocabulary(indexed)), indexed), "secret-candidates")
    found = found.select(F.col("text_key").alias("__tw_key"), F.col("rules").alias("__tw_rules"))
    rows = docs.withColumn("__tw_key", text_key()).join(found, "__tw_key", "left")
    text, none = text_or_empty(), F.array().cast(MATCHES)
    by_rule = [
        F.struct(
            F.lit(k).alias("rank"),
            F.lit(r.kind).alias("kind"),
            F.lit(r.least).alias("least"),
            (F.when(F.array_contains("__tw_rules", r.kind), matches(text, r)).otherwise(none) if r in indexed else matches(text, r)).alias("found"),
        )
        for k, r in enumerate(rules)
    ]
    return rows.withColumn("secrets", spans(F.array(*by_rule))).drop("__tw_key", "__tw_rules")
