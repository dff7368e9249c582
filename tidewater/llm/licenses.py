"""License scans: exact set-similarity join of text blocks with license templates.

A template is a word list with a label. A block is a run of ``2m`` words of a
document that starts at a multiple of ``m``, where ``m`` is the template's word
count, so every run of up to ``m + 1`` words lies inside one block. A block
meets a template when at least ``threshold`` of the template's distinct words
are in it. All such blocks are found, without looking at the others:

* template words are ordered by how many documents hold them (counted over all
  documents), rarest first;
* prefix filter: with ``o = ceil(threshold * size)`` words required, a block
  that has none of the template's first ``size - o + 1`` words can't qualify,
  so only blocks around a prefix word are looked at;
* length filter: a block needs ``o`` distinct words;
* positional filter: the words that follow the matched word in the order, in
  the template and in the block, must suffice to reach ``o``.

A ``phrase`` template also needs its words consecutively; its places are
reported. Only built-in functions run: the template index is a bounded
parameter and reaches the tasks as a scalar subquery, documents are neither
shuffled nor grouped, and each row is judged alone (a row with a third of all
words is still one row of the input). Work is linear in the words of a text, also
where each of them starts a search.

Defined cases: a null or empty text has 0 words, no label and score 0; rows
may repeat ids or be equal, each is judged alone; an empty table gives an empty
result; other columns stay, except one named like a result column.
"""

from __future__ import annotations

import math
import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import ascii_lower, text_or_empty

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"  # applied after A-Z became a-z


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    phrase: bool = False

    @property
    def words(self) -> list[str]:
        return [w for w in re.split(SEPARATORS, self.text.lower()) if w]


# The phrases and labels that every scan reports.
BASE_TEMPLATES = (
    Template("gpl", "gnu general public license", phrase=True),
    Template("apache", "apache license", phrase=True),
    Template("cc-by", "cc by", phrase=True),
    Template("mit", "mit license", phrase=True),
)

# Wording of common notices and license texts.
NOTICE_TEMPLATES = (
    Template("apache-2.0", "licensed under the apache license version 2.0"),
    Template("gpl-3.0", "this work is licensed under the gnu general public license version 3"),
    Template("cc-by-4.0", "licensed under a creative commons attribution 4.0 international license"),
    Template("cc-by-nc-4.0", "licensed under cc by-nc 4.0"),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    Template("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2.0"),
)

PRODUCTION_TEMPLATES = BASE_TEMPLATES + NOTICE_TEMPLATES
PRODUCTION_THRESHOLD = 0.9


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(text), SEPARATORS), "")


def template_index(docs: DataFrame, templates: Sequence[Template], threshold: float) -> DataFrame:
    """One row: ``order`` (all template words, rarest first), ``prefixes`` (the
    words that start a search) and ``templates`` (one struct per template)."""
    spark = docs.sparkSession
    schema = "id int, label string, phrase boolean, seq array<string>, need int"
    rows = []
    for i, t in enumerate(templates):
        distinct = len(set(t.words))
        if not distinct:
            raise ValueError(f"template {t.label!r} has no words")
        rows.append((i, t.label, t.phrase, t.words, max(1, math.ceil(threshold * distinct - 1e-9))))
    given = spark.createDataFrame(rows, schema)
    vocabulary = F.array(*[F.lit(w) for w in sorted({w for t in templates for w in t.words})])

    held = docs.select(F.explode(F.array_intersect(words_of(text_or_empty()), vocabulary)).alias("word"))
    counts = held.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    words = given.select("*", F.explode(F.array_distinct("seq")).alias("word"))
    ordered = (
        words.join(counts, "word", "left")
        .groupBy("id", "label", "phrase", "seq", "need")
        .agg(F.array_sort(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "word"))).alias("by_count"))
        .select(
            "id", "label", "phrase", "seq", "need", "by_count",
            F.size("seq").alias("m"),
            F.col("by_count.word").alias("set"),
            F.expr("slice(by_count.word, 1, size(by_count) - need + 1)").alias("prefix"),
        )
    )
    return ordered.agg(
        F.array_sort(F.collect_list(F.struct("id", "label", "phrase", "seq", "need", "m", "set", "prefix"))).alias("templates"),
        F.array_distinct(F.flatten(F.collect_list("prefix"))).alias("prefixes"),
        F.array_distinct(F.array_sort(F.flatten(F.collect_list("by_count"))))["word"].alias("order"),
    ).select(F.struct("templates", "prefixes", "order").alias("index"))


def scan_licenses(
    docs: DataFrame,
    templates: Sequence[Template] = PRODUCTION_TEMPLATES,
    threshold: float = PRODUCTION_THRESHOLD,
) -> DataFrame:
    """``docs`` with ``n_words``, ``license_blocks`` (one struct per block that
    meets a template: label, phrase, first word, containment, places) and the
    summary columns ``n_base``, ``first_word``, ``last_word``, ``base_labels``,
    ``labels``, ``score`` (the highest containment)."""
    index = template_index(docs, templates, threshold).scalar()
    rows = docs.withColumns({"__tw_index": index, "__tw_words": words_of(text_or_empty())})
    tw, order = F.col("__tw_words"), F.col("__tw_index.order")

    hits = F.when(
        F.arrays_overlap(tw, F.col("__tw_index.prefixes")),
        F.filter(
            F.transform(tw, lambda w, i: F.struct(w.alias("w"), i.alias("i"))),
            lambda h: F.array_contains(F.col("__tw_index.prefixes"), h["w"]),
        ),
    ).otherwise(F.array().cast("array<struct<w:string,i:int>>"))

    def around(t: Column, near: Column) -> Column:
        """Blocks of ``t`` that hold one of its prefix words, each once, with the rarest."""
        own = F.filter(near, lambda h: F.array_contains(t["prefix"], h["w"]))
        # block numbers are plain numbers, so telling them apart is linear in the hits
        blocks = F.array_distinct(
            F.flatten(F.transform(own, lambda h: F.array((h["i"] / t["m"]).cast("int"), (h["i"] / t["m"]).cast("int") - 1)))
        )
        cut = F.transform(
            F.filter(blocks, lambda b: b >= 0),
            lambda b: F.struct(t.alias("t"), b.alias("b"), F.array_distinct(F.slice(tw, b * t["m"] + 1, t["m"] * 2)).alias("block")),
        )
        return F.transform(
            cut, lambda c: F.struct(c["t"].alias("t"), c["b"].alias("b"), F.array_intersect(t["prefix"], c["block"])[0].alias("w"), c["block"].alias("block"))
        )

    def may_reach(c: Column) -> Column:
        """Length filter, then positional filter."""
        shared = F.array_intersect(order, c["block"])  # in the global order
        left_t = F.size(c["t"]["set"]) - F.array_position(c["t"]["set"], c["w"]).cast("int")
        left_b = F.size(shared) - F.array_position(shared, c["w"]).cast("int")
        # the matched word may not be the first common one: count those before it too
        before = F.size(F.array_intersect(c["block"], F.slice(c["t"]["set"], F.lit(1), F.array_position(c["t"]["set"], c["w"]).cast("int"))))
        return (F.size(c["block"]) >= c["t"]["need"]) & (before + F.least(left_t, left_b) >= c["t"]["need"])

    def places(c: Column) -> Column:
        start = c["b"] * c["t"]["m"]
        return F.filter(
            F.sequence(start, start + c["t"]["m"] - 1),
            lambda p: F.slice(tw, p + 1, c["t"]["m"]) == c["t"]["seq"],
        )

    # the one-element array binds the hits, so that they are found once and not for each template
    candidates = F.flatten(
        F.transform(
            F.filter(F.array(hits), lambda near: F.size(near) > 0),
            lambda near: F.flatten(F.transform(F.col("__tw_index.templates"), lambda t: around(t, near))),
        )
    )
    found = F.transform(
        F.filter(candidates, may_reach),
        lambda c: F.struct(
            c["t"]["id"].alias("template"),
            c["t"]["label"].alias("label"),
            c["t"]["phrase"].alias("phrase"),
            (c["b"] * c["t"]["m"]).alias("first_word"),
            (F.size(F.array_intersect(c["t"]["set"], c["block"])) / F.size(c["t"]["set"])).alias("containment"),
            F.when(c["t"]["phrase"], places(c)).otherwise(F.array().cast("array<int>")).alias("places"),
            (F.size(F.array_intersect(c["t"]["set"], c["block"])) >= c["t"]["need"]).alias("meets"),
        ),
    )
    # a phrase block counts where it owns a place; the block before it may only hold its words
    rows = rows.withColumn(
        "license_blocks",
        F.filter(found, lambda f: f["meets"] & (~f["phrase"] | (F.size(f["places"]) > 0))),
    )
    blocks = F.col("license_blocks")
    rows = rows.withColumn("__tw_places", F.flatten(F.transform(F.filter(blocks, lambda f: f["phrase"]), lambda f: f["places"])))
    label_list = lambda arr: F.array_join(F.array_sort(F.array_distinct(F.transform(arr, lambda f: f["label"]))), ",")
    return rows.withColumns(
        {
            "n_words": F.size(tw).cast("long"),
            "n_base": F.size("__tw_places").cast("long"),
            "first_word": F.array_min("__tw_places").cast("long"),
            "last_word": F.array_max("__tw_places").cast("long"),
            "base_labels": label_list(F.filter(blocks, lambda f: f["phrase"])),
            "labels": label_list(blocks),
            "score": F.coalesce(F.array_max(F.transform(blocks, lambda f: f["containment"])), F.lit(0.0)),
        }
    ).drop("__tw_index", "__tw_words", "__tw_places")
