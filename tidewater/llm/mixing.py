"""Mixing sources to target weights by Poisson replication.

The size of a document is the UTF-8 bytes of its text plus 1; the size of a
source is their sum over all its documents. With target weight ``w`` (a share
of the mixture) and size ``n``, the documents of a source are repeated ``w *
total / n`` times on average. Each document gets its own number of copies: a
number in [0, 1) made from the seed and the document is put through the inverse
of the Poisson distribution with that mean. The copies are exploded and then
shuffled globally, by a hash of seed, document and copy.

A rate above ``PART_RATE`` is split into equal parts, whose counts add up to
the same distribution, so that no probability underflows.

The per-source table is written to the shared folder, so Spark knows its size
when it plans the join with the documents: few sources are broadcast, very many
are joined by a shuffle in which a hot source is split (AQE skew join).
Replication happens before the one shuffle of the texts.

Defined cases: null is a source of its own; null text has size 1; equal rows get
equal counts (the count depends on the row's id, source and text only); an empty
table gives an empty result; other columns stay, except one named like a result
column. Sources with no given weight share what the given weights leave, in
proportion to ``size ** alpha``.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import materialise, text_or_empty

PART_RATE = 16.0
CDF_TERMS = 96  # the rest of a Poisson distribution with mean 16 is below 1e-40


def unit_interval(text: Column) -> Column:
    """A string as a number in [0, 1): 52 bits of its MD5."""
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long") / F.lit(2.0**52)


def poisson_cdf(rate: Column) -> Column:
    """``P(X <= k)`` for ``k`` from 0 to ``CDF_TERMS``."""
    start = F.exp(-rate)
    return F.aggregate(
        F.sequence(F.lit(1), F.lit(CDF_TERMS)),
        F.struct(start.alias("p"), F.array(start).alias("cdf")),
        lambda s, k: F.struct(
            (s["p"] * rate / k).alias("p"),
            F.array_append(s["cdf"], F.element_at(s["cdf"], -1) + s["p"] * rate / k).alias("cdf"),
        ),
        lambda s: s["cdf"],
    )


def source_rates(docs: DataFrame, weights: Mapping[str, float] | None = None, alpha: float = 0.5) -> DataFrame:
    """``source``, ``size``, ``weight`` and ``rate`` for each source of ``docs``."""
    given = {str(k): float(v) for k, v in (weights or {}).items()}
    if any(v < 0 for v in given.values()) or sum(given.values()) > 1 + 1e-9:
        raise ValueError("target weights are shares of the mixture: not negative, at most 1 together")
    sizes = materialise(
        docs.groupBy("source").agg(F.sum(F.octet_length(text_or_empty()).cast("long") + 1).alias("size")), "source-sizes"
    )
    fixed = F.lit(None).cast("double")
    for name, weight in given.items():
        fixed = F.when(F.col("source") == name, F.lit(weight)).otherwise(fixed)
    tempered = F.pow(F.col("size").cast("double"), F.lit(alpha))
    rows = sizes.withColumns({"fixed": fixed, "tempered": tempered})
    sums = rows.agg(
        F.struct(
            F.sum("size").alias("total"),
            F.coalesce(F.sum("fixed"), F.lit(0.0)).alias("fixed"),
            F.sum(F.when(F.col("fixed").isNull(), F.col("tempered"))).alias("tempered"),
        )
    ).scalar()
    weight = F.coalesce("fixed", (1 - F.col("sums.fixed")) * F.col("tempered") / F.col("sums.tempered"))
    return (
        rows.withColumn("sums", sums)
        .withColumn("weight", weight)
        .select("source", "size", "weight", (F.col("weight") * F.col("sums.total") / F.col("size")).alias("rate"))
    )


def mix_sources(docs: DataFrame, weights: Mapping[str, float] | None = None, alpha: float = 0.5, seed: int = 0) -> DataFrame:
    """The mixture: ``docs`` with ``rate``, ``n_copies``, ``copy`` (from 1) and
    ``shuffle_key``, one row per copy; partitions and their rows are in the
    order of a global shuffle."""
    parts = F.greatest(F.lit(1), F.ceil(F.col("rate") / PART_RATE)).cast("int")
    rates = (
        source_rates(docs, weights, alpha)
        .select(F.col("source").alias("__tw_source"), F.col("rate").alias("__tw_rate"), parts.alias("__tw_parts"))
        .withColumn("__tw_cdf", poisson_cdf(F.col("__tw_rate") / F.col("__tw_parts")))
    )
    joined = docs.join(rates, docs["source"].eqNullSafe(rates["__tw_source"])).drop("__tw_source")
    own = F.md5(
        F.concat_ws("|", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.coalesce(F.col("source").cast("string"), F.lit("")), F.md5(text_or_empty()))
    )
    draw = lambda j: unit_interval(F.concat_ws("|", F.lit(str(seed)), j.cast("string"), F.col("__tw_own")))
    drawn = F.transform(F.sequence(F.lit(0), F.col("__tw_parts") - 1), draw)
    # binding each number once, then counting the steps of the distribution below it
    counts = F.transform(drawn, lambda u: F.size(F.filter(F.col("__tw_cdf"), lambda c: c <= u)))
    total = F.aggregate(counts, F.lit(0), lambda a, b: a + b)
    copies = (
        joined.withColumn("__tw_own", own)
        .withColumns({"rate": F.col("__tw_rate"), "n_copies": total})
        .drop("copy", "shuffle_key")
        .filter(F.col("n_copies") > 0)
        .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("n_copies"))))
        .withColumn("shuffle_key", F.md5(F.concat_ws("|", F.lit(str(seed)), F.lit("copy"), F.col("copy").cast("string"), F.col("__tw_own"))))
        .drop("__tw_own", "__tw_rate", "__tw_parts", "__tw_cdf")
    )
    return copies.repartition(F.col("shuffle_key")).sortWithinPartitions("shuffle_key")
