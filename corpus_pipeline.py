"""A training corpus from ``documents``, in four stages.

1. Language ID: documents whose language can't be told (no text, or no letter) go.
2. Near-duplicates: of each group of linked documents the one with the smallest
   id stays; of equal rows one stays.
3. Mixing: sources are repeated or thinned to tempered target weights and
   shuffled globally.
4. Encoding: each copy's text becomes token ids; decoding them gives back its bytes.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
as Parquet and read again as the next stage's ``docs``. All but the last return
the columns of their ``docs``, further ones than those of ``documents`` as well,
whatever their names. Empty tables and null ids, texts, languages and
sources go through every stage as its operator defines them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm.bpe import decode, encode
from tidewater.llm.common import materialise, table
from tidewater.llm.langid import UNKNOWN, fit, identify
from tidewater.llm.mixing import mix_sources
from tidewater.llm.near_dedup import near_duplicates, text_key
from tidewater.llm.q_bpe import PRODUCTION_BPE, digests

ALPHA = 0.5  # of the tempered target weights
SEED = 0


def packed(docs: DataFrame, *used: str) -> DataFrame:
    """``docs`` with the columns an operator uses and all others as one, so that none
    of these meets a column of the operator's."""
    rest = [c for c in docs.columns if c not in used]
    return docs.select(*used, F.struct(*rest, F.lit(0).alias("__tw_end")).alias("__tw_rest"))


def unpacked(rows: DataFrame, docs: DataFrame, *used: str) -> DataFrame:
    """The columns of ``docs`` again, in their order."""
    return rows.select(*[F.col(c) if c in used else F.col("__tw_rest")[c].alias(c) for c in docs.columns])


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language. Learns from all labelled documents, up to the sample's bound."""
    identified = identify(packed(docs, "text"), fit(docs))
    return unpacked(identified.filter(F.col("lang_pred") != UNKNOWN), docs, "text")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group. Rows with a null id belong to no group; rows that
    repeat an id with other texts are other documents."""
    decided = near_duplicates(docs, by_text=True)
    dropped = materialise(decided.filter(~F.col("kept")).select("doc_id", "text_key").distinct(), "dropped")
    dropped = dropped.select(F.col("doc_id").alias("__tw_id"), F.col("text_key").alias("__tw_key"))
    # the ids grow with the data, so this join is always a shuffle
    keyed = packed(docs.filter(F.col("doc_id").isNotNull()), "doc_id", "text").withColumn("__tw_key", text_key())
    same = (F.col("doc_id") == F.col("__tw_id")) & (keyed["__tw_key"] == dropped["__tw_key"])
    stay = keyed.join(dropped.hint("merge"), same, "left_anti").dropDuplicates(["doc_id", "text"])
    return unpacked(stay, docs, "doc_id", "text").unionByName(docs.filter(F.col("doc_id").isNull()))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture, one row per copy."""
    used = ("doc_id", "source", "text")
    return unpacked(mix_sources(packed(docs, *used), alpha=ALPHA, seed=SEED), docs, *used)


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token count and hashes of ids and decoded bytes of each copy."""
    return digests(decode(encode(docs.select("doc_id", "text"), PRODUCTION_BPE), PRODUCTION_BPE))


STAGES = [
    ("language_id", identify_language),
    ("near_dedup", drop_near_duplicates),
    ("mix_sources", mix),
    ("byte_bpe", tokenise),
]

# The fitted machines and the merges can't be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialise(docs, f"stage-{name}")
    return docs
