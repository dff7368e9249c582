"""Query of operator 5. SQL can't express the merges; tests compare with the tokenizer library."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm.bpe import ByteBpe, decode, encode
from tidewater.llm.common import table
from tidewater.llm.registry import register

PRODUCTION_BPE = ByteBpe(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def digests(rows: DataFrame) -> DataFrame:
    """Token count and hashes of ``token_ids`` and ``decoded``."""
    return rows.select(
        "doc_id",
        F.size("token_ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("token_ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@register("op5_byte_bpe")
def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return digests(decode(encode(docs, PRODUCTION_BPE), PRODUCTION_BPE))
