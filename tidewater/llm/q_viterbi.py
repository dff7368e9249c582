"""Query of operator 4. SQL can't express the search; tests compare with two tokenizer libraries."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidewater.llm.common import table
from tidewater.llm.registry import register
from tidewater.llm.viterbi import count_tokens

PRODUCTION_MODEL = public_tokenizers.path("piece_bpe_32k.model")


@register("op4_token_counts")
def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return count_tokens(docs, PRODUCTION_MODEL).select("doc_id", "n_tokens", "token_score")
