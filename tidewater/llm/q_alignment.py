"""Query of operator 13. Tests compare with plain loops over bytes and tokens."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidewater.llm.alignment import Tokenizers, link_strengths
from tidewater.llm.common import table
from tidewater.llm.registry import register

PRODUCTION_FILES = Tokenizers(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


@register("op13_tokenizer_alignment")
def op13_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_strengths(table(spark, sf_dir, "documents"), PRODUCTION_FILES).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "n_shared"
    )
