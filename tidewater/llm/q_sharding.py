"""Query of operator 10. DuckDB has no CRC-32; tests compare with a brute-force ranking."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm.common import table, text_or_empty
from tidewater.llm.registry import register
from tidewater.llm.sharding import assign_shards

SHARDS = 24


@register("op10_shards")
def op10_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    # sizes and checksums are taken before the shuffles, so that no text goes through them
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "source", "text",
        (F.octet_length(text_or_empty()).cast("long") + 8).alias("size"),
        F.crc32(text_or_empty().cast("binary")).alias("text_crc32"),
    )
    return assign_shards(docs, SHARDS).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
