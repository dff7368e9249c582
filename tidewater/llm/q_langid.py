"""Query of operator 2. SQL can't fit the machines; tests check accuracy on held-out rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewater.llm.common import table
from tidewater.llm.langid import fit, held_out, identify
from tidewater.llm.registry import register


@register("op2_language_id")
def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = fit(docs.filter(~held_out()))
    rows = identify(docs.withColumn("held_out", held_out()), model)
    return rows.select("doc_id", "held_out", "lang_pred", "score")
