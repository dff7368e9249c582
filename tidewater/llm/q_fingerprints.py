"""Query of operator 9. SQL can't express the parse; tests compare with a plain one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewater.llm.common import table
from tidewater.llm.fingerprints import edited_neighbours
from tidewater.llm.registry import register


@register("op9_fingerprints")
def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_neighbours(table(spark, sf_dir, "documents"))
