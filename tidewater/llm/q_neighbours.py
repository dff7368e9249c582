"""Query of operator 6. The search is approximate; tests measure its recall against brute force."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm.common import table
from tidewater.llm.neighbours import nearest
from tidewater.llm.registry import register

NEIGHBOURS = 20


@register("op6_nearest_neighbours")
def op6_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, NEIGHBOURS)
