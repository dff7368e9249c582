"""Query of operator 3 and its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm.common import table
from tidewater.llm.mixing import mix_sources
from tidewater.llm.registry import register

# alpha 0.5, seed 0; the distribution function from its closed form
SQL = """
WITH sizes AS (
  SELECT source, sum(strlen(coalesce(text, '')) + 1) AS size FROM documents GROUP BY source),
rates AS (
  SELECT source, sqrt(CAST(size AS DOUBLE)) / (SELECT sum(sqrt(CAST(size AS DOUBLE))) FROM sizes)
                 * (SELECT sum(size) FROM sizes) / size AS rate FROM sizes),
steps AS (
  SELECT r.source, r.rate, r.parts, k, sum(exp(-rate / parts) * pow(rate / parts, k) / gamma(k + 1)) OVER (PARTITION BY source ORDER BY k) AS cdf
  FROM (SELECT source, rate, greatest(1, CAST(ceil(rate / 16) AS INT)) AS parts FROM rates) r, generate_series(0, 96) g(k)),
docs AS (
  SELECT row_number() OVER () AS rid, *,
         md5(coalesce(CAST(doc_id AS VARCHAR), '') || '|' || coalesce(source, '') || '|' || md5(coalesce(text, ''))) AS own
  FROM documents),
draws AS (
  SELECT rid, source, own, unnest(generate_series(0, parts - 1)) AS j
  FROM docs JOIN (SELECT DISTINCT source, parts FROM steps) p USING (source)),
counts AS (
  SELECT d.rid, any_value(s.rate) AS rate, count(*) FILTER (WHERE s.cdf <= u) AS n_copies
  FROM (SELECT *, CAST('0x' || substr(md5('0|' || j || '|' || own), 1, 13) AS BIGINT) / 4503599627370496.0 AS u FROM draws) d
  JOIN steps s USING (source) GROUP BY d.rid)
SELECT doc_id, text, lang, source, n_chars, round(rate, 9) AS rate, CAST(n_copies AS INTEGER) AS n_copies, CAST(copy AS INTEGER) AS copy,
       md5('0|copy|' || copy || '|' || own) AS shuffle_key
FROM (SELECT d.*, c.rate, c.n_copies, unnest(generate_series(1, c.n_copies)) AS copy FROM docs d JOIN counts c USING (rid))
"""


@register("op3_mix_sources", SQL)
def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix_sources(table(spark, sf_dir, "documents"), alpha=0.5, seed=0)
    return mixed.withColumn("rate", F.round("rate", 9))
