"""Query of operator 1 and its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewater.llm.common import table
from tidewater.llm.licenses import scan_licenses
from tidewater.llm.registry import register

# Every block is looked at, without filters: containment by brute force.
SQL = r"""
WITH t(id, label, phrase, txt) AS (VALUES
  (0, 'gpl', true, 'gnu general public license'),
  (1, 'apache', true, 'apache license'),
  (2, 'cc-by', true, 'cc by'),
  (3, 'mit', true, 'mit license'),
  (4, 'apache-2.0', false, 'licensed under the apache license version 2 0'),
  (5, 'gpl-3.0', false, 'this work is licensed under the gnu general public license version 3'),
  (6, 'cc-by-4.0', false, 'licensed under a creative commons attribution 4 0 international license'),
  (7, 'cc-by-nc-4.0', false, 'licensed under cc by nc 4 0'),
  (8, 'mit', false, 'permission is hereby granted free of charge to any person obtaining a copy of this software'),
  (9, 'bsd', false, 'redistribution and use in source and binary forms with or without modification are permitted'),
  (10, 'mpl-2.0', false, 'this source code form is subject to the terms of the mozilla public license v 2 0')),
templates AS (
  SELECT id, label, phrase, string_split(txt, ' ') AS seq, list_distinct(string_split(txt, ' ')) AS words,
         len(string_split(txt, ' ')) AS m FROM t),
docs AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM documents),
places AS (
  SELECT rid, label, unnest(generate_series(0, len(ws) - m)) AS p, ws, seq, m
  FROM docs, templates WHERE phrase AND len(ws) >= m),
found AS (SELECT rid, label, p FROM places WHERE ws[p + 1 : p + m] = seq),
base AS (
  SELECT rid, count(*) AS n_base, min(p) AS first_word, max(p) AS last_word,
         string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels
  FROM found GROUP BY rid),
blocks AS (
  SELECT rid, label, words, m, ws, unnest(generate_series(0, (len(ws) - 1) // m)) AS b
  FROM docs, templates WHERE NOT phrase AND len(ws) > 0),
shares AS (
  SELECT rid, label, len(list_intersect(words, ws[b * m + 1 : b * m + 2 * m])) * 1.0 / len(words) AS share FROM blocks),
met AS (
  SELECT rid, label, share FROM shares WHERE share >= 0.9 - 1e-12
  UNION ALL SELECT rid, label, 1.0 FROM found),
more AS (
  SELECT rid, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(share) AS score FROM met GROUP BY rid)
SELECT d.doc_id, CAST(len(d.ws) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base,
       CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       CAST(coalesce(score, 0) AS DOUBLE) AS score
FROM docs d LEFT JOIN base USING (rid) LEFT JOIN more USING (rid)
"""


@register("op1_license_scan", SQL)
def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"
    )
