"""Query of operator 11 and its SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm.common import table
from tidewater.llm.registry import register
from tidewater.llm.secret_scan import BASE_RULES, scan_secrets

BASE = tuple(r.kind for r in BASE_RULES)

# kind, expression, group whose length counts, least length: every expression runs over every text
_SQL_RULES = (
    ("assign", r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    ("access", r"AKIA[A-Z0-9]+", 0, 16),
    ("hex", r"[0-9a-f]+", 0, 32),
    ("private-key", r"-----BEGIN [A-Z ]{0,24}PRIVATE KEY-----", 0, 1),
    ("code-host", r"gh[pousr]_[A-Za-z0-9]{36,}", 0, 1),
    ("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}", 0, 1),
    ("maps", r"AIza[A-Za-z0-9_-]{35}", 0, 1),
    ("payment", r"[rs]k_live_[A-Za-z0-9]{16,}", 0, 1),
    ("web-token", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 1),
    ("url-login", r"://[^/\x20:@]{1,64}:[^/\x20:@]{3,64}@", 0, 1),
)
_FOUND = " UNION ALL ".join(
    f"SELECT rid, '{kind}' AS kind, {k} AS rank, {least} AS least, regexp_extract_all(t, '{rx}', 0) AS m, "
    f"regexp_extract_all(t, '{rx}', {group}) AS part, string_split_regex(t, '{rx}') AS p FROM docs WHERE regexp_matches(t, '{rx}')"
    for k, (kind, rx, group, least) in enumerate(_SQL_RULES)
)
SQL = f"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
found AS ({_FOUND}),
each AS (SELECT rid, kind, rank, least, m, part, p, unnest(generate_series(1, len(m))) AS i FROM found),
placed AS (
  SELECT rid, kind, rank, length(m[i]) AS n,
         length(array_to_string(p[1 : i], '')) + length(array_to_string(m[1 : i - 1], '')) AS s
  FROM each WHERE length(part[i]) >= least),
rows AS (
  SELECT rid, count(*) FILTER (WHERE kind = 'assign') AS n_assign, count(*) FILTER (WHERE kind = 'access') AS n_access,
         count(*) FILTER (WHERE kind = 'hex') AS n_hex,
         string_agg(kind || ':' || s || ':' || (s + n), ',' ORDER BY s, rank) FILTER (WHERE rank < 3) AS base,
         string_agg(kind || ':' || s || ':' || (s + n), ',' ORDER BY s, rank) AS spans
  FROM placed GROUP BY rid)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs LEFT JOIN rows USING (rid)
"""


def of_kind(spans: str, *kinds: str) -> Column:
    return F.filter(spans, lambda s: s["kind"].isin(*kinds))


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


@register("op11_secret_scan", SQL)
def op11_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    scanned = scan_secrets(table(spark, sf_dir, "documents")).select("doc_id", "secrets")
    counts = [F.size(of_kind("secrets", k)).cast("long").alias(f"n_{k}") for k in BASE]
    base = joined(of_kind("secrets", *BASE))
    return scanned.select("doc_id", *counts, F.sha2(base, 256).alias("base_sha256"), joined(F.col("secrets")).alias("spans"))
