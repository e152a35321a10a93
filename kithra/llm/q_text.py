"""Queries: secrets, licenses and repeated text."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import licenses, linededup, secrets, suffixdedup
from .catalog import query, table

OP3_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
rules(kind, place, pat, grp, least) AS (VALUES
  ('assign', 0, '([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 2, 8),
  ('access', 1, 'AKIA[A-Z0-9]+', 0, 16),
  ('hex', 2, '[0-9a-f]{32,}', 0, 32),
  ('private_key', 3, '-----BEGIN [A-Z ]*PRIVATE KEY-----', 0, 0),
  ('signed_token', 4, 'eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+', 0, 0),
  ('prefixed_token', 5, '(?:ghp|gho|ghu|ghs|ghr|glpat|xoxb|xoxp|sk_live|rk_live)[_-][A-Za-z0-9_-]{16,}', 0, 0)),
parts AS (
  SELECT doc_id, kind, place, least, regexp_extract_all(t, pat) AS found,
    CASE WHEN kind = 'assign' THEN regexp_extract_all(t, pat, 2) ELSE regexp_extract_all(t, pat) END AS told,
    string_split_regex(t, pat) AS gaps
  FROM d, rules),
each AS (SELECT doc_id, kind, place, least, found, told, gaps, unnest(range(1, len(found) + 1)) AS i FROM parts WHERE len(found) > 0),
placed AS (
  SELECT doc_id, kind, place, length(told[i]) >= least AS keep,
    list_sum(list_transform(gaps[1:i], lambda x: length(x)))::BIGINT + coalesce(list_sum(list_transform(found[1:i-1], lambda x: length(x))), 0)::BIGINT AS s,
    length(found[i]) AS n FROM each),
spans AS (SELECT doc_id, kind, place, s, kind || ':' || s || ':' || (s + n) AS span FROM placed WHERE keep),
lists AS (
  SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
    count(*) FILTER (kind = 'hex') AS n_hex, coalesce(string_agg(span, ',' ORDER BY s, place) FILTER (place < 3), '') AS base,
    string_agg(span, ',' ORDER BY s, place) AS spans FROM spans GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access, coalesce(n_hex, 0)::BIGINT AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN lists USING (doc_id)
"""


@query("op3_secret_scan", OP3_SQL)
def op3_secret_scan(spark, sf_dir):
    return secrets.digest(secrets.scan(table(spark, sf_dir, "documents")))


@query("op8_line_dedup")
def op8_line_dedup(spark, sf_dir):
    found = linededup.dedup_lines(table(spark, sf_dir, "documents"))
    spans = F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string"))), ",")
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", spans.alias("spans"))


@query("op7_license_scan")
def op7_license_scan(spark, sf_dir):
    return licenses.scan(table(spark, sf_dir, "documents"))


@query("op1_suffix_array_dedup")
def op1_suffix_array_dedup(spark, sf_dir):
    found = suffixdedup.byte_dedup(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
