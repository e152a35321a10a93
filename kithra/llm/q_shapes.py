"""Queries: fill-in-the-middle, vector codes and shared lines."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import dualtree, lineruns, skiplist
from .catalog import query, table

OP11_SQL = """
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, ''))::BIGINT AS n, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS s FROM documents),
h AS (
  SELECT doc_id, t, n, ('0x' || s[1:8])::BIGINT % (n + 1) AS a, ('0x' || s[9:16])::BIGINT % (n + 1) AS b,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR ('0x' || s[17:24])::BIGINT % 100 >= 90 THEN 'plain'
      WHEN ('0x' || s[25:32])::BIGINT % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM d),
c AS (SELECT *, least(a, b) AS lo, greatest(a, b) AS hi FROM h),
p AS (SELECT *, substr(t, 1, lo) AS pre, substr(t, lo + 1, hi - lo) AS mid, substr(t, hi + 1) AS suf FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN lo END AS prefix_chars, CASE WHEN form <> 'plain' THEN hi - lo END AS middle_chars,
  sha256(CASE form WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid WHEN 'spm' THEN '<S>' || suf || '<P>' || pre || '<M>' || mid
    ELSE t END) AS output_sha256, sha256(t) AS restored_sha256 FROM p
"""


@query("op11_fill_in_middle", OP11_SQL)
def op11_fill_in_middle(spark, sf_dir):
    cut = skiplist.fill_in_middle(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                      F.sha2(skiplist.restored(), 256).alias("restored_sha256"))


def _op12_sql(parts=dualtree.PARTS, entries=dualtree.ENTRIES, rounds=dualtree.ROUNDS):
    square = "list_sum(list_transform(list_zip(p.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"

    def nearest(name, book):
        return (f"{name} AS MATERIALIZED (SELECT vec_id, part, entry, v, d FROM (SELECT p.vec_id, p.part, c.entry, p.v, {square} AS d,"
                f" row_number() OVER (PARTITION BY p.vec_id, p.part ORDER BY {square}, c.entry) AS r FROM p JOIN {book} c USING (part)) WHERE r = 1)")

    def means(name, book, assigned):
        floor = "(s - ((s % n) + n) % n) // n"
        return (f"{name} AS MATERIALIZED (SELECT c.part, c.entry, coalesce(m.v, c.v) AS v FROM {book} c LEFT JOIN ("
                f"SELECT part, entry, list({floor} ORDER BY j) AS v FROM (SELECT part, entry, j, sum(x)::BIGINT AS s, count(*) AS n FROM"
                f" (SELECT part, entry, generate_subscripts(v, 1) AS j, unnest(v) AS x FROM {assigned}) GROUP BY part, entry, j)"
                " GROUP BY part, entry) m ON m.part = c.part AND m.entry = c.entry)")

    steps = []
    for r in range(rounds):
        steps += [nearest(f"a{r}", f"c{r}"), means(f"c{r + 1}", f"c{r}", f"a{r}")]
    steps.append(nearest("last", f"c{rounds}"))
    return f"""
WITH e AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor({dualtree.SCALE} * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS MATERIALIZED (SELECT vec_id, part::INT AS part, v[part * len(v) // {parts} + 1 : (part + 1) * len(v) // {parts}] AS v FROM e, range({parts}) t(part)),
first AS (SELECT vec_id, (row_number() OVER (ORDER BY vec_id) - 1)::INT AS entry FROM e ORDER BY vec_id LIMIT {entries}),
c0 AS MATERIALIZED (SELECT p.part, first.entry, p.v FROM p JOIN first USING (vec_id)),
{", ".join(steps)},
told AS (SELECT vec_id, string_agg(lpad(printf('%x', entry), 2, '0'), '' ORDER BY part) AS code, sum(d)::BIGINT AS error FROM last GROUP BY vec_id),
books AS (SELECT sha256(string_agg(x::VARCHAR, ',' ORDER BY part, entry, j)) AS codebooks_sha256 FROM
  (SELECT part, entry, generate_subscripts(v, 1) AS j, unnest(v) AS x FROM c{rounds})),
both_ AS (SELECT vec_id, code, error, label FROM told JOIN e USING (vec_id))
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256 FROM both_, books
"""


@query("op12_vector_codes", _op12_sql())
def op12_vector_codes(spark, sf_dir):
    coded, books = dualtree.encode(table(spark, sf_dir, "embeddings"))
    return coded.withColumn("codebooks_sha256", F.lit(books.sha256()))


OP13_SQL = r"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT doc_id, generate_subscripts(lines, 1) AS pos, unnest(lines) AS line FROM d),
k AS (SELECT doc_id, pos, line,
  translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
shared AS (SELECT key, max(doc_id) AS holder FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
f AS (SELECT doc_id, pos, line, holder IS NOT NULL AND doc_id <> holder AS gone FROM k LEFT JOIN shared USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256 FROM f GROUP BY doc_id
"""


@query("op13_shared_lines", OP13_SQL)
def op13_shared_lines(spark, sf_dir):
    kept = lineruns.drop_shared_lines(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))
