"""Queries: nearest vectors, decontamination and quality scores."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import decontaminate, quality, vptree
from .catalog import query, table

OP2_SQL = """
WITH e AS (
  SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
s AS (
  SELECT q.vec_id AS query_id, b.vec_id, list_sum(list_transform(list_zip(q.v, b.v), lambda z: z[1] * z[2])) AS score
  FROM e q JOIN e b ON q.vec_id <> b.vec_id AND len(q.v) = len(b.v) WHERE q.vec_id % 20 = 0)
SELECT query_id, rank::INT AS rank, vec_id FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 20
"""


@query("op2_nearest_vectors")
def op2_nearest_vectors(spark, sf_dir):
    base = table(spark, sf_dir, "embeddings")
    return vptree.vp_search(base.filter("vec_id % 20 = 0"), base, k=20)


@query("op9_quality_classifier")
def op9_quality_classifier(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.learn(docs, table(spark, sf_dir, "labels"))
    scored = quality.score(docs, model)
    return scored.select("doc_id", quality.held_out("doc_id").alias("held_out"), "score",
                         (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"))


@query("op4_benchmark_decontamination")
def op4_benchmark_decontamination(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontaminate.leaks(docs, table(spark, sf_dir, "benchmark"))
