"""Exact neighbour joins and the lookups built on them.

Queries are ``(query_id, vector)``, the base is ``(id, vector)``; results are
``(query_id, rank, id, distance)``, best first, ties by ascending id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import arrays, distances
from ..functions.hashing import keyed_hash
from .blockjoin import block_join, search, small_side, top_k

# metrics computed as another metric on prepared vectors
_NORMALIZED = ("cosine", "angular")


def _prepare(df: DataFrame, metric) -> DataFrame:
    if metric in _NORMALIZED:
        return df.withColumn("vector", arrays.l2_normalize("vector"))
    if metric in ("hamming", "code_mismatch"):
        return df
    return df.withColumn("vector", arrays.doubles("vector"))


def _kernel_metric(metric):
    return "ip" if metric in _NORMALIZED else metric


def is_similarity(metric) -> bool:
    return metric in distances.SIMILARITIES


def knn_join(queries: DataFrame, base: DataFrame, k: int, metric="l2", **options) -> DataFrame:
    """Exact k nearest base rows of every query; a row is its own neighbour."""
    found = search(_prepare(queries, metric), _prepare(base, metric), k, _kernel_metric(metric), **options)
    if metric == "angular":
        found = found.withColumn("distance", distances.angle_of(F.col("distance")))
    return found


def range_join(queries, base, radius: float, metric="l2", **options) -> DataFrame:
    """All ``(query_id, id, distance)`` nearer than ``radius``.

    Strictly below for distances (``l2`` is compared squared), strictly above
    for similarities.
    """
    if metric == "angular":
        raise ValueError("use cosine with the cosine of the angle")
    return block_join(
        _prepare(queries, metric), _prepare(base, metric), _kernel_metric(metric), radius=radius, **options
    )


def as_queries(df: DataFrame) -> DataFrame:
    """(id, vector) → (query_id, vector)."""
    return df.select(F.col("id").alias("query_id"), "vector")


def self_knn(df, k: int, candidates: int | None = None, remove_self=True, mode="best", seed=0, metric="l2", **options):
    """Neighbours of every row among the others.

    ``candidates`` rows are fetched, the row itself is dropped, and ``k`` are
    kept: the ``best`` ones, or a ``sample`` without replacement.
    """
    if mode not in ("best", "sample"):
        raise ValueError("mode must be 'best' or 'sample'")
    candidates = candidates or k + 1
    found = knn_join(as_queries(df), df, candidates, metric, **options)
    if remove_self:
        found = found.filter(F.col("query_id") != F.col("id"))
    order = [F.col("rank")]
    if mode == "sample":
        order = [keyed_hash("query_id", "id", seed=seed), F.col("id")]
    window = Window.partitionBy("query_id").orderBy(*order)
    return (
        found.withColumn("rank", F.row_number().over(window))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "id", "distance")
    )


def knn_pairs(df, k: int, **options) -> DataFrame:
    """Self neighbours as flat (i, j) pairs."""
    return self_knn(df, k, **options).select(F.col("query_id").alias("i"), F.col("id").alias("j"))


def mutual_nn(a: DataFrame, b: DataFrame, metric="l2", **options) -> DataFrame:
    """Pairs (i, j) that are each other's nearest row: ``(i, j, distance)``."""
    forward = knn_join(as_queries(a), b, 1, metric, **options)
    backward = knn_join(as_queries(b), a, 1, metric, **options)
    back = backward.select(F.col("id").alias("i"), F.col("query_id").alias("j"))
    return forward.select(F.col("query_id").alias("i"), F.col("id").alias("j"), "distance").join(back, ["i", "j"])


def refine(result: DataFrame, queries: DataFrame, base: DataFrame, k: int, metric="l2") -> DataFrame:
    """Recompute true distances of an approximate result and keep the best k.

    Carries ids until the very end; vectors are joined for the surviving rows
    only, and the base is not shuffled when the candidates can be broadcast.
    """
    dist = distances.DISTANCES[metric](F.col("_q"), F.col("_b"))
    scored = (
        base.select("id", F.col("vector").alias("_b"))
        .join(small_side(result.select("query_id", "id")), "id")
        .join(queries.select("query_id", F.col("vector").alias("_q")), "query_id")
        .select("query_id", "id", dist.alias("distance"))
    )
    return top_k(scored, k, is_similarity(metric))


def merge_topk(k: int, *results: DataFrame, metric="l2") -> DataFrame:
    """Merge the results of disjoint shards into one top-k."""
    merged = results[0].select("query_id", "id", "distance")
    for other in results[1:]:
        merged = merged.unionByName(other.select("query_id", "id", "distance"))
    return top_k(merged, k, is_similarity(metric))


def search_by_id(ids: DataFrame, base: DataFrame, k: int, metric="l2", **options) -> DataFrame:
    """Neighbours of stored rows; an unknown id keeps one row with nulls."""
    known = ids.select("id").distinct()
    vectors = base.select("id", "vector").join(small_side(known), "id")
    found = knn_join(as_queries(vectors), base, k, metric, **options)
    return known.select(F.col("id").alias("query_id")).join(found, "query_id", "left")


def global_topk(pairs: DataFrame, n: int, similarity=False) -> DataFrame:
    """Nearest n pairs overall."""
    key = F.col("distance").desc() if similarity else F.col("distance").asc()
    return pairs.orderBy(key, "query_id", "id").limit(n)


def federated_search(queries, bases: list[DataFrame], k: int, metric="cosine", **options) -> DataFrame:
    """Top-k of several collections, re-scored together: adds ``source`` (0-based)."""
    merged = None
    for number, base in enumerate(bases):
        part = knn_join(queries, base, k, metric, **options).withColumn("source", F.lit(number))
        merged = part if merged is None else merged.unionByName(part)
    key = F.col("distance").desc() if is_similarity(metric) else F.col("distance").asc()
    window = Window.partitionBy("query_id").orderBy(key, "source", "id")
    return (
        merged.withColumn("rank", F.row_number().over(window))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "source", "id", "distance")
    )


def pair_similarity(left: DataFrame, right: DataFrame, on: str = "pair_id", metric="cosine") -> DataFrame:
    """Similarity of aligned rows of two sets."""
    dist = distances.DISTANCES[metric](F.col("_l"), F.col("_r"))
    return (
        left.select(on, F.col("vector").alias("_l"))
        .join(right.select(on, F.col("vector").alias("_r")), on)
        .select(on, dist.alias("distance"))
    )


def attach_attributes(result: DataFrame, items: DataFrame, on: str = "id") -> DataFrame:
    """Neighbour id → item columns; the rank column keeps the order.

    The items are cut down to the wanted ones first, so that a large item table
    is not shuffled for a small result.
    """
    wanted = items.join(small_side(result.select(on).distinct()), on, "left_semi")
    return result.join(wanted, on, "left")


def eval_intersection(a: DataFrame, b: DataFrame) -> DataFrame:
    """Σ over queries of |neighbours in a ∩ neighbours in b|, as one row."""
    return a.select("query_id", "id").join(b.select("query_id", "id"), ["query_id", "id"]).agg(
        F.count("*").alias("common")
    )


def remove_where(df: DataFrame, selector: Column) -> DataFrame:
    """Drop the rows a boolean column selects (null counts as not selected)."""
    return df.filter(~F.coalesce(selector, F.lit(False)))
