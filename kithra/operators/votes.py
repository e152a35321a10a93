"""Images found by the votes of their descriptors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .knn import knn_join


def vote_match(queries: DataFrame, base: DataFrame, top_n: int, min_votes: int = 4, metric="l2", **options) -> DataFrame:
    """``(image_id, rank, id, votes, confidence)`` per query image.

    ``queries`` is ``(image_id, query_id, vector)``, one row per descriptor;
    ``base`` is ``(id, vector)`` with the image as ``id``, repeated for each of
    its descriptors.  A descriptor fetches ``top_n`` rows and votes once for each
    image among them; confidence is votes per hundred query descriptors.
    """
    found = knn_join(queries.select("query_id", "vector"), base, top_n, metric, **options)
    voters = queries.select("query_id", "image_id")
    votes = (
        found.select("query_id", "id").distinct().join(voters, "query_id")
        .groupBy("image_id", "id").agg(F.count("*").alias("votes")).filter(F.col("votes") >= min_votes)
    )
    sizes = queries.groupBy("image_id").agg(F.count("*").alias("_n"))
    window = Window.partitionBy("image_id").orderBy(F.col("votes").desc(), "id")
    return (
        votes.withColumn("rank", F.row_number().over(window)).filter(F.col("rank") <= top_n)
        .join(sizes, "image_id")
        .select("image_id", "rank", "id", "votes", (F.lit(100.0) * F.col("votes") / F.col("_n")).alias("confidence"))
    )


def best_and_similar(matches: DataFrame) -> DataFrame:
    """``(image_id, best, confidence, similar)``: the highest score, and the other ids in order."""
    slots = matches.groupBy("image_id").agg(
        F.array_sort(F.collect_list(F.struct((-F.col("confidence")).alias("c"), "id"))).alias("m"))
    return slots.select(
        "image_id", F.col("m")[0]["id"].alias("best"), (-F.col("m")[0]["c"]).alias("confidence"),
        F.transform(F.slice("m", F.lit(2), F.size("m")), lambda s: s["id"]).alias("similar"))
