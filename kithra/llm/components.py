"""Connected components by smallest label, with star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component): every linked id and the smallest id reachable from it.

    Each round hangs every id on the smallest id around it, first among larger
    neighbours, then among smaller ones, until nothing changes; rounds grow
    with the logarithm of the longest chain.  Rounds are written to the shared
    folder.  Links of an id to itself and repeated links do no harm.
    """
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u > v").distinct()
    edges = materialize(edges, "links")
    mark = _mark(edges)
    while True:
        edges = materialize(_small_star(_large_star(edges)), "links")
        was, mark = mark, _mark(edges)
        if mark == was:
            break
    # every id now hangs directly on its component's smallest id
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())


def _mark(edges: DataFrame):
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return row[0], row[1]


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    # each larger neighbour goes to the smallest id around u
    return both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u > v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    joined = edges.join(least, "u")
    down = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u > v")
    return down.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
