"""Ratings, factor models and neighbours of factors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import arrays
from . import skew
from .knn import as_queries, knn_join
from .ordinal import running_counts, with_ordinal


def label_encode(df: DataFrame, column: str) -> DataFrame:
    """Sorted distinct values numbered from 0: ``(column, code, rows)``; join it back for the inverse."""
    values = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("rows"))
    return with_ordinal(values, [column], "code")


def id_map_join(df: DataFrame, ids: DataFrame, on: str) -> DataFrame:
    """Values to codes, or back, through a ``label_encode`` table."""
    return skew.lookup_join(df, ids, on, "rows")


def to_sparse(ratings: DataFrame) -> DataFrame:
    """``(row, col, value)`` over encoded users and items; repeated cells add up."""
    # summed first: a user or item with very many ratings shrinks to its distinct cells
    cells = ratings.groupBy("user", "item").agg(F.sum("rating").alias("value"))
    users = label_encode(cells, "user").withColumnRenamed("code", "row")
    items = label_encode(cells, "item").withColumnRenamed("code", "col")
    coded = skew.lookup_join(skew.lookup_join(cells, users, "user", "rows").drop("rows"), items, "item", "rows")
    return coded.select("row", "col", "value")


def matrix_factorization(ratings: DataFrame, rank: int = 20, fill_zero: bool = False, iterations: int = 10, seed: int = 0):
    """Non-negative factors ``(id, vector)`` of users and of items.

    Fits the observed cells; with ``fill_zero`` unobserved cells count as weak
    zeros (implicit feedback).
    """
    from pyspark.ml.recommendation import ALS

    cells = ratings.groupBy("user", "item").agg(F.avg("rating").alias("rating"))
    # the trainer takes 32-bit ids, so any ids are numbered first and named again after
    users = label_encode(cells, "user").withColumnRenamed("code", "_u")
    items = label_encode(cells, "item").withColumnRenamed("code", "_i")
    rows = skew.lookup_join(skew.lookup_join(cells, users, "user", "rows").drop("rows"), items, "item", "rows")
    rows = rows.select(F.col("_u").cast("int").alias("user"), F.col("_i").cast("int").alias("item"), "rating")
    model = ALS(rank=rank, maxIter=iterations, userCol="user", itemCol="item", ratingCol="rating",
                nonnegative=True, implicitPrefs=fill_zero, seed=seed, coldStartStrategy="drop").fit(rows)

    def table(factors, codes, column, code):
        named = factors.join(codes.select(F.col(column).alias("_id"), F.col(code).cast("int").alias("id")), "id")
        return named.select(F.col("_id").cast("long").alias("id"), F.col("features").cast("array<double>").alias("vector"))

    return table(model.userFactors, users, "user", "_u"), table(model.itemFactors, items, "item", "_i")


def cosine_factors(ratings: DataFrame, rank: int = 8, seed: int = 0):
    """Factors to be compared by cosine: the factorization of ratings scaled to 0…1."""
    return matrix_factorization(ratings.withColumn("rating", F.col("rating") / 5.0), rank, seed=seed)


def u2i(users: DataFrame, items: DataFrame, k: int = 10, **options) -> DataFrame:
    """Items nearest to every user by cosine."""
    return knn_join(as_queries(users), items, k, "cosine", **options)


def i2i(items: DataFrame, k: int = 10, **options) -> DataFrame:
    """Items nearest to every item by cosine; the item itself comes first."""
    return knn_join(as_queries(items), items, k, "cosine", **options)


def recommend_user(users: DataFrame, items: DataFrame, user_id: int, n: int) -> DataFrame:
    """``(id, score)``: items with the largest inner product with one user's factor."""
    asked = as_queries(users.filter(F.col("id") == user_id))
    return knn_join(asked, items, n, "ip").select("id", F.col("distance").alias("score"))


def history_neighbours(items: DataFrame, centroids, k: int = 200, nprobe: int = 100, **options) -> DataFrame:
    """Neighbours of every item in the whole corpus, normalized, inner product, by cells."""
    from .ivf import build_postings, ivf_knn

    unit = items.select("id", arrays.l2_normalize("vector").alias("vector"))
    return ivf_knn(as_queries(unit), build_postings(unit, centroids, "ip"), centroids, k, nprobe, "ip", **options)


# fixed value: a scaled rating from here on counts as liked
LIKED = 0.75


def auc(scored: DataFrame, positive, score: str) -> DataFrame:
    """Area under the ROC curve by average ranks, as one row ``(auc)``.

    Works on distinct scores: ties share the mean of their ranks.
    """
    # two counts per distinct score
    groups = scored.groupBy(F.col(score).alias("x")).agg(
        F.count("*").alias("n"), F.sum(positive.cast("long")).alias("pos"))
    ranks = running_counts(groups.select("x", "n")).select("x", "before")
    both = groups.join(ranks, "x")
    out = both.agg(
        F.sum(F.col("pos") * (F.col("before") + (F.col("n") + 1) / 2.0)).alias("r"),
        F.sum("pos").alias("p"), (F.sum("n") - F.sum("pos")).alias("q"))
    return out.select(((F.col("r") - F.col("p") * (F.col("p") + 1) / 2.0) / (F.col("p") * F.col("q"))).alias("auc"))


def mae(scored: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Mean absolute error, as one row ``(mae)``."""
    return scored.agg(F.avg(F.abs(F.col(actual) - F.col(predicted))).alias("mae"))
