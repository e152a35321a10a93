"""Shuffles, splits, samples and batches that depend on ids, never on the partitioning."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import keyed_hash, keyed_uniform
from ..functions.strings import word_count
from .codebooks import first_by_hash
from .ordinal import with_ordinal
from .skew import lookup_join


def shuffle(df: DataFrame, seed: int = 0, key: str = "id") -> DataFrame:
    return df.orderBy(keyed_hash(key, seed=seed), key)


def random_split(df: DataFrame, proportions: dict[str, float], seed: int = 0, key: str = "id") -> DataFrame:
    """Adds ``split``: each row falls on its own, by its key."""
    total = sum(proportions.values())
    draw = keyed_uniform(key, seed=seed)
    out, edge = None, 0.0
    names = list(proportions)
    for name in names[:-1]:
        edge += proportions[name] / total
        out = F.when(draw < edge, F.lit(name)) if out is None else out.when(draw < edge, F.lit(name))
    last = F.lit(names[-1])
    return df.withColumn("split", last if out is None else out.otherwise(last))


def prefix_split(df: DataFrame, share: float = 0.95, seed: int = 0, key: str = "id") -> DataFrame:
    """Adds ``train``: the first ``share`` of the rows in shuffled order."""
    n = df.count()
    numbered = with_ordinal(df, [keyed_hash(key, seed=seed), F.col(key)], "_i")
    return numbered.withColumn("train", F.col("_i") < int(n * share)).drop("_i")


def split_by_class(df: DataFrame, ratio: float, label: str = "label", seed: int = 0) -> DataFrame:
    """Adds ``train``: whole classes to one side, round(classes·(1 − ratio)) of them to training."""
    classes = df.groupBy(label).agg(F.count("*").alias("_n"))
    count = classes.count()
    ordered = with_ordinal(classes, [keyed_hash(label, seed=seed), F.col(label)], "_i")
    side = ordered.select(label, (F.col("_i") < round(count * (1 - ratio))).alias("train"), "_n")
    return lookup_join(df, side, label, "_n").drop("_n")


def split_within_class(df: DataFrame, ratio: float, minimum: int = 1, label: str = "label", seed: int = 0, key: str = "id") -> DataFrame:
    """Adds ``train``: ⌊n(1 − ratio)⌋ rows of each class train, at least one tests.

    Classes with fewer than ``minimum`` training rows are left out.
    """
    # one sort over all classes, then each class is shifted by its start
    numbered = with_ordinal(df, [F.col(label), keyed_hash(key, seed=seed), F.col(key)], "_i")
    sizes = numbered.groupBy(label).agg(F.count("*").alias("_n"), F.min("_i").alias("_start"))
    split = F.floor(F.col("_n") * (1 - ratio))
    split = F.least(split, F.col("_n") - 1)
    sizes = sizes.withColumn("_split", split).filter((F.col("_split") >= minimum) & (F.col("_n") > F.col("_split")))
    rows = lookup_join(numbered, sizes, label, "_n")
    return rows.withColumn("train", F.col("_i") - F.col("_start") < F.col("_split")).select(*df.columns, "train")


def sample_lines(df: DataFrame, n: int, seed: int = 0, key: str = "id", text: str = "text") -> DataFrame:
    """``n`` lines in random order; of those, the ones with more than one word."""
    return first_by_hash(df, n, seed, key).filter(word_count(text) > 1)


def batch(df: DataFrame, size: int, order: list, wrap: int | None = None) -> DataFrame:
    """Adds ``batch``: consecutive chunks of ``size`` rows; with ``wrap`` the numbers start over."""
    number = F.floor(F.col("_i") / size)
    if wrap:
        number = number % wrap
    return with_ordinal(df, order, "_i").withColumn("batch", number.cast("long")).drop("_i")


def next_batch(df: DataFrame, start: int, size: int, order: list) -> DataFrame:
    """Rows start … start + size − 1 of the ordered rows, going round at the end."""
    n = df.count()
    numbered = with_ordinal(df, order, "_i")
    place = F.pmod(F.col("_i") - start, F.lit(max(n, 1)))
    return numbered.filter(place < size).drop("_i")


# ------------------------------------------------------------- set operations

def union(*frames: DataFrame) -> DataFrame:
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def without(df: DataFrame, ids: DataFrame, on: str = "id") -> DataFrame:
    return df.join(ids.select(on).distinct(), on, "left_anti")


def within(df: DataFrame, ids: DataFrame, on: str = "id") -> DataFrame:
    return df.join(ids.select(on).distinct(), on, "left_semi")
