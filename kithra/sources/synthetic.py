"""Generated vector sets whose values depend on (id, dimension, seed) only."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import arrays
from ..functions.hashing import keyed_uniform
from ..operators.linear import random_rotation


def cells(dim: int):
    return F.sequence(F.lit(0), F.lit(dim - 1))


def vectors_for(ids: DataFrame, dim: int, seed: int = 0, drift: bool = True) -> DataFrame:
    """U(0,1) vectors for the given ids; component 0 grows by id/1000."""
    value = F.transform(cells(dim), lambda j: keyed_uniform(F.col("id"), j, seed=seed))
    if drift:
        value = F.transform(value, lambda x, j: F.when(j == 0, x + F.col("id") / 1000.0).otherwise(x))
    return ids.select("id", value.alias("vector"))


def synthetic_vectors(spark: SparkSession, n: int, dim: int, seed: int = 0, drift: bool = True) -> DataFrame:
    return vectors_for(spark.range(n), dim, seed, drift)


def gaussian_for(ids: DataFrame, dim: int, seed: int = 0, scales=None, rotate: bool = False) -> DataFrame:
    """N(0,1) per component (Box–Muller), times a scale each, optionally rotated."""
    normal = F.transform(cells(dim), lambda j: (
        F.sqrt(-2 * F.ln(1 - keyed_uniform(F.col("id"), j, F.lit("r"), seed=seed)))
        * F.cos(2 * math.pi * keyed_uniform(F.col("id"), j, F.lit("t"), seed=seed))
    ))
    if scales is not None:
        normal = F.zip_with(normal, arrays.constant_vector(scales), lambda x, s: x * s)
    df = ids.select("id", normal.alias("vector"))
    return random_rotation(dim, dim, seed).transform(df) if rotate else df


def synthetic_gaussian(spark, n: int, dim: int, seed: int = 0, scales=None, rotate=False) -> DataFrame:
    return gaussian_for(spark.range(n), dim, seed, scales, rotate)
