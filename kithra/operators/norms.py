"""Direction and length quantized apart."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import arrays
from .codebooks import fit_codebook
from .ordinal import quantiles

METHODS = ("kmeans", "kmeans_partial", "percentile", "uniform", "exponential")
# fixed values: interval growth of the exponential method, share of small norms
GROWTH = 0.98
SMALL_SHARE = 0.7


def edges_uniform(low: float, high: float, n: int) -> list[float]:
    return [low + (high - low) * i / n for i in range(n + 1)]


def edges_exponential(low: float, high: float, n: int) -> list[float]:
    """Interval widths shrink by the growth factor and sum to the whole span."""
    return [low + (high - low) * (1 - GROWTH**i) / (1 - GROWTH**n) for i in range(n + 1)]


@dataclass
class NormCodec:
    """``inner`` codes the unit vector; the ratio ‖x‖/‖x̂‖ is put in one of the intervals or centres."""

    inner: object
    method: str
    edges: list[float] = field(default_factory=list)
    centres: list[float] = field(default_factory=list)

    def encode_norm(self, ratio: Column) -> Column:
        if self.centres:
            table = arrays.constant_vector(self.centres)

            def nearest(r):
                return F.array_min(F.transform(table, lambda c, i: F.struct(F.abs(r - c).alias("d"), i.alias("i"))))

            return arrays.bind(ratio, nearest)["i"].cast("int")
        inner = arrays.constant_vector(self.edges[1:-1])
        return arrays.bind(ratio, lambda r: F.aggregate(inner, F.lit(0), lambda s, e: s + (r >= e).cast("int")))

    def decode_norm(self, code: Column) -> Column:
        if self.centres:
            return F.get(arrays.constant_vector(self.centres), code)
        low, high = arrays.constant_vector(self.edges[:-1]), arrays.constant_vector(self.edges[1:])
        return (F.get(low, code) + F.get(high, code)) / 2.0

    def encode(self, df, vector="vector", codes="codes"):
        """``struct<direction, norm: int>``"""
        rows = directions(df, self.inner, vector)
        out = F.struct(F.col("_direction").alias("direction"), self.encode_norm(F.col("_ratio")).alias("norm"))
        return rows.withColumn(codes, out).drop("_unit", "_direction", "_approx", "_ratio")

    def decode(self, df, codes="codes", vector="vector"):
        rows = self.inner.decode(df.withColumn("_direction", F.col(codes)["direction"]), "_direction", "_approx")
        length = self.decode_norm(F.col(codes)["norm"])
        scaled = arrays.bind(length, lambda n: F.transform("_approx", lambda x: x * n))
        return rows.withColumn(vector, scaled).drop("_direction", "_approx")

    def compress(self, df, vector="vector"):
        return self.decode(self.encode(df, vector, "_codes"), "_codes", vector).drop("_codes")

    def class_message(self):
        return f"norm-explicit ({self.method}) over {self.inner.class_message()}"


def directions(df: DataFrame, inner, vector="vector") -> DataFrame:
    """Adds the coded direction and the length ratio ‖x‖/‖x̂‖."""
    rows = df.withColumn("_unit", arrays.l2_normalize(vector))
    rows = inner.decode(inner.encode(rows, "_unit", "_direction"), "_direction", "_approx")
    size = arrays.vector_norm("_approx")
    ratio = F.when(size > 0, arrays.vector_norm(vector) / F.when(size > 0, size)).otherwise(0.0)
    return rows.withColumn("_ratio", ratio)


@dataclass
class NormExplicitQuantizer:
    """``inner`` is a quantizer to fit on directions, or a trained codec."""

    inner: object
    n: int = 256
    method: str = "kmeans"
    iterations: int = 20
    seed: int = 0

    def fit(self, df: DataFrame, vector="vector", key="id") -> NormCodec:
        if self.method not in METHODS:
            raise ValueError(f"method must be one of {METHODS}")
        inner = self.inner
        if hasattr(inner, "fit"):
            inner = inner.fit(df.withColumn(vector, arrays.l2_normalize(vector)), vector, key)
        ratios = directions(df.select(key, vector), inner, vector).select(key, F.col("_ratio").alias("ratio"))
        if self.method.startswith("kmeans"):
            return NormCodec(inner, self.method, centres=self._centres(ratios, key))
        if self.method == "percentile":
            edges = quantiles(ratios, "ratio", [i / self.n for i in range(self.n + 1)])
        else:
            low, high = ratios.agg(F.min("ratio"), F.max("ratio")).first()
            make = edges_uniform if self.method == "uniform" else edges_exponential
            edges = make(low, high, self.n)
        return NormCodec(inner, self.method, edges=[float(e) for e in edges])

    def _centres(self, ratios: DataFrame, key: str) -> list[float]:
        rows = ratios.select(key, F.array("ratio").alias("vector"))
        if self.method == "kmeans":
            groups = [(rows, self.n)]
        else:
            cut = quantiles(ratios, "ratio", [SMALL_SHARE])[0]
            small = F.element_at("vector", 1) < cut
            groups = [(rows.filter(small), self.n // 2), (rows.filter(~small), self.n // 2)]
        found = [fit_codebook(g, 1, k, self.iterations, "hash", self.seed, key).centroids[:, 0] for g, k in groups]
        return np.sort(np.concatenate(found)).tolist()


def kmeans_quantize(df: DataFrame, column: str, n: int = 256, iterations: int = 20, seed: int = 0, key: str = "id") -> DataFrame:
    """Scalars replaced by their 1-d k-means centre: adds ``value``."""
    rows = df.select(key, F.array(F.col(column).cast("double")).alias("vector"))
    centres = np.sort(fit_codebook(rows, 1, n, iterations, "hash", seed, key).centroids[:, 0]).tolist()
    codec = NormCodec(None, "kmeans", centres=centres)
    return df.withColumn("value", codec.decode_norm(codec.encode_norm(F.col(column).cast("double"))))
