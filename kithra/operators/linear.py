"""Statistics, linear transforms and their training.

Training reduces rows to objects of size d or d × d inside the executors; only
those reach the driver.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import arrays, kernels
from ..functions.arrowmap import with_arrow_column
from .selection import exact_quantiles


# ---------------------------------------------------------------- statistics

def vector_stats(df: DataFrame, vector: str = "vector", by: list[str] | None = None) -> DataFrame:
    """Per-dimension count, mean, population variance, min and max."""
    by = by or []
    cells = df.select(*by, F.posexplode(arrays.doubles(vector)).alias("dim", "x"))
    return cells.groupBy(*by, "dim").agg(
        F.count("x").alias("n"),
        F.avg("x").alias("mean"),
        F.var_pop("x").alias("var"),
        F.min("x").alias("min"),
        F.max("x").alias("max"),
    )


def column_of(stats: DataFrame, name: str) -> np.ndarray:
    """One statistic as a d-vector on the driver (d rows)."""
    rows = stats.select("dim", name).orderBy("dim").collect()
    return np.array([r[1] for r in rows], dtype=np.float64)


def mean_vector(df: DataFrame, vector: str = "vector") -> np.ndarray:
    cells = df.select(F.posexplode(arrays.doubles(vector)).alias("dim", "x"))
    return column_of(cells.groupBy("dim").agg(F.avg("x").alias("mean")), "mean")


def gram_rows(df: DataFrame, vector: str = "vector", shift=None, other: str | None = None) -> DataFrame:
    """XᵀX (or XᵀY with ``other``) as rows ``(i, j, value)``.

    Each partition folds its rows into one partial matrix before the shuffle.
    """
    spark = df.sparkSession
    shift = None if shift is None else spark.sparkContext.broadcast(np.asarray(shift, np.float64))
    columns = [F.col(vector).alias("v")] + ([F.col(other).alias("w")] if other else [])

    def fold(batches):
        total = None
        for batch in batches:
            if not batch.num_rows:
                continue
            x = kernels.matrix(batch.column(0))
            if shift is not None:
                x = x - shift.value
            y = kernels.matrix(batch.column(1)) if other else x
            part = x.T @ y
            total = part if total is None else total + part
        if total is not None:
            yield pa.record_batch({
                "i": pa.array(np.arange(len(total)), pa.int32()),
                "row": kernels.list_array(total, pa.float64()),
            })

    partial = df.filter(F.col(vector).isNotNull()).select(*columns).mapInArrow(fold, "i int, row array<double>")
    return (
        partial.select("i", F.posexplode("row").alias("j", "x")).groupBy("i", "j").agg(F.sum("x").alias("value"))
    )


def matrix_of(rows: DataFrame) -> np.ndarray:
    """``(i, j, value)`` rows of a model-sized matrix → array on the driver."""
    found = rows.select("i", "j", "value").toPandas()
    out = np.zeros((int(found.i.max()) + 1, int(found.j.max()) + 1))
    out[found.i.to_numpy(), found.j.to_numpy()] = found.value.to_numpy()
    return out


def gram(df: DataFrame, vector: str = "vector") -> DataFrame:
    return gram_rows(df, vector)


def covariance(df: DataFrame, vector: str = "vector") -> DataFrame:
    """Population covariance as rows ``(i, j, value)``."""
    n = df.filter(F.col(vector).isNotNull()).count()
    return gram_rows(df, vector, shift=mean_vector(df, vector)).withColumn("value", F.col("value") / n)


def pairwise_dots(df: DataFrame) -> DataFrame:
    """XXᵀ as ``(i, j, value)``, for sets with fewer rows than dimensions only."""
    from .blockjoin import block_join

    if df.count() >= _dim(df, "vector"):
        raise ValueError("more rows than dimensions: use gram")

    queries = df.select(F.col("id").alias("query_id"), "vector")
    found = block_join(queries, df, "ip", radius=-float("inf"))
    return found.select(F.col("query_id").alias("i"), F.col("id").alias("j"), F.col("distance").alias("value"))


# ------------------------------------------------- whole-set normalizations

def zero_mean(x: DataFrame, q: DataFrame, vector: str = "vector") -> tuple[DataFrame, DataFrame]:
    """Subtract the mean of ``x`` from both sets."""
    mean = arrays.constant_vector(mean_vector(x, vector))
    return tuple(d.withColumn(vector, arrays.subtract(vector, mean)) for d in (x, q))


def max_norm(x: DataFrame, vector: str = "vector") -> float:
    return x.agg(F.max(arrays.vector_norm(vector))).first()[0]


def max_norm_scale(x, q, vector="vector"):
    """Divide both sets by the largest norm of ``x``."""
    top = F.lit(max_norm(x, vector))
    return tuple(d.withColumn(vector, arrays.divide(vector, top)) for d in (x, q))


def mean_abs(x: DataFrame, vector: str = "vector") -> float:
    return x.select(F.explode(arrays.doubles(vector)).alias("x")).agg(F.avg(F.abs("x"))).first()[0]


def coeff_scale(x, q, s: float, vector="vector"):
    """Divide both sets by mean|x| / s."""
    factor = F.lit(mean_abs(x, vector) / s)
    return tuple(d.withColumn(vector, arrays.divide(vector, factor)) for d in (x, q))


def one_half_scale(x, q, vector="vector"):
    """Mean absolute coefficient becomes one half."""
    return coeff_scale(x, q, 0.5, vector)


def inverse_d_scale(x, q, dim: int, vector="vector"):
    """Mean absolute coefficient becomes 1/d."""
    return coeff_scale(x, q, 1.0 / dim, vector)


def mips_to_l2(base: DataFrame, queries: DataFrame, vector="vector") -> tuple[DataFrame, DataFrame]:
    """Append sqrt(φ − ‖x‖²), φ the largest ‖x‖², and 0 to queries.

    The l2 neighbours of the result are the inner-product neighbours.
    """
    phi = base.agg(F.max(arrays.squared_norm(vector))).first()[0]
    extra = F.sqrt(F.greatest(F.lit(phi) - arrays.squared_norm(vector), F.lit(0.0)))
    return (
        base.withColumn(vector, F.concat(arrays.doubles(vector), F.array(extra))),
        queries.withColumn(vector, F.concat(arrays.doubles(vector), F.array(F.lit(0.0)))),
    )


def e2m_transform(x: DataFrame, q: DataFrame, vector="vector") -> tuple[DataFrame, DataFrame]:
    """Append [M − ‖x‖², 0, 0, 0] to the base, M the largest ‖x‖, and [½, 0, 0, 0] to queries."""
    top = F.lit(max_norm(x, vector))
    zero = F.lit(0.0)
    base = F.concat(arrays.doubles(vector), F.array(top - arrays.squared_norm(vector), zero, zero, zero))
    query = F.concat(arrays.doubles(vector), F.array(F.lit(0.5), zero, zero, zero))
    return x.withColumn(vector, base), q.withColumn(vector, query)


def e2m_gram(x: DataFrame, vector="vector") -> DataFrame:
    """XᵀX / n after appending −½, as ``(i, j, value)``."""
    n = x.count()
    wide = x.withColumn(vector, F.concat(arrays.doubles(vector), F.array(F.lit(-0.5))))
    return gram_rows(wide, vector).withColumn("value", F.col("value") / n)


def uniform_quantize(df: DataFrame, column: str, n: int) -> DataFrame:
    """Equal-width buckets: adds ``bucket`` and its mid ``value``."""
    low, high = df.agg(F.min(column), F.max(column)).first()
    bucket, value = uniform_bucket(F.col(column), low, high, n)
    return df.withColumn("bucket", bucket).withColumn("value", value)


def uniform_bucket(x: Column, low: float, high: float, n: int) -> tuple[Column, Column]:
    span = F.lit(float(high)) - F.lit(float(low))
    if high == low:
        return F.lit(0).cast("long"), F.lit(float(low))
    bucket = F.floor((x - low) / span * (n - 1))
    step = span / (n - 1)
    return bucket, F.lit(float(low)) + (bucket.cast("double") + 0.5) * step


# --------------------------------------------------------- linear transforms

def apply_linear(df: DataFrame, matrix, bias=None, source="vector", out="vector") -> DataFrame:
    """out = source·A + b, one matrix product per Arrow batch."""
    a = np.asarray(matrix, np.float64)
    b = np.zeros(a.shape[1]) if bias is None else np.asarray(bias, np.float64)
    return with_arrow_column(
        df, out, "array<double>", source, lambda v: kernels.list_array(kernels.matrix(v) @ a + b, pa.float64()))


@dataclass
class Linear:
    """A trained v·A + b."""

    matrix: np.ndarray
    bias: np.ndarray | None = None

    @property
    def dim_out(self) -> int:
        return self.matrix.shape[1]

    def transform(self, df: DataFrame, column: str = "vector") -> DataFrame:
        return apply_linear(df, self.matrix, self.bias, column, column)

    def then(self, other: "Linear") -> "Linear":
        """One map for two in a row."""
        bias = np.zeros(self.dim_out) if self.bias is None else self.bias
        tail = 0.0 if other.bias is None else other.bias
        return Linear(self.matrix @ other.matrix, bias @ other.matrix + tail)


@dataclass
class L2Norm:
    """Stage: scale every vector to unit length."""

    def fit(self, df, column="vector"):
        return self

    def transform(self, df, column="vector"):
        return df.withColumn(column, arrays.l2_normalize(column))


@dataclass
class Pad:
    """Stage: zero-pad to ``dim`` components."""

    dim: int

    def fit(self, df, column="vector"):
        return self

    def transform(self, df, column="vector"):
        return df.withColumn(column, arrays.pad(column, self.dim))


@dataclass
class Remap:
    """Stage: choose components by position."""

    positions: list[int]

    def fit(self, df, column="vector"):
        return self

    def transform(self, df, column="vector"):
        return df.withColumn(column, arrays.remap(column, self.positions))


def _dim(df, column) -> int:
    return df.select(F.size(column)).first()[0]


def random_rotation(d_in: int, d_out: int, seed: int = 0) -> Linear:
    """Orthonormal columns (or rows, when the output is wider)."""
    size = max(d_in, d_out)
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((size, size)))
    q = q * np.sign(np.diag(r))
    return Linear(q[:d_in, :d_out])


def random_projection(d_in: int, bits: int, seed: int = 0) -> Linear:
    return Linear(np.random.default_rng(seed).standard_normal((d_in, bits)))


@dataclass
class RandomRotation:
    """Stage: random rotation to ``dim`` components."""

    dim: int | None = None
    seed: int = 0

    def fit(self, df, column="vector"):
        d = _dim(df, column)
        return random_rotation(d, self.dim or d, self.seed)


@dataclass
class PCA:
    """Stage: principal components; whitening multiplies by eigenvalue^power."""

    dim: int
    power: float = 0.0
    rotate: bool = False
    seed: int = 0

    def fit(self, df, column="vector") -> Linear:
        mean = mean_vector(df, column)
        n = df.count()
        cov = matrix_of(gram_rows(df, column, shift=mean)) / n
        values, vectors = np.linalg.eigh(cov)
        order = np.argsort(values)[::-1][: self.dim]
        values, vectors = values[order], vectors[:, order]
        vectors = vectors * np.where(vectors[np.abs(vectors).argmax(0), np.arange(len(order))] < 0, -1.0, 1.0)
        if self.power:
            floor = max(values.max(), 0.0) * 1e-12
            vectors = vectors * np.where(values > floor, np.maximum(values, floor), np.inf) ** self.power
        model = Linear(vectors, -mean @ vectors)
        if self.rotate:
            model = model.then(random_rotation(len(order), len(order), self.seed))
        return model


@dataclass
class MahalanobisWhiten:
    """Stage: make the covariance the identity; directions without variance are dropped."""

    eps: float = 1e-10

    def fit(self, df, column="vector") -> Linear:
        cov = matrix_of(covariance(df, column))
        values, vectors = np.linalg.eigh(cov)
        live = values > self.eps * max(values.max(), 1e-300)
        if live.all():
            return Linear(np.linalg.inv(np.linalg.cholesky(cov)).T)
        return Linear(vectors[:, live] / np.sqrt(values[live]))


@dataclass
class ITQ:
    """Stage: PCA to ``bits``, then the rotation that best meets the sign codes."""

    bits: int
    iterations: int = 10
    seed: int = 0

    def fit(self, df, column="vector") -> Linear:
        pca = PCA(self.bits).fit(df, column)
        low = pca.transform(df.select(column), column)
        rotation = random_rotation(self.bits, self.bits, self.seed).matrix
        for _ in range(self.iterations):
            turned = apply_linear(low.select(F.col(column).alias("v")), rotation, source="v", out="w")
            signs = turned.withColumn("w", F.transform("w", lambda x: F.when(x > 0, 1.0).otherwise(-1.0)))
            u, _, vt = np.linalg.svd(matrix_of(gram_rows(signs, "v", other="w")))
            rotation = u @ vt
        return pca.then(Linear(rotation))


def median_thresholds(df: DataFrame, vector: str = "vector") -> DataFrame:
    """Exact per-dimension median ``(dim, threshold)``, so that bits are balanced."""
    middle = exact_quantiles(df, [0.5], vector)[0]
    return df.sparkSession.createDataFrame([(i, float(x)) for i, x in enumerate(middle)], "dim int, threshold double")


@dataclass
class Chain:
    """Stages applied in order; each is trained on the output of the ones before."""

    stages: list = field(default_factory=list)

    def fit(self, df: DataFrame, column: str = "vector") -> "Chain":
        fitted = []
        for stage in self.stages:
            model = stage.fit(df, column) if hasattr(stage, "fit") else stage
            df = model.transform(df, column)
            fitted.append(model)
        return Chain(fitted)

    def transform(self, df: DataFrame, column: str = "vector") -> DataFrame:
        for stage in self.stages:
            df = stage.transform(df, column)
        return df
