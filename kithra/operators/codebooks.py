"""Clustering and product codebooks.

One Lloyd pass trains every sub-space of a product codebook at once: each
partition folds its rows into per-(sub-space, code) counts, sums and errors, and
only those model-sized partials are shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import arrays, kernels
from ..functions.arrowmap import add_arrays, with_arrow_column
from ..functions.hashing import HASH_RANGE, keyed_hash

MODEL_BYTES = 256 << 20  # largest model shared with every task


def first_by_hash(df: DataFrame, n: int, seed: int = 0, key: str = "id") -> DataFrame:
    """The ``n`` rows that come first in the seeded hash order of ``key``.

    Hashes are uniform, so rows far behind the n-th can be dropped before the
    sort: it sees about n rows instead of n per partition.
    """
    total = df.count()
    if n < total:
        cut = int(HASH_RANGE * min(1.0, (n + 8 * n**0.5 + 64) / total))
        near = df.filter(keyed_hash(key, seed=seed) < cut)
        if cut < HASH_RANGE and near.count() >= n:  # skewed or repeated keys may leave too few
            df = near
    return df.orderBy(keyed_hash(key, seed=seed), key).limit(n)


def sample_for_training(df: DataFrame, n: int, seed: int = 0, key: str = "id") -> DataFrame:
    """``n`` rows in a random order that depends on the id only."""
    return first_by_hash(df, n, seed, key)


def suggest_nlist(n: int) -> int:
    """Number of cells for ``n`` rows: 4·√n, larger fixed tiers beyond a million."""
    tiers = [(10**6, None), (10**7, 1 << 16), (10**8, 1 << 18)]
    for limit, cells in tiers:
        if n <= limit:
            return cells or max(1, int(4 * n**0.5))
    return 1 << 20


@dataclass
class Codebook:
    """A product codebook: ``words[m]`` holds the Ks × ds codewords of sub-space m.

    One sub-space makes it a plain clustering.
    """

    starts: list[int]
    words: list[np.ndarray]
    objective: list[float] = field(default_factory=list)

    def __post_init__(self):
        size = sum(w.nbytes for w in self.words)
        if size > MODEL_BYTES:
            raise ValueError(f"model of {size} bytes is too large to share with every task")

    @property
    def parts(self):
        return list(zip(self.starts, self.words))

    @property
    def m(self) -> int:
        return len(self.words)

    @property
    def dim(self) -> int:
        return sum(w.shape[1] for w in self.words)

    @property
    def ks(self) -> int:
        return max(len(w) for w in self.words)

    @property
    def centroids(self) -> np.ndarray:
        if self.m != 1:
            raise ValueError("a product codebook has no single set of centroids")
        return self.words[0]

    # ------------------------------------------------------------- as a table

    def to_rows(self, spark: SparkSession) -> DataFrame:
        """``(component, start, code, word)``"""
        rows = [
            (m, s, c, [float(x) for x in word])
            for m, (s, w) in enumerate(self.parts) for c, word in enumerate(w)
        ]
        return spark.createDataFrame(rows, "component int, start int, code int, word array<double>")

    @staticmethod
    def from_rows(df: DataFrame) -> "Codebook":
        found = df.orderBy("component", "code").collect()
        starts, words = {}, {}
        for r in found:
            starts[r["component"]] = r["start"]
            words.setdefault(r["component"], []).append(r["word"])
        return Codebook([starts[m] for m in sorted(words)], [np.array(words[m], float) for m in sorted(words)])

    # ------------------------------------------------------------ row functions

    def encode(self, df: DataFrame, vector="vector", codes="codes") -> DataFrame:
        """Nearest codeword per sub-space, as ``array<int>``."""
        parts = self.parts
        return with_arrow_column(
            df, codes, "array<int>", vector,
            lambda v: kernels.list_array(kernels.assign_codes(kernels.matrix(v), parts).astype(np.int32), pa.int32()))

    def decode(self, df: DataFrame, codes="codes", vector="vector") -> DataFrame:
        words = self.words

        def join_words(c: pa.Array) -> pa.Array:
            code = kernels.matrix(c, np.int64)
            return kernels.list_array(np.hstack([w[code[:, m]] for m, w in enumerate(words)]), pa.float64())

        return with_arrow_column(df, vector, "array<double>", codes, join_words)

    def compress(self, df: DataFrame, vector="vector") -> DataFrame:
        """decode(encode(v)) in place."""
        return self.decode(self.encode(df, vector, "_codes"), "_codes", vector).drop("_codes")

    def class_message(self) -> str:
        return f"product codebook, {self.m} sub-spaces of {self.ks} codewords"


def initial_words(df: DataFrame, k: int, init="hash", seed: int = 0, key: str = "id") -> np.ndarray:
    """``k`` starting vectors: the lowest ids (``first``) or a seeded choice (``hash``)."""
    if init == "first":
        chosen = df.orderBy(key).limit(k)
    elif init == "hash":
        chosen = first_by_hash(df, k, seed, key)
    else:
        raise ValueError("init must be 'first', 'hash' or an array")
    return kernels.matrix(chosen.select(arrays.doubles("vector").alias("v")).toArrow()["v"])


def fit_codebook(df: DataFrame, m: int = 1, k: int = 256, iterations: int = 20, init="hash", seed: int = 0, key: str = "id") -> Codebook:
    """Train ``m`` codebooks of ``k`` words by Lloyd iterations.

    ``init`` may be an array of k starting vectors.  Empty cells keep their
    centre.  ``objective`` records the total squared error per iteration.
    """
    start = init if isinstance(init, np.ndarray) else initial_words(df, k, init, seed, key)
    if len(start) < k:
        raise ValueError(f"{k} codewords need at least {k} training rows, got {len(start)}")
    bounds = arrays.slice_bounds(start.shape[1], m)
    book = Codebook([s for s, _ in bounds], [start[:, s:s + n].copy() for s, n in bounds])
    rows = df.select(arrays.doubles("vector").alias("vector")).persist() if iterations > 1 else df
    for _ in range(iterations):
        book = lloyd_step(rows, book)
    if iterations > 1:
        rows.unpersist()
    return book


def lloyd_step(df: DataFrame, book: Codebook) -> Codebook:
    """One assign-and-average pass over all sub-spaces."""
    parts = book.parts

    def fold(batches):
        state = [(np.zeros(len(w)), np.zeros(len(w)), np.zeros_like(w)) for _, w in parts]
        for batch in batches:
            if not batch.num_rows:
                continue
            x = kernels.matrix(batch.column(0))
            for (start, w), (n, sse, sums) in zip(parts, state):
                sub = x[:, start:start + w.shape[1]]
                code, dist = kernels.nearest(sub, w)
                n += np.bincount(code[:, 0], minlength=len(w))
                sse += np.bincount(code[:, 0], weights=dist[:, 0], minlength=len(w))
                np.add.at(sums, code[:, 0], sub)
        for m, (n, sse, sums) in enumerate(state):
            live = np.flatnonzero(n)
            if len(live):
                yield pa.record_batch({
                    "m": pa.array(np.full(len(live), m), pa.int32()),
                    "code": pa.array(live, pa.int32()),
                    "n": pa.array(n[live]),
                    "sse": pa.array(sse[live]),
                    "sums": kernels.list_array(sums[live], pa.float64()),
                })

    partial = df.select("vector").mapInArrow(fold, "m int, code int, n double, sse double, sums array<double>")
    merged = add_arrays(partial, ["m", "code"], ["n", "sse"], "sums").toArrow()  # as large as the model
    m, code, n = (merged[c].to_numpy() for c in ("m", "code", "n"))
    words = [w.copy() for w in book.words]
    for part, w in enumerate(words):
        mine = np.flatnonzero(m == part)
        if len(mine):
            w[code[mine]] = kernels.matrix(merged["sums"].take(pa.array(mine))) / n[mine, None]
    error = float(np.sum(merged["sse"].to_numpy()))
    return Codebook(book.starts, words, book.objective + [error])


def assign(df: DataFrame, centroids: np.ndarray, vector="vector", cell="list_id", distance: str | None = "distance") -> DataFrame:
    """Adds the nearest centroid's number and its squared distance."""
    centroids = np.asarray(centroids, float)

    def nearest_cell(v: pa.Array) -> pa.Array:
        code, dist = kernels.nearest(kernels.matrix(v), centroids)
        return pa.StructArray.from_arrays(
            [pa.array(code[:, 0], pa.int32()), pa.array(dist[:, 0], pa.float64())], ["cell", "distance"])

    found = with_arrow_column(df, "_near", "struct<cell:int,distance:double>", vector, nearest_cell)
    found = found.withColumn(cell, F.col("_near.cell"))
    if distance:
        found = found.withColumn(distance, F.col("_near.distance"))
    return found.drop("_near")


def nearest_to_centroids(df: DataFrame, centroids: np.ndarray, n: int) -> DataFrame:
    """The n closest rows of every centroid: ``(query_id = centroid, rank, id, distance)``."""
    from .blockjoin import search

    spark = df.sparkSession
    queries = Codebook([0], [np.asarray(centroids, float)]).to_rows(spark).select(
        F.col("code").cast("long").alias("query_id"), F.col("word").alias("vector"))
    return search(queries, df, n)


def list_sizes(assigned: DataFrame, cell="list_id") -> DataFrame:
    return assigned.groupBy(cell).agg(F.count("*").alias("size"))


def list_size_histogram(assigned: DataFrame, cell="list_id") -> DataFrame:
    """How many cells have each size: ``(size, cells)``."""
    return list_sizes(assigned, cell).groupBy("size").agg(F.count("*").alias("cells"))


def reconstruction_error(original: DataFrame, decoded: DataFrame, key="id", vector="vector") -> DataFrame:
    """Σ(x − x̂)² / Σx² over aligned rows, as one row."""
    from ..functions import distances

    both = original.select(key, F.col(vector).alias("_x")).join(decoded.select(key, F.col(vector).alias("_y")), key)
    return both.agg((F.sum(distances.l2("_x", "_y")) / F.sum(arrays.squared_norm("_x"))).alias("error"))


def roundtrip_error(df: DataFrame, codec, vector="vector") -> DataFrame:
    """The same for a codec's ``compress``, without a join."""
    from ..functions import distances

    both = codec.compress(df.withColumn("_y", arrays.doubles(vector)), "_y")
    return both.agg((F.sum(distances.l2(vector, "_y")) / F.sum(arrays.squared_norm(vector))).alias("error"))
