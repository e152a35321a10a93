"""Residual codes where the second level of a pair depends on the first.

Even levels share one codebook; the next level has a codebook per parent code.
All parents are trained in the same Lloyd pass, keyed by (parent, code).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import arrays, kernels
from ..functions.arrowmap import with_arrow_column
from ..functions.hashing import keyed_hash
from ..session import materialize
from .codebooks import Codebook, fit_codebook

MODEL_BYTES = 256 << 20


@dataclass
class Branches:
    """Codewords per parent code; a parent without training rows has none."""

    words: dict[int, np.ndarray]

    def codes(self, x: np.ndarray, parent: np.ndarray) -> np.ndarray:
        out = np.zeros(len(x), np.int64)
        for p in np.unique(parent):
            words = self.words.get(int(p))
            if words is not None:
                rows = parent == p
                out[rows] = kernels.nearest(x[rows], words)[0][:, 0]
        return out

    def values(self, parent: np.ndarray, code: np.ndarray, dim: int) -> np.ndarray:
        out = np.zeros((len(parent), dim))
        for p in np.unique(parent):
            words = self.words.get(int(p))
            if words is not None:
                rows = parent == p
                out[rows] = words[code[rows]]
        return out


@dataclass
class TreeCodec:
    """``levels``: (shared codebook, branches) pairs; an odd depth ends with (codebook, None)."""

    levels: list[tuple[np.ndarray, Branches | None]]

    @property
    def depth(self) -> int:
        return sum(1 if b is None else 2 for _, b in self.levels)

    def _walk(self, x: np.ndarray):
        rest, codes = x.copy(), []
        for words, branches in self.levels:
            code = kernels.nearest(rest, words)[0][:, 0]
            rest -= words[code]
            codes.append(code)
            if branches is not None:
                sub = branches.codes(rest, code)
                rest -= branches.values(code, sub, rest.shape[1])
                codes.append(sub)
        return np.stack(codes, 1), rest

    def encode(self, df, vector="vector", codes="codes"):
        return with_arrow_column(df, codes, "array<int>", vector, lambda v: kernels.list_array(
            self._walk(kernels.matrix(v))[0].astype(np.int32), pa.int32()))

    def decode(self, df, codes="codes", vector="vector"):
        def value(c: pa.Array) -> pa.Array:
            code = kernels.matrix(c, np.int64)
            total, at = 0.0, 0
            for words, branches in self.levels:
                total = total + words[code[:, at]]
                if branches is not None:
                    total = total + branches.values(code[:, at], code[:, at + 1], words.shape[1])
                at += 1 if branches is None else 2
            return kernels.list_array(total, pa.float64())

        return with_arrow_column(df, vector, "array<double>", codes, value)

    def compress(self, df, vector="vector"):
        return self.decode(self.encode(df, vector, "_codes"), "_codes", vector).drop("_codes")

    def residuals(self, df, vector="vector"):
        return with_arrow_column(df, vector, "array<double>", vector, lambda v: kernels.list_array(
            self._walk(kernels.matrix(v))[1], pa.float64()))

    def class_message(self):
        return f"residual tree of depth {self.depth}"


@dataclass
class TreeQuantizer:
    depth: int = 2
    ks: int = 256
    iterations: int = 20
    init: object = "hash"
    seed: int = 0

    def fit(self, df: DataFrame, vector="vector", key="id") -> TreeCodec:
        rest = df.select(key, arrays.doubles(vector).alias("vector"))
        codec = TreeCodec([])
        for pair in range(self.depth // 2):
            book = fit_codebook(rest, 1, self.ks, self.iterations, self.init, self.seed + pair, key)
            branches = self._fit_branches(rest, book, key)
            codec.levels.append((book.centroids, branches))
            if 2 * (pair + 1) < self.depth:
                rest = materialize(TreeCodec([codec.levels[-1]]).residuals(rest), "tree")
        if self.depth % 2:
            book = fit_codebook(rest, 1, self.ks, self.iterations, self.init, self.seed + self.depth, key)
            codec.levels.append((book.centroids, None))
        return codec

    def _fit_branches(self, df: DataFrame, book: Codebook, key: str) -> Branches:
        """One codebook per parent; a parent with at most Ks rows stores them as they are."""
        dim = book.dim
        if book.ks * self.ks * dim * 8 > MODEL_BYTES:
            raise ValueError("branch codebooks are too large to share with every task")
        coded = book.encode(df.select(key, "vector"), "vector", "_code")
        coded = book.decode(coded, "_code", "_centre")
        coded = materialize(coded.select(
            key, F.get("_code", F.lit(0)).alias("parent"), arrays.subtract("vector", "_centre").alias("vector")), "branches")
        sizes = dict(coded.groupBy("parent").count().collect())  # at most Ks rows
        # starting words: Ks rows per parent, a model-sized set (the rank limit runs before the shuffle)
        window = Window.partitionBy("parent").orderBy(keyed_hash(key, seed=self.seed), key)
        first = coded.withColumn("_r", F.row_number().over(window)).filter(F.col("_r") <= self.ks)
        words: dict[int, np.ndarray] = {}
        picked = first.select("parent", "_r", "vector").toPandas().sort_values(["parent", "_r"])
        for parent, rows in picked.groupby("parent"):
            words[int(parent)] = np.stack([np.asarray(v, float) for v in rows.vector])
        grown = {p for p, n in sizes.items() if n > self.ks}
        for _ in range(self.iterations if grown else 0):
            words = _branch_step(coded.filter(F.col("parent").isin(sorted(grown))), words)
        return Branches(words)


def _branch_step(rows: DataFrame, words: dict[int, np.ndarray]) -> dict[int, np.ndarray]:
    def fold(batches):
        state = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            parent, x = kernels.longs(batch.column(0)), kernels.matrix(batch.column(1))
            for p in np.unique(parent):
                sub = x[parent == p]
                code = kernels.nearest(sub, words[int(p)])[0][:, 0]
                n, sums = state.setdefault(int(p), (np.zeros(len(words[int(p)])), np.zeros_like(words[int(p)])))
                n += np.bincount(code, minlength=len(n))
                np.add.at(sums, code, sub)
        for p, (n, sums) in state.items():
            live = np.flatnonzero(n)
            yield pa.record_batch({
                "parent": pa.array(np.full(len(live), p), pa.int32()),
                "code": pa.array(live, pa.int32()),
                "n": pa.array(n[live]),
                "sums": kernels.list_array(sums[live], pa.float64()),
            })

    partial = rows.select("parent", "vector").mapInArrow(fold, "parent int, code int, n double, sums array<double>")
    merged = (
        partial.select("parent", "code", "n", F.posexplode("sums").alias("j", "x"))
        .groupBy("parent", "code", "j").agg((F.sum("x") / F.sum("n")).alias("x")).toPandas()
    )
    out = {p: w.copy() for p, w in words.items()}
    for p, mine in merged.groupby("parent"):
        out[int(p)][mine.code.to_numpy(), mine.j.to_numpy()] = mine.x.to_numpy()
    return out
