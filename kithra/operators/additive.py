"""Additive codes: a vector is the sum of one codeword from each full-dimension codebook.

Training alternates a least-squares solve for the codebooks and a beam search
for the codes.  The solve needs only how often two codewords meet and the sum of
the rows using each codeword.  Few words make a small system that is solved on
the driver; with more of them the table of meetings stays a table, and conjugate
gradients multiply by it in tasks.  The beam search is a narrow stage.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import arrays, kernels
from ..functions.arrowmap import add_arrays, with_arrow_column
from ..functions.hashing import keyed_hash
from ..session import materialize
from .codebooks import MODEL_BYTES

BEAM = 64  # fixed value: width of the search
RIDGE = 1e-6
DENSE_WORDS = 2048  # words whose meetings are held as one matrix; more are never gathered
GRADIENTS, CLOSE = 300, 1e-9  # steps of the solver, and the residual, as a share of the right side, that ends it


def beam_codes(x: np.ndarray, words: np.ndarray, beam: int = BEAM) -> np.ndarray:
    """n × M codes minimizing ‖x − Σ words‖² by beam search over (codebook, word) choices."""
    m, k, _ = words.shape
    flat = words.reshape(m * k, -1)
    # many words: products with what is left of a row, instead of a table of all pairs of words
    cross = 2.0 * flat @ flat.T if m * k <= DENSE_WORDS else None
    size = np.einsum("ij,ij->i", flat, flat)
    book = np.repeat(np.arange(m), k)
    # a wrapping 64-bit sum tells sets of words apart
    mix = np.random.default_rng(1).integers(1, 2**62, m) | 1
    step = max(1, (1 << 22) // (beam * m * k))
    out = np.empty((len(x), m), np.int64)
    for lo in range(0, len(x), step):
        rows = x[lo:lo + step]
        n = len(rows)
        single = size[None, :] - 2.0 * rows @ flat.T
        codes = np.full((n, 1, m), -1, np.int64)
        score = np.zeros((n, 1))
        for depth in range(m):
            cand = score[:, :, None] + single[:, None, :]
            chosen = 0.0
            for c in range(m):
                used = codes[:, :, c] >= 0
                word = np.where(used, c * k + codes[:, :, c], 0)
                if cross is None:
                    chosen = chosen + np.where(used[..., None], flat[word], 0.0)
                else:
                    cand += np.where(used[..., None], cross[word], 0.0)
                cand[..., c * k:(c + 1) * k][used] = np.inf
            if cross is None:
                cand += 2.0 * (chosen @ flat.T)
            cand = cand.reshape(n, -1)
            # one set of words is reached in up to depth + 1 orders
            take = min(cand.shape[1], beam * (depth + 1))
            best = np.argpartition(cand, take - 1, axis=1)[:, :take]
            value = np.take_along_axis(cand, best, 1)
            order = np.lexsort((best, value), axis=1)
            best, value = np.take_along_axis(best, order, 1), np.take_along_axis(value, order, 1)
            parent, word = best // (m * k), best % (m * k)
            grown = np.take_along_axis(codes, parent[..., None], 1).copy()
            np.put_along_axis(grown, book[word][..., None], (word % k)[..., None], 2)
            label = ((grown + 1) * mix).sum(-1)
            by = np.argsort(label, axis=1, kind="stable")
            sorted_label = np.take_along_axis(label, by, 1)
            again = np.zeros_like(sorted_label, bool)
            again[:, 1:] = sorted_label[:, 1:] == sorted_label[:, :-1]
            repeat = np.zeros_like(again)
            np.put_along_axis(repeat, by, again, 1)
            value = np.where(repeat, np.inf, value)
            keep = np.argsort(value, axis=1, kind="stable")[:, :beam]
            codes = np.take_along_axis(grown, keep[..., None], 1)
            score = np.take_along_axis(value, keep, 1)
        out[lo:lo + step] = codes[:, 0, :]
    return np.maximum(out, 0)


@dataclass
class AdditiveCodec:
    words: np.ndarray  # M × K × d
    beam: int = BEAM

    def encode(self, df, vector="vector", codes="codes"):
        words, beam = self.words, self.beam
        return with_arrow_column(df, codes, "array<int>", vector, lambda v: kernels.list_array(
            beam_codes(kernels.matrix(v), words, beam).astype(np.int32), pa.int32()))

    def decode(self, df, codes="codes", vector="vector"):
        words = self.words

        def total(c: pa.Array) -> pa.Array:
            code = kernels.matrix(c, np.int64)
            return kernels.list_array(sum(w[code[:, i]] for i, w in enumerate(words)), pa.float64())

        return with_arrow_column(df, vector, "array<double>", codes, total)

    def compress(self, df, vector="vector"):
        return self.decode(self.encode(df, vector, "_codes"), "_codes", vector).drop("_codes")

    def class_message(self):
        return f"additive codec, {self.words.shape[0]} codebooks of {self.words.shape[1]} words"


@dataclass
class AdditiveQuantizer:
    m: int = 4
    ks: int = 256
    iterations: int = 10
    beam: int = BEAM
    seed: int = 0

    def fit(self, df: DataFrame, vector="vector", key="id") -> AdditiveCodec:
        m, ks = self.m, self.ks
        rows = df.select(key, arrays.doubles(vector).alias("vector")).persist()
        start = F.array(*[(keyed_hash(key, F.lit(i), seed=self.seed) % ks).cast("int") for i in range(m)])
        coded = rows.select("vector", start.alias("codes"))
        codec = None
        for _ in range(self.iterations):
            codec = AdditiveCodec(_solve(coded, m, ks), self.beam)
            coded = codec.encode(rows.select("vector"))
        rows.unpersist()
        return codec


def _solve(coded: DataFrame, m: int, ks: int, dense_words: int = DENSE_WORDS) -> np.ndarray:
    """Least-squares codebooks for fixed codes (ridge, as the one-hot design is rank-deficient)."""
    size = m * ks

    def fold(batches):
        sums = None
        for batch in batches:
            if not batch.num_rows:
                continue
            x = kernels.matrix(batch.column(0))
            code = kernels.matrix(batch.column(1), np.int64) + np.arange(m)[None, :] * ks
            sums = np.zeros((size, x.shape[1])) if sums is None else sums
            for i in range(m):
                np.add.at(sums, code[:, i], x)
            first, second = np.triu_indices(m)
            pair, n = np.unique(code[:, first] * size + code[:, second], return_counts=True)
            yield pa.record_batch({
                "i": pa.array(pair // size, pa.int32()), "j": pa.array(pair % size, pa.int32()),
                "n": pa.array(n, pa.float64()), "sums": pa.nulls(len(pair), pa.list_(pa.float64()))})
        if sums is not None:
            live = np.flatnonzero(sums.any(1))
            yield pa.record_batch({
                "i": pa.array(live, pa.int32()), "j": pa.array(np.full(len(live), -1), pa.int32()),
                "n": pa.array(np.zeros(len(live))), "sums": kernels.list_array(sums[live], pa.float64())})

    partial = materialize(coded.select("vector", "codes").mapInArrow(fold, "i int, j int, n double, sums array<double>"), "additive")
    added = add_arrays(partial.filter("j < 0").select("i", "n", "sums"), ["i"], ["n"], "sums").toArrow()  # as large as the model
    if not added.num_rows:
        raise ValueError("no training rows, or all of them zero")
    rows = kernels.matrix(added["sums"])
    if size * rows.shape[1] * 8 > MODEL_BYTES:
        raise ValueError("the codebooks are too large to share with every task")
    sums = np.zeros((size, rows.shape[1]))
    sums[added["i"].to_numpy()] = rows
    meet = partial.filter("j >= 0").groupBy("i", "j").agg(F.sum("n").alias("n"))
    if size > dense_words:
        return _gradients(materialize(meet, "meetings"), sums).reshape(m, ks, -1)
    cells = meet.toArrow()
    i, j, n = (cells[c].to_numpy() for c in ("i", "j", "n"))
    full = np.zeros((size, size))
    full[i, j] = n
    full[j, i] = n
    ridge = RIDGE * max(1.0, np.trace(full) / size)
    return np.linalg.solve(full + ridge * np.eye(size), sums).reshape(m, ks, -1)


def _gradients(meet: DataFrame, sums: np.ndarray) -> np.ndarray:
    """Solves the ridge system by conjugate gradients, every column of ``sums`` with steps of its own.

    ``meet`` holds the upper half of the table, ``(i, j, n)``.  Starting from
    zero, all steps stay in the table's range, so its null space costs none.
    """
    total = meet.filter("i = j").agg(F.sum("n")).first()[0]
    ridge = RIDGE * max(1.0, total / len(sums))
    x, left = np.zeros_like(sums), sums.copy()
    way, was = left.copy(), (left * left).sum(0)
    goal = was * CLOSE**2
    for _ in range(GRADIENTS):
        going = np.flatnonzero(was > goal)
        if not len(going):
            break
        step = way[:, going]
        image = _times(meet, step) + ridge * step
        length = was[going] / (step * image).sum(0)
        x[:, going] += length * step
        left[:, going] -= length * image
        now = (left[:, going] ** 2).sum(0)
        way[:, going] = left[:, going] + now / was[going] * step
        was[going] = now
    return x


def _times(meet: DataFrame, columns: np.ndarray) -> np.ndarray:
    """The symmetric table times ``columns``: one product per task, added word by word."""

    def product(batches):
        out = np.zeros_like(columns)
        for batch in batches:
            i, j, n = (batch.column(c).to_numpy() for c in ("i", "j", "n"))
            np.add.at(out, i, n[:, None] * columns[j])
            off = i != j
            np.add.at(out, j[off], n[off, None] * columns[i[off]])
        live = np.flatnonzero(out.any(1))
        if len(live):
            yield pa.record_batch({
                "i": pa.array(live, pa.int32()), "n": pa.array(np.zeros(len(live))), "row": kernels.list_array(out[live], pa.float64())})

    parts = meet.mapInArrow(product, "i int, n double, row array<double>")
    added = add_arrays(parts, ["i"], ["n"], "row").toArrow()  # as large as the model
    out = np.zeros_like(columns)
    if added.num_rows:
        out[added["i"].to_numpy()] = kernels.matrix(added["row"])
    return out
