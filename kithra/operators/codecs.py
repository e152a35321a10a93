"""Vector codecs: train on a sample, encode every row, decode, compress.

All codecs share ``fit(df) -> trained codec`` and, once trained, ``encode``,
``decode``, ``compress`` and ``class_message``.  A trained codec is a model of
size independent of the number of rows; row functions are narrow stages.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import arrays, kernels
from ..functions.arrowmap import with_arrow_column
from ..session import materialize
from .blockjoin import search, small_side
from .codebooks import Codebook, fit_codebook
from .linear import Linear, column_of, gram_rows, matrix_of, random_rotation, vector_stats


# ------------------------------------------------------------------- scalar

@dataclass
class ScalarQuantizer:
    """Uniform levels per dimension.

    code = min(⌊(x − lo)/(hi − lo)·2^b⌋, 2^b − 1), never below 0; decoded at
    the middle of its step.
    """

    bits: int = 8
    low: list[float] | None = None
    high: list[float] | None = None

    def fit(self, df: DataFrame, vector="vector") -> "ScalarQuantizer":
        stats = vector_stats(df, vector)
        return ScalarQuantizer(self.bits, column_of(stats, "min").tolist(), column_of(stats, "max").tolist())

    def _levels(self):
        return arrays.constant_vector(self.low), arrays.constant_vector(self.high)

    def encode(self, df, vector="vector", codes="codes"):
        low, high = self._levels()
        steps = 1 << self.bits

        def code(x, i):
            lo, hi = F.get(low, i), F.get(high, i)
            # a dimension without spread has one level
            level = F.coalesce(F.floor((x - lo) / F.when(hi > lo, hi - lo) * steps), F.lit(0))
            return F.greatest(F.least(level, F.lit(steps - 1)), F.lit(0)).cast("int")

        return df.withColumn(codes, F.transform(arrays.doubles(vector), code))

    def decode(self, df, codes="codes", vector="vector"):
        low, high = self._levels()
        steps = float(1 << self.bits)

        def value(c, i):
            lo, hi = F.get(low, i), F.get(high, i)
            return lo + (c.cast("double") + 0.5) / steps * (hi - lo)

        return df.withColumn(vector, F.transform(codes, value))

    def compress(self, df, vector="vector"):
        return self.decode(self.encode(df, vector, "_codes"), "_codes", vector).drop("_codes")

    @property
    def code_bits(self) -> list[int]:
        return [self.bits] * len(self.low)

    def class_message(self) -> str:
        return f"scalar quantizer, {self.bits} bits"


@dataclass
class HalfPrecision:
    """Components rounded to 16-bit floats; the code is their bit pattern."""

    dim: int | None = None

    def fit(self, df, vector="vector"):
        return HalfPrecision(df.select(F.size(vector)).first()[0])

    def encode(self, df, vector="vector", codes="codes"):
        return with_arrow_column(df, codes, "array<int>", vector, lambda v: kernels.list_array(
            kernels.matrix(v).astype(np.float16).view(np.uint16).astype(np.int32), pa.int32()))

    def decode(self, df, codes="codes", vector="vector"):
        return with_arrow_column(df, vector, "array<double>", codes, lambda c: kernels.list_array(
            kernels.matrix(c, np.int64).astype(np.uint16).view(np.float16).astype(np.float64), pa.float64()))

    def compress(self, df, vector="vector"):
        return self.decode(self.encode(df, vector, "_codes"), "_codes", vector).drop("_codes")

    @property
    def code_bits(self):
        return [16] * self.dim

    def class_message(self):
        return "half-precision floats"


# ------------------------------------------------------------------ product

@dataclass
class ProductQuantizer:
    """k-means in each of ``m`` sub-spaces."""

    m: int = 8
    ks: int = 256
    iterations: int = 20
    init: object = "hash"
    seed: int = 0

    def fit(self, df, vector="vector", key="id") -> Codebook:
        rows = df.select(key, F.col(vector).alias("vector"))
        return fit_codebook(rows, self.m, self.ks, self.iterations, self.init, self.seed, key)


@dataclass
class RotatedCodec:
    """A linear map followed by a codec in the mapped space."""

    rotation: Linear
    inner: object

    def encode(self, df, vector="vector", codes="codes"):
        turned = self.rotation.transform(df.withColumn("_turned", arrays.doubles(vector)), "_turned")
        return self.inner.encode(turned, "_turned", codes).drop("_turned")

    def decode(self, df, codes="codes", vector="vector"):
        back = Linear(np.linalg.pinv(self.rotation.matrix))
        decoded = self.inner.decode(df, codes, vector)
        if self.rotation.bias is not None:
            decoded = decoded.withColumn(vector, arrays.subtract(vector, arrays.constant_vector(self.rotation.bias)))
        return back.transform(decoded, vector)

    def compress(self, df, vector="vector"):
        return self.decode(self.encode(df, vector, "_codes"), "_codes", vector).drop("_codes")

    def class_message(self):
        return "rotated " + self.inner.class_message()


@dataclass
class OptimizedProduct:
    """Alternate a product codebook and the rotation that fits it best.

    Each round: rotate, one Lloyd pass, then the Procrustes rotation from the
    d × d matrix XᵀX̂.  The last round trains fully and keeps the rotation.
    """

    m: int = 8
    ks: int = 256
    iterations: int = 10
    final_iterations: int = 20
    seed: int = 0

    def fit(self, df, vector="vector", key="id") -> RotatedCodec:
        rows = df.select(key, arrays.doubles(vector).alias("vector")).persist()
        dim = rows.select(F.size("vector")).first()[0]
        rotation = np.eye(dim)
        book = None
        for _ in range(self.iterations):
            turned = Linear(rotation).transform(rows)
            start = "hash" if book is None else _start_words(book)
            book = fit_codebook(turned, self.m, self.ks, 1, start, self.seed, key)
            decoded = book.compress(Linear(rotation).transform(rows.withColumn("w", F.col("vector")), "w"), "w")
            u, _, vt = np.linalg.svd(matrix_of(gram_rows(decoded, "vector", other="w")))
            rotation = u @ vt
        turned = Linear(rotation).transform(rows)
        start = "hash" if book is None else _start_words(book)
        book = fit_codebook(turned, self.m, self.ks, self.final_iterations, start, self.seed, key)
        rows.unpersist()
        return RotatedCodec(Linear(rotation), book)


def _start_words(book: Codebook) -> np.ndarray:
    return np.hstack(book.words)


# ----------------------------------------------------------------- residual

@dataclass
class ResidualCodec:
    """Layers of codebooks; each quantizes what the layers before left over."""

    layers: list[Codebook]

    def encode(self, df, vector="vector", codes="codes"):
        """``array<array<int>>``: one code per layer."""
        layers = [book.parts for book in self.layers]

        def code_layers(v: pa.Array) -> pa.Array:
            rest = kernels.matrix(v).copy()
            found = []
            for parts in layers:
                code = kernels.assign_codes(rest, parts)
                rest -= np.hstack([w[code[:, m]] for m, (_, w) in enumerate(parts)])
                found.append(code.astype(np.int32))
            depth, m = len(found), found[0].shape[1]
            flat = kernels.list_array(np.stack(found, 1).reshape(-1, m), pa.int32())
            return pa.ListArray.from_arrays(pa.array(np.arange(0, len(v) * depth + 1, depth, dtype=np.int32)), flat)

        return with_arrow_column(df, codes, "array<array<int>>", vector, code_layers)

    def decode(self, df, codes="codes", vector="vector"):
        words = [book.words for book in self.layers]
        depth, m = len(words), len(words[0])

        def sum_layers(c: pa.Array) -> pa.Array:
            flat = kernels.matrix(c.flatten(), np.int64).reshape(len(c), depth, m)
            total = sum(np.hstack([w[flat[:, i, j]] for j, w in enumerate(ws)]) for i, ws in enumerate(words))
            return kernels.list_array(total, pa.float64())

        return with_arrow_column(df, vector, "array<double>", codes, sum_layers)

    def compress(self, df, vector="vector"):
        return self.decode(self.encode(df, vector, "_codes"), "_codes", vector).drop("_codes")

    def residuals(self, df, layers: int | None = None, vector="vector"):
        """``vector`` minus what the first layers explain."""
        part = ResidualCodec(self.layers[:layers])
        if not part.layers:
            return df.withColumn(vector, arrays.doubles(vector))
        known = part.compress(df.withColumn("_known", arrays.doubles(vector)), "_known")
        return known.withColumn(vector, arrays.subtract(vector, "_known")).drop("_known")

    def norm_stats(self, df, vector="vector") -> DataFrame:
        """Mean, max and min residual norm after each layer."""
        out = None
        for depth in range(1, len(self.layers) + 1):
            norm = arrays.vector_norm(vector)
            part = self.residuals(df, depth, vector).agg(
                F.avg(norm).alias("mean"), F.max(norm).alias("max"), F.min(norm).alias("min"))
            part = part.select(F.lit(depth).alias("layer"), "mean", "max", "min")
            out = part if out is None else out.unionByName(part)
        return out

    def class_message(self):
        return f"residual codec, {len(self.layers)} layers of " + self.layers[0].class_message()


@dataclass
class ResidualQuantizer:
    depth: int = 2
    m: int = 1
    ks: int = 256
    iterations: int = 20
    init: object = "hash"
    seed: int = 0

    def fit(self, df, vector="vector", key="id") -> ResidualCodec:
        rest = df.select(key, arrays.doubles(vector).alias("vector"))
        codec = ResidualCodec([])
        for layer in range(self.depth):
            init = self.init[layer] if isinstance(self.init, list) else self.init
            book = fit_codebook(rest, self.m, self.ks, self.iterations, init, self.seed + layer, key)
            codec.layers.append(book)
            if layer + 1 < self.depth:
                # the residual table of the next layer is written, not recomputed from the start
                rest = materialize(ResidualCodec([book]).residuals(rest), "residual")
        return codec


# ---------------------------------------------------------------- two levels

@dataclass
class TwoLevelCodec:
    """Coarse codebook, then a codec on the residual; the code holds both."""

    coarse: Codebook
    fine: object

    def residuals(self, df, vector="vector", out="_rest", coarse="_coarse"):
        rows = self.coarse.encode(df, vector, coarse)
        rows = self.coarse.decode(rows, coarse, "_centre")
        return rows.withColumn(out, arrays.subtract(vector, "_centre")).drop("_centre")

    def encode(self, df, vector="vector", codes="codes"):
        """``struct<coarse: array<int>, fine: …>``"""
        rows = self.fine.encode(self.residuals(df, vector), "_rest", "_fine")
        return rows.withColumn(codes, F.struct(F.col("_coarse").alias("coarse"), F.col("_fine").alias("fine"))).drop(
            "_coarse", "_fine", "_rest")

    def decode(self, df, codes="codes", vector="vector"):
        rows = df.withColumn("_coarse", F.col(codes)["coarse"]).withColumn("_fine", F.col(codes)["fine"])
        rows = self.fine.decode(self.coarse.decode(rows, "_coarse", "_centre"), "_fine", "_rest")
        return rows.withColumn(vector, arrays.add("_centre", "_rest")).drop("_coarse", "_fine", "_centre", "_rest")

    def compress(self, df, vector="vector"):
        return self.decode(self.encode(df, vector, "_codes"), "_codes", vector).drop("_codes")

    def class_message(self):
        return f"{self.coarse.class_message()} then {self.fine.class_message()}"


@dataclass
class TwoLevelQuantizer:
    coarse: ProductQuantizer
    fine: object

    def fit(self, df, vector="vector", key="id") -> TwoLevelCodec:
        book = self.coarse.fit(df, vector, key)
        rest = TwoLevelCodec(book, None).residuals(df.select(key, F.col(vector).alias("vector")))
        rest = materialize(rest.select(key, F.col("_rest").alias("vector")), "residual")
        fine = self.fine.fit(rest) if not isinstance(self.fine, ProductQuantizer) else self.fine.fit(rest, key=key)
        return TwoLevelCodec(book, fine)


# -------------------------------------------------------------------- split

@dataclass
class SplitCodec:
    """Each sub-space handled by its own codec; the code is a struct of codes."""

    bounds: list[tuple[int, int]]
    parts: list

    def encode(self, df, vector="vector", codes="codes"):
        names = [f"_c{i}" for i in range(len(self.parts))]
        for name, (start, size), part in zip(names, self.bounds, self.parts):
            df = part.encode(df.withColumn("_sub", F.slice(arrays.doubles(vector), start + 1, size)), "_sub", name)
        return df.withColumn(codes, F.struct(*names)).drop("_sub", *names)

    def decode(self, df, codes="codes", vector="vector"):
        names = [f"_c{i}" for i in range(len(self.parts))]
        outs = [f"_v{i}" for i in range(len(self.parts))]
        for name, out, part in zip(names, outs, self.parts):
            df = part.decode(df.withColumn(name, F.col(codes)[name]), name, out)
        return df.withColumn(vector, F.concat(*outs)).drop(*names, *outs)

    def compress(self, df, vector="vector"):
        return self.decode(self.encode(df, vector, "_codes"), "_codes", vector).drop("_codes")

    def class_message(self):
        return "split: " + ", ".join(p.class_message() for p in self.parts)


@dataclass
class SplitQuantizer:
    parts: list

    def fit(self, df, vector="vector", key="id") -> SplitCodec:
        dim = df.select(F.size(vector)).first()[0]
        bounds = arrays.slice_bounds(dim, len(self.parts))
        fitted = [
            part.fit(df.select(key, F.slice(arrays.doubles(vector), start + 1, size).alias("vector")))
            for (start, size), part in zip(bounds, self.parts)
        ]
        return SplitCodec(bounds, fitted)


# --------------------------------------------------------------- byte codes

@dataclass
class ByteCodec:
    """A codec whose integer codes are packed into fixed-size ``binary``."""

    inner: object
    bits: list[int] = field(default_factory=list)

    def __post_init__(self):
        if not self.bits:
            self.bits = getattr(self.inner, "code_bits", None) or [
                max(1, int(len(w) - 1).bit_length()) for w in self.inner.words]

    @property
    def code_size(self) -> int:
        """Bytes per vector."""
        return -(-sum(self.bits) // 8)

    def encode(self, df, vector="vector", code="code"):
        bits = self.bits

        def pack(c: pa.Array) -> pa.Array:
            codes = kernels.matrix(c, np.int64)
            planes = np.hstack([(codes[:, [j]] >> np.arange(b)) & 1 for j, b in enumerate(bits)]).astype(np.uint8)
            return pa.array([row.tobytes() for row in np.packbits(planes, axis=1, bitorder="little")], pa.binary())

        return with_arrow_column(self.inner.encode(df, vector, "_codes"), code, "binary", "_codes", pack).drop("_codes")

    def decode(self, df, code="code", vector="vector"):
        bits = self.bits

        def unpack(c: pa.Array) -> pa.Array:
            raw = np.frombuffer(b"".join(c.to_pylist()), np.uint8).reshape(len(c), -1)
            planes = np.unpackbits(raw, axis=1, bitorder="little").astype(np.int64)
            out, at = [], 0
            for b in bits:
                out.append((planes[:, at:at + b] << np.arange(b)).sum(1))
                at += b
            return kernels.list_array(np.stack(out, 1).astype(np.int32), pa.int32())

        return self.inner.decode(with_arrow_column(df, "_codes", "array<int>", code, unpack), "_codes", vector).drop("_codes")

    def compress(self, df, vector="vector"):
        return self.decode(self.encode(df, vector, "_bytes"), "_bytes", vector).drop("_bytes")

    def class_message(self):
        return f"{self.code_size}-byte codes of {self.inner.class_message()}"


# ------------------------------------------------------- search on the codes

def decoded_knn(queries, base, codec, k: int, **options) -> DataFrame:
    """Rank on decoded codes (scalar and two-level codes)."""
    return search(queries.withColumn("vector", arrays.doubles("vector")), codec.compress(base.select("id", "vector")), k, **options)


def pq_knn(queries, coded: DataFrame, book: Codebook, k: int, **options) -> DataFrame:
    """Asymmetric search: query vectors against ``(id, codes)``."""
    queries = queries.withColumn("vector", arrays.doubles("vector"))
    return search(queries, coded, k, kernels.AsymmetricCode(book.parts), base_vector="codes", **options)


def polysemous_knn(queries, coded: DataFrame, book: Codebook, k: int, ht: int, **options) -> DataFrame:
    """Asymmetric search over the rows whose code is within ``ht`` bits of the query's."""
    queries = queries.withColumn("vector", arrays.doubles("vector"))
    return search(queries, coded, k, kernels.PolysemousCode(book.parts, ht), base_vector="codes", **options)


def residual_probe(queries, centroids: np.ndarray, nprobe: int) -> DataFrame:
    """Probe rows whose vector is the query's residual to the cell's centroid."""
    from .ivf import probe

    spark = queries.sparkSession
    centres = Codebook([0], [np.asarray(centroids, float)]).to_rows(spark).select(
        F.col("code").alias("list_id"), F.col("word").alias("_centre"))
    return probe(queries, centroids, nprobe).join(F.broadcast(centres), "list_id").select(
        "query_id", arrays.subtract("vector", "_centre").alias("vector"), "list_id")


def residual_postings(base, centroids: np.ndarray) -> DataFrame:
    """``(list_id, id, vector)`` with residual vectors."""
    from .codebooks import assign

    spark = base.sparkSession
    centres = Codebook([0], [np.asarray(centroids, float)]).to_rows(spark).select(
        F.col("code").alias("list_id"), F.col("word").alias("_centre"))
    rows = assign(base.select("id", arrays.doubles("vector").alias("vector")), centroids, distance=None)
    return rows.join(F.broadcast(centres), "list_id").select(
        "list_id", "id", arrays.subtract("vector", "_centre").alias("vector"))


def ivfpq_knn(queries, coded: DataFrame, centroids, book: Codebook, k: int, nprobe: int = 1, **options) -> DataFrame:
    """``coded`` is ``(list_id, id, codes)`` with codes of the residuals."""
    from .ivf import probed_only

    metric = kernels.AsymmetricCode(book.parts)
    asked = materialize(residual_probe(queries, centroids, nprobe), "probes")
    return search(asked, probed_only(asked, coded), k, metric, group="list_id", base_vector="codes", **options)


def ivfsq_knn(queries, coded, centroids, codec: ScalarQuantizer, k: int, nprobe: int = 1, **options) -> DataFrame:
    """``coded`` is ``(list_id, id, codes)`` with scalar codes of the residuals."""
    from .ivf import probed_only

    asked = materialize(residual_probe(queries, centroids, nprobe), "probes")
    decoded = codec.decode(probed_only(asked, coded)).select("list_id", "id", "vector")
    return search(asked, decoded, k, "l2", group="list_id", **options)


def refine_codes(found, queries, coded2, centroids, first: Codebook, second: Codebook, k: int) -> DataFrame:
    """Re-rank with a second code of what the first left over.

    ``coded2`` is ``(list_id, id, codes, codes2)``; only the candidates' codes
    are decoded.
    """
    from .knn import refine

    wanted = small_side(found.select("id").distinct())
    rows = coded2.join(wanted, "id", "left_semi")
    rows = second.decode(first.decode(rows, "codes", "_a"), "codes2", "_b")
    centres = Codebook([0], [np.asarray(centroids, float)]).to_rows(rows.sparkSession).select(
        F.col("code").alias("list_id"), F.col("word").alias("_centre"))
    rows = rows.join(F.broadcast(centres), "list_id").select(
        "id", arrays.add(arrays.add("_centre", "_a"), "_b").alias("vector"))
    return refine(found, queries, rows, k)


def order_for_hamming(book: Codebook, rounds: int = 2000, seed: int = 0) -> Codebook:
    """Renumber codewords so that the bits of two codes differ more the farther apart they are.

    Swaps pairs of codewords while the weighted mismatch between codeword
    distance and bit distance goes down; works on the codebook only.
    """
    rng = np.random.default_rng(seed)
    out = []
    for words in book.words:
        n = len(words)
        bits = np.bitwise_count(np.arange(n)[:, None] ^ np.arange(n)[None, :]).astype(float)
        dist = ((words[:, None, :] - words[None, :, :]) ** 2).sum(-1)
        if dist.std():
            dist = (dist - dist.mean()) / dist.std() * bits.std() + bits.mean()
        order = np.arange(n)
        for _ in range(rounds if n > 1 else 0):
            i, j = rng.choice(n, 2, replace=False)
            swapped = order.copy()
            swapped[i], swapped[j] = order[j], order[i]
            rows = [i, j]
            before = ((dist[np.ix_(order[rows], order)] - bits[rows]) ** 2).sum()
            after = ((dist[np.ix_(swapped[rows], swapped)] - bits[rows]) ** 2).sum()
            if after < before:
                order = swapped
        out.append(words[order])
    return Codebook(book.starts, out, book.objective)


def lsh_codec(dim: int, bits: int, seed: int = 0) -> Linear:
    """Projection whose signs are the hash bits: orthonormal if bits ≤ dim, a tight frame beyond."""
    return random_rotation(dim, bits, seed)


def lsh_code_knn(queries, base, bits: int, k: int, seed: int = 0, train: bool = False, **options) -> DataFrame:
    """Hash both sides to sign bits of a projection and rank by Hamming distance.

    With ``train`` each bit's threshold is the base median.
    """
    from .linear import median_thresholds

    dim = base.select(F.size("vector")).first()[0]
    projection = lsh_codec(dim, bits, seed)
    b = projection.transform(base.select("id", arrays.doubles("vector").alias("vector")))
    q = projection.transform(queries.select("query_id", arrays.doubles("vector").alias("vector")))
    cut = None
    if train:
        cut = arrays.constant_vector(column_of(median_thresholds(b), "threshold"))
    code = arrays.pack_words(arrays.binarize("vector", cut))
    return search(q.withColumn("vector", code), b.withColumn("vector", code), k, "hamming", **options)
