"""Properties of trained models that hold whatever the training draws; SQL states that they must."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import arrays
from ..operators import codebooks, codecs, knn, linear, norms, recommend
from .q_search import scaled
from .registry import Tables, query
from .spec import train_index


def check(name: str, fn_sql_rows: list[str]):
    """Register ``fn(tables) -> {measure: bool}``; every measure must hold."""
    sql = " UNION ALL ".join(f"SELECT '{m}' AS measure, true AS holds" for m in fn_sql_rows)

    def wrap(fn):
        @query(name, sql)
        def _(t: Tables):
            found = fn(t)
            assert list(found) == fn_sql_rows
            return t.spark.createDataFrame([(m, bool(v)) for m, v in found.items()], "measure string, holds boolean")

        return fn

    return wrap


def _error(rows, codec) -> float:
    return codebooks.roundtrip_error(rows, codec).first()[0]


@check("opq_error_not_above_plain", ["rotated"])
def _(t: Tables):
    plain = codecs.ProductQuantizer(4, 16, 3).fit(t.vectors)
    rotated = codecs.OptimizedProduct(4, 16, iterations=3, final_iterations=3).fit(t.vectors)
    return {"rotated": _error(t.vectors, rotated) <= 1.1 * _error(t.vectors, plain)}


@check("additive_error_below_one_book", ["additive", "tree"])
def _(t: Tables):
    from ..operators.additive import AdditiveQuantizer
    from ..operators.trees import TreeQuantizer

    one = _error(t.vectors, codecs.ProductQuantizer(1, 16, 3).fit(t.vectors))
    return {
        "additive": _error(t.vectors, AdditiveQuantizer(3, 16, 3, beam=16).fit(t.vectors)) < one,
        "tree": _error(t.vectors, TreeQuantizer(2, 16, 3).fit(t.vectors)) < one,
    }


@check("additive_many_words", ["below_half_of_few"])
def _(t: Tables):
    """More words than one matrix of meetings may hold: solved by gradients in tasks."""
    from ..operators.additive import DENSE_WORDS, AdditiveQuantizer

    few = _error(t.vectors, AdditiveQuantizer(2, 16, 1, beam=4).fit(t.vectors))
    many = _error(t.vectors, AdditiveQuantizer(2, DENSE_WORDS // 2 + 1, 1, beam=4).fit(t.vectors))
    return {"below_half_of_few": many < 0.5 * few}


@check("codec_error_falls_with_bits", ["half_below_sq6", "sq6_below_sq4", "split_below_one_book"])
def _(t: Tables):
    half = _error(t.vectors, codecs.HalfPrecision().fit(t.vectors))
    sq6, sq4 = (_error(t.vectors, codecs.ScalarQuantizer(b).fit(t.vectors)) for b in (6, 4))
    split = _error(t.vectors, codecs.SplitQuantizer([codecs.ProductQuantizer(2, 16, 3), codecs.ScalarQuantizer(6)]).fit(t.vectors))
    one = _error(t.vectors, codecs.ProductQuantizer(1, 16, 3).fit(t.vectors))
    return {"half_below_sq6": half < sq6, "sq6_below_sq4": sq6 < sq4, "split_below_one_book": split < one}


@check("itq_rotation_is_orthonormal", ["orthonormal"])
def _(t: Tables):
    import numpy as np

    matrix = np.asarray(linear.ITQ(16, iterations=4).fit(t.vectors).matrix, float)
    small = matrix if matrix.shape[0] <= matrix.shape[1] else matrix.T
    return {"orthonormal": np.allclose(small @ small.T, np.eye(len(small)), atol=1e-6)}


@check("pca_energy_falls", ["falling", "not_above_total"])
def _(t: Tables):
    rows = scaled(t.vectors, "id")
    kept = linear.vector_stats(linear.PCA(16).fit(rows).transform(rows)).orderBy("dim").select("var").collect()
    total = linear.vector_stats(rows).agg(F.sum("var")).first()[0]
    values = [r["var"] for r in kept]
    return {"falling": all(a >= b - 1e-12 for a, b in zip(values, values[1:])), "not_above_total": sum(values) <= total * (1 + 1e-9)}


@check("norm_codes_stay_near", ["norms"])
def _(t: Tables):
    rows = scaled(t.vectors, "id")
    size = rows.select("id", arrays.vector_norm("vector").alias("norm"))
    coded = norms.kmeans_quantize(size, "norm", 7, 5)
    levels = coded.columns[-1]
    span = size.agg(F.max("norm") - F.min("norm")).first()[0]
    worst = coded.join(size.withColumnRenamed("norm", "_true"), "id").agg(F.max(F.abs(F.col(levels) - F.col("_true")))).first()[0]
    return {"norms": worst < span}


TRAINED = {
    "pcar_ivf_sq8": ("PCAR32,IVF8,SQ8", 0.3), "opq_ivf_pq": ("OPQ8_32,IVF8,PQ8x4", 0.1), "rr_sqfp16": ("RR64,SQfp16", 0.95),
    "pad_pq_refined": ("Pad72,PQ8x4+8", 0.2), "imi_flat": ("IMI2x2,Flat", 0.3), "ivf_residual": ("IVF8,Residual2x4", 0.1),
    "itq_lsh": ("ITQ32,LSH", 0.05), "lsh_rotated_trained": ("LSHrt", 0.05), "ivf_sq4_cosine": ("IVF8,SQ4", 0.3),
}


@check("trained_indexes_find_neighbours", list(TRAINED))
def _(t: Tables):
    """Share of the exact five neighbours that each index finds; a blind guess finds one in a hundred."""
    rows, asked = scaled(t.vectors, "id"), scaled(t.queries, "query_id")
    truth = knn.knn_join(asked, rows, 5).select("query_id", "id").persist()
    n = truth.count()
    out = {}
    for name, (spec, least) in TRAINED.items():
        found = train_index(spec, rows, "l2", iterations=3).add_with_ids(rows).search(asked, 5, nprobe=6)
        out[name] = found.join(truth, ["query_id", "id"]).count() >= least * n
    truth.unpersist()
    return out


@check("whitening_keeps_more_neighbours", ["whitened"])
def _(t: Tables):
    """Neighbours in a space whose scales were distorted: whitening finds over twice as many as plain distance."""
    stretch = [40.0 ** (1 - i / 4) if i < 8 else 1.0 for i in range(8)]
    cut = t.vectors.select("id", F.slice(F.col("vector").cast("array<double>"), 1, 8).alias("vector"))
    bent = cut.select("id", F.zip_with("vector", F.array(*[F.lit(s) for s in stretch]), lambda x, s: x * s).alias("vector"))
    centred = linear.vector_stats(cut)
    unit = F.array(*[F.lit(1 / max(r["var"], 1e-12) ** 0.5) for r in centred.orderBy("dim").collect()])
    even = cut.select("id", F.zip_with("vector", unit, lambda x, s: x * s).alias("vector"))
    truth = knn.knn_join(even.withColumnRenamed("id", "query_id"), even, 5).select("query_id", "id")
    asked = bent.withColumnRenamed("id", "query_id")

    def hits(spec):
        return train_index(spec, bent).add_with_ids(bent).search(asked, 5).join(truth, ["query_id", "id"]).count()

    return {"whitened": hits("PCAW8,Flat") > 2 * hits("Flat")}


@check("factors_fit_the_ratings", ["observed", "wide_ids"])
def _(t: Tables):
    """Fitted ratings are nearer than the overall mean; ids may be wider than 32 bits."""
    wide = t.ratings.withColumn("user", F.col("user") + (1 << 40))
    users, items = recommend.matrix_factorization(wide, rank=8, iterations=5)
    cells = wide.groupBy("user", "item").agg(F.avg("rating").alias("rating"))
    mean = cells.agg(F.avg("rating")).first()[0]
    fitted = cells.join(users.select(F.col("id").alias("user"), F.col("vector").alias("u")), "user").join(
        items.select(F.col("id").alias("item"), F.col("vector").alias("i")), "item")
    guess = F.aggregate(F.zip_with("u", "i", lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x)
    row = fitted.agg(F.avg((guess - F.col("rating")) ** 2), F.avg((F.lit(mean) - F.col("rating")) ** 2)).first()
    return {"observed": row[0] < 0.8 * row[1], "wide_ids": users.filter("id <= 2147483648").count() == 0}


@check("lsh_codes_find_neighbours", ["random", "trained"])
def _(t: Tables):
    truth = knn.knn_join(t.queries, t.vectors, 10).select("query_id", "id").persist()
    n = truth.count()
    found = {
        "random": codecs.lsh_code_knn(t.queries, t.vectors, 96, 10, seed=3),
        "trained": codecs.lsh_code_knn(t.queries, t.vectors, 96, 10, seed=3, train=True),
    }
    out = {name: df.join(truth, ["query_id", "id"]).count() >= 0.1 * n for name, df in found.items()}
    truth.unpersist()
    return out
