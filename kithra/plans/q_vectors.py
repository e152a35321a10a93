"""Vector expressions, whole-set normalizations and linear maps."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from ..functions import arrays, distances
from ..operators import linear
from .q_search import PROBS, SCALED, probabilities, scaled
from .registry import Tables, query
from .snippets import VECTORS, each, ip, l2, norm

SIX = "list_transform({}, lambda x: round(x, 6))"


def six(expression):
    return SIX.format(expression)


def neighbours(t: Tables, prepare=lambda df: df):
    """Consecutive stored vectors as pairs (id, a, b)."""
    rows = prepare(t.vectors.withColumn("vector", arrays.doubles("vector")))
    return rows.select("id", F.col("vector").alias("a")).join(
        rows.select((F.col("id") - 1).alias("id"), F.col("vector").alias("b")), "id"
    )


PAIRS = "pair AS (SELECT a.id, a.v AS a, b.v AS b FROM svec a JOIN svec b ON b.id = a.id + 1)"


@query("l2_normalize", f"WITH {VECTORS}, {SCALED} SELECT id, list_transform(v, lambda x: x / n) AS vector"
       f" FROM (SELECT id, v, {norm('v')} AS n FROM svec)")
def _(t: Tables):
    return scaled(t.vectors, "id").select("id", arrays.l2_normalize("vector").alias("vector"))


@query("vector_norm_and_dot", f"WITH {VECTORS}, {SCALED}, {PAIRS} SELECT id, {norm('a')} AS norm, {ip('a', 'b')} AS dot FROM pair")
def _(t: Tables):
    pairs = neighbours(t, lambda d: scaled(d, "id"))
    return pairs.select("id", arrays.vector_norm("a").alias("norm"), arrays.dot("a", "b").alias("dot"))


@query("pairwise_distances", f"""WITH {VECTORS}, {SCALED}, {PAIRS}
  SELECT id, {l2('a', 'b')} AS l2, {ip('a', 'b')} AS ip, sqrt({l2('a', 'b')}) AS euclid,
   {each('a', 'b', 'abs(z[1]-z[2])')} AS l1,
   list_max(list_transform(list_zip(a, b), lambda z: abs(z[1]-z[2]))) AS linf,
   round({each('a', 'b', 'pow(abs(z[1]-z[2]), 3.0)')}, 6) AS l3,
   {each('a', 'b', 'abs(z[1]-z[2])/(abs(z[1])+abs(z[2]))')} AS canberra,
   {each('a', 'b', 'abs(z[1]-z[2])')} / {each('a', 'b', 'abs(z[1]+z[2])')} AS braycurtis,
   list_sum(list_transform(list_zip(a, b), lambda z: ((z[1] > 0) <> (z[2] > 0))::BIGINT))::BIGINT AS sign_mismatch,
   round(acos({ip('a', 'b')} / ({norm('a')} * {norm('b')})) / pi(), 6) AS angular FROM pair""")
def _(t: Tables):
    pairs = neighbours(t, lambda d: scaled(d, "id"))
    d = distances
    exact = {n: d.DISTANCES[n]("a", "b") for n in
             ("l2", "ip", "euclid", "l1", "linf", "canberra", "braycurtis", "sign_mismatch")}
    return pairs.select(
        "id", *[c.alias(n) for n, c in exact.items()],
        F.round(d.lp("a", "b", 3), 6).alias("l3"), F.round(d.angular("a", "b"), 6).alias("angular"),
    )


@query("jensenshannon_distance", f"""WITH {VECTORS}, {PROBS} SELECT a.id, round({each('a.v', 'b.v',
    "0.5*z[1]*ln(z[1]/((z[1]+z[2])/2)) + 0.5*z[2]*ln(z[2]/((z[1]+z[2])/2))")}, 6) AS distance
  FROM pvec a JOIN pvec b ON b.id = a.id + 1""")
def _(t: Tables):
    pairs = neighbours(t, probabilities)
    return pairs.select("id", F.round(distances.jensenshannon("a", "b"), 6).alias("distance"))


@query("unit_l2_from_cosine", f"""WITH {VECTORS}, {SCALED}, {PAIRS} SELECT id, round(2 - 2 * {ip('a', 'b')} / ({norm('a')} * {norm('b')}), 6) AS distance FROM pair""")
def _(t: Tables):
    unit = neighbours(t, lambda d: scaled(d, "id").withColumn("vector", arrays.l2_normalize("vector")))
    return unit.select("id", F.round(distances.l2("a", "b"), 6).alias("distance"))


@query("hamming_text_distance", """WITH e AS (SELECT event_id, event_type, lag(event_type) OVER (ORDER BY event_id) AS prev,
   event_id::VARCHAR AS a, (event_id + 1)::VARCHAR AS b FROM events)
  SELECT event_id, CASE WHEN length(a) = length(b) THEN list_sum(list_transform(generate_series(1, length(a)),
    lambda i: (a[i] <> b[i])::INTEGER))::INTEGER END AS distance FROM e""")
def _(t: Tables):
    digits = t("events").select("event_id", F.col("event_id").cast("string").alias("a"),
                                (F.col("event_id") + 1).cast("string").alias("b"))
    return digits.select("event_id", distances.hamming_text("a", "b").alias("distance"))


@query("hamming_weight", f"""WITH {VECTORS} SELECT id, list_sum(list_transform(v, lambda x: (x > 0)::BIGINT))::BIGINT AS weight FROM vec""")
def _(t: Tables):
    return t.vectors.select("id", distances.hamming_weight(arrays.sign_code("vector")).alias("weight"))


@query("binarize_and_pack", f"""WITH {VECTORS} SELECT id, list_transform(v, lambda x: (x > 0)::INTEGER) AS bits,
  list_transform(generate_series(0, 1), lambda w: list_sum(list_transform(generate_series(1, 32),
   lambda i: CASE WHEN v[w*32+i] > 0 THEN (1::BIGINT << (i-1)) ELSE 0 END))::BIGINT) AS words FROM vec""")
def _(t: Tables):
    return t.vectors.select("id", arrays.binarize("vector").alias("bits"), arrays.sign_code("vector").alias("words"))


@query("pack_bits_bytes", f"""WITH {VECTORS} SELECT id, upper(list_aggregate(list_transform(generate_series(0, 7),
  lambda w: lpad(printf('%x', list_sum(list_transform(generate_series(1, 8),
   lambda i: CASE WHEN v[w*8+i] > 0 THEN (1::BIGINT << (8-i)) ELSE 0 END))::BIGINT), 2, '0')), 'string_agg', '')) AS hex FROM vec""")
def _(t: Tables):
    return t.vectors.select("id", F.hex(arrays.pack_bits(arrays.binarize("vector"))).alias("hex"))


@query("prewhiten", f"""WITH {VECTORS}, c AS (SELECT id, list_transform(v, lambda x: x - m) AS c FROM
   (SELECT id, v, list_sum(v) / len(v) AS m FROM vec))
  SELECT id, {six("list_transform(c, lambda x: x / s)")} AS vector FROM
   (SELECT id, c, greatest(sqrt(list_sum(list_transform(c, lambda x: x*x)) / len(c)), 1 / sqrt(len(c))) AS s FROM c)""")
def _(t: Tables):
    return t.vectors.select("id", arrays.rounded(arrays.prewhiten("vector")).alias("vector"))


@query("pad_and_remap", f"""WITH {VECTORS} SELECT id, list_concat(v, list_transform(generate_series(1, 8), lambda i: 0.0::DOUBLE)) AS padded,
  [v[64], v[1], 0.0::DOUBLE, v[33]] AS remapped FROM vec""")
def _(t: Tables):
    return t.vectors.select("id", arrays.pad("vector", 72).alias("padded"),
                            arrays.remap("vector", [63, 0, -1, 32]).alias("remapped"))


@query("reshape_vectors", f"""WITH {VECTORS} SELECT id, (i)::INTEGER AS part, v[i*16+1 : i*16+16] AS vector FROM vec, generate_series(0, 3) s(i)""")
def _(t: Tables):
    parts = arrays.reshape(arrays.doubles("vector"), 16)
    return t.vectors.select("id", F.posexplode(parts).alias("part", "vector"))


@query("affine_map", f"""WITH {VECTORS} SELECT id, [
   list_sum(list_transform(list_zip(v, generate_series(0, 63)), lambda z: z[1] * (z[2] % 3)::DOUBLE)) + 0.5,
   list_sum(list_transform(list_zip(v, generate_series(0, 63)), lambda z: z[1] * (z[2] % 5)::DOUBLE)) - 1.0] AS vector FROM vec""")
def _(t: Tables):
    model = [[float(i % 3), float(i % 5)] for i in range(64)]
    return t.vectors.select("id", arrays.affine("vector", model, [0.5, -1.0]).alias("vector"))


@query("affine_map_batched", f"""WITH {VECTORS} SELECT id, {six('''[
   list_sum(list_transform(list_zip(v, generate_series(0, 63)), lambda z: z[1] * (z[2] % 3)::DOUBLE)) + 0.5,
   list_sum(list_transform(list_zip(v, generate_series(0, 63)), lambda z: z[1] * (z[2] % 5)::DOUBLE)) - 1.0]''')} AS vector FROM vec""")
def _(t: Tables):
    model = linear.Linear(np.array([[i % 3, i % 5] for i in range(64)], float), np.array([0.5, -1.0]))
    return model.transform(t.vectors).select("id", arrays.rounded("vector").alias("vector"))


# ------------------------------------------------- whole-set normalizations

STATS = ("st AS (SELECT list(m ORDER BY dim) AS m FROM (SELECT dim, avg(x) AS m FROM (SELECT generate_subscripts(v, 1) - 1 AS dim,"
         " unnest(v) AS x FROM svec) GROUP BY dim))")


@query("zero_mean", f"""WITH {VECTORS}, {SCALED}, {STATS}
  SELECT 'base' AS side, id, {six("list_transform(list_zip(v, m), lambda z: z[1] - z[2])")} AS vector FROM svec, st
  UNION ALL SELECT 'query', id, {six("list_transform(list_zip(v, m), lambda z: z[1] - z[2])")} FROM vec, st""")
def _(t: Tables):
    return _both(*linear.zero_mean(scaled(t.vectors, "id"), t.vectors))


def _both(base, queries):
    sides = base.withColumn("side", F.lit("base")).unionByName(queries.withColumn("side", F.lit("query")))
    return sides.select("side", "id", arrays.rounded("vector").alias("vector"))


def _scale_sql(factor):
    return f"""WITH {VECTORS}, {SCALED}, f AS (SELECT {factor} AS f FROM svec)
  SELECT 'base' AS side, id, {six("list_transform(v, lambda x: x / f)")} AS vector FROM svec, f
  UNION ALL SELECT 'query', id, {six("list_transform(v, lambda x: x / f)")} FROM vec, f"""


MEAN_ABS = "avg(list_sum(list_transform(v, lambda x: abs(x))) / 64)"


@query("max_norm_scale", _scale_sql(f"max({norm('v')})"))
def _(t: Tables):
    return _both(*linear.max_norm_scale(scaled(t.vectors, "id"), t.vectors))


@query("coeff_scale", _scale_sql(f"{MEAN_ABS} / 3.0"))
def _(t: Tables):
    return _both(*linear.coeff_scale(scaled(t.vectors, "id"), t.vectors, 3.0))


@query("one_half_coeff_scale", _scale_sql(f"{MEAN_ABS} * 2"))
def _(t: Tables):
    return _both(*linear.one_half_scale(scaled(t.vectors, "id"), t.vectors))


@query("inverse_d_coeff_scale", _scale_sql(f"{MEAN_ABS} * 64"))
def _(t: Tables):
    return _both(*linear.inverse_d_scale(scaled(t.vectors, "id"), t.vectors, 64))


@query("mips_to_l2_search", f"""WITH {VECTORS}, {SCALED}, p AS (SELECT a.id AS query_id, b.id AS id, {ip('a.v', 'b.v')} AS s FROM vec a, svec b)
  SELECT query_id, "rank", id FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, id)::INTEGER AS "rank" FROM p)
  WHERE "rank" <= 10""")
def _(t: Tables):
    from ..operators import knn

    base, asked = linear.mips_to_l2(scaled(t.vectors, "id"), t.queries)
    return knn.knn_join(asked, base, 10).select("query_id", "rank", "id")


@query("mips_to_l2_vectors", f"""WITH {VECTORS}, {SCALED}, f AS (SELECT max({ip('v', 'v')}) AS phi FROM svec)
  SELECT id, round(sqrt(phi - {ip('v', 'v')}), 6) AS extra, len(v) + 1 AS dim FROM svec, f""")
def _(t: Tables):
    base, _ = linear.mips_to_l2(scaled(t.vectors, "id"), t.vectors)
    return base.select("id", F.round(F.element_at("vector", -1), 6).alias("extra"),
                       F.size("vector").cast("long").alias("dim"))


@query("e2m_transform", f"""WITH {VECTORS}, {SCALED}, f AS (SELECT max({norm('v')}) AS m FROM svec)
  SELECT 'base' AS side, id, {six(f"list_concat(v, [m - {ip('v', 'v')}, 0.0, 0.0, 0.0])")} AS vector FROM svec, f
  UNION ALL SELECT 'query', id, {six("list_concat(v, [0.5::DOUBLE, 0.0, 0.0, 0.0])")} FROM vec""")
def _(t: Tables):
    return _both(*linear.e2m_transform(scaled(t.vectors, "id"), t.vectors))


CELLS = "c AS (SELECT id, generate_subscripts(v, 1) - 1 AS dim, unnest(v) AS x FROM {})"


def _gram_sql(source, value, ctes=""):
    return f"""WITH {VECTORS}, {SCALED}{ctes}, {CELLS.format(source)}
  SELECT a.dim::INTEGER AS i, b.dim::INTEGER AS j, round({value}, 6) + 0.0 AS value FROM c a JOIN c b USING (id) GROUP BY ALL"""


def _gram(rows):
    return rows.select("i", "j", (F.round("value", 6) + 0.0).alias("value"))


@query("e2m_gram", _gram_sql("wide", "sum(a.x * b.x) / count(*)", ", wide AS (SELECT id, list_concat(v, [-0.5::DOUBLE]) AS v FROM svec)"))
def _(t: Tables):
    return _gram(linear.e2m_gram(scaled(t.vectors, "id")))


@query("gram_matrix", _gram_sql("svec", "sum(a.x * b.x)"))
def _(t: Tables):
    return _gram(linear.gram(scaled(t.vectors, "id")))


@query("covariance_matrix", _gram_sql("svec", "covar_pop(a.x, b.x)"))
def _(t: Tables):
    return _gram(linear.covariance(scaled(t.vectors, "id")))


@query("pairwise_dot_products", """WITH c AS (SELECT label, generate_subscripts(embedding, 1) AS dim, unnest(embedding::DOUBLE[]) AS x FROM embeddings),
  m AS (SELECT label, dim, avg(x) AS x FROM c GROUP BY label, dim)
  SELECT a.label::BIGINT AS i, b.label::BIGINT AS j, round(sum(a.x * b.x), 6) AS value FROM m a JOIN m b USING (dim) GROUP BY ALL""")
def _(t: Tables):
    """Dot products of the class centres (fewer centres than dimensions)."""
    centres = (
        linear.vector_stats(t.labelled, by=["label"]).groupBy(F.col("label").cast("long").alias("id"))
        .agg(F.array_sort(F.collect_list(F.struct("dim", "mean"))).alias("cells"))
        .select("id", F.col("cells.mean").alias("vector"))
    )
    return linear.pairwise_dots(centres).withColumn("value", F.round("value", 6))


@query("vector_statistics", f"""WITH {VECTORS}, {SCALED}, {CELLS.format('svec')}
  SELECT dim::INTEGER AS dim, count(*) AS n, round(avg(x), 6) AS mean, round(var_pop(x), 6) AS var, min(x) AS min, max(x) AS max FROM c GROUP BY dim""")
def _(t: Tables):
    s = linear.vector_stats(scaled(t.vectors, "id"))
    return s.select("dim", "n", F.round("mean", 6).alias("mean"), F.round("var", 6).alias("var"), "min", "max")


@query("vector_statistics_by_label", """WITH c AS (SELECT label, generate_subscripts(embedding, 1) - 1 AS dim, unnest(embedding::DOUBLE[]) AS x FROM embeddings)
  SELECT label, dim::INTEGER AS dim, count(*) AS n, round(avg(x), 6) AS mean, min(x) AS min, max(x) AS max FROM c GROUP BY label, dim""")
def _(t: Tables):
    s = linear.vector_stats(t.labelled, by=["label"])
    return s.select("label", "dim", "n", F.round("mean", 6).alias("mean"), "min", "max")


@query("median_thresholds", f"""WITH {VECTORS}, {CELLS.format('vec')} SELECT dim::INTEGER AS dim, round(quantile_cont(x, 0.5), 6) AS threshold FROM c GROUP BY dim""")
def _(t: Tables):
    return linear.median_thresholds(t.vectors).select("dim", F.round("threshold", 6).alias("threshold"))


@query("uniform_norm_quantize", """WITH n AS (SELECT l_orderkey, l_linenumber, l_extendedprice AS x FROM lineitem),
   r AS (SELECT min(x) AS lo, max(x) AS hi FROM n), b AS (SELECT n.*, lo, (hi - lo) AS w, floor((x - lo) / (hi - lo) * 255) AS b FROM n, r)
  SELECT l_orderkey, l_linenumber, b::BIGINT AS bucket, round(lo + (b + 0.5) * (w / 255), 6) AS value FROM b""")
def _(t: Tables):
    rows = t("lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    out = linear.uniform_quantize(rows, "l_extendedprice", 256)
    return out.select("l_orderkey", "l_linenumber", "bucket", F.round("value", 6).alias("value"))


# ----------------------------------------------- trained maps, checked by rows

@query("pca_energy")
def _(t: Tables):
    """Variance of each principal component, decreasing."""
    model = linear.PCA(16).fit(scaled(t.vectors, "id"))
    s = linear.vector_stats(model.transform(scaled(t.vectors, "id")))
    return s.select("dim", F.round("var", 6).alias("var"))


@query("pca_total_variance", f"""WITH {VECTORS}, {SCALED}, {CELLS.format('svec')}, s AS (SELECT dim, var_pop(x) AS v FROM c GROUP BY dim)
  SELECT round(sum(v), 6) AS total FROM s""")
def _(t: Tables):
    model = linear.PCA(64).fit(scaled(t.vectors, "id"))
    s = linear.vector_stats(model.transform(scaled(t.vectors, "id")))
    return s.agg(F.round(F.sum("var"), 6).alias("total"))


@query("mahalanobis_whitened_covariance", """SELECT i::INTEGER AS i, j::INTEGER AS j, (CASE WHEN i = j THEN 1.0 ELSE 0.0 END)::DOUBLE AS value
  FROM generate_series(0, 63) a(i), generate_series(0, 63) b(j)""")
def _(t: Tables):
    model = linear.MahalanobisWhiten().fit(t.vectors)
    return linear.covariance(model.transform(t.vectors)).select("i", "j", (F.round("value", 5) + 0.0).alias("value"))


@query("random_rotation_keeps_norms", f"""WITH {VECTORS}, {SCALED} SELECT id, round({norm('v')}, 6) AS norm FROM svec""")
def _(t: Tables):
    turned = linear.random_rotation(64, 64, seed=5).transform(scaled(t.vectors, "id"))
    return turned.select("id", F.round(arrays.vector_norm("vector"), 6).alias("norm"))


@query("transform_chain")
def _(t: Tables):
    """L2norm → PCA2 → L2norm: unit vectors of two components."""
    chain = linear.Chain([linear.L2Norm(), linear.PCA(2), linear.L2Norm()]).fit(scaled(t.vectors, "id"))
    return chain.transform(scaled(t.vectors, "id")).select("id", arrays.rounded("vector").alias("vector"))


@query("itq_rotation_codes")
def _(t: Tables):
    model = linear.ITQ(16, iterations=4).fit(t.vectors)
    return model.transform(t.vectors).select("id", arrays.sign_code("vector").alias("code"))
