"""Exact search under every metric, and the joins built on it."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import arrays
from ..operators import knn
from .registry import Tables, query
from .snippets import VECTORS, each, h, ip, knn as knn_sql, l2, norm, top

K = 10

# vectors of different lengths, so that the metrics rank differently
SCALED = "svec AS (SELECT id, list_transform(v, lambda x: x * (1 + id % 7)) AS v FROM vec)"
UNITS = (
    f"uvec AS (SELECT id, list_transform(v, lambda x: x / n) AS v FROM (SELECT id, v, {norm('v')} AS n FROM svec))"
)
PROBS = (
    "pvec AS (SELECT id, list_transform(v, lambda x: abs(x) / t) AS v FROM"
    " (SELECT id, v, list_sum(list_transform(v, lambda x: abs(x))) AS t FROM vec))"
)
ROUNDED = 'query_id, "rank", id, round(distance, 6) AS distance'


def scaled(df, key):
    return df.withColumn("vector", arrays.scale("vector", F.lit(1) + F.col(key) % 7))


def probabilities(df):
    total = arrays.array_total(F.transform(arrays.doubles("vector"), F.abs))
    spread = arrays.bind(total, lambda s: F.transform(arrays.doubles("vector"), lambda x: F.abs(x) / s))
    return df.withColumn("vector", spread)


def round_distance(df):
    return df.withColumn("distance", F.round("distance", 6))


@query("knn_join_l2", knn_sql(l2("a.v", "b.v"), K))
def _(t: Tables):
    return knn.knn_join(t.queries, t.vectors, K, "l2")


@query("knn_join_ip", knn_sql(ip("a.v", "b.v"), K, "distance DESC", SCALED, b="svec"))
def _(t: Tables):
    return knn.knn_join(t.queries, scaled(t.vectors, "id"), K, "ip")


@query("knn_join_cosine", knn_sql(ip("a.v", "b.v"), K, "distance DESC", f"{SCALED}, {UNITS}", q="uvec", b="uvec"))
def _(t: Tables):
    return knn.knn_join(scaled(t.queries, "query_id"), scaled(t.vectors, "id"), K, "cosine")


@query("knn_join_angular", knn_sql(
    ip("a.v", "b.v"), K, "distance DESC", f"{SCALED}, {UNITS}", q="uvec", b="uvec",
    select='query_id, "rank", id, round(acos(greatest(least(distance, 1.0), -1.0)) / pi(), 6) AS distance'))
def _(t: Tables):
    return round_distance(knn.knn_join(scaled(t.queries, "query_id"), scaled(t.vectors, "id"), K, "angular"))


@query("knn_join_euclid", knn_sql(
    l2("a.v", "b.v"), K, ctes=SCALED, q="svec", b="svec", select='query_id, "rank", id, sqrt(distance) AS distance'))
def _(t: Tables):
    return knn.knn_join(scaled(t.queries, "query_id"), scaled(t.vectors, "id"), K, "euclid")


@query("knn_join_l1", knn_sql(each("a.v", "b.v", "abs(z[1]-z[2])"), K, ctes=SCALED, b="svec"))
def _(t: Tables):
    return knn.knn_join(t.queries, scaled(t.vectors, "id"), K, "l1")


@query("knn_join_linf", knn_sql(
    "list_max(list_transform(list_zip(a.v, b.v), lambda z: abs(z[1]-z[2])))", K, ctes=SCALED, b="svec"))
def _(t: Tables):
    return knn.knn_join(t.queries, scaled(t.vectors, "id"), K, "linf")


@query("knn_join_l3", knn_sql(each("a.v", "b.v", "pow(abs(z[1]-z[2]), 3.0)"), K, ctes=SCALED, b="svec", select=ROUNDED))
def _(t: Tables):
    return round_distance(knn.knn_join(t.queries, scaled(t.vectors, "id"), K, ("lp", 3)))


@query("knn_join_canberra", knn_sql(
    each("a.v", "b.v", "CASE WHEN abs(z[1])+abs(z[2]) = 0 THEN 0.0 ELSE abs(z[1]-z[2])/(abs(z[1])+abs(z[2])) END"),
    K, ctes=SCALED, b="svec"))
def _(t: Tables):
    return knn.knn_join(t.queries, scaled(t.vectors, "id"), K, "canberra")


@query("knn_join_braycurtis", knn_sql(
    each("a.v", "b.v", "abs(z[1]-z[2])") + " / " + each("a.v", "b.v", "abs(z[1]+z[2])"), K, ctes=SCALED, b="svec"))
def _(t: Tables):
    return knn.knn_join(t.queries, scaled(t.vectors, "id"), K, "braycurtis")


@query("knn_join_jensenshannon", knn_sql(
    each("a.v", "b.v",
         "(CASE WHEN z[1] > 0 THEN 0.5*z[1]*ln(z[1]/((z[1]+z[2])/2)) ELSE 0.0 END)"
         " + (CASE WHEN z[2] > 0 THEN 0.5*z[2]*ln(z[2]/((z[1]+z[2])/2)) ELSE 0.0 END)"),
    K, ctes=PROBS, q="pvec", b="pvec", select=ROUNDED))
def _(t: Tables):
    return round_distance(knn.knn_join(probabilities(t.queries), probabilities(t.vectors), K, "jensenshannon"))


@query("knn_join_sign_mismatch", knn_sql(
    "list_sum(list_transform(list_zip(a.v, b.v), lambda z: ((z[1] > 0) <> (z[2] > 0))::DOUBLE))", K))
def _(t: Tables):
    return knn.knn_join(t.queries, t.vectors, K, "sign_mismatch")


# ------------------------------------------------------------- self and range

def _self_pairs(k):
    return top(f"SELECT a.id AS query_id, b.id AS id, {l2('a.v', 'b.v')} AS distance FROM vec a, vec b", k)


def _self_sql(candidates, kept, order):
    return (
        f"WITH {VECTORS}, cand AS ({_self_pairs(candidates)}), other AS (SELECT * EXCLUDE (\"rank\"), "
        f"row_number() OVER (PARTITION BY query_id ORDER BY {order})::INTEGER AS \"rank\" FROM cand WHERE query_id <> id)"
        f" SELECT query_id, \"rank\", id, distance FROM other WHERE \"rank\" <= {kept}"
    )


@query("self_knn_best", _self_sql(6, 4, '"rank"'))
def _(t: Tables):
    return knn.self_knn(t.vectors, 4, candidates=6)


@query("self_knn_sample", _self_sql(8, 3, f"{h('query_id', 'id', seed=7)}, id"))
def _(t: Tables):
    return knn.self_knn(t.vectors, 3, candidates=8, mode="sample", seed=7)


@query("knn_pairs", f"WITH {VECTORS}, cand AS ({_self_pairs(5)}), "
       "o AS (SELECT query_id, id, row_number() OVER (PARTITION BY query_id ORDER BY \"rank\") AS r FROM cand"
       " WHERE query_id <> id) SELECT query_id AS i, id AS j FROM o WHERE r <= 4")
def _(t: Tables):
    return knn.knn_pairs(t.vectors, 4)


@query("range_join_l2", f"WITH {VECTORS} SELECT * FROM (SELECT a.id AS query_id, b.id AS id, {l2('a.v', 'b.v')} AS distance"
       " FROM vec a, vec b) WHERE distance < 1.2")
def _(t: Tables):
    return knn.range_join(t.queries, t.vectors, 1.2)


@query("range_join_ip", f"WITH {VECTORS}, {SCALED} SELECT * FROM (SELECT a.id AS query_id, b.id AS id, {ip('a.v', 'b.v')}"
       " AS distance FROM vec a, svec b) WHERE distance > 2.0")
def _(t: Tables):
    return knn.range_join(t.queries, scaled(t.vectors, "id"), 2.0, "ip")


@query("mutual_nn", f"""WITH {VECTORS}, pair AS (SELECT a.id AS i, b.id AS j, {l2('a.v', 'b.v')} AS distance
  FROM vec a, vec b WHERE a.label < 5 AND b.label >= 5),
  f AS (SELECT *, row_number() OVER (PARTITION BY i ORDER BY distance, j) AS r FROM pair),
  g AS (SELECT *, row_number() OVER (PARTITION BY j ORDER BY distance, i) AS r FROM pair)
  SELECT f.i, f.j, f.distance FROM f JOIN g ON f.i = g.i AND f.j = g.j WHERE f.r = 1 AND g.r = 1""")
def _(t: Tables):
    rows = t.labelled
    return knn.mutual_nn(rows.filter("label < 5").drop("label"), rows.filter("label >= 5").drop("label"))


@query("search_by_id", f"""WITH {VECTORS}, asked AS (SELECT DISTINCT user_id AS id FROM events),
  found AS ({top(f"SELECT a.id AS query_id, b.id AS id, {l2('a.v', 'b.v')} AS distance FROM vec a JOIN asked USING (id), vec b", 5)})
  SELECT asked.id AS query_id, "rank", found.id, distance FROM asked LEFT JOIN found ON asked.id = query_id""")
def _(t: Tables):
    return knn.search_by_id(t("events").select(F.col("user_id").alias("id")), t.vectors, 5)


@query("refine_true_distance", f"""WITH {VECTORS}, cand AS ({top(
    "SELECT a.id AS query_id, b.id AS id, list_sum(list_transform(list_zip(a.v, b.v),"
    " lambda z: ((z[1] > 0) <> (z[2] > 0))::DOUBLE)) AS distance FROM vec a, vec b", 20)})
  {top(f"SELECT query_id, c.id AS id, {l2('a.v', 'b.v')} AS distance FROM cand c JOIN vec a ON a.id = query_id"
       " JOIN vec b ON b.id = c.id", 5)}""")
def _(t: Tables):
    rough = knn.knn_join(t.queries, t.vectors, 20, "sign_mismatch")
    return knn.refine(rough, t.queries, t.vectors, 5)


@query("merge_topk_shards", knn_sql(l2("a.v", "b.v"), 7))
def _(t: Tables):
    shards = [t.vectors.filter(F.col("id") % 3 == r) for r in range(3)]
    return knn.merge_topk(7, *[knn.knn_join(t.queries, s, 7) for s in shards])


@query("topk_per_query", f"""WITH {VECTORS} {top(f"SELECT a.label::BIGINT AS query_id, a.id AS id, list_sum(v) AS distance FROM vec a", 5)}""")
def _(t: Tables):
    from ..operators.blockjoin import top_k

    pairs = t.labelled.select(F.col("label").cast("long").alias("query_id"), "id", arrays.array_total("vector").alias("distance"))
    return top_k(pairs, 5)


@query("global_topk", f"""WITH {VECTORS}, p AS (SELECT a.id AS query_id, b.id AS id, {l2('a.v', 'b.v')} AS distance FROM vec a, vec b
  WHERE a.id <> b.id) SELECT query_id, id, distance FROM p ORDER BY distance, query_id, id LIMIT 25""")
def _(t: Tables):
    # one row may own all 25, so each brings as many
    pairs = knn.self_knn(t.vectors, 25).drop("rank")
    return knn.global_topk(pairs, 25)


@query("federated_search", f"""WITH {VECTORS}, {SCALED}, {UNITS}, p AS (
  SELECT a.id AS query_id, b.id AS id, {ip('a.v', 'b.v')} AS distance, (b.id % 2)::INTEGER AS source FROM uvec a, uvec b)
  SELECT query_id, "rank", source, id, distance FROM (SELECT *, row_number() OVER (PARTITION BY query_id
   ORDER BY distance DESC, source, id)::INTEGER AS "rank" FROM p) WHERE "rank" <= 6""")
def _(t: Tables):
    base = scaled(t.vectors, "id")
    parts = [base.filter(F.col("id") % 2 == r) for r in (0, 1)]
    return knn.federated_search(scaled(t.queries, "query_id"), parts, 6)


@query("pair_similarity", f"""WITH {VECTORS}, n AS (SELECT id, v, {norm('v')} AS v_n FROM vec),
  w AS (SELECT id, list_transform(v, lambda x: x / v_n) AS v FROM n)
  SELECT a.id AS pair_id, {ip('a.v', 'b.v')} AS distance FROM w a JOIN w b ON b.id = a.id + 1""")
def _(t: Tables):
    left = t.vectors.withColumnRenamed("id", "pair_id")
    right = t.vectors.select((F.col("id") - 1).alias("pair_id"), "vector")
    return knn.pair_similarity(left, right)


@query("attach_attributes", f"""WITH {VECTORS}, r AS ({_self_pairs(3)})
  SELECT query_id, "rank", r.id, distance, p_name AS title FROM r LEFT JOIN part ON p_partkey = r.id""")
def _(t: Tables):
    items = t("part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("title"))
    return knn.attach_attributes(knn.knn_join(t.queries, t.vectors, 3), items)


@query("neighbour_overlap", f"""WITH {VECTORS}, {SCALED}, a AS ({_self_pairs(10)}),
  b AS ({top(f"SELECT a.id AS query_id, b.id AS id, {each('a.v', 'b.v', 'abs(z[1]-z[2])')} AS distance FROM vec a, svec b", 10)})
  SELECT count(*) AS common FROM a JOIN b ON a.query_id = b.query_id AND a.id = b.id""")
def _(t: Tables):
    a = knn.knn_join(t.queries, t.vectors, 10)
    b = knn.knn_join(t.queries, scaled(t.vectors, "id"), 10, "l1")
    return knn.eval_intersection(a, b)


# ------------------------------------------------------------------ bit codes

SIGNS = (
    "bits AS (SELECT id, label, list_transform(generate_series(0, 1), lambda w: list_sum(list_transform("
    "generate_series(1, 32), lambda i: CASE WHEN v[w*32+i] > 0 THEN (1::BIGINT << (i-1)) ELSE 0 END))::BIGINT) AS v FROM vec)"
)
BITS = "(bit_count(xor(a.v[1], b.v[1])) + bit_count(xor(a.v[2], b.v[2])))::DOUBLE"


@query("hamming_knn", knn_sql(BITS, K, ctes=SIGNS, q="bits", b="bits"))
def _(t: Tables):
    code = arrays.sign_code("vector")
    return knn.knn_join(t.queries.withColumn("vector", code), t.vectors.withColumn("vector", code), K, "hamming")


@query("hamming_range", f"WITH {VECTORS}, {SIGNS} SELECT * FROM (SELECT a.id AS query_id, b.id AS id, {BITS} AS distance"
       " FROM bits a, bits b) WHERE distance < 20")
def _(t: Tables):
    code = arrays.sign_code("vector")
    return knn.range_join(t.queries.withColumn("vector", code), t.vectors.withColumn("vector", code), 20, "hamming")


@query("method_pairs", f"WITH {VECTORS}, cand AS ({_self_pairs(4)}) SELECT query_id AS i, id AS j FROM cand WHERE query_id <> id")
def _(t: Tables):
    from ..operators.methods import method_named

    return method_named("Vector").create_pairs(t.vectors, k=4)


@query("knn_join_mahalanobis")
def _(t: Tables):
    """l2 after whitening with the inverse Cholesky factor of the covariance."""
    from ..operators.linear import MahalanobisWhiten

    model = MahalanobisWhiten().fit(scaled(t.vectors, "id"))
    return knn.knn_join(model.transform(scaled(t.queries, "query_id")), model.transform(scaled(t.vectors, "id")), K)
