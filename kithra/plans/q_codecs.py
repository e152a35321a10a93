"""Codecs and search on compressed vectors.

The checked codebooks are fixed: the lowest ids give the starting words.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import arrays
from ..operators import codebooks, codecs, knn, norms
from .q_cells import CENTRES, _assign_sql, _means, _probe_sql, centres
from .q_search import SCALED, scaled
from .q_vectors import CELLS, six
from .registry import Tables, query
from .snippets import VECTORS, ip, l2, norm, top

# ------------------------------------------------------------------- scalar


def _sq_cells(bits, source="vec"):
    n = 1 << bits
    return (
        f"{CELLS.format(source)}, rng AS (SELECT dim, min(x) AS lo, max(x) AS hi FROM c GROUP BY dim),"
        f" code AS (SELECT id, dim, least(floor((x - lo) / (hi - lo) * {n}), {n - 1})::INTEGER AS code, lo, hi FROM c JOIN rng USING (dim)),"
        f" sq AS (SELECT id, list(code ORDER BY dim) AS codes, list(lo + (code::DOUBLE + 0.5) / {n}.0 * (hi - lo) ORDER BY dim) AS v FROM code GROUP BY id)"
    )


def _register_sq(bits):
    @query(f"sq{bits}_encode_decode", f"WITH {VECTORS}, {_sq_cells(bits)} SELECT id, codes, {six('v')} AS vector FROM sq")
    def _(t: Tables):
        codec = codecs.ScalarQuantizer(bits).fit(t.vectors)
        out = codec.decode(codec.encode(t.vectors))
        return out.select("id", "codes", arrays.rounded("vector").alias("vector"))

    @query(f"sq{bits}_knn", f"WITH {VECTORS}, {_sq_cells(bits)} " + top(
        f"SELECT a.id AS query_id, b.id AS id, {l2('a.v', 'b.v')} AS distance FROM vec a, sq b", 10))
    def _(t: Tables):
        return codecs.decoded_knn(t.queries, t.vectors, codecs.ScalarQuantizer(bits).fit(t.vectors), 10)

    @query(f"sq{bits}_roundtrip_error", f"WITH {VECTORS}, {_sq_cells(bits)} SELECT round(sum({l2('a.v', 'b.v')}) / sum({ip('a.v', 'a.v')}), 9) AS error"
           " FROM vec a JOIN sq b USING (id)")
    def _(t: Tables):
        codec = codecs.ScalarQuantizer(bits).fit(t.vectors)
        return codebooks.roundtrip_error(t.vectors, codec).withColumn("error", F.round("error", 9))


for _bits in (4, 6, 8):
    _register_sq(_bits)


@query("fp16_roundtrip_error")
def _(t: Tables):
    return codebooks.roundtrip_error(t.vectors, codecs.HalfPrecision().fit(t.vectors))


@query("byte_codes_sq4", f"""WITH {VECTORS}, {_sq_cells(4)} SELECT id, upper(list_aggregate(list_transform(generate_series(0, 31),
   lambda i: printf('%02x', codes[2*i+1] + 16 * codes[2*i+2])), 'string_agg', '')) AS code, 32::BIGINT AS bytes FROM sq""")
def _(t: Tables):
    codec = codecs.ByteCodec(codecs.ScalarQuantizer(4).fit(t.vectors))
    coded = codec.encode(t.vectors)
    return coded.select("id", F.hex("code").alias("code"), F.octet_length("code").cast("long").alias("bytes"))


# ------------------------------------------------------------------ product

KS, M, DS = 16, 4, 16


def _book_sql(source="vec", where=f"id < {KS}", shift=0):
    return (
        f"sub AS (SELECT id, m, v[m*{DS}+1 : m*{DS}+{DS}] AS s FROM {source}, generate_series(0, {M - 1}) g(m)),"
        f" book AS (SELECT m, id - {shift} AS code, s AS w FROM sub WHERE {where}),"
        f" pqc AS (SELECT id, m, code, w FROM (SELECT sub.id, sub.m, code, w, row_number() OVER (PARTITION BY sub.id, sub.m"
        f" ORDER BY {l2('s', 'w')}, code) AS r FROM sub JOIN book USING (m)) WHERE r = 1)"
    )


def book(rows, iterations=0):
    return codebooks.fit_codebook(rows, M, KS, iterations=iterations, init="first")


@query("pq_encode", f"WITH {VECTORS}, {_book_sql()} SELECT id, list(code::INTEGER ORDER BY m) AS codes FROM pqc GROUP BY id")
def _(t: Tables):
    return book(t.vectors).encode(t.vectors).select("id", "codes")


@query("pq_compress", f"WITH {VECTORS}, {_book_sql()} SELECT id, flatten(list(w ORDER BY m)) AS vector FROM pqc GROUP BY id")
def _(t: Tables):
    return book(t.vectors).compress(t.vectors)


@query("pq_fit_one_iteration", f"""WITH {VECTORS}, {_book_sql()}, e AS (SELECT m, code, generate_subscripts(s, 1) AS dim, unnest(s) AS x FROM pqc JOIN sub USING (id, m)),
  a AS (SELECT m, code, dim, avg(x) AS x FROM e GROUP BY ALL)
  SELECT b.m::INTEGER AS component, b.code::INTEGER AS code, list_transform(coalesce(l.w, b.w), lambda x: round(x, 6)) AS word
  FROM book b LEFT JOIN (SELECT m, code, list(x ORDER BY dim) AS w FROM a GROUP BY m, code) l ON l.m = b.m AND l.code = b.code""")
def _(t: Tables):
    rows = book(t.vectors, iterations=1).to_rows(t.spark)
    return rows.select("component", "code", arrays.rounded("word").alias("word"))


@query("pq_roundtrip_error", f"WITH {VECTORS}, {_book_sql()}, d AS (SELECT id, flatten(list(w ORDER BY m)) AS y FROM pqc GROUP BY id)"
       f" SELECT round(sum({l2('v', 'y')}) / sum({ip('v', 'v')}), 9) AS error FROM vec JOIN d USING (id)")
def _(t: Tables):
    return codebooks.roundtrip_error(t.vectors, book(t.vectors)).withColumn("error", F.round("error", 9))


@query("pq_cut_uneven", f"""WITH {VECTORS} SELECT id, m::INTEGER AS part, v[s+1 : s+n] AS vector FROM vec,
  (VALUES (0, 0, 13), (1, 13, 13), (2, 26, 13), (3, 39, 13), (4, 52, 12)) p(m, s, n)""")
def _(t: Tables):
    parts = F.array(*arrays.slices("vector", 5, 64))
    return t.vectors.select("id", F.posexplode(parts).alias("part", "vector"))


def _adc(q="vec", codes="pqc", joined="", on="TRUE", qid="a.id"):
    """Σ_m of squared sub-distances, in the order of m."""
    return (
        f"SELECT query_id, id, list_sum(list(d ORDER BY m)) AS distance FROM (SELECT {qid} AS query_id, c.id, c.m,"
        f" {l2(f'a.v[c.m*{DS}+1 : c.m*{DS}+{DS}]', 'c.w')} AS d FROM {q} a JOIN {codes} c ON {on} {joined}) GROUP BY query_id, id"
    )


# the table of sub-distances, then sums over the code's entries
LUT = f"lut AS (SELECT a.id AS query_id, book.m, book.code, {l2('a.s', 'book.w')} AS d FROM sub a JOIN book USING (m))"
ADC = "SELECT query_id, id, list_sum(list(d ORDER BY m)) AS distance FROM lut JOIN pqc USING (m, code) GROUP BY query_id, id"


@query("pq_knn", f"WITH {VECTORS}, {_book_sql()}, {LUT} " + top(ADC, 10))
def _(t: Tables):
    b = book(t.vectors)
    return codecs.pq_knn(t.queries, b.encode(t.vectors).select("id", "codes"), b, 10)


@query("polysemous_knn", f"""WITH {VECTORS}, {_book_sql()}, {LUT}, near AS (SELECT a.id AS query_id, b.id AS id FROM pqc a JOIN pqc b USING (m)
  GROUP BY a.id, b.id HAVING sum(bit_count(xor(a.code::BIGINT, b.code::BIGINT))) <= 5) """ + top(
    f"SELECT p.* FROM ({ADC}) p JOIN near USING (query_id, id)", 10))
def _(t: Tables):
    b = book(t.vectors)
    return codecs.polysemous_knn(t.queries, b.encode(t.vectors).select("id", "codes"), b, 10, ht=5)


@query("code_mismatch_knn", f"""WITH {VECTORS}, {_book_sql()} """ + top(
    "SELECT a.id AS query_id, b.id AS id, sum((a.code <> b.code)::INTEGER)::DOUBLE AS distance FROM pqc a JOIN pqc b USING (m) GROUP BY a.id, b.id", 5))
def _(t: Tables):
    coded = book(t.vectors).encode(t.vectors).select("id", F.col("codes").alias("vector"))
    return knn.knn_join(knn.as_queries(coded), coded, 5, "code_mismatch")


# --------------------------------------------------------- codes in cells

RESID = (
    f"{CENTRES}, {_assign_sql()}, res AS (SELECT a.id, list_id, list_transform(list_zip(a.v, c.v), lambda z: z[1] - z[2]) AS v"
    " FROM asg a JOIN cen c ON c.id = list_id)"
)
RPRB = (
    f"{_probe_sql(3)}, rprb AS (SELECT query_id, list_id, list_transform(list_zip(p.v, c.v), lambda z: z[1] - z[2]) AS v"
    " FROM prb p JOIN cen c ON c.id = list_id)"
)


def residual_book(t: Tables, c):
    """Words from the lowest ids that are not centroids themselves."""
    return book(codecs.residual_postings(t.vectors, c).filter(F.col("id") >= len(c)))


RBOOK = _book_sql("res", f"id >= 10 AND id < {10 + KS}", 10)
RLUT = (
    f"rlut AS (SELECT query_id, list_id, book.m, book.code, {l2(f'p.v[book.m*{DS}+1 : book.m*{DS}+{DS}]', 'book.w')} AS d"
    " FROM rprb p, book)"
)
RADC = (
    "SELECT query_id, id, list_sum(list(d ORDER BY m)) AS distance FROM rlut JOIN (SELECT pqc.id, m, code, list_id FROM pqc JOIN asg USING (id)) x"
    " USING (list_id, m, code) GROUP BY query_id, id"
)


@query("ivfpq_knn", f"WITH {VECTORS}, {RESID}, {RPRB}, {RBOOK}, {RLUT} " + top(RADC, 10))
def _(t: Tables):
    c = centres(t)
    b = residual_book(t, c)
    coded = b.encode(codecs.residual_postings(t.vectors, c)).select("list_id", "id", "codes")
    return codecs.ivfpq_knn(t.queries, coded, c, b, 10, nprobe=3)


@query("ivfpq_refined", f"WITH {VECTORS}, {RESID}, {RPRB}, {RBOOK}, {RLUT}, cand AS ({top(RADC, 40)}) " + top(
    f"SELECT query_id, cand.id AS id, {l2('a.v', 'b.v')} AS distance FROM cand JOIN vec a ON a.id = query_id JOIN vec b ON b.id = cand.id", 10))
def _(t: Tables):
    c = centres(t)
    b = residual_book(t, c)
    coded = b.encode(codecs.residual_postings(t.vectors, c)).select("list_id", "id", "codes")
    found = codecs.ivfpq_knn(t.queries, coded, c, b, 40, nprobe=3)
    return knn.refine(found, t.queries, t.vectors, 10)


@query("ivfpq_code_refined")
def _(t: Tables):
    """Second code of the remaining residual re-ranks the candidates."""
    c = centres(t)
    posts = codecs.residual_postings(t.vectors, c)
    first = residual_book(t, c)
    rest = first.decode(first.encode(posts), "codes", "_known")
    rest = rest.withColumn("vector", arrays.subtract("vector", "_known")).drop("_known")
    second = codebooks.fit_codebook(rest.select("id", "vector"), M, KS, 3, "hash")
    coded = second.encode(rest, "vector", "codes2").select("list_id", "id", "codes", "codes2")
    found = codecs.ivfpq_knn(t.queries, coded, c, first, 40, nprobe=3)
    return codecs.refine_codes(found, t.queries, coded, c, first, second, 10)


@query("ivfsq_knn", f"WITH {VECTORS}, {RESID}, {RPRB}, {_sq_cells(8, 'res')} " + top(
    f"SELECT query_id, b.id AS id, {l2('a.v', 'b.v')} AS distance FROM rprb a JOIN asg USING (list_id) JOIN sq b ON b.id = asg.id", 10))
def _(t: Tables):
    c = centres(t)
    posts = codecs.residual_postings(t.vectors, c)
    codec = codecs.ScalarQuantizer(8).fit(posts)
    return codecs.ivfsq_knn(t.queries, codec.encode(posts).select("list_id", "id", "codes"), c, codec, 10, nprobe=3)


@query("two_level_codec", f"WITH {VECTORS}, {RESID}, {RBOOK} SELECT id, [list_id::INTEGER] AS coarse, list(code::INTEGER ORDER BY m) AS fine"
       " FROM pqc JOIN asg USING (id) GROUP BY id, list_id")
def _(t: Tables):
    c = centres(t)
    codec = codecs.TwoLevelCodec(codebooks.Codebook([0], [c]), residual_book(t, c))
    coded = codec.encode(t.vectors)
    return coded.select("id", F.col("codes.coarse").alias("coarse"), F.col("codes.fine").alias("fine"))


@query("two_level_compress", f"WITH {VECTORS}, {RESID}, {RBOOK}, d AS (SELECT id, flatten(list(w ORDER BY m)) AS y FROM pqc GROUP BY id)"
       f" SELECT d.id, {six('list_transform(list_zip(cen.v, y), lambda z: z[1] + z[2])')} AS vector FROM d JOIN asg ON asg.id = d.id JOIN cen ON cen.id = list_id")
def _(t: Tables):
    c = centres(t)
    codec = codecs.TwoLevelCodec(codebooks.Codebook([0], [c]), residual_book(t, c))
    return codec.compress(t.vectors).select("id", arrays.rounded("vector").alias("vector"))


# ----------------------------------------------------------------- residual

LAYER1 = f"cen AS (SELECT id, v FROM vec WHERE id < 8), {_assign_sql(name='a1')}, {_means('a1', 'cen', 'c1')}, {_assign_sql(cen='c1', name='f1')}"
LAYER2 = (
    "res AS (SELECT f.id, list_transform(list_zip(f.v, c.v), lambda z: z[1] - z[2]) AS v FROM f1 f JOIN c1 c ON c.id = f.list_id),"
    f" cen2 AS (SELECT id, v FROM res WHERE id < 8), {_assign_sql('res', 'cen2', 'a2')}, {_means('a2', 'cen2', 'c2')}, {_assign_sql('res', 'c2', 'f2')}"
)


@query("residual_pq_codes", f"WITH {VECTORS}, {LAYER1}, {LAYER2} SELECT f1.id, f1.list_id::INTEGER AS layer1, f2.list_id::INTEGER AS layer2 FROM f1 JOIN f2 USING (id)")
def _(t: Tables):
    codec = codecs.ResidualQuantizer(2, 1, 8, 1, "first").fit(t.vectors)
    code = codec.encode(t.vectors)
    return code.select("id", F.col("codes")[0][0].alias("layer1"), F.col("codes")[1][0].alias("layer2"))


@query("residual_norm_stats", f"""WITH {VECTORS}, {LAYER1}, {LAYER2}, n AS (SELECT 1 AS layer, sqrt(distance) AS x FROM f1 UNION ALL SELECT 2, sqrt(distance) FROM f2)
  SELECT layer, round(avg(x), 6) AS mean, round(max(x), 6) AS max, round(min(x), 6) AS min FROM n GROUP BY layer""")
def _(t: Tables):
    codec = codecs.ResidualQuantizer(2, 1, 8, 1, "first").fit(t.vectors)
    stats = codec.norm_stats(t.vectors)
    return stats.select("layer", *[F.round(c, 6).alias(c) for c in ("mean", "max", "min")])


@query("residual_pq_compress", f"""WITH {VECTORS}, {LAYER1}, {LAYER2} SELECT f1.id, {six('list_transform(list_zip(c1.v, c2.v), lambda z: z[1] + z[2])')} AS vector
  FROM f1 JOIN f2 USING (id) JOIN c1 ON c1.id = f1.list_id JOIN c2 ON c2.id = f2.list_id""")
def _(t: Tables):
    codec = codecs.ResidualQuantizer(2, 1, 8, 1, "first").fit(t.vectors)
    return codec.compress(t.vectors).select("id", arrays.rounded("vector").alias("vector"))


# -------------------------------------------------------------- norm-explicit

UNIT = f"unit AS (SELECT id, list_transform(v, lambda x: x / n) AS v, n FROM (SELECT id, v, {norm('v')} AS n FROM svec))"
RATIO = (
    f"{_book_sql('unit')}, apx AS (SELECT id, y, {norm('y')} AS yn FROM (SELECT id, flatten(list(w ORDER BY m)) AS y FROM pqc GROUP BY id)),"
    " rat AS (SELECT id, y, n / yn AS ratio FROM apx JOIN unit USING (id))"
)
NORM_EDGES = {
    "uniform": "SELECT i, lo + (hi - lo) * i / 16 AS e FROM (SELECT min(ratio) AS lo, max(ratio) AS hi FROM rat), generate_series(0, 16) g(i)",
    "exponential": "SELECT i, lo + (hi - lo) * (1 - pow(0.98, i)) / (1 - pow(0.98, 16)) AS e FROM (SELECT min(ratio) AS lo, max(ratio) AS hi FROM rat), generate_series(0, 16) g(i)",
    "percentile": "SELECT i, quantile_cont(ratio, i / 16.0) AS e FROM rat, generate_series(0, 16) g(i) GROUP BY i",
}


def _register_norm(method, edges):
    if method == "percentile":
        edges = "SELECT unnest(generate_series(0, 16)) AS i, unnest((SELECT quantile_cont(ratio, [" + ", ".join(
            f"{i / 16}" for i in range(17)) + "]) FROM rat)) AS e"

    @query(f"norm_explicit_{method}", f"""WITH {VECTORS}, {SCALED}, {UNIT}, {RATIO}, edge AS ({edges}),
      code AS (SELECT id, y, (SELECT count(*) FROM edge WHERE i BETWEEN 1 AND 15 AND e <= ratio) AS c FROM rat)
      SELECT id, c::INTEGER AS norm_code, {six('list_transform(y, lambda x: x * ((a.e + b.e) / 2.0))')} AS vector
      FROM code JOIN edge a ON a.i = c JOIN edge b ON b.i = c + 1""")
    def _(t: Tables):
        rows = scaled(t.vectors, "id")
        inner = book(rows.withColumn("vector", arrays.l2_normalize("vector")))
        # a trained inner codec has no fit: its codebook is used as it is
        codec = norms.NormExplicitQuantizer(inner, 16, method).fit(rows)
        coded = codec.encode(rows)
        return codec.decode(coded).select("id", F.col("codes.norm").alias("norm_code"), arrays.rounded("vector").alias("vector"))


for _method, _edges in NORM_EDGES.items():
    _register_norm(_method, _edges)


@query("norm_explicit_kmeans")
def _(t: Tables):
    rows = scaled(t.vectors, "id")
    codec = norms.NormExplicitQuantizer(codecs.ProductQuantizer(4, 16, 3), 16, "kmeans", 5).fit(rows)
    return codec.compress(rows).select("id", arrays.rounded("vector").alias("vector"))


@query("norm_explicit_kmeans_partial")
def _(t: Tables):
    rows = scaled(t.vectors, "id")
    codec = norms.NormExplicitQuantizer(codecs.ProductQuantizer(4, 16, 3), 16, "kmeans_partial", 5).fit(rows)
    return codec.compress(rows).select("id", arrays.rounded("vector").alias("vector"))


@query("kmeans_norm_quantize")
def _(t: Tables):
    rows = scaled(t.vectors, "id").select("id", arrays.vector_norm("vector").alias("norm"))
    return norms.kmeans_quantize(rows, "norm", 7, 5)


# ---------------------------------------------------------- trained families

@query("opq_roundtrip_error")
def _(t: Tables):
    codec = codecs.OptimizedProduct(4, 16, iterations=3, final_iterations=3).fit(t.vectors)
    return codebooks.roundtrip_error(t.vectors, codec)


@query("split_quantizer_error")
def _(t: Tables):
    parts = [codecs.ProductQuantizer(2, 16, 3), codecs.ScalarQuantizer(6)]
    return codebooks.roundtrip_error(t.vectors, codecs.SplitQuantizer(parts).fit(t.vectors))


@query("lsh_code_knn")
def _(t: Tables):
    return codecs.lsh_code_knn(t.queries, t.vectors, 48, 10, seed=3)


@query("lsh_trained_code_knn")
def _(t: Tables):
    return codecs.lsh_code_knn(t.queries, t.vectors, 96, 10, seed=3, train=True)


@query("residual_tree_error")
def _(t: Tables):
    from ..operators.trees import TreeQuantizer

    return codebooks.roundtrip_error(t.vectors, TreeQuantizer(3, 8, 3).fit(t.vectors))


@query("residual_tree_codes", f"""WITH {VECTORS}, {LAYER1},
  res AS (SELECT f.id, f.list_id AS parent, list_transform(list_zip(f.v, c.v), lambda z: z[1] - z[2]) AS v FROM f1 f JOIN c1 c ON c.id = f.list_id),
  w AS (SELECT parent, v, r - 1 AS code FROM (SELECT *, row_number() OVER (PARTITION BY parent ORDER BY ('0x'||substr(md5(concat_ws(':', id::VARCHAR, '0')),1,8))::BIGINT, id) AS r FROM res) WHERE r <= 8)
  SELECT id, parent::INTEGER AS level1, code::INTEGER AS level2 FROM (SELECT res.id, res.parent, w.code, row_number() OVER (PARTITION BY res.id ORDER BY {l2('res.v', 'w.v')}, w.code) AS r
   FROM res JOIN w USING (parent)) WHERE r = 1""")
def _(t: Tables):
    """Second level untrained: the starting words of every parent are its codebook."""
    from ..operators.trees import TreeCodec, TreeQuantizer

    shared = codebooks.fit_codebook(t.vectors, 1, 8, 1, "first")
    branches = TreeQuantizer(2, 8, 0)._fit_branches(t.vectors.withColumn("vector", arrays.doubles("vector")), shared, "id")
    codes = TreeCodec([(shared.centroids, branches)]).encode(t.vectors)
    return codes.select("id", F.col("codes")[0].alias("level1"), F.col("codes")[1].alias("level2"))


@query("additive_quantizer_error")
def _(t: Tables):
    from ..operators.additive import AdditiveQuantizer

    return codebooks.roundtrip_error(t.vectors, AdditiveQuantizer(3, 16, 3, beam=16).fit(t.vectors))
