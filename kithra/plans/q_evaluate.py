"""Quality measures, splits, samples and batches."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import evaluate, knn, splits
from .q_search import SCALED, scaled
from .registry import Tables, query
from .snippets import VECTORS, each, h, l2, top, u

EXACT = f"truth AS ({top(f'''SELECT a.id AS query_id, b.id AS id, {l2('a.v', 'b.v')} AS distance FROM vec a, vec b''', 20)})"
OTHER = f"other AS ({top(f'''SELECT a.id AS query_id, b.id AS id, {each('a.v', 'b.v', 'abs(z[1]-z[2])')} AS distance FROM vec a, svec b''', 64)})"


@query("ground_truth", f"WITH {VECTORS}, {EXACT} SELECT * FROM truth")
def _(t: Tables):
    return evaluate.ground_truth(t.vectors, t.queries, 20)


@query("recall_curve", f"""WITH {VECTORS}, {SCALED}, {EXACT}, {OTHER}, j AS (SELECT truth.query_id, other."rank" AS r FROM truth LEFT JOIN other ON truth.query_id = other.query_id AND truth.id = other.id),
  ts AS (SELECT unnest([1, 2, 4, 8, 16, 32, 64]) AS t), s AS (SELECT t, count(*) FILTER (WHERE r <= t)::DOUBLE / (count(DISTINCT query_id) * 20) AS recall FROM j, ts GROUP BY t)
  SELECT t, recall, recall * 20 / t AS precision FROM s""")
def _(t: Tables):
    truth = knn.knn_join(t.queries, t.vectors, 20)
    ranked = knn.knn_join(t.queries, scaled(t.vectors, "id"), 64, "l1")
    return evaluate.recall_curve(ranked, truth, 20, [1, 2, 4, 8, 16, 32, 64])


def _eval_sql(name, dist, base, order):
    return (
        f"{name}n AS (SELECT query_id, \"rank\", (a.label = b.label)::INTEGER AS rel, a.label FROM ({top(f'SELECT a.id AS query_id, b.id AS id, {dist} AS distance FROM vec a, {base} b WHERE a.id <> b.id', 4, order)}) r"
        f" JOIN vec a ON a.id = query_id JOIN vec b ON b.id = r.id), {name} AS (SELECT query_id, label, list(rel ORDER BY \"rank\") AS e FROM {name}n GROUP BY ALL)"
    )


def _evals(t: Tables, base, metric):
    found = knn.self_knn(t.vectors, 4, metric=metric) if base is None else (
        knn.knn_join(t.queries, base, 5, metric).filter("query_id <> id"))
    labels = t.labelled.select("id", "label")
    rows = found.join(labels, "id").join(labels.select(F.col("id").alias("query_id"), F.col("label").alias("own")), "query_id")
    slots = rows.groupBy("query_id", "own").agg(F.array_sort(F.collect_list(F.struct("rank", (F.col("label") == F.col("own")).cast("int").alias("rel")))).alias("s"))
    return slots.select("query_id", "own", F.slice(F.col("s.rel"), 1, 4).alias("eval"))


METRICS = (
    "m AS (SELECT kind, CASE WHEN list_position(e, 1) IS NOT NULL AND list_position(e, 1) > 0 THEN 1.0 / list_position(e, 1) ELSE 0.0 END AS mrr,"
    " CASE WHEN list_sum(e) > 0 THEN (e[1] * e[1]::DOUBLE + e[2] * (e[1]+e[2]) / 2.0::DOUBLE + e[3] * (e[1]+e[2]+e[3]) / 3.0::DOUBLE + e[4] * list_sum(e) / 4.0::DOUBLE) / list_sum(e) ELSE 0.0 END AS map,"
    + ", ".join(f"list_sum(e[1:{i}]) / {i}.0::DOUBLE AS precision_{i}, (list_sum(e[1:{i}]) > 0)::INTEGER AS recall_1_{i}" for i in range(1, 5)) + " FROM ek)"
)
AVERAGES = ", ".join(f"round(avg({c}), 4) AS {c}" for c in ["mrr", "map"] + [f"{n}_{i}" for i in range(1, 5) for n in ("precision", "recall_1")])


@query("ranking_metrics", f"""WITH {VECTORS}, {_eval_sql('ev', l2('a.v', 'b.v'), 'vec', 'distance ASC')},
  ek AS (SELECT CASE WHEN label < 5 THEN 'question' ELSE 'search' END AS kind, e FROM ev), {METRICS}
  SELECT 'all' AS kind, {AVERAGES} FROM m UNION ALL SELECT kind, {AVERAGES} FROM m GROUP BY kind""")
def _(t: Tables):
    rows = _evals(t, None, "l2").withColumn("kind", F.when(F.col("own") < 5, "question").otherwise("search"))
    return evaluate.ranking_metrics(rows, 4, "kind")


@query("compare_systems", f"""WITH {VECTORS}, {SCALED}, {_eval_sql('ea', l2('a.v', 'b.v'), 'vec', 'distance ASC')},
  {_eval_sql('eb', "list_sum(list_transform(list_zip(a.v, b.v), lambda z: ((z[1] > 0) <> (z[2] > 0))::DOUBLE))", 'vec', 'distance ASC')},
  r AS (SELECT list_sum(a.e) AS ac, CASE WHEN list_sum(a.e) > 0 THEN list_position(a.e, 1) ELSE -1 END AS ar, list_sum(b.e) AS bc, CASE WHEN list_sum(b.e) > 0 THEN list_position(b.e, 1) ELSE -1 END AS br
   FROM ea a JOIN eb b USING (query_id))
  SELECT count(*) FILTER (WHERE ac > 0 AND bc = 0) AS recall_improved, count(*) FILTER (WHERE ac > 0 AND bc = 0) / count(*) AS recall_share,
   count(*) FILTER (WHERE ar > 0 AND br > ar) AS rank_improved, count(*) FILTER (WHERE ar > 0 AND br > ar) / count(*) AS rank_share FROM r""")
def _(t: Tables):
    a, b = _evals(t, None, "l2"), _evals(t, None, "sign_mismatch")

    def named(df, n):
        correct = F.aggregate("eval", F.lit(0), lambda s, x: s + x)
        return df.select("query_id", correct.alias(f"{n}_correct"), evaluate.rank_of_first_hit("eval").alias(f"{n}_rank"))

    return evaluate.compare_systems(named(a, "a").join(named(b, "b"), "query_id"))


# -------------------------------------------------------------- verification

THRESHOLDS = [round(0.05 * i, 2) for i in range(80)]
N_FOLDS = 5


def verification_pairs(t: Tables):
    """Each vector and the next one; same when the label is."""
    rows = t.labelled
    return rows.select(F.col("id").alias("pair_id"), F.col("vector").alias("a"), F.col("label").alias("la")).join(
        rows.select((F.col("id") - 1).alias("pair_id"), F.col("vector").alias("b"), F.col("label").alias("lb")), "pair_id"
    ).select("pair_id", "a", "b", (F.col("la") == F.col("lb")).alias("issame"))


def _fold_sql(dist):
    return (
        f"p0 AS (SELECT a.id AS pair_id, a.v AS a, b.v AS b, a.label = b.label AS same, row_number() OVER (ORDER BY a.id) - 1 AS i, count(*) OVER () AS n FROM vec a JOIN vec b ON b.id = a.id + 1),"
        f" p1 AS (SELECT *, (CASE WHEN i < (n % {N_FOLDS}) * (n // {N_FOLDS} + 1) THEN i // (n // {N_FOLDS} + 1)"
        f" ELSE n % {N_FOLDS} + (i - (n % {N_FOLDS}) * (n // {N_FOLDS} + 1)) // (n // {N_FOLDS}) END)::INTEGER AS fold FROM p0), {dist},"
        f" th AS (SELECT generate_subscripts(x, 1) - 1 AS slot, unnest(x) AS t FROM (SELECT {THRESHOLDS}::DOUBLE[] AS x)),"
        " st AS (SELECT model, model = fold AS test, slot, t, count(*) FILTER (WHERE d < t AND same) AS tp, count(*) FILTER (WHERE d < t AND NOT same) AS fp,"
        " count(*) FILTER (WHERE same) AS s, count(*) FILTER (WHERE NOT same) AS f FROM dd, th GROUP BY ALL)"
    )


PLAIN = f"dd AS (SELECT m AS model, fold, same, {l2('a', 'b')} AS d FROM p1, generate_series(0, {N_FOLDS - 1}) g(m))"
CENTRED = (
    "fv AS (SELECT fold, generate_subscripts(a, 1) AS dim, unnest(a) AS x FROM p1 UNION ALL SELECT fold, generate_subscripts(b, 1), unnest(b) FROM p1),"
    f" mu AS (SELECT m AS model, list(x ORDER BY dim) AS mean FROM (SELECT m, dim, avg(x) AS x FROM fv, generate_series(0, {N_FOLDS - 1}) g(m) WHERE fold <> m GROUP BY m, dim) GROUP BY m),"
    f" dd AS (SELECT model, fold, same, {each('list_transform(list_zip(a, mean), lambda z: z[1] - z[2])', 'list_transform(list_zip(b, mean), lambda z: z[1] - z[2])', '(z[1]-z[2])*(z[1]-z[2])')} AS d FROM p1, mu)"
)
BEST = (
    "best AS (SELECT model, slot FROM (SELECT model, slot, row_number() OVER (PARTITION BY model ORDER BY (tp + f - fp) / (s + f) DESC, slot) AS r FROM st WHERE NOT test) WHERE r = 1)"
    " SELECT model::INTEGER AS fold, t AS threshold, CASE WHEN s > 0 THEN tp / s ELSE 0.0 END AS tpr, CASE WHEN f > 0 THEN fp / f ELSE 0.0 END AS fpr, (tp + f - fp) / (s + f) AS accuracy"
    " FROM st JOIN best USING (model, slot) WHERE test"
)


@query("roc_kfold", f"WITH {VECTORS}, {_fold_sql(PLAIN)}, {BEST}")
def _(t: Tables):
    return evaluate.roc_kfold(verification_pairs(t), THRESHOLDS, N_FOLDS)


@query("roc_kfold_mean_subtracted", f"WITH {VECTORS}, {_fold_sql(CENTRED)}, {BEST}")
def _(t: Tables):
    return evaluate.roc_kfold(verification_pairs(t), THRESHOLDS, N_FOLDS, subtract_mean=True)


@query("roc_curve", f"""WITH {VECTORS}, {_fold_sql(PLAIN)} SELECT t AS threshold, round(avg(CASE WHEN s > 0 THEN tp / s ELSE 0.0 END), 9) AS tpr,
  round(avg(CASE WHEN f > 0 THEN fp / f ELSE 0.0 END), 9) AS fpr FROM st WHERE test GROUP BY t""")
def _(t: Tables):
    out = evaluate.roc_curve(verification_pairs(t), THRESHOLDS, N_FOLDS)
    return out.select("threshold", F.round("tpr", 9).alias("tpr"), F.round("fpr", 9).alias("fpr"))


@query("val_at_far", f"""WITH {VECTORS}, {_fold_sql(PLAIN)}, tr AS (SELECT model, slot, t, fp / f AS far, lead(fp / f) OVER w AS nf, lead(t) OVER w AS nt FROM st WHERE NOT test WINDOW w AS (PARTITION BY model ORDER BY slot)),
  pick AS (SELECT model, t, far, nf, nt, row_number() OVER (PARTITION BY model ORDER BY slot DESC) AS r FROM tr WHERE far <= 0.3),
  top AS (SELECT model, max(far) AS m FROM tr GROUP BY model),
  cut AS (SELECT model, CASE WHEN m >= 0.3 THEN coalesce(t + (0.3 - far) / nullif(nf - far, 0) * (nt - t), t) ELSE 0.0 END AS c FROM pick JOIN top USING (model) WHERE r = 1),
  v AS (SELECT model, count(*) FILTER (WHERE d < c AND same) / count(*) FILTER (WHERE same) AS val, count(*) FILTER (WHERE d < c AND NOT same) / count(*) FILTER (WHERE NOT same) AS far
   FROM dd JOIN cut USING (model) WHERE fold = model GROUP BY model)
  SELECT round(avg(val), 9) AS val, round(stddev_pop(val), 9) AS val_std, round(avg(far), 9) AS far FROM v""")
def _(t: Tables):
    out = evaluate.val_at_far(verification_pairs(t), 0.3, THRESHOLDS, N_FOLDS)
    return out.select(*[F.round(c, 9).alias(c) for c in ("val", "val_std", "far")])


@query("contrastive_loss", f"""WITH {VECTORS}, p AS (SELECT {l2('a.v', 'b.v')} AS d2, a.label = b.label AS same FROM vec a JOIN vec b ON b.id = a.id + 1)
  SELECT round(avg(CASE WHEN same THEN d2 ELSE pow(greatest(1.5 - sqrt(d2), 0), 2) END) / 2 + 1e-9, 9) AS loss FROM p""")
def _(t: Tables):
    return evaluate.contrastive_loss(verification_pairs(t), 1.5).withColumn("loss", F.round("loss", 9))


@query("triplet_loss", f"""WITH {VECTORS} SELECT round(avg(greatest({l2('a.v', 'b.v')} - {l2('a.v', 'c.v')} + 0.2, 0)), 9) AS loss
  FROM vec a JOIN vec b ON b.id = a.id + 1 JOIN vec c ON c.id = a.id + 2""")
def _(t: Tables):
    rows = t.vectors
    triplets = rows.select("id", F.col("vector").alias("anchor")).join(
        rows.select((F.col("id") - 1).alias("id"), F.col("vector").alias("positive")), "id").join(
        rows.select((F.col("id") - 2).alias("id"), F.col("vector").alias("negative")), "id")
    return evaluate.triplet_loss(triplets, 0.2).withColumn("loss", F.round("loss", 9))


@query("group_centroid_spread", """WITH c AS (SELECT label, generate_subscripts(embedding, 1) AS dim, unnest(embedding::DOUBLE[]) AS x FROM embeddings)
  SELECT label, max(n) AS n, round(sum(v), 6) AS spread FROM (SELECT label, dim, count(*) AS n, var_pop(x) AS v FROM c GROUP BY label, dim) GROUP BY label""")
def _(t: Tables):
    return evaluate.group_centroid_spread(t.labelled).withColumn("spread", F.round("spread", 6))


# ------------------------------------------------------- splits and batches

@query("shuffle_order", f"SELECT doc_id AS id, row_number() OVER (ORDER BY {h('doc_id', seed=5)}, doc_id) - 1 AS place FROM documents")
def _(t: Tables):
    from ..functions.hashing import keyed_hash
    from ..operators.ordinal import with_ordinal

    return with_ordinal(t.documents.select("id"), [keyed_hash("id", seed=5), F.col("id")], "place")


@query("random_split", f"""SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN d < 0.999 THEN 'train' WHEN d < 0.9995 THEN 'test' ELSE 'valid' END AS split
  FROM (SELECT *, {u("concat_ws('-', l_orderkey, l_linenumber, l_partkey)", seed=11)} AS d FROM lineitem)""")
def _(t: Tables):
    rows = t("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey").alias("key"))
    return splits.random_split(rows, {"train": 0.999, "test": 0.0005, "valid": 0.0005}, 11, "key").drop("key")


@query("prefix_split", f"""SELECT id, r <= floor(n * 0.95) AS train FROM (SELECT doc_id AS id, row_number() OVER (ORDER BY {h('doc_id', seed=2)}, doc_id) AS r, count(*) OVER () AS n FROM documents)""")
def _(t: Tables):
    return splits.prefix_split(t.documents.select("id"), 0.95, 2)


@query("split_by_class", f"""WITH c AS (SELECT label, row_number() OVER (ORDER BY {h('label', seed=1)}, label) AS r, count(*) OVER () AS n FROM (SELECT DISTINCT label FROM embeddings))
  SELECT vec_id AS id, label, r <= round(n * 0.7) AS train FROM embeddings JOIN c USING (label)""")
def _(t: Tables):
    return splits.split_by_class(t.labelled.drop("vector"), 0.3, seed=1)


@query("split_within_class", f"""WITH o AS (SELECT doc_id AS id, source, row_number() OVER (PARTITION BY source ORDER BY {h('doc_id', seed=1)}, doc_id) AS r, count(*) OVER (PARTITION BY source) AS n FROM documents),
  s AS (SELECT *, least(floor(n * 0.8), n - 1) AS k FROM o) SELECT id, source, r <= k AS train FROM s WHERE k >= 30""")
def _(t: Tables):
    rows = t("documents").select(F.col("doc_id").alias("id"), "source")
    return splits.split_within_class(rows, 1 - 0.8, 30, "source", 1)


@query("sample_lines", f"SELECT id, text FROM (SELECT doc_id AS id, text FROM documents ORDER BY {h('doc_id', seed=9)}, doc_id LIMIT 200) WHERE len(string_split(text, ' ')) > 1")
def _(t: Tables):
    return splits.sample_lines(t.documents, 200, 9)


@query("batches", "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, (row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) - 1) // 500 % 7 AS batch FROM lineitem")
def _(t: Tables):
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    rows = t("lineitem").select(*keys, "l_extendedprice")
    return splits.batch(rows, 500, [*keys, "l_extendedprice"], wrap=7).drop("l_extendedprice")


@query("next_batch_wraps", "WITH o AS (SELECT doc_id AS id, row_number() OVER (ORDER BY doc_id) - 1 AS i, count(*) OVER () AS n FROM documents) SELECT id FROM o WHERE (i - (n - 20) + n) % n < 50")
def _(t: Tables):
    rows = t.documents.select("id")
    return splits.next_batch(rows, rows.count() - 20, 50, ["id"])


@query("set_operations", """WITH a AS (SELECT l_partkey AS id FROM lineitem WHERE l_quantity > 25), b AS (SELECT p_partkey AS id FROM part WHERE p_size > 10)
  SELECT 'union' AS op, id FROM (SELECT DISTINCT id FROM (SELECT * FROM a UNION ALL SELECT * FROM b)) UNION ALL SELECT 'except', id FROM (SELECT * FROM a EXCEPT SELECT * FROM b)
  UNION ALL SELECT 'intersect', id FROM (SELECT * FROM a INTERSECT SELECT * FROM b)""")
def _(t: Tables):
    a = t("lineitem").filter("l_quantity > 25").select(F.col("l_partkey").alias("id"))
    b = t("part").filter("p_size > 10").select(F.col("p_partkey").alias("id"))
    return splits.union(
        splits.union(a, b).distinct().withColumn("op", F.lit("union")),
        splits.without(a.distinct(), b).withColumn("op", F.lit("except")),
        splits.within(a.distinct(), b).withColumn("op", F.lit("intersect")))
