"""Sources and sinks: what was written reads back as it was."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import arrays
from ..operators import knn, setjoin, splits, text
from ..session import scratch_path
from ..sources import readers, synthetic, vecs, writers
from .q_search import _self_pairs, scaled
from .q_text import CLEAN, EDGES, INTER, SETS, TURNS, VOCAB, turns
from .registry import Tables, query
from .snippets import VECTORS, norm, u

FLOATS = "SELECT vec_id AS id, embedding AS vector FROM embeddings"


@query("fvecs_round_trip", FLOATS)
def _(t: Tables):
    path = scratch_path(t.spark, "fvecs")
    vecs.write_fvecs(t.vectors, path)
    return vecs.read_fvecs(t.spark, path)


@query("fvecs_in_small_ranges", FLOATS)
def _(t: Tables):
    """The data source itself, each file cut into many byte ranges."""
    path = scratch_path(t.spark, "fvecs")
    vecs.write_fvecs(t.vectors, path)
    return t.spark.read.format("fvecs").option("splitbytes", 8 * 260).load(path)


@query("ivecs_round_trip", f"WITH {VECTORS}, r AS ({_self_pairs(5)}) SELECT query_id AS id, list(id::INTEGER ORDER BY \"rank\") AS vector FROM r GROUP BY query_id")
def _(t: Tables):
    found = knn.knn_join(t.queries, t.vectors, 5)
    lists = found.groupBy(F.col("query_id").alias("id")).agg(F.array_sort(F.collect_list(F.struct("rank", "id"))).alias("l"))
    path = scratch_path(t.spark, "ivecs")
    vecs.write_ivecs(lists.select("id", F.col("l.id").alias("vector")), path)
    return vecs.read_ivecs(t.spark, path)


@query("bvecs_round_trip", f"WITH {VECTORS} SELECT id, list_transform(v, lambda x: (floor((x + 1) * 100))::FLOAT) AS vector FROM vec")
def _(t: Tables):
    rows = t.vectors.select("id", F.transform(arrays.doubles("vector"), lambda x: F.floor((x + 1) * 100)).alias("vector"))
    path = scratch_path(t.spark, "bvecs")
    vecs.write_vecs(rows, path, "bvecs")
    return vecs.read_bvecs(t.spark, path)


PLACED = "p AS (SELECT row_number() OVER (ORDER BY vec_id) - 1 AS id, vec_id, embedding::DOUBLE[] AS vector FROM embeddings)"


@query("benchmark_folder", f"""WITH {PLACED} SELECT 'base' AS part, id, vector FROM p UNION ALL SELECT 'query', id, list_transform(vector, lambda x: -x) FROM p
  UNION ALL SELECT 'truth', id, [vec_id::DOUBLE] FROM p""")
def _(t: Tables):
    root = scratch_path(t.spark, "bench")
    vecs.write_fvecs(t.vectors, f"{root}/emb/emb_base.fvecs")
    vecs.write_fvecs(t.vectors.select("id", F.transform("vector", lambda x: -x).alias("vector")), f"{root}/emb/emb_query.fvecs")
    vecs.write_ivecs(t.vectors.select("id", F.array(F.col("id").cast("int")).alias("vector")), f"{root}/emb/20_emb_euclid_groundtruth.ivecs")
    base, train, queries, truth = vecs.load_benchmark(t.spark, root, "emb")
    if train is not None:
        raise ValueError("no training file was written")
    parts = (("base", base), ("query", queries), ("truth", truth))
    return splits.union(*[d.select(F.lit(n).alias("part"), "id", F.col("vector").cast("array<double>").alias("vector")) for n, d in parts])


@query("kv_embeddings", "SELECT 'v' || vec_id AS key, embedding AS vector FROM embeddings")
def _(t: Tables):
    path = scratch_path(t.spark, "kv")
    writers.write_kv_embeddings(t.vectors.select(F.concat(F.lit("v"), "id").alias("key"), "vector"), path)
    return readers.read_kv_embeddings(t.spark, path)


@query("space_vectors", "SELECT embedding AS vector FROM embeddings")
def _(t: Tables):
    path = scratch_path(t.spark, "space")
    writers.write_space_vectors(t.vectors, path)
    return readers.read_space_vectors(t.spark, path)


@query("normalized_and_index", f"""WITH {VECTORS}, n AS (SELECT 'v' || id AS key, v, {norm('v')} AS n FROM (SELECT id, list_transform(v, lambda x: x * (1 + id % 7)) AS v FROM vec))
  SELECT key, row_number() OVER (ORDER BY key) - 1 AS id, list_transform(v, lambda x: x / n) AS vector FROM n""")
def _(t: Tables):
    path = scratch_path(t.spark, "norm")
    rows = scaled(t.vectors, "id").select(F.concat(F.lit("v"), "id").alias("key"), "vector")
    writers.write_normalized_and_index(rows, path)
    keys = readers.read_key_index(t.spark, f"{path}/index")
    return t.spark.read.parquet(f"{path}/norm").join(keys, "id").select("key", "id", "vector")


@query("topk_text", f"WITH {VECTORS}, r AS ({_self_pairs(4)}) SELECT 'v' || query_id AS key, list('v' || id ORDER BY \"rank\") AS ids, list(distance ORDER BY \"rank\") AS scores FROM r GROUP BY query_id")
def _(t: Tables):
    path = scratch_path(t.spark, "topk")
    keys = t.vectors.select("id", F.concat(F.lit("v"), "id").alias("key"))
    writers.write_topk_text(knn.knn_join(t.queries, t.vectors, 4), path, keys)
    return readers.read_topk_text(t.spark, path).select(
        "key", F.col("neighbours.id").alias("ids"), F.col("neighbours.score").alias("scores"))


@query("ratings_csv", "SELECT o_custkey AS \"user\", l_partkey AS item, 1.0 + l_quantity % 5 AS rating FROM lineitem JOIN orders ON o_orderkey = l_orderkey")
def _(t: Tables):
    path = scratch_path(t.spark, "ratings")
    t.ratings.withColumn("timestamp", F.lit(0)).write.csv(path, header=True)
    return readers.read_ratings(t.spark, path)


@query("items_csv", "SELECT p_partkey AS item, p_name AS title, [p_type, p_brand] AS genres FROM part")
def _(t: Tables):
    path = scratch_path(t.spark, "items")
    t("part").select("p_partkey", "p_name", F.concat_ws("|", "p_type", "p_brand")).write.csv(path, header=True, escape='"')
    return readers.read_items(t.spark, path)


@query("token_embeddings_mean_pool", f"""WITH {VECTORS} SELECT id::INTEGER AS linex_index, list_transform(generate_series(1, 16), lambda j: round((v[j] + v[16+j] + v[32+j] + v[48+j]) / 4, 6)) AS vector FROM vec""")
def _(t: Tables):
    """Each stored vector written as four tokens of sixteen values, read back and averaged."""
    tokens = F.transform(arrays.reshape(arrays.doubles("vector"), 16), lambda v, i: F.struct(
        i.cast("string").alias("token"), F.array(F.struct(F.lit(-1).alias("index"), v.alias("values"))).alias("layers")))
    path = scratch_path(t.spark, "tokens")
    t.vectors.select(F.col("id").cast("int").alias("linex_index"), tokens.alias("features")).write.json(path)
    return text.mean_pool(readers.read_token_embeddings(t.spark, path)).select("linex_index", arrays.rounded("vector").alias("vector"))


@query("id_text_lines", "SELECT doc_id AS id, rtrim(regexp_replace(text, '\\s', ' ', 'g')) AS text FROM documents")
def _(t: Tables):
    path = scratch_path(t.spark, "idtext")
    flat = F.regexp_replace("text", r"\s", " ")
    t.documents.select(F.concat_ws(":", F.col("id").cast("string"), flat)).write.text(path)
    return readers.read_id_text(t.spark, path)


@query("lines_by_position", r"SELECT row_number() OVER (ORDER BY doc_id) - 1 AS id, rtrim(regexp_replace(text, '\s', ' ', 'g')) AS text FROM documents")
def _(t: Tables):
    path = scratch_path(t.spark, "lines")
    ordered = t.documents.repartitionByRange("id").sortWithinPartitions("id")
    ordered.select(F.regexp_replace("text", r"\s", " ")).write.text(path)
    return readers.read_lines(t.spark, path)


@query("question_pairs_csv", f"WITH {TURNS} SELECT question1, question2, (turn % 2)::INTEGER AS is_duplicate FROM turns")
def _(t: Tables):
    path = scratch_path(t.spark, "pairs")
    rows = turns(t).select("question1", "question2", (F.col("turn") % 2).cast("int").alias("is_duplicate"))
    rows.write.csv(path, header=True, quote='"', escape='"', quoteAll=True)
    return readers.read_question_pairs(t.spark, path)


@query("embedding_strings", f"WITH {VECTORS} SELECT id, v AS vector FROM vec")
def _(t: Tables):
    """Vectors printed as ``(v1, v2, …)`` and parsed again."""
    printed = t.vectors.select("id", writers.embedding_text().alias("embeddings"))
    return printed.select("id", readers.parse_embedding_text("embeddings").alias("vector"))


@query("sentence_pairs", f"WITH {TURNS} SELECT conv_id, turn, trim(regexp_replace(question1, '\\s+', ' ', 'g')) AS text_a, trim(regexp_replace(question2, '\\s+', ' ', 'g')) AS text_b FROM turns")
def _(t: Tables):
    def flat(c):
        return F.trim(F.regexp_replace(c, r"\s+", " "))

    lines = turns(t).select("conv_id", "turn", F.concat(flat("question1"), F.lit(" ||| "), flat("question2")).alias("line"))
    return readers.split_sentence_pair(lines, "line").select("conv_id", "turn", "text_a", "text_b")


@query("class_directories", "SELECT 'lang=' || lang AS class, row_number() OVER (ORDER BY lang) - 1 AS class_id FROM documents GROUP BY lang")
def _(t: Tables):
    path = scratch_path(t.spark, "classes")
    rows = t("documents").select("lang", F.regexp_replace("text", r"\s", " ").alias("value"))
    rows.repartition("lang").write.partitionBy("lang").text(path)
    return readers.class_directory_dataset(t.spark, path).select("class", "class_id").distinct()


@query("binary_files", "SELECT lang, sum(octet_length(encode(regexp_replace(text, '\\s', ' ', 'g'))) + 1)::BIGINT AS bytes FROM documents GROUP BY lang")
def _(t: Tables):
    path = scratch_path(t.spark, "binary")
    rows = t("documents").select("lang", F.regexp_replace("text", r"\s", " ").alias("value"))
    rows.write.partitionBy("lang").text(path)
    files = readers.read_binary_files(t.spark, path, ["txt", "TXT"])
    return files.groupBy(F.regexp_extract("path", "lang=([^/]+)/", 1).alias("lang")).agg(F.sum("length").alias("bytes"))


# -------------------------------------------------------------- generators

SYN = f"SELECT vec_id AS id, list_transform(generate_series(0, 7), lambda j: {u('vec_id', 'j', seed=1234)} + CASE WHEN j = 0 THEN vec_id / 1000.0::DOUBLE ELSE 0 END) AS vector FROM embeddings"


@query("synthetic_vectors", SYN)
def _(t: Tables):
    return synthetic.vectors_for(t.vectors.select("id"), 8, 1234)


@query("synthetic_gaussian", f"""SELECT id, list_transform(list_zip(g, [10.0::DOUBLE, 4.0, 1.0, 0.5]), lambda z: round(z[1] * z[2], 6)) AS vector FROM (SELECT vec_id AS id,
  list_transform(generate_series(0, 3), lambda j: sqrt(-2 * ln(1 - {u('vec_id', 'j', "'r'", seed=5)})) * cos(2 * pi() * {u('vec_id', 'j', "'t'", seed=5)})) AS g FROM embeddings)""")
def _(t: Tables):
    rows = synthetic.gaussian_for(t.vectors.select("id"), 4, 5, [10, 4, 1, 0.5])
    return rows.select("id", arrays.rounded("vector").alias("vector"))


# ------------------------------------------------------------------- graphs

def _edges(t: Tables):
    return setjoin.neighbour_graph(setjoin.jaccard_join(t.documents, None, 0.4))


@query("adjacency_lines", f"WITH {SETS}, {INTER}, {EDGES} SELECT src, src || ',' || string_agg(dst::VARCHAR, ',' ORDER BY dst) AS value FROM edge GROUP BY src")
def _(t: Tables):
    return writers.adjacency_lines(_edges(t))


@query("adjacency_round_trip", f"WITH {SETS}, {INTER}, {EDGES} SELECT src, dst FROM edge")
def _(t: Tables):
    path = scratch_path(t.spark, "adj")
    writers.write_adjlist(_edges(t), path)
    return readers.read_adjlist(t.spark, f"{path}/int").select("src", "dst")


@query("adjacency_texts", f"WITH {SETS}, {INTER}, {EDGES} SELECT src, string_agg(text, chr(10) ORDER BY dst) || chr(10) AS value FROM edge JOIN documents ON doc_id = dst GROUP BY src")
def _(t: Tables):
    return writers.adjacency_texts(_edges(t), t.documents)


@query("pairs_file", f"WITH {VECTORS}, r AS ({_self_pairs(4)}) SELECT query_id AS i, id AS j FROM r WHERE query_id <> id")
def _(t: Tables):
    path = scratch_path(t.spark, "pairs")
    writers.write_pairs(knn.knn_pairs(t.vectors, 3), path)
    return t.spark.read.parquet(path)


@query("pair_splits", f"""SELECT regexp_replace(text, '\\s+', ' ', 'g') AS base, regexp_replace(text, '\\s+', ' ', 'g') AS target,
  CASE WHEN d < 0.8 THEN 'train' WHEN d < 0.9 THEN 'test' ELSE 'valid' END AS split FROM (SELECT trim(text) AS text, {u('doc_id', seed=4)} AS d FROM documents)""")
def _(t: Tables):
    path = scratch_path(t.spark, "splits")
    flat = F.regexp_replace(F.trim("text"), r"\s+", " ")
    rows = setjoin.identity_pairs(t.documents.withColumn("text", flat))
    writers.write_pair_splits(splits.random_split(rows, {"train": 0.8, "test": 0.1, "valid": 0.1}, 4), path)
    return t.spark.read.csv(path, sep="\t", schema="base string, target string, split string").select("base", "target", "split")


@query("recommendation_columns", f"WITH {VECTORS}, r AS ({_self_pairs(3)}) SELECT query_id, max(id) FILTER (WHERE \"rank\" = 1) AS n1, max(id) FILTER (WHERE \"rank\" = 2) AS n2, max(id) FILTER (WHERE \"rank\" = 3) AS n3 FROM r GROUP BY query_id")
def _(t: Tables):
    path = scratch_path(t.spark, "reco")
    writers.write_recommendations(knn.knn_join(t.queries, t.vectors, 3), path, 3)
    return t.spark.read.csv(path, header=True, schema="query_id long, n1 long, n2 long, n3 long")


@query("vocabulary_file", f"WITH tok AS (SELECT conv_id * 1000 + turn AS id, generate_subscripts(w, 1) - 1 AS pos, unnest(w) AS word FROM (SELECT conv_id, turn, string_split({CLEAN.format('text')}, ' ') AS w FROM conversations)), {VOCAB} SELECT word_id AS \"Index\", word AS \"Label\" FROM voc")
def _(t: Tables):
    from ..functions import strings

    rows = t("conversations").select((F.col("conv_id") * 1000 + F.col("turn")).alias("id"), strings.normalize_question("text").alias("text"))
    path = scratch_path(t.spark, "vocab")
    writers.write_vocab_metadata(text.vocab_fit(rows), path)
    return t.spark.read.csv(path, sep="\t", header=True, schema="Index long, Label string", quote="")
