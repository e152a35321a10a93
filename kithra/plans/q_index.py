"""Index maintenance and persistence, as searches that must not change (or change as told)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import index as ix
from ..operators.codebooks import Codebook
from ..session import scratch_path
from ..streaming import index_stream
from .q_cells import CENTRES, _assign_sql, _probe_sql, centres
from .q_search import SCALED, UNITS, scaled
from .registry import Tables, query
from .snippets import VECTORS, l2, knn as knn_sql, top
from .spec import train_index

NP = 3


def cell_index(t: Tables, rows=None) -> ix.VectorIndex:
    """Cells around the ten lowest ids, holding the given rows (all by default)."""
    book = Codebook([0], [centres(t)])
    empty = ix.VectorIndex(t.spark, 64, coarse=book)
    return empty.add_with_ids(t.vectors if rows is None else rows)


def _found(rows="vec", k=6, nprobe=NP):
    """Search of all stored vectors in the cells of ``rows``."""
    return (
        f"{CENTRES}, {_assign_sql(rows)}, {_probe_sql(nprobe)} "
        + top(f"SELECT query_id, b.id AS id, {l2('a.v', 'b.v')} AS distance FROM prb a JOIN asg b USING (list_id)", k)
    )


@query("index_add_in_batches", f"WITH {VECTORS}, {_found()}")
def _(t: Tables):
    i = cell_index(t, t.vectors.filter("id % 2 = 0")).add_with_ids(t.vectors.filter("id % 2 = 1"))
    return i.search(t.queries, 6, NP)


@query("index_add_sequential_ids", f"WITH {VECTORS}, n AS (SELECT id FROM vec UNION ALL SELECT (SELECT max(id) + 1 FROM vec) + row_number() OVER (ORDER BY id DESC) - 1 FROM vec) SELECT id FROM n")
def _(t: Tables):
    i = cell_index(t)
    return i.add(t.vectors, [-F.col("id")]).postings.select("id")


KEPT = "kept AS (SELECT * FROM vec WHERE id NOT IN (SELECT user_id FROM events))"


@query("index_remove_ids", f"WITH {VECTORS}, {KEPT}, {_found('kept')}")
def _(t: Tables):
    return cell_index(t).remove_ids(t("events").select(F.col("user_id").alias("id"))).search(t.queries, 6, NP)


@query("index_remove_selected", f"WITH {VECTORS}, kept AS (SELECT * FROM vec WHERE NOT (id BETWEEN 100 AND 199)), {_found('kept')}")
def _(t: Tables):
    return cell_index(t).remove_ids(F.col("id").between(100, 199)).search(t.queries, 6, NP)


@query("index_remove_sequential", f"WITH {VECTORS}, {KEPT} SELECT row_number() OVER (ORDER BY id) - 1 AS id, v AS vector FROM kept")
def _(t: Tables):
    gone = t("events").select(F.col("user_id").alias("id"))
    return cell_index(t).remove_sequential(gone).postings.select("id", "vector")


NEW = "upd AS (SELECT a.id, CASE WHEN a.id % 3 = 0 THEN b.v ELSE a.v END AS v FROM vec a JOIN vec b ON b.id = (SELECT max(id) FROM vec) - a.id)"


def _changed(t: Tables):
    """Every third id takes the vector of its mirror image in the id order."""
    last = t.vectors.agg(F.max("id")).first()[0]
    mirrored = t.vectors.select((F.lit(last) - F.col("id")).alias("id"), "vector")
    return mirrored.filter("id % 3 = 0")


@query("index_replace", f"WITH {VECTORS}, {NEW}, {_found('upd')}")
def _(t: Tables):
    return cell_index(t).replace_vectors(_changed(t)).search(t.queries, 6, NP)


@query("index_update_vectors", f"WITH {VECTORS}, {NEW}, {_found('upd')}")
def _(t: Tables):
    return cell_index(t).update_vectors(_changed(t)).search(t.queries, 6, NP)


@query("index_reconstruct", f"WITH {VECTORS} SELECT id, v AS vector FROM vec WHERE id IN (SELECT user_id FROM events)")
def _(t: Tables):
    return cell_index(t).reconstruct(t("events").select(F.col("user_id").alias("id")).distinct())


@query("index_merge", f"WITH {VECTORS}, dbl AS (SELECT id, v FROM vec UNION ALL SELECT id + 5000, v FROM vec), {_found('dbl')}")
def _(t: Tables):
    return cell_index(t).merge(cell_index(t), 5000).search(t.queries, 6, NP)


@query("index_copy_subset", f"WITH {VECTORS}, {CENTRES}, {_assign_sql()} SELECT id, list_id::BIGINT AS list_id FROM asg WHERE id >= 50 AND list_id < 6")
def _(t: Tables):
    part = cell_index(t).copy_subset((F.col("id") >= 50) & (F.col("list_id") < 6))
    return part.postings.select("id", "list_id")


@query("index_slice_and_stack", f"WITH {VECTORS}, {_found()}")
def _(t: Tables):
    whole = cell_index(t)
    parts = [whole.slice_lists(a, b) for a, b in ((0, 3), (3, 7), (7, 10))]
    return parts[0].stack(*parts[1:]).search(t.queries, 6, NP)


@query("index_list_content", f"WITH {VECTORS}, {CENTRES}, {_assign_sql()} SELECT id, v AS vector FROM asg WHERE list_id = 4")
def _(t: Tables):
    return cell_index(t).list_content(4).select("id", "vector")


@query("index_stats", "SELECT count(*) AS ntotal, 10::BIGINT AS nlist, 64 AS d, 'l2' AS metric, true AS is_trained, 512 AS code_bytes, 'Flat' AS encoding FROM embeddings")
def _(t: Tables):
    return cell_index(t).stats()


@query("index_save_load", f"WITH {VECTORS}, {_found()}")
def _(t: Tables):
    path = scratch_path(t.spark, "index")
    cell_index(t).save(path)
    return ix.VectorIndex.load(t.spark, path).search(t.queries, 6, NP)


@query("index_model_bytes", f"WITH {VECTORS}, {_found()}")
def _(t: Tables):
    i = cell_index(t)
    return ix.VectorIndex.from_bytes(i.to_bytes(), i.postings).search(t.queries, 6, NP)


@query("index_range_search", f"WITH {VECTORS} SELECT * FROM (SELECT a.id AS query_id, b.id AS id, {l2('a.v', 'b.v')} AS distance FROM vec a, vec b) WHERE distance < 1.1")
def _(t: Tables):
    return cell_index(t).range_search(t.queries, 1.1)


@query("index_clone", f"WITH {VECTORS}, {KEPT}, {_found('kept')}")
def _(t: Tables):
    """The copy loses rows, the original keeps them all."""
    whole = cell_index(t)
    return whole.clone().remove_ids(t("events").select(F.col("user_id").alias("id"))).search(t.queries, 6, NP)


# ------------------------------------------------------------- change log

@query("index_change_log", f"WITH {VECTORS}, {KEPT}, {_found('kept')}")
def _(t: Tables):
    path = scratch_path(t.spark, "index")
    i = cell_index(t, t.vectors.filter("id % 2 = 0")).save(path)
    ix.log_added(i, path, t.vectors.filter("id % 2 = 1"), 0)
    ix.log_removed(path, t("events").select(F.col("user_id").alias("id")), 0)
    return ix.compact(path, scratch_path(t.spark, "index"), t.spark).search(t.queries, 6, NP)


@query("index_two_writers", f"WITH {VECTORS}, {_found()}")
def _(t: Tables):
    """Two streams both count their batches from 0."""
    path = scratch_path(t.spark, "index")
    i = cell_index(t, t.vectors.limit(0)).save(path)
    for part, stream in ((0, "a"), (1, "b")):
        ix.log_added(i, path, t.vectors.filter(F.col("id") % 2 == part), 0, stream)
    return ix.VectorIndex.load(t.spark, path).search(t.queries, 6, NP)


@query("index_replayed_batch", f"WITH {VECTORS}, {KEPT}, {_found('kept')}")
def _(t: Tables):
    """An addition that runs again after a removal keeps its place before it."""
    path = scratch_path(t.spark, "index")
    i = cell_index(t, t.vectors.limit(0)).save(path)
    ix.log_added(i, path, t.vectors, 0)
    ix.log_removed(path, t("events").select(F.col("user_id").alias("id")), 0)
    ix.log_added(i, path, t.vectors, 0)
    return ix.VectorIndex.load(t.spark, path).search(t.queries, 6, NP)


@query("index_add_after_remove", f"""WITH {VECTORS} SELECT id FROM vec WHERE id >= 10 UNION ALL
  SELECT (SELECT max(id) FROM vec) + row_number() OVER (ORDER BY id) FROM vec WHERE id < 20""")
def _(t: Tables):
    left = cell_index(t).remove_ids(F.col("id") < 10)
    return left.add(t.vectors.filter("id < 20"), ["id"]).postings.select("id")


@query("index_moved", f"WITH {VECTORS}, {_found()}")
def _(t: Tables):
    path, moved = scratch_path(t.spark, "index"), scratch_path(t.spark, "moved")
    i = cell_index(t, t.vectors.filter("id % 2 = 0")).save(path)
    ix.log_added(i, path, t.vectors.filter("id % 2 = 1"), 0)
    return ix.copy_index(t.spark, path, moved).search(t.queries, 6, NP)


@query("index_catalog_search", f"""WITH {VECTORS}, r AS ({top(f"SELECT a.id AS query_id, b.id AS id, {l2('a.v', 'b.v')} AS distance FROM vec a, vec b", 3)})
  SELECT query_id, "rank", r.id, distance, p_name AS text FROM r LEFT JOIN part ON p_partkey = r.id""")
def _(t: Tables):
    catalog = ix.IndexCatalog(t.spark, scratch_path(t.spark, "catalog"))
    items = t("part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("text"))
    catalog.create("parts", ix.VectorIndex(t.spark, 64).add_with_ids(t.vectors), items)
    return catalog.search("parts", t.queries, 3)


# ------------------------------------------------------------- streams

def _stream(t: Tables, key: str):
    """The stored vectors as a file stream (one file per micro-batch)."""
    source = scratch_path(t.spark, "stream")
    t.queries.withColumnRenamed("query_id", key).repartition(4).write.parquet(source)
    schema = f"{key} long, vector array<float>"
    return t.spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)


@query("streaming_add", f"WITH {VECTORS}, {_found()}")
def _(t: Tables):
    path = scratch_path(t.spark, "index")
    cell_index(t, t.vectors.limit(0)).save(path)
    index_stream.streaming_add(_stream(t, "id"), t.spark, path, scratch_path(t.spark, "cp")).awaitTermination()
    return ix.VectorIndex.load(t.spark, path).search(t.queries, 6, NP)


@query("streaming_delete", f"WITH {VECTORS} SELECT id FROM vec WHERE id NOT IN (SELECT user_id FROM events)")
def _(t: Tables):
    path = scratch_path(t.spark, "index")
    cell_index(t).save(path)
    source = scratch_path(t.spark, "stream")
    t("events").select(F.col("user_id").alias("id")).distinct().repartition(3).write.parquet(source)
    stream = t.spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).parquet(source)
    index_stream.streaming_delete(stream, path, scratch_path(t.spark, "cp")).awaitTermination()
    return ix.VectorIndex.load(t.spark, path).postings.select("id")


@query("streaming_knn", f"WITH {VECTORS}, {_found()}")
def _(t: Tables):
    path, out = scratch_path(t.spark, "index"), scratch_path(t.spark, "answers")
    cell_index(t).save(path)
    index_stream.streaming_knn(_stream(t, "query_id"), t.spark, path, 6, out, scratch_path(t.spark, "cp"), NP).awaitTermination()
    return t.spark.read.parquet(out).select("query_id", "rank", "id", "distance")


# ------------------------------------------- configuration strings, by rows

UNIT_KNN = knn_sql(l2("a.v", "b.v"), 5, ctes=f"{SCALED}, {UNITS}", q="uvec", b="uvec")


def _register_spec(name, text, metric="l2", sql=None):
    @query(f"spec_{name}", sql)
    def _(t: Tables):
        rows = scaled(t.vectors, "id")
        index = train_index(text, rows, metric, iterations=3).add_with_ids(rows)
        return index.search(scaled(t.queries, "query_id"), 5, nprobe=4)


for _name, _text, _metric, *_sql in (
    ("pcar_ivf_sq8", "PCAR16,IVF16,SQ8", "l2"),
    ("opq_ivf_pq", "OPQ8_32,IVF8,PQ8x4", "l2"),
    ("l2norm_flat", "IDMap,L2norm,Flat", "l2", UNIT_KNN),
    ("pcaw_flat", "PCAW8,Flat", "l2"),
    ("rr_sqfp16", "RR48,SQfp16", "ip"),
    ("pad_pq_refined", "Pad72,PQ8x4+8", "l2"),
    ("imi_flat", "IMI2x3,Flat", "l2"),
    ("ivf_residual", "IVF8,Residual2x4", "l2"),
    ("itq_lsh", "ITQ32,LSH", "l2"),
    ("lsh_rotated_trained", "LSHrt", "l2"),
    ("ivf_sq4_cosine", "IVF8,SQ4", "cosine"),
):
    _register_spec(_name, _text, _metric, *_sql)


@query("spec_ivf_flat_all_cells", knn_sql(l2("a.v", "b.v"), 5))
def _(t: Tables):
    index = train_index("IVF12,Flat", t.vectors, iterations=2).add_with_ids(t.vectors)
    return index.search(t.queries, 5, nprobe=12)
