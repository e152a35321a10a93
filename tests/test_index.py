import numpy as np
import pytest
from pyspark.sql import functions as F

from kithra.functions.hashing import keyed_hash
from kithra.operators import index as ix
from kithra.operators.codebooks import Codebook
from kithra.plans.spec import parse_spec, train_index
from kithra.session import scratch_path
from kithra.streaming import index_stream

RNG = np.random.default_rng(11)
X = RNG.normal(size=(200, 8))


@pytest.fixture
def base(vectors):
    return vectors(enumerate(X))


@pytest.fixture
def queries(vectors):
    return vectors(enumerate(X[:40] + 0.01), "query_id")


def cells(spark, rows):
    return ix.VectorIndex(spark, 8, coarse=Codebook([0], [X[:10].copy()])).add_with_ids(rows)


def rows_of(df):
    return df.orderBy("query_id", "rank").collect()


def test_odd_ids_removed_between_adds(spark, vectors):
    ids = [0, 10, 20, 30, 40, 5, 15, 25, 35, 45]
    x = RNG.normal(size=(10, 10))
    index = ix.VectorIndex(spark, 10).add_with_ids(vectors(zip(ids[:5], x[:5])))
    index = index.remove_ids(spark.createDataFrame([(10,), (30,)], "id long")).add_with_ids(vectors(zip(ids[5:], x[5:])))
    assert sorted(r["id"] for r in index.postings.collect()) == [0, 5, 15, 20, 25, 35, 40, 45]
    back = {r["id"]: r["vector"] for r in index.reconstruct(spark.createDataFrame([(15,), (40,)], "id long")).collect()}
    assert back[15] == x[6].tolist() and back[40] == x[4].tolist()
    with pytest.raises(KeyError):
        index.reconstruct(spark.createDataFrame([(10,)], "id long"))


def test_sequential_removal_moves_ids_down(spark, vectors):
    index = ix.VectorIndex(spark, 1).add_with_ids(vectors([(i, [float(i)]) for i in range(6)]))
    left = index.remove_sequential(F.col("id").isin(1, 3)).postings.orderBy("id").collect()
    assert [(r["id"], r["vector"][0]) for r in left] == [(0, 0.0), (1, 2.0), (2, 4.0), (3, 5.0)]


def test_update_moves_vectors_between_cells(spark, base, queries, vectors):
    flipped = X.copy()
    flipped[:100] = flipped[:100][::-1]
    index = cells(spark, base).update_vectors(vectors(enumerate(flipped[:100])))
    assert rows_of(index.search(queries, 4, 10)) == rows_of(cells(spark, vectors(enumerate(flipped))).search(queries, 4, 10))
    with pytest.raises(KeyError):
        index.update_vectors(vectors([(9999, X[0])]))


def test_merge_slice_stack_do_not_change_results(spark, base, queries):
    whole = cells(spark, base)
    half = [cells(spark, base.filter(c)) for c in ("id < 100", "id >= 100")]
    want = rows_of(whole.search(queries, 5, 3))
    assert rows_of(half[0].merge(half[1]).search(queries, 5, 3)) == want
    parts = [whole.slice_lists(a, b) for a, b in ((0, 4), (4, 7), (7, 10))]
    assert rows_of(parts[0].stack(parts[1], parts[2]).search(queries, 5, 3)) == want
    other = ix.VectorIndex(spark, 8, coarse=Codebook([0], [X[10:20].copy()])).add_with_ids(base)
    with pytest.raises(ValueError):
        whole.merge(other)


@pytest.mark.parametrize("spec", ["Flat", "PCAR4,IVF6,SQ8", "OPQ4_8,IVF4,PQ4x3", "L2norm,PCA2,L2norm,Flat", "PQ4x3+2", "IMI2x2,SQ6", "LSHrt", "IVF4,Residual2x3", "SQfp16"])
def test_saved_moved_and_loaded_index_answers_the_same(spark, base, queries, spec, tmp_path):
    index = train_index(spec, base, iterations=2).add_with_ids(base)
    want = rows_of(index.search(queries, 5, 3))
    assert len(want) > 0
    stored = index.save(str(tmp_path / "a"))
    assert rows_of(stored.search(queries, 5, 3)) == want
    (tmp_path / "a").rename(tmp_path / "b")
    assert rows_of(ix.VectorIndex.load(spark, str(tmp_path / "b")).search(queries, 5, 3)) == want
    again = ix.VectorIndex.from_bytes(index.to_bytes(), index.postings)
    assert rows_of(again.search(queries, 5, 3)) == want


def test_whitening_finds_the_true_space_better(spark, vectors):
    scale = np.array([10.0, 4.0, 1.0, 0.5])
    turn = np.linalg.qr(RNG.normal(size=(4, 4)))[0]
    true = RNG.normal(size=(1400, 4))
    seen = (true * scale) @ turn
    train, base, asked = vectors(enumerate(seen[:1000])), vectors(enumerate(seen[1000:1200])), vectors(enumerate(seen[1200:]), "query_id")

    def overlap(found):
        truth = {}
        for i, x in enumerate(true[1200:]):
            truth[i] = set(np.argsort(((true[1000:1200] - x) ** 2).sum(1))[:5])
        return sum(r["id"] in truth[r["query_id"]] for r in found.collect())

    white = train_index("PCAW4,Flat", train).add_with_ids(base).search(asked, 5)
    plain = train_index("Flat", train).add_with_ids(base).search(asked, 5)
    assert overlap(white) > 2 * overlap(plain)


def test_spec_strings():
    spec = parse_spec("IDMap,PCAWR16,IVF50,PQ8x4+8")
    assert spec.cells == ("IVF", 50) and spec.code == ("PQ", 8, 4, 8)
    assert spec.stages[0].dim == 16 and spec.stages[0].rotate and spec.stages[0].power == -0.5
    for bad in ("IVF5,IVF6", "Flat,PCA4", "PX8"):
        with pytest.raises(ValueError):
            parse_spec(bad)


def test_streams_change_and_query_the_index(spark, base, queries, tmp_path):
    path = str(tmp_path / "index")
    cells(spark, base.limit(0)).save(path)
    source = str(tmp_path / "in")
    base.repartition(3).write.parquet(source)
    stream = spark.readStream.schema("id long, vector array<double>").option("maxFilesPerTrigger", 1).parquet(source)
    index_stream.streaming_add(stream, spark, path, str(tmp_path / "cp1")).awaitTermination()
    assert rows_of(ix.VectorIndex.load(spark, path).search(queries, 4, 2)) == rows_of(cells(spark, base).search(queries, 4, 2))
    gone = str(tmp_path / "gone")
    base.filter("id < 50").select("id").write.parquet(gone)
    index_stream.streaming_delete(spark.readStream.schema("id long").parquet(gone), path, str(tmp_path / "cp2")).awaitTermination()
    loaded = ix.VectorIndex.load(spark, path)
    assert loaded.postings.agg(F.min("id"), F.count("*")).first()[:] == (50, 150)
    # an id may come back after it was removed
    ix.log_added(loaded, path, base.filter("id = 7"), 99)
    assert ix.VectorIndex.load(spark, path).ntotal == 151
    # a batch that runs again changes nothing, also after a later removal
    ix.log_added(loaded, path, base.filter("id = 7"), 99)
    assert ix.VectorIndex.load(spark, path).ntotal == 151
    ix.log_removed(path, base.filter("id = 7").select("id"), 100)
    ix.log_added(loaded, path, base.filter("id = 7"), 99)
    assert ix.VectorIndex.load(spark, path).ntotal == 150
    # another writer counts its batches on its own
    ix.log_added(loaded, path, base.filter("id = 7"), 99, stream="other")
    assert ix.VectorIndex.load(spark, path).ntotal == 151
    ix.log_removed(path, base.filter("id = 7").select("id"), 101)
    asked = str(tmp_path / "asked")
    queries.repartition(2).write.parquet(asked)
    answers = str(tmp_path / "answers")
    qs = spark.readStream.schema("query_id long, vector array<double>").option("maxFilesPerTrigger", 1).parquet(asked)
    index_stream.streaming_knn(qs, spark, path, 3, answers, str(tmp_path / "cp3"), 2).awaitTermination()
    got = spark.read.parquet(answers).select("query_id", "rank", "id", "distance")
    assert rows_of(got) == rows_of(ix.VectorIndex.load(spark, path).search(queries, 3, 2))


def test_index_is_saved_without_session_settings(spark, base, queries, tmp_path):
    key = "spark.sql.execution.arrow.pyspark.enabled"
    spark.conf.set(key, "false")
    try:
        index = cells(spark, base)
        assert rows_of(index.save(str(tmp_path / "plain")).search(queries, 4, 2)) == rows_of(index.search(queries, 4, 2))
    finally:
        spark.conf.set(key, "true")


def test_ids_go_on_after_the_highest(spark, base):
    left = cells(spark, base).remove_ids(F.col("id").between(3, 9))
    ids = [r["id"] for r in left.add(base.filter("id < 5"), ["id"]).postings.select("id").collect()]
    assert len(ids) == len(set(ids)) and max(ids) == 204


def test_catalog(spark, vectors):
    catalog = ix.IndexCatalog(spark, scratch_path(spark, "catalog"))
    items = spark.createDataFrame([(0, "a"), (1, "b")], "id long, text string")
    catalog.create("faq", ix.VectorIndex(spark, 1).add_with_ids(vectors([(0, [0.0]), (1, [5.0])])), items)
    with pytest.raises(ValueError):
        catalog.create("faq", ix.VectorIndex(spark, 1), items)
    texts = spark.createDataFrame([(1, "c")], "key long, text string")
    new = spark.createDataFrame([(1, [2.0])], "key long, vector array<double>")
    with pytest.raises(ValueError):
        catalog.add("faq", texts, new, texts.limit(0).selectExpr("key", "key as id"))
    catalog.add("faq", texts, new)
    found = catalog.search("faq", vectors([(0, [2.1])], "query_id"), 1).first()
    assert (found["id"], found["text"]) == (2, "c")
    assert [r["name"] for r in catalog.list().collect()] == ["faq"]
    catalog.delete("faq")
    assert catalog.list().count() == 0
    with pytest.raises(KeyError):
        catalog.load("faq")


def test_hash_depends_on_the_key_only(spark):
    a = spark.range(100).repartition(7).select("id", keyed_hash("id", seed=3).alias("h")).collect()
    b = spark.range(100).coalesce(1).select("id", keyed_hash("id", seed=3).alias("h")).collect()
    assert sorted(a) == sorted(b)
