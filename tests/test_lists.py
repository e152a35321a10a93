"""Cells in two levels, stored postings, composed cells and bit lists."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kithra.functions.arrowmap import add_arrays
from kithra.operators import binary, ivf, knn, routing
from kithra.operators import index as ix
from kithra.operators.codebooks import Codebook
from kithra.plans.spec import parse_spec, train_index
from kithra.session import materialize, scratch_path


def random_rows(spark, n, d, seed=0, partitions=6):
    x = np.random.default_rng(seed).normal(size=(n, d))
    return x, spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, vector array<double>").repartition(partitions)


# ------------------------------------------------------------------- two levels

def test_many_cells_without_a_shared_model(spark):
    """2^16 cells; all of them probed give the exact result."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(66_000, 3)).round(6)
    rows = materialize(spark.range(66_000, numPartitions=8).select("id").mapInPandas(
        lambda frames: (f.assign(vector=[x[i].tolist() for i in f.id]) for f in frames), "id long, vector array<double>"), "rows")
    cells = routing.fit_routed(rows, 1 << 16, iterations=1, parent_iterations=2)
    assert cells.nlist == 1 << 16 and len(cells.parents.centroids) <= 256
    index = ix.VectorIndex(spark, 3, coarse=cells).add_with_ids(rows)
    index = index._with(materialize(index.postings, "postings"))
    asked = rows.filter("id < 4").withColumnRenamed("id", "query_id")
    # all parents are followed and all of their cells are read
    found = index.search(asked, 3, nprobe=1 << 16).orderBy("query_id", "rank").collect()
    for r in found:
        order = np.lexsort((np.arange(len(x)), ((x - x[r["query_id"]]) ** 2).sum(1)))
        assert r["id"] == order[r["rank"] - 1]
    assert len(found) == 12


def test_hot_parents_are_cut_into_blocks(spark):
    x, rows = random_rows(spark, 600, 4, 1)
    hot = rows.unionByName(rows.filter("id < 5").crossJoin(spark.range(200).select(F.col("id").alias("n"))).select((F.col("id") + 1000 + F.col("n") * 10).alias("id"), "vector"))
    whole = routing.fit_routed(rows, 30, 5, iterations=2, seed=4)
    cut = routing.RoutedCells(whole.parents, whole.children, whole.nlist, block_rows=7)
    assert sorted(whole.assign(hot).select("id", "list_id").collect()) == sorted(cut.assign(hot).select("id", "list_id").collect())
    routed = materialize(whole._routed(hot, 1), "routed")
    for a, b in zip(routing.lloyd_step(routed, whole).children.orderBy("list_id").collect(), routing.lloyd_step(routed, cut).children.orderBy("list_id").collect()):
        assert a["list_id"] == b["list_id"] and np.allclose(a["centre"], b["centre"])


def test_cells_are_shared_out_by_rows():
    assert routing.shares({0: 50, 1: 30, 2: 20}, 10) == {0: 5, 1: 3, 2: 2}
    assert routing.shares({0: 1, 1: 999}, 100) == {0: 1, 1: 99}
    assert sum(routing.shares({p: p + 1 for p in range(40)}, 333).values()) == 333
    assert routing.shares({0: 2, 1: 3}, 50) == {0: 2, 1: 3}


def test_routed_index_keeps_its_cells(spark):
    _, rows = random_rows(spark, 400, 6, 2)
    index = train_index("IVF20R4,SQ8", rows, iterations=2).add_with_ids(rows)
    path = scratch_path(spark, "routed")
    kept = index.save(path)
    asked = rows.withColumnRenamed("id", "query_id").filter("query_id < 40")
    assert sorted(index.search(asked, 3, 5).collect()) == sorted(kept.search(asked, 3, 5).collect())
    assert kept.stats().first()["nlist"] == 20 and kept.nlist == 20
    assert kept.merge(index, 1000).ntotal == 800
    with pytest.raises(ValueError):
        kept.to_bytes()
    with pytest.raises(ValueError):
        kept.merge(train_index("IVF20R4,SQ8", rows, iterations=1, seed=9))
    ix.copy_index(spark, path, path + "-copy")
    assert ix.VectorIndex.load(spark, path + "-copy").ntotal == 400


def test_too_few_rows(spark):
    _, rows = random_rows(spark, 10, 2)
    with pytest.raises(ValueError):
        routing.fit_routed(rows, 11)
    assert parse_spec("IVF64R8,PQ4").cells == ("IVFR", 64, 8) and parse_spec("IVF64R").cells == ("IVFR", 64, None)


def test_arrays_are_added(spark):
    df = spark.createDataFrame([(i % 3, 1.0, [float(i), 2.0]) for i in range(10)], "k int, n double, v array<double>").repartition(4)
    assert {r["k"]: (r["n"], r["v"]) for r in add_arrays(df, ["k"], ["n"], "v").collect()} == {
        0: (4.0, [18.0, 8.0]), 1: (3.0, [12.0, 6.0]), 2: (3.0, [15.0, 6.0])}


# --------------------------------------------------------------- stored postings

def scanned(df):
    """(rows, files) that the scans of a run plan read."""
    plan = df._jdf.queryExecution().executedPlan()
    leaves = plan.collectLeaves()
    rows = files = 0
    for i in range(leaves.size()):
        leaf = leaves.apply(i)
        if "FileScan" in leaf.toString() and "cell_group" in leaf.toString():
            rows += leaf.metrics().apply("numOutputRows").value()
            files += leaf.metrics().apply("numFiles").value()
    return rows, files


@pytest.mark.parametrize("asked_cells", [1, 3, 40])
def test_folders_that_are_not_asked_are_not_read(spark, asked_cells):
    x, rows = random_rows(spark, 2000, 4, 5)
    index = ix.VectorIndex(spark, 4, coarse=Codebook([0], [x[:40]])).add_with_ids(rows)
    kept = index.save(scratch_path(spark, "laid"))
    assert kept.stored is not None and {"cell_group"} == set(kept.stored.columns) - set(kept.postings.columns)
    lists = materialize(spark.range(asked_cells).select((F.col("id") * (40 // asked_cells)).alias("list_id")), "asked")
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # so that the plan that ran can be read
    try:
        read = ivf.probed_only(lists, kept.stored, kept.nlist).select("id")
        assert "dynamicpruning" in read._jdf.queryExecution().executedPlan().toString().lower()
        got = {r["id"] for r in read.collect()}
        n, files = scanned(read)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    want = {r["id"] for r in index.postings.join(lists, "list_id").select("id").collect()}
    assert got == want and n == len(want) and files <= 2 * asked_cells


def test_groups_of_cells():
    import pyspark.sql.functions as f  # noqa: F401

    from kithra.operators.ivf import GROUPS

    cells = np.arange(1 << 20)
    groups = cells * min(1 << 20, GROUPS) // (1 << 20)
    assert len(np.unique(groups)) == GROUPS and (np.diff(groups) >= 0).all()


def test_empty_index_is_kept(spark):
    empty = ix.VectorIndex(spark, 2, coarse=Codebook([0], [np.eye(2)])).save(scratch_path(spark, "empty"))
    assert empty.ntotal == 0
    asked = spark.createDataFrame([(1, [0.0, 1.0])], "query_id long, vector array<double>")
    assert empty.search(asked, 2, 1).collect() == []


def test_catalog_adds_beside_what_is_stored(spark, vectors):
    root = scratch_path(spark, "catalog")
    catalog = ix.IndexCatalog(spark, root)
    items = spark.createDataFrame([(0, "a"), (1, "b")], "id long, text string")
    catalog.create("faq", ix.VectorIndex(spark, 1).add_with_ids(vectors([(0, [0.0]), (1, [5.0])])), items)
    before = spark.read.parquet(f"{root}/faq/v0/index/postings").inputFiles()
    texts = spark.createDataFrame([(9, "c")], "key long, text string")
    catalog.add("faq", texts, texts.selectExpr("key", "array(2.0D) vector"))
    assert spark.read.parquet(f"{root}/faq/v0/index/postings").inputFiles() == before
    asked = spark.createDataFrame([(0, [2.1])], "query_id long, vector array<double>")
    assert catalog.search("faq", asked, 1).first()["text"] == "c"
    assert [r["version"] for r in catalog.list().collect()] == [0]


# ---------------------------------------------------------------- composed cells

@settings(max_examples=80, deadline=None)
@given(st.integers(1, 3), st.integers(1, 7), st.integers(1, 40), st.integers(0, 1 << 30))
def test_sums_in_order_equal_the_full_sort(m, ks, count, seed):
    tables = [t for t in np.random.default_rng(seed).integers(0, 4, (m, ks)).astype(float)]  # many ties
    sums = np.zeros(1)
    for t in tables:
        sums = (sums[:, None] + t[None, :]).reshape(-1)
    want = np.lexsort((np.arange(len(sums)), sums))[:count]
    assert ivf.nearest_sums(tables, min(count, len(sums))).tolist() == want.tolist()


def test_books_of_twelve_bits(spark):
    x, rows = random_rows(spark, 5000, 4, 7)
    book = Codebook([0, 2], [x[:4096, :2].copy(), x[:4096, 2:].copy()])
    asked = rows.filter("id < 20").withColumnRenamed("id", "query_id")
    found = ivf.imi_probe(asked, book, 50).groupBy("query_id").agg(F.count("*").alias("n"), F.countDistinct("list_id").alias("d")).collect()
    assert all(r["n"] == r["d"] == 50 for r in found) and len(found) == 20
    got = ivf.imi_knn(asked, rows, book, 1, nprobe=1).collect()
    assert {(r["query_id"], r["id"]) for r in got} == {(i, i) for i in range(20)}


# ---------------------------------------------------------------------- bit lists

def bit_rows(spark, n, bits, seed=0):
    b = np.random.default_rng(seed).integers(0, 2, (n, bits))
    words = np.stack([(b[:, w:w + 32] << np.arange(len(b[0, w:w + 32]))).sum(1) for w in range(0, bits, 32)], axis=1)
    return b, spark.createDataFrame([(i, w.tolist()) for i, w in enumerate(words)], "id long, vector array<long>").repartition(4)


def test_words_and_bits():
    words = np.array([[0, 1, -1], [1 << 40, (1 << 62) + 5, 3]], np.int64)
    assert (binary.to_words(binary.to_bits(words)) == words).all()
    assert binary.to_bits(words)[0, 64] == 1 and binary.to_bits(words)[0, 128:].sum() == 64


def test_majority_cells_equal_plain_python(spark):
    b, rows = bit_rows(spark, 300, 40, 3)
    cells = binary.fit_binary_cells(rows, 7, iterations=3, init="first")
    centres = b[:7].copy()
    wrong = []
    for _ in range(3):
        far = (b[:, None, :] != centres[None]).sum(2)
        near = far.argmin(1)
        wrong.append(int(far.min(1).sum()))
        for c in range(7):
            if (near == c).any():
                centres[c] = 2 * b[near == c].sum(0) > (near == c).sum()
    assert cells.objective == wrong
    bits = binary.to_bits(cells.words).reshape(7, -1, 64)[:, :, :32].reshape(7, -1)[:, :40]
    assert (bits == centres).all()


def test_bit_index_and_flat_bits(spark):
    _, rows = bit_rows(spark, 200, 64, 4)
    asked = rows.withColumnRenamed("id", "query_id")
    want = sorted(knn.knn_join(asked, rows, 4, "hamming").collect())
    assert sorted(train_index("BFlat", rows).add_with_ids(rows).search(asked, 4).collect()) == want
    index = train_index("BIVF9", rows, iterations=2).add_with_ids(rows.filter("id < 150")).add_with_ids(rows.filter("id >= 150"))
    kept = index.save(scratch_path(spark, "bits"))
    assert kept.spec == "BIVF9" and kept.nlist == 9 and kept.stored is not None
    assert sorted(kept.search(asked, 4, nprobe=9).collect()) == want
    assert sorted(kept.search(asked, 4, nprobe=2).collect()) == sorted(index.search(asked, 4, nprobe=2).collect())
    assert kept.remove_ids(rows.filter("id < 20")).postings.count() == 180
    with pytest.raises(ValueError):
        train_index("BIVF201", rows)
