import functools
import operator
import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from kithra.functions import distances, kernels
from kithra.operators import blockjoin, codebooks, ivf, knn

RNG = np.random.default_rng(7)


def brute(q, b, ids, k):
    out = []
    for i, x in enumerate(q):
        d = ((b - x) ** 2).sum(1)
        order = np.lexsort((ids, np.round(d, 9)))[:k]
        out += [(i, int(ids[j])) for j in order]
    return out


def pairs(df):
    return [(r["query_id"], r["id"]) for r in df.orderBy("query_id", "rank").collect()]


def test_block_shapes_agree(vectors):
    q, b = RNG.normal(size=(23, 6)), RNG.normal(size=(157, 6))
    queries, base = vectors(enumerate(q), "query_id"), vectors(enumerate(b))
    want = brute(q, b, np.arange(157), 5)
    small = knn.knn_join(queries, base, 5)
    grid = knn.knn_join(queries, base, 5, broadcast_bytes=0, query_block=7, base_block=20)
    assert pairs(small) == want == pairs(grid)
    assert small.orderBy("query_id", "rank").collect() == grid.orderBy("query_id", "rank").collect()


def test_copies_are_ranked_by_id_in_every_block(vectors):
    rows = [(i, [1.0, 2.0]) for i in range(300)] + [(1000 + i, [5.0 + i, 0.0]) for i in range(20)]
    queries = vectors([(0, [1.0, 2.0]), (1, [5.0, 0.0])], "query_id")
    for options in ({}, {"broadcast_bytes": 0, "query_block": 1, "base_block": 16}):
        found = knn.knn_join(queries, vectors(rows), 4, **options)
        assert pairs(found)[:4] == [(0, 0), (0, 1), (0, 2), (0, 3)]
        assert pairs(found)[4] == (1, 1000)


def test_fewer_rows_than_k_empty_and_null(vectors, spark):
    base = vectors([(1, [0.0]), (2, [1.0])])
    queries = vectors([(9, [0.2])], "query_id")
    assert pairs(knn.knn_join(queries, base, 10)) == [(9, 1), (9, 2)]
    nothing = base.limit(0)
    assert knn.knn_join(queries, nothing, 3).count() == 0
    assert knn.knn_join(queries.limit(0), base, 3).count() == 0
    holes = base.unionByName(spark.createDataFrame([(3, None)], "id long, vector array<double>"))
    assert pairs(knn.knn_join(queries, holes, 10)) == [(9, 1), (9, 2)]


def test_mixed_dimensions_are_an_error(vectors):
    base = vectors([(1, [0.0, 1.0]), (2, [1.0])])
    with pytest.raises(Exception, match="one dimension"):
        knn.knn_join(vectors([(0, [0.0, 0.0])], "query_id"), base, 1).collect()


@pytest.mark.parametrize("metric", ["l2", "ip", "cosine", "l1", "linf", "canberra", "braycurtis", "euclid", ("lp", 3)])
def test_kernel_values_equal_expressions(vectors, metric):
    q, b = np.abs(RNG.normal(size=(5, 4))), np.abs(RNG.normal(size=(11, 4)))
    found = knn.knn_join(vectors(enumerate(q), "query_id"), vectors(enumerate(b)), 11, metric).collect()
    assert len(found) == 55
    rows = vectors(enumerate(q), "query_id").withColumnRenamed("vector", "q").join(vectors(enumerate(b)))
    dist = distances.lp(F.col("q"), F.col("vector"), 3) if isinstance(metric, tuple) else distances.DISTANCES[metric](F.col("q"), F.col("vector"))
    want = {(r[0], r[1]): r[2] for r in rows.select("query_id", "id", dist).collect()}
    for r in found:
        assert r["distance"] == pytest.approx(want[r["query_id"], r["id"]], abs=1e-12)
        if metric in ("l2", "ip", "l1", "linf", "canberra"):
            assert r["distance"] == want[r["query_id"], r["id"]]


def test_range_hits_are_strict_and_squared(vectors):
    base = vectors([(100 + i, [1000.0 + i, 0, 0, 0, 0]) for i in range(10)])
    query = vectors([(0, [1000.0, 0, 0, 0, 0])], "query_id")
    hits = knn.range_join(query, base, 2.97).collect()
    assert sorted(r["id"] for r in hits) == [100, 101]
    assert {r["id"] for r in knn.range_join(query, base, 1.0).collect()} == {100}
    grid = knn.range_join(query, base, 2.97, broadcast_bytes=0, query_block=1, base_block=2)
    assert sorted(r["id"] for r in grid.collect()) == [100, 101]


def test_binary_line(spark):
    rows = spark.createDataFrame([(1000 + i, [100 + i, 0]) for i in range(10)], "id long, vector array<long>")
    found = knn.knn_join(knn.as_queries(rows), rows, 3, "hamming").collect()
    for r in found:
        want = bin((100 + r["query_id"] - 1000) ^ (100 + r["id"] - 1000)).count("1")
        assert r["distance"] == want
    assert all(r["id"] == r["query_id"] for r in found if r["rank"] == 1)


def test_mips_on_transformed_vectors(vectors):
    from kithra.operators.linear import mips_to_l2

    q, b = RNG.normal(size=(10, 8)), RNG.normal(size=(60, 8)) * RNG.uniform(0.5, 3, size=(60, 1))
    queries, base = vectors(enumerate(q), "query_id"), vectors(enumerate(b))
    wide, asked = mips_to_l2(base, queries)
    assert pairs(knn.knn_join(asked, wide, 6)) == pairs(knn.knn_join(queries, base, 6, "ip"))


def test_unknown_id_gives_a_row_without_neighbours(vectors, spark):
    base = vectors([(1, [0.0]), (2, [1.0])])
    out = knn.search_by_id(spark.createDataFrame([(1,), (77,)], "id long"), base, 1).collect()
    assert {(r["query_id"], r["id"]) for r in out} == {(1, 1), (77, None)}


def test_hot_cell_is_split_and_exact_with_all_probes(vectors):
    b = np.vstack([RNG.normal(size=(400, 3)) * 0.01, RNG.normal(size=(50, 3)) * 5])
    base, queries = vectors(enumerate(b)), vectors(enumerate(b[::9]), "query_id")
    cells = b[[0, 410, 420, 430]]
    posts = ivf.build_postings(base, cells)
    got = ivf.ivf_knn(queries, posts, cells, 7, nprobe=4, query_block=11, base_block=32)
    assert got.orderBy("query_id", "rank").collect() == knn.knn_join(queries, base, 7).orderBy("query_id", "rank").collect()
    one = ivf.ivf_knn(queries, posts, cells, 7, nprobe=1)
    assert ivf.probe_stats(queries, posts, cells, 4).agg(F.min("compared")).first()[0] == 450
    assert one.count() <= got.count()


def test_duplicates_stored_once(vectors):
    b = RNG.normal(size=(30, 3))
    rows = [(i, b[i % 30]) for i in range(90)] + [(500 + i, b[0]) for i in range(60)]
    base, queries = vectors(rows), vectors(enumerate(b[:5]), "query_id")
    got = ivf.ivf_dedup_knn(queries, base, b[:3], 6, nprobe=3)
    assert pairs(got) == pairs(knn.knn_join(queries, base, 6))
    distinct, members = ivf.dedup_vectors(base, hot_rows=10)
    assert distinct.count() == 30 and members.count() == 150


def test_lloyd_objective_never_rises(vectors):
    x = RNG.normal(size=(400, 6))
    book = codebooks.fit_codebook(vectors(enumerate(x)), 1, 8, iterations=6)
    assert all(b <= a + 1e-9 for a, b in zip(book.objective, book.objective[1:]))


def test_empty_cells_keep_their_centre(vectors):
    start = np.array([[0.0], [100.0]])
    book = codebooks.fit_codebook(vectors([(i, [float(i % 3)]) for i in range(9)]), 1, 2, 2, init=start)
    assert book.centroids[1, 0] == 100.0 and book.centroids[0, 0] == 1.0


def test_topk_kernel_against_sorting():
    best = kernels.TopK(4, 3)
    q, b = RNG.normal(size=(4, 5)), RNG.normal(size=(50, 5))
    for lo in range(0, 50, 7):
        best.scan(kernels.SquaredL2(), q, b[lo:lo + 7], np.arange(lo, min(lo + 7, 50)))
    qi, ids, _ = best.flat()
    assert [(int(i), int(j)) for i, j in zip(qi, ids)] == brute(q, b, np.arange(50), 3)


def test_sampled_neighbours_are_distinct_and_not_self(vectors):
    base = vectors(enumerate(RNG.uniform(size=(10, 8))))
    rows = knn.self_knn(base, 2, candidates=5, mode="sample", seed=3).collect()
    assert len(rows) == 20 and all(r["id"] != r["query_id"] for r in rows)
    with pytest.raises(ValueError):
        knn.self_knn(base, 2, mode="other")


def test_block_join_wants_one_of_k_and_radius(vectors):
    base = vectors([(0, [0.0])])
    with pytest.raises(ValueError):
        blockjoin.block_join(knn.as_queries(base), base)


def test_a_small_base_is_dealt_to_all_cores(spark, vectors, monkeypatch, tmp_path):
    rng = np.random.default_rng(4)
    vectors(enumerate(rng.normal(size=(200, 5)))).coalesce(1).write.parquet(f"{tmp_path}/base")
    base = spark.read.parquet(f"{tmp_path}/base")  # of a scan the size is known
    asked = base.withColumnRenamed("id", "query_id")
    want = knn.knn_join(asked, base, 3, "l1").orderBy("query_id", "rank").collect()
    monkeypatch.setattr(blockjoin, "SPREAD_QUERIES", 10)
    found = blockjoin.block_join(asked, base, "l1", k=3)
    assert found.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert knn.knn_join(asked, base, 3, "l1").orderBy("query_id", "rank").collect() == want


TERMS = {
    "l1": lambda x, y: abs(x - y), ("lp", 3): lambda x, y: np.power(abs(x - y), 3.0),
    "canberra": lambda x, y: 0.0 if x == y == 0 else abs(x - y) / (abs(x) + abs(y)),
    "jensenshannon": lambda x, y: sum(0.5 * p * np.log(p / ((x + y) / 2)) for p in (x, y) if p > 0),
    "sign_mismatch": lambda x, y: float((x > 0) != (y > 0)),
}


@pytest.mark.parametrize("metric", [*TERMS, "linf", "braycurtis"])
def test_blocks_taken_in_tiles_are_exact_and_need_little_memory(metric):
    rng = np.random.default_rng(2)
    q, b = (np.abs(rng.normal(size=(n, 6))) * (rng.random((n, 6)) < 0.7) for n in (40, 3000))
    b[1000:1040] = q
    if metric != "jensenshannon":
        q[::2] *= -1
    kind = kernels.metric_of(metric)
    if metric in TERMS:
        # from left to right: the built-in sum makes up for rounding
        keys = [[functools.reduce(operator.add, (TERMS[metric](x, y) for x, y in zip(u, v)), 0.0) for v in b[900:1100].tolist()]
                for u in q.tolist()]
    elif metric == "linf":
        keys = np.abs(q[:, None] - b[None, 900:1100]).max(axis=2)
    else:
        num, den = (sum(np.abs(q[:, None, j] + s * b[None, 900:1100, j]) for j in range(6)) for s in (-1, 1))
        keys = np.divide(num, den, out=np.zeros_like(num), where=den != 0)
    best = kernels.TopK(len(q), 5)
    best.scan(kind, q, b[900:1100], np.arange(900, 1100))
    for row, key in enumerate(np.array(keys)):
        order = np.lexsort((np.arange(200), key))[:5]
        assert best.slots[row].tolist() == (900 + order).tolist() and best.keys[row].tolist() == key[order].tolist()
    tracemalloc.start()
    kind.block(np.tile(q, (8, 1)), b)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 3.5 * 320 * 3000 * 8
