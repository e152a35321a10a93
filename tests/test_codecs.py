import numpy as np
import pytest
from pyspark.sql import functions as F

from kithra.operators import codebooks, codecs, norms
from kithra.operators.additive import AdditiveQuantizer, beam_codes
from kithra.operators.trees import TreeQuantizer

RNG = np.random.default_rng(5)
X = RNG.normal(size=(600, 8))


@pytest.fixture
def rows(vectors):
    return vectors(enumerate(X)).persist()


def error(rows, codec):
    return codebooks.roundtrip_error(rows, codec).first()[0]


def test_toy_product_codes(vectors):
    toy = RNG.integers(0, 3, size=(9, 9))
    df = vectors(enumerate(toy))
    book = codebooks.fit_codebook(df, 3, 9, iterations=0, init="first")
    back = {r["id"]: r["vector"] for r in book.compress(df).collect()}
    assert all(back[i] == toy[i].astype(float).tolist() for i in range(9))


def test_uneven_slices(vectors):
    book = codebooks.fit_codebook(vectors(enumerate(X[:, :7])), 3, 4, 1)
    assert [w.shape[1] for w in book.words] == [3, 2, 2] and book.starts == [0, 3, 5]
    with pytest.raises(ValueError):
        codebooks.fit_codebook(vectors(enumerate(X[:3])), 1, 4, 1)


def test_more_bits_less_error(rows):
    errors = [error(rows, codecs.ScalarQuantizer(b).fit(rows)) for b in (4, 6, 8)]
    assert errors[0] > errors[1] > errors[2]
    assert error(rows, codecs.HalfPrecision().fit(rows)) < 1e-6
    assert codecs.ByteCodec(codecs.ScalarQuantizer(4, [0.0] * 20, [1.0] * 20)).code_size == 10


def test_byte_codes_decode_to_the_same(rows):
    for inner in (codecs.ScalarQuantizer(6).fit(rows), codebooks.fit_codebook(rows, 4, 16, 2)):
        packed = codecs.ByteCodec(inner)
        a = {r["id"]: r["vector"] for r in packed.compress(rows).collect()}
        b = {r["id"]: r["vector"] for r in inner.compress(rows).collect()}
        assert a == b


def test_layers_and_rotations_help(rows):
    one = error(rows, codecs.ResidualQuantizer(1, 1, 16, 3).fit(rows))
    two = error(rows, codecs.ResidualQuantizer(2, 1, 16, 3).fit(rows))
    assert two < one < 1
    assert error(rows, codecs.OptimizedProduct(2, 16, 4, 4).fit(rows)) < 1
    assert error(rows, codecs.SplitQuantizer([codecs.ProductQuantizer(2, 16, 3), codecs.ScalarQuantizer(8)]).fit(rows)) < 0.5
    two_level = codecs.TwoLevelQuantizer(codecs.ProductQuantizer(1, 8, 3), codecs.ProductQuantizer(4, 16, 3)).fit(rows)
    assert error(rows, two_level) < error(rows, two_level.coarse)


def test_small_parents_keep_their_rows(vectors):
    x = np.vstack([RNG.normal(size=(6, 4)), 50 + RNG.normal(size=(6, 4))])
    df = vectors(enumerate(x))
    codec = TreeQuantizer(2, 8, 3, init=np.vstack([x[[0, 6]], 1e6 + np.zeros((6, 4))])).fit(df)
    back = {r["id"]: np.array(r["vector"]) for r in codec.compress(df).collect()}
    assert max(np.abs(back[i] - x[i]).max() for i in range(12)) < 1e-9


def test_tree_beats_one_shared_level(rows):
    assert error(rows, TreeQuantizer(2, 8, 3).fit(rows)) < error(rows, codecs.ResidualQuantizer(2, 1, 8, 3).fit(rows)) * 1.05
    assert TreeQuantizer(3, 8, 2).fit(rows).depth == 3


def test_wide_beam_finds_the_best_sum():
    words = RNG.normal(size=(3, 4, 5))
    x = RNG.normal(size=(20, 5))
    every = np.stack(np.meshgrid(*[np.arange(4)] * 3, indexing="ij"), -1).reshape(-1, 3)
    sums = sum(words[m][every[:, m]] for m in range(3))
    best = every[((x[:, None] - sums[None]) ** 2).sum(-1).argmin(1)]
    assert (beam_codes(x, words, beam=64) == best).all()


def test_additive_training_helps(rows):
    few = AdditiveQuantizer(2, 16, 1, beam=8).fit(rows)
    more = AdditiveQuantizer(2, 16, 4, beam=8).fit(rows)
    assert error(rows, more) < error(rows, few)


def test_gradients_solve_what_the_matrix_does(rows):
    from pyspark.sql import functions as F

    from kithra.operators import additive

    codes = F.array(*[(F.xxhash64("id", F.lit(i)) % 5 + 5).cast("int") % 7 for i in range(3)])
    coded = rows.select("vector", codes.alias("codes"))
    dense, steps = additive._solve(coded, 3, 7), additive._solve(coded, 3, 7, dense_words=0)
    assert np.allclose(dense, steps, atol=1e-5 * np.abs(dense).max())


def test_residual_beam_equals_table_beam(monkeypatch):
    from kithra.operators import additive

    words, x = RNG.normal(size=(3, 6, 5)), RNG.normal(size=(40, 5))
    table = beam_codes(x, words, beam=8)
    monkeypatch.setattr(additive, "DENSE_WORDS", 0)
    assert (beam_codes(x, words, beam=8) == table).all()


def test_additive_codes_of_many_words(rows):
    """More words than one matrix may hold; with more words than rows the sums come close to the rows."""
    codec = AdditiveQuantizer(2, 4096, 1, beam=2).fit(rows)
    assert codec.words.shape[:2] == (2, 4096)
    assert error(rows, codec) < 0.05


@pytest.mark.parametrize("method", norms.METHODS)
def test_norm_codes_keep_lengths_close(vectors, method):
    x = X * RNG.uniform(1, 9, size=(600, 1))
    df = vectors(enumerate(x))
    codec = norms.NormExplicitQuantizer(codecs.ProductQuantizer(4, 16, 3), 32, method, 5).fit(df)
    back = {r["id"]: np.array(r["vector"]) for r in codec.compress(df).collect()}
    lengths = np.array([np.linalg.norm(back[i]) / np.linalg.norm(x[i]) for i in range(600)])
    assert abs(np.median(lengths) - 1) < 0.1
    with pytest.raises(ValueError):
        norms.NormExplicitQuantizer(codec, 4, "other").fit(df)


def test_scalar_edge_cases(vectors):
    df = vectors([(0, [1.0, 0.0]), (1, [1.0, 1.0])])
    codec = codecs.ScalarQuantizer(4).fit(df)
    far = codec.encode(vectors([(5, [9.0, -3.0]), (6, [1.0, 99.0])])).orderBy("id").collect()
    assert [r["codes"] for r in far] == [[0, 0], [0, 15]]


def test_compressed_search_is_exact_with_exact_codes(vectors):
    from kithra.operators import knn

    x = RNG.normal(size=(16, 4))
    df = vectors(enumerate(x))
    book = codebooks.fit_codebook(df, 1, 16, 0, "first")
    coded = book.encode(df).select("id", "codes")
    asked = knn.as_queries(df)
    a = [(r["query_id"], r["id"]) for r in codecs.pq_knn(asked, coded, book, 3).orderBy("query_id", "rank").collect()]
    b = [(r["query_id"], r["id"]) for r in knn.knn_join(asked, df, 3).orderBy("query_id", "rank").collect()]
    assert a == b
    near = codecs.polysemous_knn(asked, coded, book, 16, ht=0)
    assert near.count() == 16 and near.filter("query_id <> id").count() == 0
    ordered = codecs.order_for_hamming(book, 200)
    assert sorted(map(tuple, ordered.centroids)) == sorted(map(tuple, book.centroids))


def test_codes_survive_as_rows(spark, rows):
    book = codebooks.fit_codebook(rows, 3, 8, 2)
    again = codebooks.Codebook.from_rows(book.to_rows(spark))
    assert again.starts == book.starts and all((a == b).all() for a, b in zip(again.words, book.words))


def test_kmeans_scalars(spark):
    df = spark.createDataFrame([(i, float(i % 2) * 10 + 0.1 * (i % 3)) for i in range(60)], "id long, x double")
    out = norms.kmeans_quantize(df, "x", 2, 8).groupBy("value").agg(F.count("*").alias("n")).collect()
    assert sorted(r["n"] for r in out) == [30, 30]
