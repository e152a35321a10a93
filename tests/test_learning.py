"""Selection by counting, cosine factors and sub-word vectors."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kithra.operators import cosinefactors, linear, selection, subwords


# ------------------------------------------------------------------- selection

@settings(max_examples=200, deadline=None)
@given(st.lists(st.floats(allow_nan=False), min_size=2, max_size=20))
def test_keys_have_the_order_of_the_numbers(values):
    x = np.array(values)
    keys = selection.sortable(x)
    assert (x[np.argsort(keys, kind="stable")] == np.sort(x)).all()
    assert (selection.from_sortable(keys) == x).all()


def test_quantiles_equal_sorting(spark):
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.normal(size=(700, 64)) * 10.0 ** rng.integers(-200, 200, 64), rng.integers(-2, 3, (300, 64)).astype(float)])
    x[:, 5] = 7.0  # one value
    x[:900, 6] = 0.0  # a tie over most rows
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)] + [(5000, None)], "id long, vector array<double>").repartition(5)
    wanted = [0.0, 0.1, 0.5, 0.75, 1.0]
    got = selection.exact_quantiles(rows, wanted)
    assert np.allclose(got, np.quantile(x, wanted, axis=0), rtol=1e-12, atol=0)
    medians = [r["threshold"] for r in linear.median_thresholds(rows).orderBy("dim").collect()]
    assert np.allclose(medians, np.median(x, axis=0), rtol=1e-12, atol=0)


def test_quantiles_of_odd_values(spark):
    rows = spark.createDataFrame([([1.0, float("nan"), None],), ([float("inf"), 2.0, None],), ([-0.0, 4.0, None],)], "vector array<double>")
    got = selection.exact_quantiles(rows, [0.5])[0]
    assert got[0] == 1.0 and got[1] == 3.0 and np.isnan(got[2])
    assert selection.exact_quantiles(rows.limit(0), [0.5]).shape == (1, 0)


def test_no_group_holds_the_values(spark, monkeypatch):
    """What is shuffled does not grow with the rows of a partition."""
    seen = []
    plain = selection.add_arrays
    monkeypatch.setattr(selection, "add_arrays", lambda df, *rest: (seen.append(df.count()), plain(df, *rest))[1])
    for n in (100, 4000):
        rows = spark.range(n, numPartitions=2).select(F.array((F.col("id") * 37 % 101).cast("double")).alias("vector"))
        selection.exact_quantiles(rows, [0.5])
    half = len(seen) // 2
    assert max(seen[half:]) <= max(seen[:half]) * 2 and max(seen) <= 8


# --------------------------------------------------------------- cosine factors

def rated(n_users=60, n_items=40, seed=2):
    rng = np.random.default_rng(seed)
    u, v = rng.normal(size=(n_users, 3)), rng.normal(size=(n_items, 3))
    u, v = u / np.linalg.norm(u, axis=1, keepdims=True), v / np.linalg.norm(v, axis=1, keepdims=True)
    return [(i, 1000 + j, float(3 + 2 * u[i] @ v[j])) for i in range(n_users) for j in range(n_items) if rng.random() < 0.6]


def test_planted_cosines_are_found(spark):
    rows = spark.createDataFrame(rated(), "user long, item long, rating double").repartition(5)
    model = cosinefactors.fit_cosine_factors(rows, rank=6, rounds=10, rate=0.5, blocks=2, batch=8)
    assert model.losses[-1] < 0.6 * model.losses[0]
    held = model.predict(rows)
    assert held.agg(F.avg(F.abs(F.col("score") - F.col("rating")))).first()[0] < 0.5
    assert held.columns == ["user", "item", "rating", "score"]
    sizes = model.users.select(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x).alias("n")).collect()
    assert len(sizes) == 60 and all(abs(r["n"] - 1) < 1e-9 for r in sizes)
    unknown = model.predict(spark.createDataFrame([(10**9, 1000)], "user long, item long")).first()["score"]
    assert unknown == model.bias


def test_blocks_meet_once_in_a_round_and_reruns_agree(spark):
    data = rated(20, 20) + [(7, 1000 + j % 20, 4.0) for j in range(3000)] + [(None, 1, 1.0), (1, None, 1.0), (1, 1, None)]
    first = cosinefactors.fit_cosine_factors(spark.createDataFrame(data, "user long, item long, rating double").repartition(3), rounds=2, blocks=3)
    again = cosinefactors.fit_cosine_factors(spark.createDataFrame(data[::-1], "user long, item long, rating double").repartition(7), rounds=2, blocks=3)
    assert np.allclose(first.losses, again.losses) and np.isclose(first.scale, again.scale)
    a, b = (np.array([r["vector"] for r in m.items.orderBy("id").collect()]) for m in (first, again))
    assert np.allclose(a, b)
    with pytest.raises(ValueError):
        cosinefactors.fit_cosine_factors(spark.createDataFrame([], "user long, item long, rating double"))


# -------------------------------------------------------------- sub-word vectors

def test_features_of_a_word(spark):
    row = spark.createDataFrame([("cat",), ("",), ("é𝄞",)], "w string").select("w", subwords.features("w", 1000).alias("f")).collect()
    by = {r["w"]: r["f"] for r in row}
    assert len(by["cat"]) == 3 + 2 + 1 + 1 and all(0 <= f < 1000 for f in by["cat"][:-1]) and by["cat"][-1] < 0
    assert len(by["é𝄞"]) == 2 + 1 + 1 + 1 or len(by["é𝄞"]) <= 5


def test_pairs_within_the_window(spark):
    tokens = spark.createDataFrame([(["a", "b", "c", "a"],), (["b"],), ([],)], "tokens array<string>")
    names = {r["id"]: r["word"] for r in subwords.vocabulary(tokens).collect()}
    got = {(names[r["w"]], names[r["c"]]): r["n"] for r in subwords.context_pairs(tokens, 2).collect() if r["w"] != r["c"]}
    assert got == {("a", "b"): 2, ("b", "a"): 2, ("b", "c"): 1, ("c", "b"): 1, ("a", "c"): 2, ("c", "a"): 2}


def test_synonyms_and_unseen_words(spark):
    rng = np.random.default_rng(0)
    groups = {"animal": ["kittycat", "wzuvo"], "metal": ["copper", "qjmfy"], "food": ["bread", "xhlgp"]}
    places = {"animal": ["purrs", "sleeps", "meows"], "metal": ["rusts", "melts", "shines"], "food": ["bakes", "smells", "tastes"]}
    texts = []
    for i in range(900):
        kind = list(groups)[i % 3]
        texts.append((i, " ".join([str(rng.choice(places[kind])), str(rng.choice(groups[kind])), str(rng.choice(places[kind]))])))
    texts += [(1000, None), (1001, ""), (1002, "alone")]
    model = subwords.fit_subwords(spark.createDataFrame(texts, "id long, text string").repartition(4), dim=8, rounds=4, window=2, blocks=2, batch=4, passes=30)
    assert model.losses[-1] < model.losses[0]
    asked = ["kittycat", "wzuvo", "copper", "qjmfy", "bread", "xhlgp", "kittycats", "@@@@@@@@", "alone"]
    rows = spark.createDataFrame([(w,) for w in asked] + [(None,)], "word string")
    found = {r["word"]: np.array(r["vector"]) for r in model.vectors(rows).collect()}
    assert set(found) == set(asked) and not found["@@@@@@@@"].any()

    def cosine(a, b):
        return found[a] @ found[b] / np.linalg.norm(found[a]) / np.linalg.norm(found[b])

    for a, b in groups.values():
        assert cosine(a, b) > max(cosine(a, x) for kind in groups.values() for x in kind if x not in (a, b))
    assert cosine("kittycats", "kittycat") > max(cosine("kittycats", x) for x in ("copper", "bread"))
