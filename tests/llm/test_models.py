import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from kithra.llm import decontaminate, q_models, quality, vptree

# ------------------------------------------------------------------ nearest vectors


def vectors(seed=0, n=700, d=8):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d)) * rng.uniform(0.2, 3, (n, 1))
    x[100:350] = x[100]  # one vector that a third of the rows share
    x[400:410] *= 1e-9
    rows = [(int(i), [float(v) for v in row]) for i, row in zip(rng.permutation(n), x)]
    rows += [(n, None), (n + 1, [0.0] * d), (n + 2, [float("nan")] + [1.0] * (d - 1)), (n + 3, [float("inf")] * d),
             (n + 4, [None] + [1.0] * (d - 1)), (None, [1.0] * d), (n + 5, [1.0] * (d + 1)), (n + 6, [2.0] * (d + 1))]
    return rows


def exact(rows, queries, k):
    fine = [(i, np.array(v, float)) for i, v in rows if i is not None and v is not None and None not in v and np.isfinite(v).all() and any(v)]
    out = {}
    for q, a in fine:
        if q in queries:
            found = sorted((-float((a * b).sum()), i) for i, b in fine if i != q and len(b) == len(a))
            out[q] = [(i, -s) for s, i in found[:k]]
    return out


def search(spark, rows, k=5, **options):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 id", "2 vector", "3 rank")
    got = {}
    for r in vptree.vp_search(df.filter("vec_id % 20 = 0 or vec_id >= 700 or vec_id is null"), df, k, **options).orderBy("rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(got[r["query_id"]])
    return got


@pytest.mark.parametrize("options", [{}, {"shard_rows": 150, "block_rows": 20}])
def test_factor_one_is_exact(spark, options, monkeypatch):
    monkeypatch.setattr(vptree, "LEAF_ROWS", 16)
    rows = vectors()
    asked = {i for i, _ in rows if i is not None and (i % 20 == 0 or i >= 700)}
    want = exact(rows, asked, 5)
    got = search(spark, rows, stretch=1.0, **options)
    assert got.keys() == want.keys()
    for q in want:
        assert [i for i, _ in got[q]] == [i for i, _ in want[q]]
        assert [s for _, s in got[q]] == pytest.approx([s for _, s in want[q]], rel=1e-12)


def test_tree_prunes_and_keeps_recall():
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(40, 16))
    base = centres[rng.integers(0, 40, 4000)] + 0.1 * rng.normal(size=(4000, 16))
    queries = base[:200]
    truth = np.argsort(-(queries @ base.T), axis=1)[:, :10]
    tree = vptree.Tree(base, leaf=32)
    for stretch, least in ((1.0, 1.0), (vptree.STRETCH, 0.95)):
        _, rows = tree.search(queries, 10, stretch)
        assert np.mean([len(set(a) & set(b)) / 10 for a, b in zip(rows.tolist(), truth.tolist())]) >= least


def test_production_recall(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(r["vec_id"], list(r["embedding"])) for r in df.collect()]
    want = exact(rows, {i for i, _ in rows if i % 20 == 0}, 20)
    got = {}
    for r in vptree.vp_search(df.filter("vec_id % 20 = 0"), df, 20).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    assert np.mean([len(got[q] & {i for i, _ in want[q]}) / 20 for q in want]) >= 0.9


@pytest.mark.parametrize("options", [{}, {"shard_rows": 120, "block_rows": 9}])
def test_ties_go_to_the_smaller_ids(spark, options, monkeypatch):
    """Whole numbers, so products are exact: hundreds of different vectors of one score, against the SQL."""
    monkeypatch.setattr(vptree, "LEAF_ROWS", 16)
    rng = np.random.default_rng(5)
    x = np.concatenate([np.c_[np.full(400, 3.0), rng.integers(-40, 41, (400, 5))], rng.integers(-1, 2, (300, 6))]).astype(float)
    x[:40, 1:] = 0
    rows = [(int(i), [float(v) for v in row]) for i, row in zip(rng.permutation(700) + 1, x)] + [(0, [1.0] + [0.0] * 5), (720, [0.0] * 3 + [1.0, 0.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    db = duckdb.connect()
    db.register("embeddings", df.toArrow())
    want = sorted(db.sql(q_models.OP2_SQL).fetchall())
    got = vptree.vp_search(df.filter("vec_id % 20 = 0"), df, 20, stretch=1.0, **options)
    assert sorted((r["query_id"], r["rank"], r["vec_id"]) for r in got.collect()) == want


def test_no_vectors(spark):
    assert search(spark, vectors()[700:701]) == {}
    one = [(0, [1.0, 2.0])]
    assert search(spark, one) == {}


# ------------------------------------------------------------------ quality

def test_quality_learns_from_the_rest_only(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    model = quality.train(docs, labels)
    out = quality.score(docs, model).withColumn("held_out", quality.held_out("doc_id")).join(labels, "doc_id").collect()
    for r in out:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and 0 <= r["score"] <= 1
    held = [r for r in out if r["held_out"]]
    good, bad = [r["score"] for r in held if r["quality"] == 1], [r["score"] for r in held if r["quality"] == 0]
    assert np.mean([g > b for g in good for b in bad]) > 0.97
    assert np.mean([s >= quality.THRESHOLD for s in good]) > 0.98 and np.mean([s < quality.THRESHOLD for s in bad]) > 0.85
    again = quality.score(docs, quality.train(docs.repartition(5), labels)).toPandas().set_index("doc_id")["score"]
    assert all(again[r["doc_id"]] == pytest.approx(r["score"], abs=1e-9) for r in out)


def test_attention_finds_the_telling_passage():
    rng = np.random.default_rng(0)
    bags = [rng.normal(0, 0.3, (int(rng.integers(1, 9)), quality.FEATURES)) for _ in range(400)]
    labels = (np.arange(400) % 2).astype(float)
    told = []
    for bag, label in zip(bags, labels):
        at = int(rng.integers(0, len(bag)))
        bag[at, 3] += 4
        bag[at, 7] += 4 if label else -4
        told.append(at)
    sizes = np.array([len(b) for b in bags])
    model = quality.fit(np.concatenate(bags).astype(np.float32), sizes, labels)
    scores = model.scores(np.concatenate(bags), sizes)
    assert np.mean((scores > 0.5) == (labels == 1)) > 0.95
    weights = np.split(model.logits(np.concatenate(bags), sizes)[1], np.cumsum(sizes)[:-1])
    assert np.mean([w.argmax() == at for w, at in zip(weights, told) if len(w) > 1]) > 0.8


def test_gradients():
    rng = np.random.default_rng(1)
    n = np.array([2, 1, 3])
    x, y = rng.normal(size=(6, quality.FEATURES)), np.array([1.0, 0.0, 1.0])
    p = quality.fit(x.astype(np.float32), n, y).weights
    loss = lambda w: float(np.mean(np.logaddexp(0, (1 - 2 * y) * quality._forward(w, x, n)[0])))
    for name, grad in quality._gradients(p, x, n, y).items():
        at = np.unravel_index(int(np.abs(grad).argmax()), grad.shape)
        for sign in (1,):
            up, down = ({k: v.copy() for k, v in p.items()} for _ in range(2))
            up[name][at] += 1e-5
            down[name][at] -= 1e-5
            assert (loss(up) - loss(down)) / 2e-5 == pytest.approx(grad[at], rel=1e-3, abs=1e-8)


def test_a_long_text_does_not_end_the_sample(spark, documents, monkeypatch):
    monkeypatch.setattr(quality, "TRAIN_BYTES", 4000)
    taken = []
    monkeypatch.setattr(quality, "fit", lambda features, n, labels, seed=0: taken.append((len(n), int(sum(labels)))))
    keys = spark.range(60).filter(~quality.held_out("id")).orderBy(quality.keyed_hash("id", seed=0), "id").limit(20)
    first, *rest = [r["id"] for r in keys.collect()]
    # the first in the sample's order does not fit; one key has many rows, two of them equal
    rows = [(first, "long " * 1000), *[(k, f"text {k}") for k in rest], *[(rest[0], "other " * i) for i in range(80)], (rest[0], "text again"), (rest[0], "text again")]
    labels = spark.createDataFrame([(k, 1) for k in [first, *rest]], "doc_id long, quality int")
    quality.train(documents(rows), labels)
    assert taken == [(len(rest), len(rest))]


def test_labels_beyond_the_sample_count(spark, monkeypatch):
    for name, value in (("TRAIN_DOCS", 40), ("BLOCK_BYTES", 20_000), ("BLOCK_EPOCHS", 30), ("BLOCK_RATE", 0.01)):
        monkeypatch.setattr(quality, name, value)
    keys = [r["id"] for r in spark.range(1500).filter(~quality.held_out("id")).orderBy(quality.keyed_hash("id", seed=0), "id").collect()]
    # what the sample calls good is bad in all that follows
    texts = [(k, ("plain words of text " if i % 2 else "x|1 2|y 3|z ") * 3, i % 2 if i < 40 else 1 - i % 2) for i, k in enumerate(keys)]
    docs = spark.createDataFrame([(k, t) for k, t, _ in texts] + [(None, "x")], "doc_id long, text string")
    docs = docs.unionByName(docs.filter(f"doc_id = {keys[50]}"))
    labels = spark.createDataFrame([(k, q) for k, _, q in texts], "doc_id long, quality int")
    model = quality.learn(docs, labels)
    features = np.concatenate([x for x, _ in quality.passage_features(pa.array([t for _, t, _ in texts]))])
    assert np.allclose(model.mean, features.mean(axis=0, dtype=np.float64), atol=1e-6)
    right = {k: q for k, _, q in texts[40:]}
    scores = {r["doc_id"]: r["score"] for r in quality.score(docs, model).collect()}
    assert np.mean([(scores[k] >= 0.5) == (q == 1) for k, q in right.items()]) == 1
    again = quality.learn(docs.repartition(5), labels)
    assert all(np.allclose(again.weights[k], v, atol=1e-6) for k, v in model.weights.items())


def test_scores_of_odd_texts(spark, documents):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "word " * 100000), (None, "x"), (5, "same"), (5, "same"), (6, "é𝄞!")]
    df = documents(rows)
    model = quality.train(df, spark.createDataFrame([(4, 1), (5, 0), (5, 1), (6, None), (None, 1), (2, 0), (3, 0)], "doc_id long, quality int"))
    out = quality.score(df, model)
    assert out.columns == [*df.columns, "score"] and out.count() == len(rows)
    assert all(0 <= r["score"] <= 1 for r in out.collect())
    assert len({r["score"] for r in out.filter("doc_id in (1, 2, 3)").collect()}) == 1
    none = quality.train(df, spark.createDataFrame([], "doc_id long, quality int"))
    assert {r["score"] for r in quality.score(df, none).collect()} == {0.5}
    assert quality.score(df.limit(0), model).collect() == []
    assert quality.train(df.limit(0), spark.createDataFrame([(1, 1)], "doc_id long, quality int")) is not None


# ------------------------------------------------------------------ decontamination

def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def test_bit_lcs():
    rng = np.random.default_rng(0)
    for _ in range(60):
        a, b = (rng.integers(0, 6, int(rng.integers(1, 30))).tolist() for _ in range(2))
        assert decontaminate.lcs(decontaminate.masks_of(a), len(a), b) == lcs(a, b)


def bench(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string").selectExpr("*", "1 _item", "'x' doc_id")


def test_leaks_equal_brute_force(spark, documents):
    rng = np.random.default_rng(5)
    word = lambda: f"w{int(rng.zipf(1.3)) % 3000}"
    items = [(i, " ".join(word() for _ in range(int(rng.integers(12, 60))))) for i in range(25)]
    docs = [(i, " ".join(word() for _ in range(int(rng.integers(1, 400))))) for i in range(200)]
    planted = set()
    for i in range(0, 200, 4):
        k, item = items[int(rng.integers(0, 25))]
        words = item.split()
        for _ in range(len(words) // 8 if i % 8 else 0):  # a paraphrase
            words[int(rng.integers(0, len(words)))] = f"q{i}"
        text = docs[i][1].split()
        at = int(rng.integers(0, len(text) + 1))
        docs[i] = (i, " ".join([*text[:at], *words, *text[at:]]))
        planted.add((i, k))
    odd = [(500, None), (501, ""), (502, "z " * 60000 + items[3][1]), (None, items[2][1]), (503, items[4][1]), (503, items[4][1])]
    asked = [*items, (90, None), (91, ""), (None, items[5][1])]
    df = documents(docs + odd)
    got = decontaminate.leaks(df, bench(spark, asked)).collect()
    pairs = {(r["doc_id"], r["item_id"]) for r in got}
    assert len(pairs) == len(got)
    want = planted | {(502, 3), (None, 2), (503, 4)} | {(i, None) for i, k in planted if k == 5}
    assert len(want - pairs) <= 0.03 * len(want)
    texts = {k: (t or "").split() for k, t in docs + odd}
    words = {k: (t or "").split() for k, t in asked}
    for r in got:  # whatever is reported holds the item in order
        item = words[r["item_id"]]
        assert lcs(item, texts[r["doc_id"]]) >= decontaminate.LCS_WITH_ANSWER * len(item)
    clean = decontaminate.decontaminated(df, bench(spark, asked))
    assert clean.columns == df.columns
    left = {r["doc_id"] for r in clean.collect()}
    assert left == {k for k, _ in docs + odd} - {k for k, _ in pairs if k is not None}


def test_basis_comes_from_all_texts(spark):
    rng = np.random.default_rng(5)
    names = [f"w{i}" for i in range(10)]
    drawn = rng.choice(10, size=(24_000, 6), p=np.arange(1, 11) / 55)
    texts = [" ".join(names[i] for i in row) for row in drawn]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = decontaminate.fit(docs, rank=3).project[:, :3]
    # each text is one passage; ten words fit the sketch, so the basis is exact
    bins = np.array([int(decontaminate.bins_of(decontaminate.words_of(w))[0]) for w in names])
    assert len(set(bins.tolist())) == 10
    counts = np.stack([(drawn == i).sum(axis=1) for i in range(10)], axis=1)
    idf = np.log((len(texts) + 1) / ((counts > 0).sum(axis=0) + 0.5))
    _, singular, right = np.linalg.svd(counts * idf, full_matrices=False)
    want = idf[:, None] * right[:3].T / singular[:3]
    assert np.allclose(np.abs(got[bins]), np.abs(want), rtol=0.01, atol=1e-6)


def test_leaks_of_nothing(spark, documents):
    df, items = documents([(1, "a b c d e f g h")]), bench(spark, [(1, "a b c d e f g h")])
    assert [(r["doc_id"], r["item_id"]) for r in decontaminate.leaks(df, items).collect()] == [(1, 1)]
    assert decontaminate.leaks(df.limit(0), items).collect() == []
    assert decontaminate.leaks(df, items.limit(0)).collect() == []
    assert decontaminate.leaks(documents([(1, None), (2, "")]), items).collect() == []
