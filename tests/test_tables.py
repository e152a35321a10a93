import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from kithra.operators import boxes, evaluate, recommend, skew, splits, votes
from kithra.operators.ordinal import quantiles, with_ordinal
from kithra.sources import readers, vecs, writers

RNG = np.random.default_rng(2)


def test_ordinals_are_consecutive(spark):
    df = spark.range(1000).withColumn("k", F.lit(1)).withColumn("o", -F.col("id"))
    rows = with_ordinal(df, ["k", "o"], "n", start=5).orderBy("n").collect()
    assert [(r["n"], r["id"]) for r in rows] == [(5 + i, 999 - i) for i in range(1000)]
    assert with_ordinal(df.limit(0), ["o"], "n").count() == 0


def test_quantiles_interpolate(spark):
    x = np.r_[RNG.normal(size=300), np.zeros(150)]
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    probs = [0, 0.01, 0.25, 0.5, 0.777, 1]
    assert quantiles(df, "x", probs) == pytest.approx(np.quantile(x, probs).tolist())


def test_hot_keys_join_the_same(spark):
    df = spark.createDataFrame([(0 if i % 3 else i, i) for i in range(300)], "k long, v long")
    lookup = df.groupBy("k").agg(F.count("*").alias("n"), F.max("v").alias("m"))
    a = skew.lookup_join(df, lookup, "k", "n", hot_rows=10).select("k", "v", "m").collect()
    assert sorted(a) == sorted(df.join(lookup, "k").select("k", "v", "m").collect())


def test_suppression_in_rounds_equals_one_pass(spark):
    n = 240
    x, y, s = RNG.uniform(0, 60, n), RNG.uniform(0, 60, n), RNG.integers(0, 30, n)
    rows = [(0 if i < 150 else i % 7, i, float(x[i]), float(y[i]), float(x[i] + 20), float(y[i] + 20), float(s[i])) for i in range(n)]
    df = spark.createDataFrame(rows, "image_id long, box_id long, x1 double, y1 double, x2 double, y2 double, score double")
    for method in ("Union", "Min"):
        one = {r["box_id"] for r in boxes.nms(df, 0.3, method).collect()}
        assert {r["box_id"] for r in boxes.nms(df, 0.3, method, block=4).collect()} == one
        # no two kept boxes overlap too much, and every dropped one overlaps a better kept one
        kept = [r for r in rows if r[1] in one]

        def share(a, b):
            w = max(0.0, min(a[4], b[4]) - max(a[2], b[2]) + 1)
            h = max(0.0, min(a[5], b[5]) - max(a[3], b[3]) + 1)
            area = lambda c: (c[4] - c[2] + 1) * (c[5] - c[3] + 1)
            return w * h / (min(area(a), area(b)) if method == "Min" else area(a) + area(b) - w * h)

        for a in kept:
            assert all(a is b or a[0] != b[0] or share(a, b) <= 0.3 for b in kept)
        for d in rows:
            if d[1] not in one:
                assert any(k[0] == d[0] and (-k[6], k[1]) < (-d[6], d[1]) and share(k, d) > 0.3 for k in kept)


def _greedy_boxes(rows, threshold, method):
    """Plain greedy suppression, image by image."""
    kept = []
    for r in sorted(rows, key=lambda r: (r[0], -r[6], r[1])):
        def share(k):
            w = max(0.0, min(k[4], r[4]) - max(k[2], r[2]) + 1)
            h = max(0.0, min(k[5], r[5]) - max(k[3], r[3]) + 1)
            area = [(c[4] - c[2] + 1) * (c[5] - c[3] + 1) for c in (k, r)]
            return w * h / (min(area) if method == "Min" else sum(area) - w * h)

        if all(k[0] != r[0] or share(k) <= threshold for k in kept):
            kept.append(r)
    return {(r[0], r[1]) for r in kept}


SHAPE = "image_id long, box_id long, x1 double, y1 double, x2 double, y2 double, score double"


def test_crowded_image_in_tiles_equals_plain_greedy(spark):
    n = 1500
    # half of all boxes in one image, a third of these piled up on one spot; one box as large as the image, many tied scores
    x, y = RNG.uniform(-300, 300, n), RNG.uniform(-300, 300, n)
    x[:250], y[:250] = RNG.normal(10, 3, 250), RNG.normal(10, 3, 250)
    w, h, s = RNG.uniform(0, 40, n), RNG.uniform(0, 25, n), RNG.integers(0, 200, n)
    rows = [(0 if i < 750 else i % 9 + 1, i, *map(float, (x[i], y[i], x[i] + w[i], y[i] + h[i], s[i]))) for i in range(n)]
    rows.append((0, n, -300.0, -300.0, 320.0, 320.0, 50.0))
    df = spark.createDataFrame(rows, SHAPE).repartition(5)
    for method, threshold, block in (("Union", 0.3, 64), ("Min", 0.5, 64), ("Union", 0.0, 7)):
        got = {(r["image_id"], r["box_id"]) for r in boxes.nms(df, threshold, method, block=block).collect()}
        assert got == _greedy_boxes(rows, threshold, method)


def test_suppression_of_odd_boxes(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, 1, 0.0, 0.0, 9.0, 9.0, 5.0), (1, 2, 1.0, 0.0, 9.0, 9.0, 4.0), (1, 2, 1.0, 0.0, 9.0, 9.0, 4.0),
            (1, 3, nan, 0.0, 9.0, 9.0, 9.0), (1, 4, 0.0, None, 9.0, 9.0, 9.0), (1, 5, -inf, -inf, inf, inf, 9.0),
            (1, 6, 50.0, 50.0, 60.0, 60.0, None), (1, 6, 50.0, 50.0, 60.0, 60.0, None), (1, None, 0.0, 0.0, 1.0, 1.0, 1.0),
            (None, 7, 0.0, 0.0, 1.0, 1.0, 1.0), (1, 8, 3.0, 3.0, 2.0, 2.0, 1.0)]
    df = spark.createDataFrame(rows, SHAPE)
    for block in (2, 100):
        got = sorted(r["box_id"] for r in boxes.nms(df, 0.5, block=block).collect())
        assert got == [1, 3, 4, 5, 6, 6, 8]
    assert boxes.nms(df.limit(0), 0.5).count() == 0


def test_votes_count_once_per_descriptor(spark, vectors):
    base = vectors([(1, [0.0]), (1, [0.1]), (1, [0.2]), (2, [5.0]), (2, [5.1])])
    asked = spark.createDataFrame([(9, 0, [0.0]), (9, 1, [0.1]), (9, 2, [5.0]), (9, 3, [5.1])], "image_id long, query_id long, vector array<double>")
    out = votes.vote_match(asked, base, 2, min_votes=2).orderBy("rank").collect()
    assert [(r["id"], r["votes"], r["confidence"]) for r in out] == [(1, 2, 50.0), (2, 2, 50.0)]
    best = votes.best_and_similar(votes.vote_match(asked, base, 2, min_votes=2)).first()
    assert best["best"] == 1 and best["similar"] == [2]


def test_auc_with_ties(spark):
    rows = [(float(s), bool(l)) for s, l in zip(RNG.integers(0, 6, 80), RNG.integers(0, 2, 80))]
    df = spark.createDataFrame(rows, "s double, l boolean")
    pos, neg = [s for s, l in rows if l], [s for s, l in rows if not l]
    want = np.mean([(p > q) + 0.5 * (p == q) for p in pos for q in neg])
    assert recommend.auc(df, F.col("l"), "s").first()[0] == pytest.approx(want)


def test_sparse_cells_add_up(spark):
    df = spark.createDataFrame([(7, 1, 2.0), (7, 1, 3.0), (5, 2, 1.0)], "user long, item long, rating double")
    assert {tuple(r) for r in recommend.to_sparse(df).collect()} == {(1, 0, 5.0), (0, 1, 1.0)}


def test_folds_and_rates(spark):
    n, folds = 23, 4
    a, b = RNG.normal(size=(n, 3)), RNG.normal(size=(n, 3))
    same = RNG.integers(0, 2, n).astype(bool)
    df = spark.createDataFrame([(i, a[i].tolist(), b[i].tolist(), bool(same[i])) for i in range(n)], "pair_id long, a array<double>, b array<double>, issame boolean")
    ts = [0.5 * i for i in range(30)]
    parts = np.array_split(np.arange(n), folds)
    for centred in (False, True):
        got = evaluate.roc_kfold(df, ts, folds, subtract_mean=centred).orderBy("fold").collect()
        for f, test in enumerate(parts):
            train = np.setdiff1d(np.arange(n), test)
            mean = np.concatenate([a[train], b[train]]).mean(0) if centred else 0.0
            d = (((a - mean) - (b - mean)) ** 2).sum(1)
            acc = [((d[train] < t) == same[train]).mean() for t in ts]
            t = ts[int(np.argmax(acc))]
            assert got[f]["threshold"] == t
            assert got[f]["accuracy"] == pytest.approx(((d[test] < t) == same[test]).mean())
    out = evaluate.val_at_far(df, 0.2, ts, folds).first()
    assert 0 <= out["val"] <= 1 and 0 <= out["far"] <= 1


def test_recall_of_the_truth_is_one(vectors):
    from kithra.operators import knn

    base = vectors(enumerate(RNG.normal(size=(40, 3))))
    truth = knn.knn_join(knn.as_queries(base), base, 4)
    curve = {r["t"]: (r["recall"], r["precision"]) for r in evaluate.recall_curve(truth, truth, 4, [1, 2, 4]).collect()}
    assert curve == {1: (0.25, 1.0), 2: (0.5, 1.0), 4: (1.0, 1.0)}


def test_ranking_metrics(spark):
    df = spark.createDataFrame([([0, 1, 0, 1],), ([0, 0, 0, 0],)], "eval array<int>")
    r = evaluate.ranking_metrics(df, 4).first()
    assert (r["mrr"], r["map"], r["precision_4"], r["recall_1_1"], r["recall_1_2"]) == (0.25, 0.25, 0.25, 0.0, 0.5)


def test_splits(spark):
    df = spark.range(200).withColumn("label", F.when(F.col("id") < 120, 0).otherwise(F.col("id") % 5))
    parts = splits.random_split(df, {"a": 0.5, "b": 0.3, "c": 0.2}, 1).groupBy("split").count().collect()
    assert sum(r["count"] for r in parts) == 200 and len(parts) == 3
    assert splits.prefix_split(df, 0.95).filter("train").count() == 190
    inside = splits.split_within_class(df, 0.25, 1)
    assert inside.groupBy("label").agg(F.sum(F.col("train").cast("int")).alias("t"), F.count("*").alias("n")).filter("t = n or t <> floor(n * 0.75)").count() == 0
    sides = splits.split_by_class(df, 0.4).groupBy("label").agg(F.countDistinct("train").alias("s"), F.first("train").alias("t")).collect()
    assert all(r["s"] == 1 for r in sides) and sum(r["t"] for r in sides) == 3
    assert sorted(r["id"] for r in splits.next_batch(df, 195, 8, ["id"]).collect()) == [0, 1, 2, 195, 196, 197, 198, 199]


def test_vector_files(spark, vectors, tmp_path):
    x = RNG.normal(size=(57, 5)).astype(np.float32)
    path = f"{tmp_path}/x"
    assert vecs.write_fvecs(vectors(enumerate(x)), path).agg(F.sum("rows")).first()[0] == 57
    back = vecs.read_fvecs(spark, path).orderBy("id").collect()
    assert [r["id"] for r in back] == list(range(57)) and np.array([r["vector"] for r in back], np.float32).tobytes() == x.tobytes()
    raw = b"".join(open(os.path.join(path, f), "rb").read() for f in sorted(os.listdir(path)) if f.startswith("part"))
    assert np.frombuffer(raw, "<i4")[0] == 5 and len(raw) == 57 * 24
    with pytest.raises(FileNotFoundError):
        vecs.load_benchmark(spark, str(tmp_path), "none")


def test_text_formats(spark, tmp_path):
    lines = tmp_path / "lines.txt"
    lines.write_text("5:a:b  \nno\n7: c ||| d\n")
    assert [(r["id"], r["text"]) for r in readers.read_id_text(spark, str(lines)).orderBy("id").collect()] == [(5, "a:b"), (7, " c ||| d")]
    assert [r["text"] for r in readers.read_lines(spark, str(lines)).orderBy("id").collect()] == ["5:a:b", "no", "7: c ||| d"]
    pairs = readers.read_sentence_pairs(spark, str(lines)).orderBy("unique_id").collect()
    assert (pairs[1]["text_a"], pairs[1]["text_b"]) == ("no", None) and pairs[2]["text_b"] == "d"
    kv = tmp_path / "kv.txt"
    kv.write_text("k\t1\x022.5\x01junk\n")
    assert readers.read_kv_embeddings(spark, str(kv)).first()[:] == ("k", [1.0, 2.5])
    parsed = spark.createDataFrame([("(1.0, -2.5, 3e-2)",)], "s string").select(readers.parse_embedding_text("s")).first()[0]
    assert parsed == [1.0, -2.5, 0.03]


def test_topk_text_has_no_trailing_separator(spark, tmp_path):
    found = spark.createDataFrame([(1, 1, 5, 0.5), (1, 2, -1, 0.0)], "query_id long, rank int, id long, distance double")
    assert writers.topk_lines(found).first()[0] == "1\t5\x020.5"


def test_wide_nodes_take_several_lines(spark, tmp_path):
    edges = spark.createDataFrame([(0, i) for i in range(50)] + [(1, 2)], "src long, dst long")
    lines = writers.adjacency_lines(edges, line_entries=10).collect()
    assert len(lines) > 4 and max(len(r["value"].split(",")) for r in lines) < 30
    path = str(tmp_path / "adj")
    writers.write_adjlist(edges, path)
    assert sorted(readers.read_adjlist(spark, f"{path}/int").select("src", "dst").collect()) == sorted(edges.collect())


def test_files_and_classes(spark, tmp_path):
    for name in ("b/2.jpg", "a/1.jpg", "a/x.txt", "a/deep/3.JPG"):
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(b"xy")
    files = readers.read_binary_files(spark, str(tmp_path)).orderBy("id").collect()
    assert [os.path.basename(r["path"]) for r in files] == ["1.jpg", "3.JPG", "2.jpg"] and files[0]["length"] == 2
    classes = readers.class_directory_dataset(spark, str(tmp_path)).select("class", "class_id").distinct().orderBy("class_id").collect()
    assert [r["class"] for r in classes] == ["a", "b", "deep"]
