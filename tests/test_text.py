import itertools
import random

import pytest
from pyspark.sql import functions as F

from kithra.functions import strings
from kithra.operators import setjoin, text


def corpus(n=140, seed=3):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)]
    base = [" ".join(rng.choices(words, weights=[1 / (i + 1) for i in range(60)], k=rng.randint(1, 14))) for _ in range(n // 2)]
    rows = list(base)
    for line in base[: n // 4]:
        parts = line.split(" ")
        parts[rng.randrange(len(parts))] = rng.choice(words)
        rows.append(" ".join(parts))
    rows += [base[0]] * (n - len(rows))  # a third or so are copies
    return list(enumerate(rows))


def brute_pairs(rows, t):
    reps = {}
    for i, line in rows:
        reps.setdefault(frozenset(line.split(" ")), i)
    out = set()
    for (x, i), (y, j) in itertools.combinations(reps.items(), 2):
        if len(x & y) / len(x | y) > t:
            out.add((min(i, j), max(i, j)))
    return out


@pytest.fixture
def texts(spark):
    return spark.createDataFrame(corpus(), "id long, text string")


@pytest.mark.parametrize("t", [0.1, 0.2, 0.4, 0.5, 0.7, 0.9])
def test_exact_join_against_all_pairs(texts, t):
    got = {(r["a"], r["b"]) for r in setjoin.jaccard_join(texts, None, t).collect()}
    assert got == brute_pairs(corpus(), t)


def test_crowded_words_are_split_without_loss(texts):
    got = {(r["a"], r["b"]) for r in setjoin.jaccard_join(texts, None, 0.4, bucket_rows=5).collect()}
    assert got == brute_pairs(corpus(), 0.4)


def test_pairs_below_the_threshold_leave_no_task(spark):
    """Every set shares ten words with every other; only the pairs that come near the threshold are handed on."""
    from kithra.operators import overlap

    rng = random.Random(5)
    common = [f"c{i}" for i in range(10)]
    sets = [common + [f"r{rng.randrange(4000)}" for _ in range(20)] for _ in range(300)]
    sets += [s[:-3] + ["x", "y", "z"] for s in sets[:20]]
    sets = [(i, sorted(set(s))) for i, s in enumerate(sets)]
    df = spark.createDataFrame(sets, "set_id long, words array<string>")

    def jac(x, y):
        return len(set(x) & set(y)) / len(set(x) | set(y))

    want = {(i, j) for (i, x), (j, y) in itertools.combinations(sets, 2) if jac(x, y) > 0.5}
    for rows in (1 << 16, 40):
        got = [(r["a"], r["b"]) for r in overlap.similar_sets(df, None, 0.5, rows).collect()]
        assert len(got) == len(set(got)) and want <= set(got) and len(got) <= 2 * len(want)
    both = {(r["a"], r["b"]) for r in overlap.similar_sets(df.filter("set_id < 50"), df, 0.5, 40).collect()}
    assert {(i, j) for i, x in sets[:50] for j, y in sets if jac(x, y) > 0.5} <= both


def test_copies_are_one_set_with_many_members(texts):
    sets, members = setjoin.distinct_sets(texts, hot_rows=10)
    assert members.count() == 140 and sets.agg(F.sum("copies")).first()[0] == 140
    assert sets.agg(F.max("copies")).first()[0] > 30


def test_bands_have_no_false_pairs_and_good_recall(texts):
    exact = brute_pairs(corpus(), 0.6)
    got = {(r["a"], r["b"]) for r in setjoin.minhash_lsh_join(texts, None, 0.6).collect()}
    assert got <= exact and len(got) >= 0.8 * len(exact)


def test_signature_is_the_minimum_over_words(spark):
    a, b = setjoin.permutations(16, 2)
    df = spark.createDataFrame([(0, ["x", "yy", "x z"])], "set_id long, words array<string>")
    import hashlib

    h = [int(hashlib.md5(w.encode()).hexdigest()[:8], 16) & 0x7FFFFFFF for w in ["x", "yy", "x z"]]
    want = [min((int(p) * v + int(q)) % setjoin.PRIME for v in h) for p, q in zip(a, b)]
    assert setjoin.minhash_signature(df, 16, 2).first()["signature"] == want


def test_text_neighbours_against_brute_force(spark):
    rows = [(i, line.upper() if i % 5 == 0 else line, line) for i, line in corpus(60)]
    df = spark.createDataFrame(rows, "id long, text string, lemma string")

    def jac(x, y):
        x, y = set(x.split(" ")), set(y.split(" "))
        return len(x & y) / len(x | y)

    for drop in (False, True):
        want = {}
        for i, ti, li in rows:
            hits = [(-jac(ti, tj), j) for j, tj, lj in rows if jac(li, lj) > 0.4 and jac(ti, tj) > 0.2 and not (drop and ti == tj)]
            want[i] = [j for _, j in sorted(hits)[:3]]
        got = {}
        for r in setjoin.text_neighbours(df, df, 3, 0.4, 0.2, remove_identical=drop).orderBy("query_id", "rank").collect():
            got.setdefault(r["query_id"], []).append(r["id"])
        assert got == {i: js for i, js in want.items() if js}


def test_bfs_rounds(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(6)] + [(0, 0), (3, 0)], "src long, dst long")
    seeds = spark.createDataFrame([(0,)], "id long")
    assert {(r["id"], r["depth"]) for r in setjoin.bfs(edges, seeds, 3).collect()} == {(0, 0), (1, 1), (2, 2), (3, 3)}
    assert setjoin.bfs(edges, seeds, 20).count() == 7


@pytest.mark.parametrize("raw,clean", [
    ("What's 12 + 345?", "whats <number> + <number>"),
    ("  A/B-test: (é) [ok]!", "a b test ok"),
    (None, ""),
    ("x9y10", "x<number>y<number>"),
])
def test_question_cleaning(spark, raw, clean):
    df = spark.createDataFrame([(raw,)], "t string")
    assert df.select(strings.normalize_question("t")).first()[0] == clean


def test_pair_packing_trims_the_longer_side(spark):
    def loop(a, b, length):
        a, b = list(a), list(b)
        while len(a) + len(b) > length - 3:
            (a if len(a) > len(b) else b).pop()
        return ["[CLS]", *a, "[SEP]", *b, "[SEP]"]

    cases = [(["a"] * i, ["b"] * j) for i in range(0, 9) for j in range(0, 9)]
    df = spark.createDataFrame([(n, a, b) for n, (a, b) in enumerate(cases)], "n int, a array<string>, b array<string>")
    for length in (8, 11):
        for r in text.pack_pair_tokens(df, "a", "b", length).collect():
            want = loop(*cases[r["n"]], length)
            assert r["tokens"] == want
            assert len(r["type_ids"]) == len(r["mask"]) == length
            assert sum(r["mask"]) == len(want) and sum(r["type_ids"]) == len(want) - want.index("[SEP]") - 1
    alone = df.withColumn("b", F.lit(None).cast("array<string>"))
    for r in text.pack_pair_tokens(alone, "a", "b", 6).collect():
        assert r["tokens"] == ["[CLS]", *cases[r["n"]][0][:4], "[SEP]"] and sum(r["type_ids"]) == 0


def test_encoder_registry(spark):
    df = spark.createDataFrame([(0, "a b a")], "id long, text string")
    text.register_encoder("length", lambda d, key="id", text="text": d.select(key, F.array(F.length(text).cast("double")).alias("vector")))
    assert text.encode_texts(df, "length").first()["vector"] == [5.0]
    assert sum(text.encode_one(spark, "a b a")) == 3.0
    with pytest.raises(ValueError):
        text.encode_texts(df, "missing")


def test_base64(spark):
    df = spark.createDataFrame([("aGk=",), ("aGk",), ("no!",), ("",), (None,)], "s string")
    assert [r[0] for r in df.select(strings.is_base64("s")).collect()] == [True, False, False, True, False]


def test_band_layout_moves_with_the_threshold():
    assert setjoin.band_layout(0.9, 128)[1] > setjoin.band_layout(0.3, 128)[1]


def test_document_pairs_hold_every_copy(spark, texts):
    rows = [(i, set(x.split(" "))) for i, x in corpus()]
    want = {(a, b) for a, wa in rows for b, wb in rows if a < b and len(wa & wb) / len(wa | wb) > 0.6}
    assert {(r["a"], r["b"]) for r in setjoin.jaccard_documents(texts, 0.6).collect()} == want
    root = {i: i for i, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in want:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    got = setjoin.families(setjoin.jaccard_join(texts, None, 0.6), setjoin.distinct_sets(texts)[1])
    assert {r["id"]: r["family"] for r in got.collect()} == {i: find(i) for i, _ in rows}


def test_sample_draws_from_all_copies(spark):
    rows = spark.createDataFrame([(i, "one two three four", "one two three four") for i in range(40)], "id long, text string, lemma string")
    got = setjoin.text_neighbours(rows.filter("id < 6"), rows, 3, 0.4, 0.2, mode="sample").collect()
    assert len(got) == 18 and len({r["id"] for r in got}) > 8


def test_bfs_runs_to_the_end(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(14)], "src long, dst long")
    seeds = spark.createDataFrame([(0,)], "id long")
    assert setjoin.bfs(chain, seeds).count() == 15 and setjoin.bfs(chain, seeds, 3).count() == 4
