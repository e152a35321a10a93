import random
import re

import numpy as np
import pytest

from kithra.llm import bytewords, ngramjoin
from kithra.llm.components import components


def shingles(text, width):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if len(words) < width:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i:i + width]) for i in range(len(words) - width + 1))


def brute(rows, width, percent):
    """Component of each key; rows that repeat a key are one document."""
    sets = [(k, shingles(t, width)) for k, t in rows]
    root = {k: k for k, _ in rows if k is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (a, sa) in enumerate(sets):
        for b, sb in sets[:i]:
            if a is not None and b is not None and sa and sb and 100 * len(sa & sb) >= percent * len(sa | sb):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {k: find(k) for k in root}


def family(rng, base, n, edits, start):
    out = []
    for i in range(n):
        words = list(base)
        for _ in range(rng.randint(0, edits)):
            words[rng.randrange(len(words))] = f"e{rng.random()}"
        out.append((start + i, " ".join(words)))
    return out


def corpus(seed=0):
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdefghij") + str(rng.randint(0, 300))
    rows = [(i, " ".join(word() for _ in range(rng.randint(1, 60)))) for i in range(120)]
    # graded near copies: some link to some, a chain links most
    for f in range(3):
        rows += family(rng, [word() for _ in range(90)], 45, 8, 200 + 100 * f)
    rows += [(600 + i, "Same  words\there TODAY") for i in range(20)] + [(630, "same words here today")]
    rows += [(700, None), (701, ""), (702, " \t"), (703, "one"), (704, "ONE"), (None, "one"), (None, None), (705, "long " * 30000)]
    rows += [(800, rows[130][1]), (800, "quite another text of a few words")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("width, percent", [(3, 90), (5, 80)])
def test_components_equal_brute_force(documents, monkeypatch, width, percent):
    monkeypatch.setattr(ngramjoin, "PAIR_UP", 6)  # most groups go block by block
    monkeypatch.setattr(ngramjoin, "CELL_ELEMENTS", 1500)
    rows = corpus(percent)
    got = ngramjoin.ngram_jaccard_classes(documents(rows), width=width, percent=percent).collect()
    want = brute(rows, width, percent)
    assert sorted((repr(r["doc_id"]), r["n_shingles"], r["component_id"]) for r in got if r["doc_id"] is not None) == sorted(
        (repr(k), len(shingles(t, width)), want[k]) for k, t in rows if k is not None)
    assert all(r["component_id"] is None for r in got if r["doc_id"] is None)
    assert sum(r["doc_id"] is None for r in got) == 2


def test_empty_table(documents):
    assert ngramjoin.ngram_jaccard_classes(documents([(1, "x")]).limit(0)).collect() == []
    assert ngramjoin.ngram_jaccard_classes(documents([(1, None), (2, "")])).count() == 2


@pytest.mark.parametrize("percent", [80, 90])
def test_linked_sets_share_a_named_part(percent):
    rng = np.random.default_rng(percent)
    edges = ngramjoin.bands(4000)
    hot = np.sort(rng.integers(0, 2**63, 30).astype(np.uint64))
    for _ in range(400):
        n = int(rng.integers(1, 300))
        a = np.unique(np.concatenate([rng.integers(0, 2**63, n).astype(np.uint64), hot[:int(rng.integers(0, 20))]]))
        change = int(rng.integers(0, ngramjoin.differing(len(a), percent) + 1))
        b = np.unique(np.concatenate([a[change // 2:], rng.integers(0, 2**63, change - change // 2).astype(np.uint64)]))
        both = len(np.intersect1d(a, b))
        if not len(b) or 100 * both < percent * (len(a) + len(b) - both):
            continue

        def keys(x):
            band, own_at, own, next_at, following = ngramjoin.sketch_parts(x, edges, percent, hot)
            return {(band, *p) for p in zip(own_at.tolist(), own.tolist())} | {(band + 1, *p) for p in zip(next_at.tolist(), following.tolist())}

        assert keys(a) & keys(b)


def test_words_and_shingles_of_bytes():
    import pyarrow as pa

    texts = ["A b\x0bc", None, "", "x", "é è\x85ê", "a b c d a b c"]
    got = [len(x) for x in bytewords.shingle_sets(pa.array(texts), 3)]
    assert got == [len(shingles(t, 3)) for t in texts]
    assert bytewords.word_counts(pa.array(texts)).tolist() == [3, 0, 0, 1, 2, 7]
    a, b = bytewords.shingle_sets(pa.array(["X Y Z", "x  y\nz"]), 3)
    assert (a == b).all()


def test_components_of_chains(spark):
    rng = random.Random(1)
    links = [(i, i + 1) for i in range(0, 60)] + [(100, 101), (101, 99), (7, 7), (200, 150), (150, 200)]
    rng.shuffle(links)
    got = {r["id"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, 99: 99, 100: 99, 101: 99, 150: 150, 200: 150}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


@pytest.mark.parametrize("percent", [1, 10, 33, 50, 70, 76, 77, 80, 90])
def test_linked_sizes_lie_in_neighbouring_bands(percent):
    edges = ngramjoin.bands(100 * 3000 // percent, percent)
    small = np.arange(1, 3000)
    apart = np.searchsorted(edges, 100 * small // percent, side="right") - np.searchsorted(edges, small, side="right")
    assert apart.max() <= 1


@pytest.mark.parametrize("percent", [10, 50])
def test_links_of_far_sizes(documents, percent):
    rng = random.Random(percent)
    rows = []
    for f in range(12):
        words = [f"w{f}x{i}" for i in range(2 + rng.randint(5, 20) * 100 // percent)]
        rows += [(10 * f, " ".join(words)), (10 * f + 1, " ".join(words[:2 + -(-(len(words) - 2) * percent // 100)]))]
        rows += [(10 * f + 2, " ".join(words[:1 + (len(words) - 2) * percent // 200]))]
    rows += [(990, " ".join(f"long{i}" for i in range(402))), (991, " ".join(f"long{i}" for i in range(2 + 4 * percent)))]
    got = {r["doc_id"]: r["component_id"] for r in ngramjoin.ngram_jaccard_classes(documents(rows), percent=percent).collect()}
    assert got == brute(rows, ngramjoin.WIDTH, percent)
    assert got[1] == 0 and got[991] == 990


def test_parts_are_shuffled_once(spark):
    rows = [(i, v) for i in range(60) for v in (i, i % 7 + 1000, 5000)] + [(3, 9000), (3, 9000)]
    parts = spark.createDataFrame(rows, "id long, value long").selectExpr("id", "explode(array(value)) value")
    found = ngramjoin.shared_parts(parts)
    assert {tuple(r) for r in found.collect()} == {(v, i) for i in range(60) for v in (i % 7 + 1000, 5000)}
    plan = found._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    assert "ReusedExchange" in final


def test_near_members_take_little_memory():
    import tracemalloc

    import pyarrow as pa

    rng = np.random.default_rng(5)
    n = 2 * ngramjoin.NEAR_ROWS  # two full blocks meet in a cell
    first = rng.integers(-2**62, 2**62, 4)
    bits = np.where(rng.random((n, 1)) < 0.5, first, rng.integers(-2**62, 2**62, (n, 4)))
    bits[:, 0] ^= 1 << rng.integers(0, 60, n)
    table = pa.table({
        "id": np.arange(n), "component": np.arange(n) // 2, "n_shingles": np.full(n, 200), "band": pa.array(np.full(n, 9), pa.int32()),
        "own_bits": pa.array(list(bits)), "next_bits": pa.array([[]] * n, pa.list_(pa.int64()))})
    tracemalloc.start()
    try:
        got = ngramjoin.near_members(table, 80)["id"].to_pylist()
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert got == np.flatnonzero((bits[:, 1:] == first[1:]).all(axis=1)).tolist()
    assert peak < 32 << 20
