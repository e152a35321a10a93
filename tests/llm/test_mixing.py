from collections import Counter, defaultdict

import pytest

from kithra.llm import mixing


def targets(sizes, weights, ceiling):
    total, capped = sum(sizes.values()), {}
    while True:
        free = [s for s in sizes if s not in capped]
        rest = total - sum(capped.values())
        share = {s: rest * weights[s] / sum(weights[f] for f in free) for s in free}
        above = [s for s in free if share[s] > ceiling * sizes[s]]
        if not above:
            return capped | share
        capped |= {s: ceiling * sizes[s] for s in above}


ROWS = [(i, "w " * (i * 7 % 40 + 1), s) for i, s in enumerate(["a"] * 90 + ["b"] * 6 + ["\U0001f600"] * 30 + ["￿"] * 20 + [None] * 9)]


def test_targets_and_takes(documents):
    rows = mixing.mix(documents(ROWS)).collect()
    size = defaultdict(int)
    for i, t, s in ROWS:
        size[s] += len(t.split())
    order = ["a", "b", "￿", "\U0001f600", None]
    want = targets(size, dict(zip(order, [5, 2, 1, 5, 2])), 3)
    taken = Counter()
    for r in rows:
        source = ROWS[r["doc_id"]][2]
        assert r["size"] == len(ROWS[r["doc_id"]][1].split()) and r["source_size"] == size[source]
        assert r["target"] == pytest.approx(want[source])
        assert 0 <= r["copies"] <= 3 and r["taken"] == r["copies"] * r["size"]
        taken[source] += r["taken"]
    assert len(rows) == len(ROWS)
    for s in order:
        assert abs(taken[s] - want[s]) <= 2 * 40  # about the largest text


def test_systematic_by_hand(spark):
    df = spark.createDataFrame([(k, "g", 0.4 + (k % 3)) for k in range(50)], "k long, g string, e double")
    got = {r["k"]: r["copies"] for r in mixing.systematic_copies(df.repartition(5), "g", ["k"], "e", seed=3).collect()}
    units = [round((0.4 + k % 3) * mixing.UNITS) for k in range(50)]
    assert any(
        all(got[k] == (u + sum(units[:k + 1])) // mixing.UNITS - (u + sum(units[:k])) // mixing.UNITS for k in range(50))
        for u in range(0, mixing.UNITS, 100_000 // 10))


def test_reruns_agree_whatever_the_partitions(documents):
    first = sorted(map(tuple, mixing.mix(documents(ROWS, 2)).select("doc_id", "taken").collect()))
    assert first == sorted(map(tuple, mixing.mix(documents(ROWS, 7)).select("doc_id", "taken").collect()))


def test_nulls_copies_and_nothing(documents):
    rows = [(None, None, None), (None, "", None), (1, "a b", "x"), (1, "a b", "x"), (1, "b c", "x"), (2, None, "y"), (3, "z " * 50000, "y")]
    df = documents(rows)
    drawn = mixing.mix(df).collect()
    assert len(drawn) == len(rows) and {r["size"] for r in drawn} == {0, 2, 50000}
    out = mixing.mixed(df)
    assert out.columns == df.columns
    assert out.count() == sum(r["copies"] for r in drawn)
    assert mixing.mix(df.limit(0)).collect() == [] and mixing.mixed(df.limit(0)).collect() == []
    none = documents([(1, "", "a"), (2, None, "b")])
    assert {(r["target"], r["taken"]) for r in mixing.mix(none).collect()} == {(0.0, 0)}
