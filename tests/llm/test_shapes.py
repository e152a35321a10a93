"""Fill-in-the-middle, vector codes and shared lines against plain Python."""

import hashlib
import re
from collections import defaultdict

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kithra.llm import dualtree, lineruns, skiplist

# ------------------------------------------------------------ fill in the middle

TEXTS = [(i, t) for i, t in enumerate(
    ["", None, "a", "ab", "é𝄞x" * 7, "has <M> inside", "x<", "<S" * 9, "word " * 4000, "line\nline\r\n\n", "日本語の文章です。" * 30] * 9)]
TEXTS += [(3, "repeated"), (3, "repeated"), (None, "no key at all"), (-5, "below zero")]


def plain_cut(key, text):
    text = text or ""
    said = hashlib.sha256(f"1:{'' if key is None else key}".encode()).hexdigest()
    h = [int(said[8 * i:8 * i + 8], 16) for i in range(4)]
    n = len(text)
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= 90:
        return key, n, "plain", None, None, text
    low, high = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    pre, mid, suf = text[:low], text[low:high], text[high:]
    form = "spm" if h[3] % 100 < 20 else "psm"
    return key, n, form, low, high - low, f"<P>{pre}<S>{suf}<M>{mid}" if form == "psm" else f"<S>{suf}<P>{pre}<M>{mid}"


def test_cuts_equal_plain_python(documents):
    out = skiplist.fill_in_middle(documents(TEXTS)).withColumn("back", skiplist.restored())
    rows = out.collect()
    assert sorted(map(repr, (tuple(r)[:6] for r in rows))) == sorted(repr(plain_cut(k, t)) for k, t in TEXTS)
    assert {r["form"] for r in rows} == {"plain", "psm", "spm"}
    assert sorted(map(repr, ((r["doc_id"], r["back"]) for r in rows))) == sorted(repr((k, t or "")) for k, t in TEXTS)
    assert skiplist.fill_in_middle(documents(TEXTS).limit(0)).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 9), max_size=300), st.data())
def test_descent_adds_both_widths(widths, data):
    starts = np.cumsum([0, *widths])
    units = skiplist.SkipList(starts)
    for rank in {0, len(widths), data.draw(st.integers(0, len(widths)))}:
        assert units.reach(rank) == starts[rank]


def test_long_lists_have_lanes_and_exact_ranks():
    starts = np.cumsum(np.append(0, np.arange(200_000) % 7 + 1))
    units = skiplist.SkipList(starts)
    sizes = [len(unit_widths) for unit_widths, _, _ in units.lanes]
    assert len(sizes) > 4 and sizes == sorted(sizes, reverse=True) and all(u.sum() == 200_000 and p.sum() == starts[-1] for u, p, _ in units.lanes)
    for rank in (0, 1, 99_999, 199_999, 200_000, *range(5, 200_000, 3_333)):
        assert units.reach(rank) == starts[rank]


def test_units_of_a_pattern(documents):
    rows = [(i, "ein Wort, zwei\n Wörter  und 日本 mehr") for i in range(40)]
    words = re.compile(r"\w+\s*")
    ends = [m.start() for m in words.finditer(rows[0][1])] + [len(rows[0][1])]
    ends += [i for i, c in enumerate(rows[0][1]) if c == ","]  # not covered: a unit of its own
    out = skiplist.fill_in_middle(documents(rows), unit=r"\w+\s*").withColumn("back", skiplist.restored()).collect()
    assert {r["n"] for r in out} == {len(set(ends)) - 1 + rows[0][1].count(", ")}
    for r in out:
        assert r["back"] == rows[0][1]
        if r["form"] != "plain":
            places = {m.start() for m in re.finditer(r"\w+\s*|.", rows[0][1], re.S)} | {len(rows[0][1])}
            assert {r["prefix_chars"], r["prefix_chars"] + r["middle_chars"]} <= places


def test_markers_that_cannot_be_told_apart():
    for bad in (("<a>", "<a><b>", "<c>"), ("aa", "ab", "c"), ("", "b", "c"), ("xy", "yz", "q")):
        with pytest.raises(ValueError):
            skiplist.check_markers(bad)


# ------------------------------------------------------------------ vector codes

def plain_codes(rows, parts=8, entries=16, rounds=6):
    """Lloyd rounds over Python integers: (codes by row, codebooks)."""
    kept = [(k, lab, [int(np.floor(4096.0 * x)) for x in v]) for k, v, lab in rows
            if v is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    width = len(kept[0][2]) // parts
    cut = [[v[p * width:(p + 1) * width] for _, _, v in kept] for p in range(parts)]
    books = [[list(x) for x in cut[p][:entries]] for p in range(parts)]

    def near(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), i) for i, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            mine = defaultdict(list)
            for x in cut[p]:
                mine[near(x, books[p])[1]].append(x)
            for i, xs in mine.items():
                books[p][i] = [sum(c) // len(xs) for c in zip(*xs)]
    out, by_label = [], defaultdict(int)
    for n, (k, lab, _) in enumerate(kept):
        found = [near(cut[p][n], books[p]) for p in range(parts)]
        error = sum(d for d, _ in found)
        by_label[lab] += error
        out.append((k, "".join(f"{i:02x}" for _, i in found), error, lab))
    said = ",".join(str(x) for book in books for e in book for x in e)
    return [(k, c, e, by_label[lab]) for k, c, e, lab in out], hashlib.sha256(said.encode()).hexdigest()


def vector_table(spark, rows, partitions=3):
    df = spark.createDataFrame([(k, v, lab) for k, v, lab in rows], "vec_id long, embedding array<double>, label int")
    return df.repartition(partitions).selectExpr("*", "1 key", "2 v", "'x' code", "3 n", "4 known")


def check_codes(spark, rows, **options):
    coded, books = dualtree.encode(vector_table(spark, rows), **options)
    want, sha = plain_codes(rows, **options)
    assert sorted(map(repr, (tuple(r) for r in coded.collect()))) == sorted(map(repr, want))
    assert books.sha256() == sha


def test_codes_equal_plain_lloyd(spark):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(6, 16))
    rows = [(int(i), (centres[i % 6] + rng.normal(size=16) * 0.05).tolist(), int(i) % 3 if i % 4 else None) for i in rng.permutation(300)]
    rows += [(1000, None, 1), (1001, [None] * 16, 1), (1002, [float("nan")] + [0.0] * 15, 2), (1003, [float("inf")] * 16, 2), (1004, [], 1)]
    rows += [(7, [0.25] * 16, 1)] * 60 + [(None, [-0.25] * 16, None)] * 5  # a hot vector, repeated and missing ids
    check_codes(spark, rows)
    check_codes(spark, rows, parts=4, entries=3, rounds=2)


def test_codes_of_ties_and_few_rows(spark):
    check_codes(spark, [(i, [float(i % 2), -float(i % 3)] * 4, i % 2) for i in range(40)], parts=4)
    check_codes(spark, [(2, [1.0] * 8, None), (1, [1.0] * 8, None)])
    coded, _ = dualtree.encode(vector_table(spark, [(1, None, 1)]))
    assert coded.collect() == [] and coded.columns == ["vec_id", "code", "error", "label_error"]


def test_other_lengths_are_left_out(spark):
    coded, _ = dualtree.encode(vector_table(spark, [(1, [1.0] * 16, 1), (2, [2.0] * 16, 1), (3, [3.0] * 8, 1), (4, [1e9] * 16, 1)]))
    assert sorted(r["vec_id"] for r in coded.collect()) == [1, 2]
    with pytest.raises(ValueError):
        dualtree.encode(vector_table(spark, [(1, [1.0] * 9, 1)]))


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 200), st.integers(1, 20), st.integers(1, 5), st.integers(1, 40), st.integers(0, 1 << 30))
def test_traversal_equals_brute_force(n, k, d, spread, seed):
    rng = np.random.default_rng(seed)
    points, entries = rng.integers(-spread, spread, (n, d)), rng.integers(-spread, spread, (k, d))
    order, bounds = dualtree.leaf_order(points, 8)
    assert sorted(order) == list(range(n)) and np.diff(bounds).max() <= 8
    mine = points[order]
    tree = dualtree.Tree.over(mine, bounds)
    want = ((mine[:, None, :] - entries[None]) ** 2).sum(axis=2).argmin(axis=1)
    assert (dualtree.assigned_codes(tree, mine, entries) == want).all()
    counts, sums = dualtree.assigned_sums(tree, mine, entries)
    assert (counts == np.bincount(want, minlength=k)).all()
    assert all((sums[e] == mine[want == e].sum(axis=0)).all() for e in range(k))


def test_clustered_parts_are_assigned_by_the_node():
    rng = np.random.default_rng(2)
    centres = rng.integers(-4096, 4096, (16, 8))
    points = np.repeat(centres, 500, axis=0) + rng.integers(-40, 40, (8000, 8))
    order, bounds = dualtree.leaf_order(points, dualtree.LEAF)
    nodes, _, who, _ = dualtree.nearest_entries(dualtree.Tree.over(points[order], bounds), points[order], centres)
    assert len(who) < 1000 and len(nodes) < 400


# ------------------------------------------------------------------ shared lines

LONG = "this Line is long enough to Count as one of them"
LINES = [(i, f"{LONG}\n  {LONG.upper()}\t\nown line of document number {i} that stands once only\nshort") for i in range(1, 8)]
LINES += [(20, f"\r{LONG} \x0b\n{LONG}x"), (21, None), (22, ""), (23, "\n"), (24, "\n\n" + LONG + "\n"), (25, LONG + "x")]
LINES += [(i, "x" * 39 + "\n" + "é" * 40 + "\n" + "É" * 40 + "\nİ" * 1 + "Ä" * 45) for i in range(30, 36)]
LINES += [(40, "four documents hold this line and no more than that"), (41, "four documents hold this line and no more than that")] * 3
LINES += [(42, "four documents hold this line and no more than that"), (43, "four documents hold this line and no more than that")]
LINES += [(None, LONG), (None, LONG), (50, "z" * 50 + "\n" + ("w" * 60 + "\n") * 3000), (50, "z" * 50), (51, LONG), (51, LONG)]
LINES += [(k, "no key counts once only, as a document below the others") for k in (None, None, None, None, 60, 61, 62)]


def plain_lines(rows, least=40, docs=5):
    def key(line):
        bare = line.strip(" \t\n\x0b\f\r")
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in bare)

    holders = defaultdict(set)
    for k, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= least:
                holders[key(line)].add(k)
    last = {x: max(k for k in ks if k is not None) for x, ks in holders.items() if len(ks) >= docs}
    out = []
    for k, t in rows:
        lines = (t or "").split("\n")
        gone = [i for i, line in enumerate(lines) if key(line) in last and last[key(line)] != k]
        out.append((k, len(lines), len(gone), gone, "\n".join(x for i, x in enumerate(lines) if i not in set(gone))))
    return sorted(map(repr, out))


@pytest.mark.parametrize("options", [{}, {"batches": 1}, {"batches": 7, "fanout": 3}, {"min_docs": 2, "min_chars": 4}])
def test_shared_lines_equal_plain_python(documents, options):
    got = lineruns.drop_shared_lines(documents(LINES), **options).collect()
    want = plain_lines(LINES, options.get("min_chars", 40), options.get("min_docs", 5))
    assert sorted(repr(tuple(r)) for r in got) == want


def test_lines_of_no_rows(documents):
    assert lineruns.drop_shared_lines(documents(LINES).limit(0)).collect() == []
    nulls = lineruns.drop_shared_lines(documents([(None, None), (1, None)])).collect()
    assert sorted(repr(tuple(r)) for r in nulls) == sorted(repr((k, 1, 0, [], "")) for k in (None, 1))


def test_runs_are_levelled_and_batches_anti_joined(spark, tmp_path):
    runs = lineruns.LineRuns(spark, str(tmp_path), fanout=2)
    for n in range(5):
        rows = [(1, 1, 10 - n, 2), (n, 2, 10 - n, 1)]
        runs.add(spark.createDataFrame(rows, "high long, low long, holder long, docs long"))
    assert [len(level) for level in runs.levels] == [1, 0, 1]
    # the last run holds its new line with its holder, the known one with a count alone
    assert sorted(tuple(r) for r in runs.levels[0][0].collect()) == [(1, 1, None, 2), (4, 2, 6, 1)]
    assert {tuple(r) for r in runs.merged().collect()} == {(1, 1, 10, 10), *((n, 2, 10 - n, 1) for n in range(5))}
    plan = runs.runs[0].join(runs.runs[1], lineruns.DIGEST, "full")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    runs.forget()


def test_sql_of_the_three(spark):
    from kithra.llm import q_shapes
    from kithra.llm.catalog import ORACLES

    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for name in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    for name in ("op11_fill_in_middle", "op12_vector_codes", "op13_shared_lines"):
        df = getattr(q_shapes, name)(spark, sf)
        found = con.execute(ORACLES[name])
        columns = [c[0] for c in found.description]
        want = sorted(map(repr, found.fetchall()))
        assert sorted(repr(tuple(r[c] for c in columns)) for r in df.select(*[F.col(c) for c in columns]).collect()) == want
