"""Near-duplicate text by word-set similarity.

Texts with equal word sets are folded into one set first, so a group of copies
of any size costs one row; the member table keeps every text.  Pairs are then
found between distinct sets, exactly (prefix filter) or by MinHash bands.
"""

from __future__ import annotations

import hashlib
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import kernels
from ..functions.arrowmap import release, with_arrow_column
from ..functions.hashing import keyed_hash, token_hash31
from ..functions.strings import word_set, words
from ..session import materialize
from . import overlap, skew
from .blockjoin import grid, small_side

BUCKET_ROWS = 4096  # rows of one band that one task may pair up
PRIME = (1 << 31) - 1  # fixed value: modulus of the MinHash permutations


# ------------------------------------------------------------------ word sets

def _signed(texts: DataFrame, key, text) -> DataFrame:
    # words hold no spaces, so the joined text stands for the set; it is also shorter than an array of words
    rows = texts.select(F.col(key).alias("id"), F.array_join(F.sort_array(word_set(text)), " ").alias("joined"))
    return rows.withColumn("sig", F.sha2("joined", 256))


def word_sets(texts: DataFrame, key="id", text="text") -> DataFrame:
    """Distinct word sets ``(set_id, words, copies)``; ``set_id`` is the lowest id of the set."""
    sets = _signed(texts, key, text).groupBy("sig").agg(
        F.min("id").alias("set_id"), F.first("joined").alias("joined"), F.count("*").alias("copies"))
    return sets.select("set_id", words("joined").alias("words"), "copies")


def distinct_sets(texts: DataFrame, key="id", text="text", hot_rows=skew.HOT_ROWS) -> tuple[DataFrame, DataFrame]:
    """``word_sets`` and their members ``(set_id, id)``.

    Copies are folded inside each partition before the shuffle, so a large
    group of them travels as one row.
    """
    signed = _signed(texts, key, text).select("id", "sig")
    found = signed.groupBy("sig").agg(F.min("id").alias("set_id"), F.count("*").alias("copies"))
    members = skew.lookup_join(signed, found, "sig", "copies", hot_rows).select("set_id", "id")
    return word_sets(texts, key, text), members


# ------------------------------------------------------------ exact set join

def _verified(candidates: DataFrame, left: DataFrame, right: DataFrame, threshold: float) -> DataFrame:
    """Exact Jaccard of candidate ``(a, b)`` pairs of sets ``(set_id, words)``, strictly above the threshold."""
    found = materialize(candidates.distinct(), "candidates")

    def words_of(sets, key, name):
        wanted = small_side(found.select(F.col(key).alias("set_id")).distinct())
        return sets.join(wanted, "set_id", "left_semi").select(F.col("set_id").alias(key), F.array_join("words", " ").alias(name))

    rows = found.join(words_of(left, "a", "wa"), "a").join(words_of(right, "b", "wb"), "b")
    return rows.select("a", "b", "wa", "wb").mapInArrow(_overlaps(threshold), "a long, b long, jaccard double")


def _overlaps(threshold):
    """Exact Jaccard of rows ``(a, b, wa, wb)`` of joined words; a set that comes again is not split again."""
    def run(batches):
        for batch in batches:
            last, right, jaccard = None, set(), np.empty(batch.num_rows)
            wa, wb = batch.column(2), batch.column(3)
            for i in range(batch.num_rows):
                words_b = wb[i].as_py()
                if words_b != last:
                    last, right = words_b, set(words_b.split(" "))
                left = wa[i].as_py().split(" ")
                common = len(right.intersection(left))
                jaccard[i] = common / (len(left) + len(right) - common)
            found = pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(jaccard)], ["a", "b", "jaccard"])
            yield found.filter(pa.array(jaccard > threshold))
        release()

    return run


def jaccard_join(a: DataFrame, b: DataFrame | None, threshold: float, **options) -> DataFrame:
    """Pairs of distinct word sets ``(a, b, jaccard)`` of two text tables ``(id, text)``, or of one."""
    left = materialize(word_sets(a), "sets")
    right = None if b is None else materialize(word_sets(b), "sets")
    return _joined_sets(left, right, threshold, **options)


def _joined_sets(left, right, threshold, bucket_rows=overlap.BLOCK_ROWS):
    if not 0 < threshold < 1:
        raise ValueError("threshold must lie between 0 and 1")
    found = overlap.similar_sets(left, right, threshold, bucket_rows)
    return _verified(found, left, left if right is None else right, threshold)


def document_pairs(pairs: DataFrame, members: DataFrame, other: DataFrame | None = None) -> DataFrame:
    """``(a, b, jaccard)`` of documents, from pairs of sets and their members ``(set_id, id)``.

    Within one table documents of one set are pairs too, and a < b.  The result
    has as many rows as there are similar documents; ``families`` is the form
    whose size stays with the input.
    """
    left = members.select(F.col("set_id").alias("a"), F.col("id").alias("ida"))
    right = (members if other is None else other).select(F.col("set_id").alias("b"), F.col("id").alias("idb"))
    both = pairs.select("a", "b", "jaccard").join(left, "a").join(right, "b").select("ida", "idb", "jaccard")
    if other is not None:
        return both.select(F.col("ida").alias("a"), F.col("idb").alias("b"), "jaccard")
    same = left.join(right, left["a"] == right["b"]).filter("ida < idb").select("ida", "idb", F.lit(1.0).alias("jaccard"))
    return both.unionByName(same).select(F.least("ida", "idb").alias("a"), F.greatest("ida", "idb").alias("b"), "jaccard")


def jaccard_documents(texts: DataFrame, threshold: float, **options) -> DataFrame:
    """Pairs of documents ``(a, b, jaccard)``, a < b, those with equal word sets included."""
    sets, members = distinct_sets(texts)
    sets, members = materialize(sets, "sets"), materialize(members, "members")
    return document_pairs(materialize(_joined_sets(sets, None, threshold, **options), "set-pairs"), members)


def families(pairs: DataFrame, members: DataFrame) -> DataFrame:
    """``(id, family)`` of every document: the lowest id that a chain of pairs of sets leads to."""
    label = materialize(members.select("set_id").distinct().withColumn("family", F.col("set_id")), "family")
    both = materialize(pairs.select("a", "b").unionAll(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))), "links")
    while True:
        seen = both.join(label.select(F.col("set_id").alias("b"), "family"), "b").groupBy("a").agg(F.min("family").alias("_least"))
        near = label.join(seen.withColumnRenamed("a", "set_id"), "set_id", "left").select(
            "set_id", F.least("family", "_least").alias("family"), "_least", F.col("family").alias("_was"))
        # a label is itself a set; taking its label in turn halves the way
        near = near.join(near.select(F.col("set_id").alias("family"), F.col("family").alias("_far")), "family").select(
            "set_id", F.least("family", "_far").alias("family"), "_was")
        near = materialize(near, "family")
        label = near.select("set_id", "family")
        if not near.filter("family <> _was").limit(1).count():
            return members.join(label, "set_id").select("id", "family")


# ----------------------------------------------------------------- MinHash

def permutations(n_perm: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Coefficients of h ↦ (a·h + b) mod prime."""
    def draw(name, i):
        return int(hashlib.md5(f"{name}:{i}:{seed}".encode()).hexdigest()[:8], 16)

    a = np.array([1 + draw("a", i) % (PRIME - 1) for i in range(n_perm)], np.int64)
    b = np.array([draw("b", i) % PRIME for i in range(n_perm)], np.int64)
    return a, b


def minhash_signature(sets: DataFrame, n_perm: int = 256, seed: int = 0, words="words", out="signature") -> DataFrame:
    """Adds one minimum per permutation over the 31-bit hashes of the words."""
    a, b = permutations(n_perm, seed)

    def minima(h: pa.Array) -> pa.Array:
        flat = h.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        ends = np.cumsum(np.diff(h.offsets.to_numpy()))
        starts = np.r_[0, ends[:-1]]
        out = np.empty((len(h), n_perm), np.int64)
        # rows are taken in runs of bounded token count
        lo = 0
        while lo < len(h):
            hi = max(lo + 1, int(np.searchsorted(ends, starts[lo] + 8192, side="right")))
            part = (flat[starts[lo]:ends[hi - 1], None] * a[None, :] + b[None, :]) % PRIME
            out[lo:hi] = np.minimum.reduceat(part, starts[lo:hi] - starts[lo], axis=0)
            lo = hi
        return kernels.list_array(out, pa.int64())

    hashed = sets.filter(F.size(words) > 0).withColumn("_h", F.transform(words, token_hash31))
    return with_arrow_column(hashed, out, "array<bigint>", "_h", minima).drop("_h")


def band_layout(threshold: float, n_perm: int) -> tuple[int, int]:
    """(bands, rows) with the least false-positive plus false-negative area."""
    best = None
    grid_points = np.linspace(0, 1, 1001)
    for rows in range(1, n_perm + 1):
        for bands in range(1, n_perm // rows + 1):
            hit = 1 - (1 - grid_points**rows) ** bands
            wrong = np.where(grid_points < threshold, hit, 1 - hit).mean()
            if best is None or wrong < best[0]:
                best = (wrong, bands, rows)
    return best[1], best[2]


def lsh_candidates(left: DataFrame, right: DataFrame | None, bands: int, rows: int, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """``(a, b)`` pairs sharing a band; inputs are ``(set_id, signature)``."""
    def banded(df):
        parts = F.transform(F.sequence(F.lit(0), F.lit(bands - 1)),
                            lambda i: F.struct(i.alias("band"), F.xxhash64(F.slice("signature", i * rows + 1, F.lit(rows))).alias("h")))
        return df.select("set_id", F.explode(parts).alias("p")).select("set_id", F.struct("p.band", "p.h").alias("bucket"))

    own = right is None
    lb = banded(left)
    lb, rb = grid(lb, lb if own else banded(right), "bucket", bucket_rows, bucket_rows, F.xxhash64("set_id"), F.xxhash64("set_id"))
    pairs = lb.withColumnRenamed("set_id", "a").join(rb.withColumnRenamed("set_id", "b"), ["bucket", "_lb", "_rb"])
    if own:
        pairs = pairs.filter(F.col("a") < F.col("b"))
    return pairs.select("a", "b").distinct()


def minhash_lsh_join(
    a: DataFrame, b: DataFrame | None, threshold: float, n_perm: int = 256, seed: int = 0, layout=None, min_words: int = 0,
) -> DataFrame:
    """Pairs of distinct word sets found by banded MinHash and verified exactly.

    No false positives; ``min_words`` leaves out sets of fewer words (of the stored side).
    """
    left = materialize(word_sets(a), "sets")
    right = None if b is None else materialize(word_sets(b), "sets")
    return _lsh_joined_sets(left, right, threshold, n_perm, seed, layout, min_words)


def _lsh_joined_sets(left, right, threshold, n_perm, seed, layout=None, min_words=0):
    bands, rows = layout or band_layout(threshold, n_perm)
    long_enough = F.size("words") >= min_words
    left = left.filter(long_enough) if right is None else left
    right = None if right is None else right.filter(long_enough)

    def signed(sets):
        return materialize(minhash_signature(sets.select("set_id", "words"), n_perm, seed).select("set_id", "signature"), "signatures")

    found = lsh_candidates(signed(left), None if right is None else signed(right), bands, rows)
    return _verified(found, left, left if right is None else right, threshold)


# ------------------------------------------------------------- applications

def text_neighbours(
    queries: DataFrame, source: DataFrame, k: int, lemma_threshold: float, text_threshold: float,
    method="exact", remove_identical=False, mode="best", seed=0, n_perm: int = 256, min_words: int = 0,
) -> DataFrame:
    """Similar texts per query: ``(query_id, rank, id, jaccard)``.

    Both tables are ``(id, text, lemma)``.  Candidates come from lemma sets
    above one threshold, are kept where the texts' own word sets are above the
    other, best first (ties by id).  Of a group of identical source sets k
    members are enough then, as they tie and the lowest ids win.  ``sample``
    draws k of all that are kept, for each query anew.
    """
    if mode not in ("best", "sample"):
        raise ValueError("mode must be 'best' or 'sample'")
    asked = queries.select("id", F.col("lemma").alias("text"))
    stored = source.select("id", F.col("lemma").alias("text"))
    asked_sets, asked_members = distinct_sets(asked)
    stored_sets, stored_members = distinct_sets(stored)
    asked_sets, stored_sets = materialize(asked_sets, "sets"), materialize(stored_sets, "sets")
    if method == "exact":
        pairs = _joined_sets(asked_sets, stored_sets, lemma_threshold)
    else:
        pairs = _lsh_joined_sets(asked_sets, stored_sets, lemma_threshold, n_perm, seed, min_words=min_words)
    # group the stored members by (lemma set, text): equal texts tie, so k of each are enough
    texts = source.select("id", "text", F.sort_array(word_set("text")).alias("words"))
    rows = stored_members.join(texts, "id").withColumn("sig", F.sha2("text", 256))
    if mode == "best":
        rows = rows.withColumn("_r", F.row_number().over(Window.partitionBy("set_id", "sig").orderBy("id"))).filter(F.col("_r") <= k)
    qrows = asked_members.join(
        queries.select(F.col("id"), F.col("text").alias("qtext"), F.sort_array(word_set("text")).alias("qwords")), "id")
    found = (
        pairs.select("a", "b")
        .join(qrows.select(F.col("set_id").alias("a"), F.col("id").alias("query_id"), "qtext", "qwords"), "a")
        .join(rows.select(F.col("set_id").alias("b"), "id", "text", "words"), "b")
    )
    if remove_identical:
        found = found.filter(F.col("qtext") != F.col("text"))
    common = F.size(F.array_intersect("qwords", "words"))
    value = common.cast("double") / (F.size("qwords") + F.size("words") - common)
    found = found.select("query_id", "id", value.alias("jaccard")).filter(F.col("jaccard") > text_threshold)
    rank = [F.col("jaccard").desc(), F.col("id")]
    if mode == "sample":
        rank = [keyed_hash("query_id", "id", seed=seed), F.col("id")]
    window = Window.partitionBy("query_id").orderBy(*rank)
    return found.withColumn("rank", F.row_number().over(window)).filter(F.col("rank") <= k).select("query_id", "rank", "id", "jaccard")


def neighbour_graph(pairs: DataFrame) -> DataFrame:
    """Directed edges ``(src, dst)`` of nodes with another neighbour; each node lists itself too."""
    pairs = materialize(pairs.select("a", "b"), "pairs")  # read three times
    both = pairs.select(F.col("a").alias("src"), F.col("b").alias("dst")).unionAll(
        pairs.select(F.col("b").alias("src"), F.col("a").alias("dst")))
    nodes = both.select("src").distinct()
    return both.unionAll(nodes.select("src", F.col("src").alias("dst")))


def bfs(edges: DataFrame, seeds: DataFrame, rounds: int | None = None) -> DataFrame:
    """Nodes reached from the seeds ``(id)``, within ``rounds`` steps if given: ``(id, depth)``."""
    # many frontier rows may lead to one node: distinct folds them before the shuffle
    seen = materialize(seeds.select("id").distinct().withColumn("depth", F.lit(0)), "bfs")
    frontier = seen.select("id")
    for depth in count(1) if rounds is None else range(1, rounds + 1):
        step = (
            edges.join(frontier.withColumnRenamed("id", "src"), "src").select(F.col("dst").alias("id")).distinct()
            .join(seen, "id", "left_anti").withColumn("depth", F.lit(depth))
        )
        step = materialize(step, "bfs")
        if step.limit(1).count() == 0:
            break
        seen = seen.unionByName(step)
        frontier = step.select("id")
    return seen


def edit_pairs(edges: DataFrame, sets: DataFrame, maxbucket: int, lower: float, limit: int | None = None) -> DataFrame:
    """``(src, dst, jaccard)`` for the first ``maxbucket`` neighbours with lower < Jaccard < 1.

    ``sets`` is ``(id, words)`` of the raw texts; ``limit`` caps the total.
    """
    window = Window.partitionBy("src").orderBy("dst")
    first = edges.filter("src <> dst").withColumn("_r", F.row_number().over(window)).filter(F.col("_r") <= maxbucket)
    rows = first.join(sets.select(F.col("id").alias("src"), F.col("words").alias("wa")), "src").join(
        sets.select(F.col("id").alias("dst"), F.col("words").alias("wb")), "dst")
    common = F.size(F.array_intersect("wa", "wb"))
    value = common.cast("double") / (F.size("wa") + F.size("wb") - common)
    out = rows.select("src", "dst", value.alias("jaccard")).filter((F.col("jaccard") > lower) & (F.col("jaccard") < 1.0))
    return out.orderBy("src", "dst").limit(limit) if limit else out


def identity_pairs(texts: DataFrame, text="text") -> DataFrame:
    return texts.select("id", F.col(text).alias("base"), F.col(text).alias("target"))


def dedup_adjacency(edges: DataFrame, texts: DataFrame) -> DataFrame:
    """``(src, text)``: each distinct neighbour text of a node once."""
    return edges.join(texts.select(F.col("id").alias("dst"), "text"), "dst").select("src", "text").distinct()
