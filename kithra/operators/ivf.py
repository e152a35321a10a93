"""Cell-probing search: compare a query with the rows of its nearest cells only.

The probe list is an explode of the queries; the rest is the block join grouped
by cell, so an oversize cell is split and cells nobody probes are not read past
the join filter.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import arrays, kernels
from ..functions.arrowmap import with_arrow_column
from ..session import materialize
from . import skew
from .blockjoin import bounded_rows, search
from .codebooks import MODEL_BYTES, Codebook, assign

#: Stored postings lie in at most so many folders, each of neighbouring cells.
GROUPS = 1 << 10
GROUP = "cell_group"


def cell_group(list_id, nlist: int):
    """The folder of a cell: ``GROUPS`` stretches of the cell numbers, or one folder a cell if there are fewer."""
    return F.floor(F.col(list_id) * F.lit(min(nlist, GROUPS)) / F.lit(nlist)).cast("int")


def probe(queries: DataFrame, centroids: np.ndarray, nprobe: int, metric="l2") -> DataFrame:
    """``(query_id, vector, list_id)``, one row per probed cell."""
    centroids = np.asarray(centroids, float)
    kernel = kernels.metric_of("ip" if metric in ("ip", "cosine") else "l2")
    count = min(nprobe, len(centroids))

    def cells(v: pa.Array) -> pa.Array:
        best = kernels.TopK(len(v), count)
        best.scan(kernel, kernels.matrix(v), centroids, np.arange(len(centroids)))
        return kernels.list_array(best.slots.astype(np.int32), pa.int32())

    rows = queries.select("query_id", arrays.doubles("vector").alias("vector"))
    rows = with_arrow_column(rows, "cells", "array<int>", "vector", cells)
    return rows.select("query_id", "vector", F.explode("cells").alias("list_id"))


def build_postings(base: DataFrame, centroids: np.ndarray, metric="l2") -> DataFrame:
    """``(list_id, id, vector)``"""
    if metric in ("ip", "cosine"):
        rows = base.select(F.col("id").alias("query_id"), "vector")
        return probe(rows, centroids, 1, metric).withColumnRenamed("query_id", "id")
    return assign(base.select("id", arrays.doubles("vector").alias("vector")), centroids, distance=None)


def ivf_knn(queries, postings, centroids, k: int, nprobe: int = 1, metric="l2", **options) -> DataFrame:
    """Top-k inside the ``nprobe`` nearest cells; all cells give the exact result."""
    kernel = "ip" if metric == "cosine" else metric
    if metric == "cosine":
        queries = queries.withColumn("vector", arrays.l2_normalize("vector"))
        postings = postings.withColumn("vector", arrays.l2_normalize("vector"))
    asked = materialize(probe(queries, centroids, nprobe, metric), "probes")
    return search(asked, probed_only(asked, postings), k, kernel, group="list_id", **options)


def probed_only(asked: DataFrame, postings: DataFrame, nlist: int | None = None) -> DataFrame:
    """Postings of the cells that written probes ask for; one plan for any number of cells.

    Stored postings (with a ``cell_group`` column, see ``cell_group``) are
    joined with the asked groups, of which there are at most ``GROUPS``: Spark
    turns the join into a filter on folders when it runs, and the others are not
    opened.  Rows of cells that nobody asks for are dropped by a semi-join,
    which Spark broadcasts or shuffles by the size of the probes.
    """
    lists = asked.select("list_id").distinct()
    if nlist and GROUP in postings.columns:
        # the filter holds for every cell; pruning is planned only where the other side has one
        groups = asked.filter(F.col("list_id") >= 0).select(cell_group("list_id", nlist).alias(GROUP)).distinct()
        postings = postings.join(F.broadcast(groups), GROUP).drop(GROUP)
    return postings.join(lists, "list_id", "left_semi")


def probe_stats(queries, postings, centroids, nprobe: int = 1, metric="l2") -> DataFrame:
    """Distances computed per query: the sizes of its probed cells."""
    sizes = postings.groupBy("list_id").agg(F.count("*").alias("size"))
    return (
        probe(queries, centroids, nprobe, metric).join(sizes, "list_id", "left")
        .groupBy("query_id").agg(F.coalesce(F.sum("size"), F.lit(0)).alias("compared"))
    )


# -------------------------------------------------------------- duplicates

def dedup_vectors(base: DataFrame, hot_rows: int = skew.HOT_ROWS) -> tuple[DataFrame, DataFrame]:
    """Distinct vectors ``(id, vector, copies)`` with their lowest id, and ``(rep, id)`` members.

    Copies are folded before the shuffle; a vector with very many copies is
    looked up by broadcast instead of being gathered.
    """
    vectors = base.groupBy("vector").agg(F.min("id").alias("rep"), F.count("*").alias("copies"))
    members = skew.lookup_join(base.select("vector", "id"), vectors, "vector", "copies", hot_rows)
    return vectors.select(F.col("rep").alias("id"), "vector", "copies"), members.select("rep", "id")


def expand_members(found: DataFrame, members: DataFrame, k: int) -> DataFrame:
    """Results over representatives → results over all stored rows.

    Copies tie, and ties are won by the lowest id: k members of each
    representative are enough.
    """
    ranked = Window.partitionBy("rep").orderBy("id")
    few = members.withColumn("_r", F.row_number().over(ranked)).filter(F.col("_r") <= k).drop("_r")
    from .blockjoin import top_k

    wide = found.withColumnRenamed("id", "rep").drop("rank").join(few, "rep")
    return top_k(wide.select("query_id", "id", "distance"), k)


def ivf_dedup_knn(queries, base, centroids, k: int, nprobe: int = 1, **options) -> DataFrame:
    """Duplicates are stored once; results are as if all were stored."""
    distinct, members = dedup_vectors(base)
    found = ivf_knn(queries, build_postings(distinct, centroids), centroids, k, nprobe, **options)
    return expand_members(found, members, k)


# ------------------------------------------------------ composed (multi) cells

def imi_cells(rows: DataFrame, book: Codebook, key: str = "id") -> DataFrame:
    """Adds ``list_id``: the codes of all segments composed into one number."""
    coded = book.encode(rows, "vector", "_codes")
    number = F.aggregate("_codes", F.lit(0).cast("long"), lambda s, c: s * book.ks + c)
    return coded.withColumn("list_id", number).drop("_codes")


def nearest_sums(tables: list[np.ndarray], count: int) -> np.ndarray:
    """The ``count`` cells of least sum of one distance per segment, ties to the lower cell number.

    Best first: each segment's distances are sorted once, and a heap holds the
    places in these lists whose neighbours before them have all been taken.  It
    takes ``count`` steps, and as many more as there are ties with the last.
    """
    orders = [np.argsort(t, kind="stable")[:count] for t in tables]
    ranked = [t[o].tolist() for t, o in zip(tables, orders)]
    orders = [o.tolist() for o in orders]

    def total(place):
        out = 0.0
        for values, i in zip(ranked, place):
            out += values[i]
        return out

    # a list is cut after ``count`` places; equal distances behind the cut belong to higher codes
    first = (0,) * len(tables)
    heap, seen, taken = [(total(first), first)], {first}, []
    while heap and (len(taken) < count or heap[0][0] <= taken[count - 1][0]):
        value, place = heapq.heappop(heap)
        cell = 0
        for t, o, i in zip(tables, orders, place):
            cell = cell * len(t) + o[i]
        taken.append((value, cell))
        for m in range(len(place)):
            after = place[:m] + (place[m] + 1,) + place[m + 1:]
            if after[m] < len(ranked[m]) and after not in seen:
                seen.add(after)
                heapq.heappush(heap, (total(after), after))
    return np.array([cell for _, cell in sorted(taken)[:count]], np.int64)


def imi_probe(queries: DataFrame, book: Codebook, nprobe: int) -> DataFrame:
    """The cells with the smallest sums of segment distances; only as many sums as needed are formed."""
    parts, ks = book.parts, book.ks
    count = min(nprobe, ks ** book.m)

    def best_cells(v: pa.Array) -> pa.Array:
        tables = kernels.AsymmetricCode(parts).tables(kernels.matrix(v))
        out = np.empty((len(v), count), np.int64)
        for i in range(len(v)):
            out[i] = nearest_sums([t[i] for t in tables], count)
        return kernels.list_array(out, pa.int64())

    rows = queries.select("query_id", arrays.doubles("vector").alias("vector"))
    rows = with_arrow_column(rows, "cells", "array<bigint>", "vector", best_cells)
    return rows.select("query_id", "vector", F.explode("cells").alias("list_id"))


def imi_knn(queries, base, book: Codebook, k: int, nprobe: int, **options) -> DataFrame:
    postings = imi_cells(base.withColumn("vector", arrays.doubles("vector")), book)
    return search(imi_probe(queries, book, nprobe), postings, k, "l2", group="list_id", **options)


# ----------------------------------------------------------------- bit cells

def hamming_cells(rows: DataFrame, centroids: DataFrame | np.ndarray, key: str, nprobe: int, out: str = "list_id") -> DataFrame:
    """Rows with their ``nprobe`` nearest binary centroids: a table ``(id, vector)`` or the words of cells 0, 1, …"""
    if isinstance(centroids, DataFrame):
        if bounded_rows(centroids, "vector", MODEL_BYTES) is None:
            raise ValueError("binary centroids are too large to share with every task")
        table = centroids.select("id", "vector").orderBy("id").toArrow()
        ids, words = kernels.longs(table["id"]), kernels.matrix(table["vector"], np.int64)
    else:
        ids, words = np.arange(len(centroids)), np.asarray(centroids, np.int64)
    count = min(nprobe, len(ids))

    def cells(v: pa.Array) -> pa.Array:
        best = kernels.TopK(len(v), count)
        best.scan(kernels.Hamming(), kernels.matrix(v, np.int64), words, ids)
        return kernels.list_array(best.slots, pa.int64())

    return with_arrow_column(rows, out, "array<bigint>", "vector", cells).withColumn(out, F.explode(out))


def hamming_ivf_knn(queries, base, centroids: DataFrame | np.ndarray, k: int, nprobe: int = 1, **options) -> DataFrame:
    asked = materialize(hamming_cells(queries, centroids, "query_id", nprobe), "probes")
    postings = materialize(hamming_cells(base, centroids, "id", 1), "postings")
    return search(asked, probed_only(asked, postings), k, "hamming", group="list_id", **options)
