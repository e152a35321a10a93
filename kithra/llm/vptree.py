"""Nearest vectors by inner product: a vantage-point tree in each shard.

Vectors of a shard are lifted by one component to a common length, so the
largest inner product is the smallest angle, and angles obey the triangle
inequality.  A subtree is skipped if its least possible angle, times
``stretch``, is above the angle of the k-th best so far: ``stretch`` 1 is exact,
more skips sooner.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import ship_package

SHARD_ROWS = 32768  # base rows of a tree, a bound on a task's memory
BLOCK_ROWS = 8192  # queries that one task asks together
LEAF_ROWS = 1024
STRETCH = 1.05
SLACK = 1e-7  # of an angle, for rounding
EXACT_SLACK = 1e-12  # of a cosine: products that may still be as large as the k-th are computed again in one order
EXACT_PAIRS = 1 << 16  # pairs whose products are computed again at once


class Tree:
    """Vantage-point tree over the rows of ``points``, lifted to one length; of equal products the earlier row is better."""

    def __init__(self, points: np.ndarray, leaf: int | None = None, seed: int = 0):
        norms = np.einsum("ij,ij->i", points, points)
        self.length = float(np.sqrt(norms.max()))
        lift = np.sqrt(np.maximum(norms.max() - norms, 0))
        self.raw, self.points = points, np.hstack([points, lift[:, None]]) / self.length
        self.leaf, self.rng = leaf or LEAF_ROWS, np.random.default_rng(seed)
        self.root = self._build(np.arange(len(points)))

    def _build(self, rows: np.ndarray):
        if len(rows) <= self.leaf:
            return rows
        vantage = self.points[self.rng.choice(rows)]
        angle = np.arccos(np.clip(self.points[rows] @ vantage, -1, 1))
        order = np.argsort(angle, kind="stable")  # halves by rank, so equal angles still split
        half = len(rows) // 2
        near, far = order[:half], order[half:]
        return (vantage, (angle[near].min(), angle[near].max()), (angle[far].min(), angle[far].max()),
                self._build(rows[near]), self._build(rows[far]))

    def search(self, queries: np.ndarray, k: int, stretch: float = 1.0):
        """(inner products, rows) of the k best points of each query, best first; -inf and -1 where there are fewer."""
        size = np.linalg.norm(queries, axis=1, keepdims=True)
        q = np.hstack([queries / size, np.zeros((len(queries), 1))])
        best = np.full((len(q), k), -np.inf)
        rows = np.full((len(q), k), -1, np.int64)
        self._visit(self.root, np.arange(len(q)), (queries, q, size[:, 0] * self.length), best, rows, stretch)
        return best, rows

    def _visit(self, node, active, asked, best, rows, stretch):
        if isinstance(node, np.ndarray):
            self._leaf(node, active, asked, best, rows)
            return
        vantage, near, far, left, right = node
        _, q, length = asked
        angle = np.arccos(np.clip(q[active] @ vantage, -1, 1))
        # first the side whose angles are closer, then the other if it may still hold better ones
        inner = np.maximum(np.maximum(near[0] - angle, angle - near[1]), 0)
        outer = np.maximum(np.maximum(far[0] - angle, angle - far[1]), 0)
        first = inner <= outer
        for pick, bound, child in ((first, inner, left), (~first, outer, right), (~first, inner, left), (first, outer, right)):
            worst = np.arccos(np.clip(best[active[pick], -1] / length[active[pick]], -1, 1))
            worst[np.isneginf(best[active[pick], -1])] = np.inf
            go = active[pick][bound[pick] * stretch <= worst + SLACK]
            if len(go):
                self._visit(child, go, asked, best, rows, stretch)

    def _leaf(self, node, active, asked, best, rows):
        queries, q, length = asked
        k = best.shape[1]
        cosine = q[active] @ self.points[node].T
        floor = best[active, -1] / length[active]
        if len(node) > k:
            floor = np.maximum(floor, np.partition(cosine, len(node) - k, axis=1)[:, len(node) - k])
        at, place = np.nonzero(cosine >= floor[:, None] - EXACT_SLACK)
        if not len(at):
            return
        # the products themselves decide, so that ties are ties
        found, point = active[at], node[place]
        old = np.unique(found)
        who = np.concatenate([np.repeat(old, k), found])
        value = np.concatenate([best[old].ravel(), self._products(queries, found, point)])
        name = np.concatenate([rows[old].ravel(), point])
        order = np.lexsort((name, -value, who))
        who, value, name = who[order], value[order], name[order]
        start = np.searchsorted(who, old)
        taken = (start[:, None] + np.arange(k)[None, :])
        best[old], rows[old] = value[taken], name[taken]

    def _products(self, queries, found, point):
        """Inner products, added in one order for every pair, so that equal vectors have equal ones."""
        return np.concatenate([(queries[found[low:low + EXACT_PAIRS]] * self.raw[point[low:low + EXACT_PAIRS]]).sum(axis=1)
                               for low in range(0, len(found), EXACT_PAIRS)])


def nearest(queries: np.ndarray, query_ids: np.ndarray, base: np.ndarray, base_ids: np.ndarray, k: int, stretch: float) -> pd.DataFrame:
    """(query_id, vec_id, score): the k best base rows of each query within one shard, its own id left out.

    Equal vectors are one point with its smallest k + 1 ids, so copies neither
    unbalance the tree nor crowd out a result.  Points are in order of their
    smallest ids: the k + 1 best of them, earlier ones first among equals, hold
    the k best rows, however many vectors tie.
    """
    order = np.argsort(base_ids, kind="stable")
    base, base_ids = base[order], base_ids[order]
    points, begin, which = np.unique(base, axis=0, return_index=True, return_inverse=True)
    earlier = np.argsort(begin)
    points, which = points[earlier], np.argsort(earlier)[which.reshape(-1)]
    members = np.argsort(which, kind="stable")
    size = np.bincount(which, minlength=len(points))
    begin = np.cumsum(size) - size
    size = np.minimum(size, k + 1)
    scores, rows = Tree(points).search(queries, min(k + 1, len(points)), stretch)
    at, place = np.nonzero(rows >= 0)
    point, score = rows[at, place], scores[at, place]
    n = size[point]
    wide = np.repeat(np.arange(len(point)), n)
    nth = np.arange(len(wide)) - np.repeat(np.cumsum(n) - n, n)
    out = pd.DataFrame({
        "query_id": query_ids[at[wide]], "vec_id": base_ids[members[begin[point[wide]] + nth]], "score": score[wide]})
    out = out[out["query_id"] != out["vec_id"]].sort_values(["query_id", "score", "vec_id"], ascending=[True, False, True])
    return out.groupby("query_id", sort=False).head(k)


def usable(df: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, vector) rows with an id and a finite vector that is not zero, components as doubles."""
    rows = df.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector"))
    fine = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return rows.filter(F.col("id").isNotNull() & F.coalesce(fine & F.exists("vector", lambda x: x != 0), F.lit(False)))


def vp_search(queries: DataFrame, base: DataFrame, k: int, key: str = "vec_id", vector: str = "embedding",
              stretch: float = STRETCH, shard_rows: int = SHARD_ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): the k base rows of largest inner product, ties to the smaller id.

    Base rows are dealt into shards, queries into blocks, by a hash of their
    ids, and every block meets every shard in a task of bounded size.  A row is
    no answer to its own id.  Vectors that are null, zero, or hold null or
    non-finite components take no part, nor do null ids; vectors of other
    lengths than the query's are not compared; a repeated id may be returned
    once for each of its vectors.
    """
    ship_package(base.sparkSession)
    base, queries = usable(base, key, vector), usable(queries, key, vector)
    shards = max(1, -(-base.count() // shard_rows))
    blocks = max(1, -(-queries.count() // block_rows))

    def dealt(df, own, n, other, m):
        mine = F.pmod(F.xxhash64("id"), F.lit(n)).cast("int").alias(own)
        return df.select("id", "vector", F.size("vector").alias("dim"), mine,
                         F.explode(F.sequence(F.lit(0), F.lit(m - 1))).alias(other))

    left = dealt(queries, "block", blocks, "shard", shards).groupBy("dim", "shard", "block")
    right = dealt(base, "shard", shards, "block", blocks).groupBy("dim", "shard", "block")

    def cell(q: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if not len(q) or not len(b):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype({"query_id": "int64", "vec_id": "int64"})
        return nearest(np.stack(q["vector"].to_list()), q["id"].to_numpy(), np.stack(b["vector"].to_list()), b["id"].to_numpy(), k, stretch)

    found = left.cogroup(right).applyInPandas(cell, "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
