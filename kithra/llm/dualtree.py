"""Product codes of vectors by dual-tree Lloyd rounds in whole numbers.

Vectors become integers and are cut into equal parts; each part position has a
codebook.  A tree of boxes stands over the parts of a block of vectors, another
over the entries of a codebook.  Pairs of nodes, one of either tree, are
followed from the roots: a pair goes if its least distance is above the greatest
one of another pair of the same parts.  Where one entry is left for a node, all
its parts are assigned at once and its stored sum is added; parts of leaves with
several entries left are compared one by one.  All of it is integer arithmetic,
so results do not depend on how rows are dealt.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.kernels import list_array
from ..session import materialize, ship_package
from .hotjoin import hot_join

SCALE = 4096  # a component x is taken as floor(SCALE * x)
LIMIT = 1 << 24  # integers beyond this could not be squared and summed in 64 bits
PARTS, ENTRIES, ROUNDS = 8, 16, 6
LEAF = 32  # parts in a leaf, about
BLOCK = 1 << 13  # vectors under one tree at most


# ---------------------------------------------------------------------- trees

def leaf_order(points: np.ndarray, leaf: int) -> tuple[np.ndarray, np.ndarray]:
    """An order of the points and the bounds of leaves of at most ``leaf``: halves by the widest side of each box."""
    n = len(points)
    order, bounds = np.arange(n), np.array([0, n])
    while n and np.diff(bounds).max() > leaf:
        segment = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
        mine = points[order]
        low, high = np.minimum.reduceat(mine, bounds[:-1]), np.maximum.reduceat(mine, bounds[:-1])
        side = np.argmax(high - low, axis=1)
        order = order[np.lexsort((mine[np.arange(n), side[segment]], segment))]
        bounds = np.unique(np.concatenate([bounds, (bounds[:-1] + bounds[1:]) // 2]))
    return order, bounds


@dataclass
class Tree:
    """Boxes over runs of points.  Node 0 is the root; ``left`` and ``right`` are -1 at leaves."""

    low: np.ndarray
    high: np.ndarray
    left: np.ndarray
    right: np.ndarray
    first: np.ndarray  # a node holds the points first..last - 1
    last: np.ndarray
    sums: np.ndarray

    @staticmethod
    def over(points: np.ndarray, bounds: np.ndarray) -> "Tree":
        """The tree over leaves that lie side by side; neighbours are joined level by level."""
        starts = bounds[:-1]
        levels = [(np.minimum.reduceat(points, starts), np.maximum.reduceat(points, starts), starts, bounds[1:],
                   np.add.reduceat(points, starts))]
        while len(levels[-1][0]) > 1:
            low, high, first, last, sums = levels[-1]
            even = np.arange(0, len(low), 2)
            levels.append((np.minimum.reduceat(low, even), np.maximum.reduceat(high, even), first[::2],
                           last[np.minimum(even + 1, len(last) - 1)], np.add.reduceat(sums, even)))
        levels.reverse()
        sizes = [len(level[0]) for level in levels]
        begins = np.cumsum([0, *sizes])
        left, right = [np.full(sizes[-1], -1)], [np.full(sizes[-1], -1)]
        for k in range(len(levels) - 2, -1, -1):
            child = begins[k + 1] + 2 * np.arange(sizes[k])
            left.insert(0, child)
            # an only child is named twice and followed once
            right.insert(0, np.minimum(child + 1, begins[k + 2] - 1))
        low, high, first, last, sums = (np.concatenate([level[i] for level in levels]) for i in range(5))
        return Tree(low, high, np.concatenate(left), np.concatenate(right), first, last, sums)

    def children(self, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(position in ``nodes``, child) of all children."""
        left, right = self.left[nodes], self.right[nodes]
        two = np.flatnonzero(left != right)
        at = np.concatenate([np.arange(len(nodes)), two])
        child = np.concatenate([left, right[two]])
        order = np.argsort(at, kind="stable")
        return at[order], child[order]


def entry_tree(entries: np.ndarray) -> tuple[Tree, np.ndarray]:
    """A tree with one entry to a leaf, and the entries in its order."""
    order, bounds = leaf_order(entries, 1)
    return Tree.over(entries[order], bounds), order


# ------------------------------------------------------------------- traversal

def nearest_entries(tree: Tree, points: np.ndarray, entries: np.ndarray):
    """Assign all points of a tree: ``(nodes, their entry, points, their entry)``.

    The first pair of arrays are nodes assigned as a whole, the second the
    points of leaves that had to be compared.  Ties go to the lower entry.
    """
    codes, order = entry_tree(entries)
    norm = (entries * entries).sum(axis=1)
    whole_nodes, whole_entries = [], []
    leaf_nodes, leaf_entries = [], []
    parts, others = np.zeros(1, np.int64), np.zeros(1, np.int64)  # pairs, in order of the first
    while len(parts):
        plow, phigh, elow, ehigh = tree.low[parts], tree.high[parts], codes.low[others], codes.high[others]
        gap = np.maximum(np.maximum(plow - ehigh, elow - phigh), 0)
        far = np.maximum(phigh - elow, ehigh - plow)
        least, most = (gap * gap).sum(axis=1), (far * far).sum(axis=1)
        begins = np.flatnonzero(np.append(True, parts[1:] != parts[:-1]))
        sizes = np.diff(np.append(begins, len(parts)))
        bound = np.repeat(np.minimum.reduceat(most, begins), sizes)
        kept = least <= bound
        # where all entries stand alone: one that is farther than the best one in every corner of the box goes
        single = codes.left[others] < 0
        alone = np.repeat(np.logical_and.reduceat(single, begins), sizes)
        ranked = np.lexsort((most, parts))
        best = np.repeat(others[ranked[begins]], sizes)
        if alone.any():
            a, b = order[codes.first[others[alone]]], order[codes.first[best[alone]]]
            step = entries[a] - entries[b]
            corner = np.where(step > 0, phigh[alone], plow[alone])
            kept[alone] &= norm[a] - norm[b] - 2 * (corner * step).sum(axis=1) <= 0
        parts, others, single = parts[kept], others[kept], single[kept]
        begins = np.flatnonzero(np.append(True, parts[1:] != parts[:-1]))
        sizes = np.diff(np.append(begins, len(parts)))
        alone = np.logical_and.reduceat(single, begins)
        done = alone & (sizes == 1)
        whole_nodes.append(parts[begins[done]])
        whole_entries.append(order[codes.first[others[begins[done]]]])
        bottom = alone & ~done & (tree.left[parts[begins]] < 0)
        pairs = np.repeat(bottom, sizes)
        leaf_nodes.append(parts[pairs])
        leaf_entries.append(order[codes.first[others[pairs]]])
        # of all others, the wider side is split: the part node, or those of its entry nodes that are not single
        pspan = (tree.high[parts] - tree.low[parts]).max(axis=1)
        espan = np.where(codes.left[others] < 0, -1, (codes.high[others] - codes.low[others]).max(axis=1))
        wide = np.maximum.reduceat(espan, begins)
        split_entries = ~alone & ((wide >= np.maximum.reduceat(pspan, begins)) | (tree.left[parts[begins]] < 0))
        active = ~done & ~bottom
        by_entry, by_part = np.repeat(active & split_entries, sizes), np.repeat(active & ~split_entries, sizes)
        p, e = parts[by_entry], others[by_entry]
        inner = codes.left[e] >= 0
        at, child = codes.children(e[inner])
        q, f = parts[by_part], others[by_part]
        to, node = tree.children(q)
        parts = np.concatenate([p[~inner], p[inner][at], node])
        others = np.concatenate([e[~inner], child, f[to]])
        order_pairs = np.lexsort((others, parts))
        parts, others = parts[order_pairs], others[order_pairs]
    nodes, chosen = np.concatenate(whole_nodes), np.concatenate(whole_entries)
    leaves, candidates = np.concatenate(leaf_nodes), np.concatenate(leaf_entries)
    unsure, at = np.unique(leaves, return_inverse=True)
    allowed = np.zeros((len(unsure), len(entries)), bool)
    allowed[at, candidates] = True
    sizes = tree.last[unsure] - tree.first[unsure]
    who = _ranges(tree.first[unsure], sizes)
    mine = points[who]
    distance = np.full((len(who), len(entries)), np.iinfo(np.int64).max)
    mask = np.repeat(allowed, sizes, axis=0)
    for e, entry in enumerate(entries):
        rows = np.flatnonzero(mask[:, e])
        if len(rows):
            rest = mine[rows] - entry
            distance[rows, e] = (rest * rest).sum(axis=1)
    return nodes, chosen, who, distance.argmin(axis=1) if len(who) else np.zeros(0, np.int64)


def _ranges(first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """first[0], first[0] + 1, … for ``sizes`` numbers of each."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(first - (ends - sizes), sizes)


def assigned_sums(tree: Tree, points: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number and sum of the points that each entry is nearest to."""
    nodes, chosen, who, code = nearest_entries(tree, points, entries)
    counts, sums = np.zeros(len(entries), np.int64), np.zeros_like(entries)
    np.add.at(counts, chosen, tree.last[nodes] - tree.first[nodes])
    np.add.at(sums, chosen, tree.sums[nodes])
    np.add.at(counts, code, 1)
    np.add.at(sums, code, points[who])
    return counts, sums


def assigned_codes(tree: Tree, points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """The nearest entry of each point."""
    nodes, chosen, who, code = nearest_entries(tree, points, entries)
    out = np.empty(len(points), np.int64)
    sizes = tree.last[nodes] - tree.first[nodes]
    out[_ranges(tree.first[nodes], sizes)] = np.repeat(chosen, sizes)
    out[who] = code
    return out


# ------------------------------------------------------------------------ spark

def whole_numbers(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str | None = None, scale: int = SCALE) -> DataFrame:
    """(key, label, v): ``v`` holds floor(scale * x); see ``encode`` for the rows that are left out."""
    x = F.transform(F.col(vector).cast("array<double>"), lambda c: F.floor(c * F.lit(float(scale))))
    good = F.col(vector).isNotNull() & (F.size(vector) > 0) & F.forall(
        F.col(vector).cast("array<double>"),
        lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) * F.lit(float(scale)) < F.lit(float(LIMIT))))
    rows = vectors.filter(good).select(
        F.col(key).alias("key"), (F.lit(None).cast("string") if label is None else F.col(label).cast("string")).alias("label"),
        x.cast("array<long>").alias("v"))
    return rows


@dataclass
class Codebooks:
    """``entries[p]`` are the integer entries of part position p."""

    entries: list[np.ndarray]

    @property
    def width(self) -> int:
        return self.entries[0].shape[1]

    def sha256(self) -> str:
        """Of all integers by part, entry and position, comma-joined; lower-case hex."""
        said = ",".join(str(int(x)) for book in self.entries for x in book.reshape(-1))
        return hashlib.sha256(said.encode()).hexdigest()


def one_length(rows: DataFrame, parts: int) -> tuple[DataFrame, int]:
    """Rows whose vectors have the commonest length (the greatest of equals), and that length."""
    top = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.col("count").desc(), F.col("n").desc()).first()
    if top is None:
        return rows, 0
    if top["n"] % parts:
        raise ValueError(f"vectors of {top['n']} components cannot be cut into {parts} equal parts")
    return rows.filter(F.size("v") == top["n"]), top["n"]


def leaf_rows(rows: DataFrame, parts: int, width: int, block: int = BLOCK, leaf: int = LEAF) -> DataFrame:
    """(part, points): the leaves of the trees over each block's parts, in tree order; a block is up to ``block`` rows of a task."""

    def cut(batches):
        for batch in batches:
            for low in range(0, batch.num_rows, block):
                v = _matrix(batch.column(0).slice(low, block), parts * width)
                for p in range(parts):
                    points = v[:, p * width:(p + 1) * width]
                    order, bounds = leaf_order(points, leaf)
                    flat = np.ascontiguousarray(points[order]).reshape(-1)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(bounds) - 1, p), pa.int32()),
                         pa.ListArray.from_arrays(pa.array(bounds * width, pa.int32()), pa.array(flat, pa.int64()))], ["part", "points"])

    return rows.select("v").mapInArrow(cut, "part int, points array<long>")


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, width)


def lloyd_round(leaves: DataFrame, books: Codebooks) -> Codebooks:
    """One round over stored leaves: neighbouring leaves of a batch form a tree; only counts and sums are shuffled."""
    entries, width = books.entries, books.width

    def fold(batches):
        counts = [np.zeros(len(book), np.int64) for book in entries]
        sums = [np.zeros_like(book) for book in entries]
        for batch in batches:
            part = batch.column(0).to_numpy()
            cuts = np.flatnonzero(np.append(True, part[1:] != part[:-1])) if len(part) else []
            for low, high in zip(cuts, [*cuts[1:], len(part)]):
                p, mine = int(part[low]), batch.column(1).slice(low, high - low)
                points = _matrix(mine, width)
                bounds = mine.offsets.to_numpy() // width
                n, s = assigned_sums(Tree.over(points, bounds - bounds[0]), points, entries[p])
                counts[p] += n
                sums[p] += s
        for p, (n, s) in enumerate(zip(counts, sums)):
            live = np.flatnonzero(n)
            if len(live):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(live), p), pa.int32()), pa.array(live, pa.int32()), pa.array(n[live], pa.int64()),
                     list_array(s[live], pa.int64())], ["part", "entry", "n", "sums"])

    partial = leaves.mapInArrow(fold, "part int, entry int, n long, sums array<long>")
    # as many rows as the codebooks have entries reach the driver
    found = partial.groupBy("part", "entry").agg(F.sum("n").alias("n"), *[F.sum(F.get("sums", F.lit(j))).alias(f"s{j}") for j in range(width)]).collect()
    new = [book.copy() for book in entries]
    for row in found:
        new[row["part"]][row["entry"]] = [row[f"s{j}"] // row["n"] for j in range(width)]
    return Codebooks(new)


def fit(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, length: int | None = None) -> Codebooks:
    """Codebooks of (key, v) rows of one length.

    They start as the parts of the ``entries`` rows of least key (null keys
    last, equal keys by their vectors; of fewer rows, all), and each round
    replaces an entry by the componentwise floor of the mean of its parts.
    """
    length = length or rows.select(F.size("v")).first()[0]
    width = length // parts
    first = rows.orderBy(F.col("key").asc_nulls_last(), "v").select("v").limit(entries).collect()
    start = np.array([r["v"] for r in first], np.int64)
    books = Codebooks([start[:, p * width:(p + 1) * width].copy() for p in range(parts)])
    leaves = materialize(leaf_rows(rows, parts, width), "part-leaves")
    for _ in range(rounds):
        books = lloyd_round(leaves, books)
    return books


def assign(rows: DataFrame, books: Codebooks) -> DataFrame:
    """(key, label, code, error): two hex digits a part, and the squared distances summed over the parts.  No row is shuffled."""
    entries, width = books.entries, books.width
    fields = {f.name: f.dataType.simpleString() for f in rows.schema.fields}

    def code(batches):
        for batch in batches:
            for low in range(0, batch.num_rows, BLOCK):
                piece = batch.slice(low, BLOCK)
                v = _matrix(piece.column(2), len(entries) * width)
                codes, error = np.empty((len(v), len(entries)), np.int64), np.zeros(len(v), np.int64)
                for p, book in enumerate(entries):
                    points = v[:, p * width:(p + 1) * width]
                    order, bounds = leaf_order(points, LEAF)
                    mine = points[order]
                    codes[order, p] = assigned_codes(Tree.over(mine, bounds), mine, book)
                    rest = points - book[codes[:, p]]
                    error += (rest * rest).sum(axis=1)
                told = [row.tobytes().hex() for row in codes.astype(np.uint8)]
                yield pa.RecordBatch.from_arrays([piece.column(0), piece.column(1), pa.array(told, pa.string()), pa.array(error, pa.int64())],
                                                 ["key", "label", "code", "error"])

    return rows.select("key", "label", "v").mapInArrow(code, f"key {fields['key']}, label string, code string, error long")


def with_label_error(coded: DataFrame) -> DataFrame:
    """Adds ``label_error``, the error summed over the rows of one label; rows without a label together.  ``coded`` should be written."""
    # a null label joins like any other
    rows = coded.withColumn("known", F.col("label").isNotNull()).withColumn("told", F.coalesce("label", F.lit("")))
    sums = materialize(rows.groupBy("known", "told").agg(F.sum("error").alias("label_error"), F.count(F.lit(1)).alias("n")), "label-errors")
    return hot_join(rows, sums, ["known", "told"]).drop("known", "told", "n")


def encode(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label",
           parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, Codebooks]:
    """Train codebooks on all vectors and code them: (key, code, error, label_error), and the codebooks.

    Left out are vectors that are null or empty, hold a null or non-finite
    component, or one whose integer is beyond 24 bits (its squares would not
    fit), and vectors of another length than the commonest.  Rows that repeat a
    key are rows of their own; equal vectors have equal codes.  A row without
    a key is coded like others.  Fewer rows than ``entries`` make as many entries; no
    rows make an empty result.  At most 256 entries, for two hex digits.
    """
    if not 1 <= entries <= 256:
        raise ValueError("a code has two hex digits: 1 to 256 entries")
    ship_package(vectors.sparkSession)
    kind = vectors.schema[key].dataType.simpleString()
    rows, length = one_length(materialize(whole_numbers(vectors, key, vector, label), "whole-vectors"), parts)
    if not length:
        return vectors.sparkSession.createDataFrame([], f"`{key}` {kind}, code string, error long, label_error long"), Codebooks([np.zeros((0, 0), np.int64)] * parts)
    books = fit(rows, parts, entries, rounds, length)
    coded = with_label_error(materialize(assign(rows, books), "coded-vectors"))
    return coded.select(F.col("key").alias(key), "code", "error", "label_error"), books
