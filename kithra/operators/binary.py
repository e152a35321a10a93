"""Inverted lists over bit vectors: cells trained by majority, packed words stored by cell.

Vectors are arrays of packed words (``arrays.pack_words``); distances count
differing bits.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import kernels
from ..functions.arrowmap import add_arrays
from ..session import materialize
from . import ivf, knn
from .blockjoin import block_join, search, small_side
from .codebooks import MODEL_BYTES, first_by_hash
from .layout import read_stored, write_stored

BITS = 64  # bits of a stored word


def to_bits(words: np.ndarray) -> np.ndarray:
    """n × W words → n × 64·W bits, lowest bit of each word first."""
    return np.unpackbits(np.ascontiguousarray(words, "<i8").view(np.uint8), axis=1, bitorder="little")


def to_words(bits: np.ndarray) -> np.ndarray:
    return np.packbits(bits.astype(np.uint8), axis=1, bitorder="little").view("<i8").astype(np.int64)


@dataclass
class BinaryCells:
    """``words`` are the cells' centroids; ``objective`` the differing bits of every iteration."""

    words: np.ndarray
    objective: list[int] = field(default_factory=list)

    def __post_init__(self):
        if self.words.nbytes > MODEL_BYTES:
            raise ValueError(f"model of {self.words.nbytes} bytes is too large to share with every task")

    def __len__(self) -> int:
        return len(self.words)

    def to_rows(self, spark: SparkSession) -> DataFrame:
        """``(list_id, words)``"""
        return spark.createDataFrame([(i, w.tolist()) for i, w in enumerate(self.words)], "list_id long, words array<long>")


def fit_binary_cells(rows: DataFrame, k: int, iterations: int = 10, init="hash", seed: int = 0) -> BinaryCells:
    """Cells of ``(id, vector)`` rows by majority: a centroid's bit is set where more than half of its rows set it.

    They start at ``k`` rows, the lowest ids (``first``) or a choice by hash.
    Each iteration assigns by Hamming distance (ties to the lower cell) and
    takes majorities, so the objective never rises; empty cells keep their centroid.
    """
    rows = rows.select("id", "vector").filter(F.col("vector").isNotNull())
    chosen = rows.orderBy("id").limit(k) if init == "first" else first_by_hash(rows, k, seed)
    start = kernels.matrix(chosen.select("vector").toArrow()["vector"], np.int64)
    if len(start) < k:
        raise ValueError(f"{k} cells need at least {k} training rows, got {len(start)}")
    cells = BinaryCells(start)
    kept = materialize(rows.select("vector"), "train") if iterations > 1 else rows
    for _ in range(iterations):
        cells = majority_step(kept, cells)
    return cells


def majority_step(rows: DataFrame, cells: BinaryCells) -> BinaryCells:
    """One assign-and-vote pass; each task hands on one row of bit counts per cell it meets."""
    words = cells.words

    def fold(batches):
        n, wrong = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        votes = np.zeros((len(words), words.shape[1] * BITS), np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            v = kernels.matrix(batch.column(0), np.int64)
            best = kernels.TopK(len(v), 1)
            best.scan(kernels.Hamming(), v, words, np.arange(len(words)))
            cell = best.slots[:, 0]
            order = np.argsort(cell, kind="stable")
            live, first = np.unique(cell[order], return_index=True)
            votes[live] += np.add.reduceat(to_bits(v[order]).astype(np.int64), first)
            n += np.bincount(cell, minlength=len(words))
            wrong += np.bincount(cell, weights=best.keys[:, 0], minlength=len(words)).astype(np.int64)
        live = np.flatnonzero(n)
        if len(live):
            yield pa.record_batch({
                "list_id": pa.array(live, pa.int64()), "n": pa.array(n[live]), "wrong": pa.array(wrong[live]),
                "votes": kernels.list_array(votes[live], pa.int64())})

    partial = rows.select("vector").mapInArrow(fold, "list_id long, n long, wrong long, votes array<long>")
    merged = add_arrays(partial, ["list_id"], ["n", "wrong"], "votes").toArrow()  # as large as the model
    out = words.copy()
    if merged.num_rows:
        n = kernels.longs(merged["n"])
        votes = kernels.matrix(merged["votes"], np.int64)
        out[kernels.longs(merged["list_id"])] = to_words(2 * votes > n[:, None])
    return BinaryCells(out, [*cells.objective, int(sum(merged["wrong"].to_pylist()))])


@dataclass
class BinaryIndex:
    """Postings ``(list_id, id, vector)`` of packed words; without ``cells`` all rows are one list."""

    spark: SparkSession
    cells: BinaryCells | None = None
    postings: DataFrame | None = None
    stored: DataFrame | None = None  # the same rows as they lie on disk, with their folder
    spec: str = ""

    @property
    def nlist(self) -> int:
        return 1 if self.cells is None else len(self.cells)

    def encode(self, rows: DataFrame) -> DataFrame:
        rows = rows.select("id", "vector").filter(F.col("vector").isNotNull())
        if self.cells is None:
            return rows.select(F.lit(0).cast("long").alias("list_id"), "id", "vector")
        return ivf.hamming_cells(rows, self.cells.words, "id", 1).select("list_id", "id", "vector")

    def _with(self, postings: DataFrame) -> "BinaryIndex":
        return replace(self, postings=postings, stored=None)

    def add_with_ids(self, rows: DataFrame) -> "BinaryIndex":
        new = self.encode(rows)
        return self._with(new if self.postings is None else self.postings.unionByName(new))

    def remove_ids(self, ids: DataFrame | Column) -> "BinaryIndex":
        """Remove the ids of a table, or the rows a boolean column selects."""
        if isinstance(ids, Column):
            return self._with(knn.remove_where(self.postings, ids))
        return self._with(self.postings.join(small_side(ids.select("id").distinct()), "id", "left_anti").select("list_id", "id", "vector"))

    def _asked(self, queries: DataFrame, nprobe: int):
        """Queries with their cells, the rows of these cells, and the column that groups them."""
        asked = queries.select("query_id", "vector").filter(F.col("vector").isNotNull())
        if self.cells is None or nprobe >= self.nlist:
            return asked, self.postings, None
        asked = materialize(ivf.hamming_cells(asked, self.cells.words, "query_id", nprobe), "probes")
        return asked, ivf.probed_only(asked, self.postings if self.stored is None else self.stored, self.nlist), "list_id"

    def search(self, queries: DataFrame, k: int, nprobe: int = 1, **options) -> DataFrame:
        """``(query_id, rank, id, distance)``; all cells give the exact result."""
        asked, postings, group = self._asked(queries, nprobe)
        return search(asked, postings, k, "hamming", group=group, **options)

    def range_search(self, queries: DataFrame, radius: float, nprobe: int | None = None) -> DataFrame:
        """``(query_id, id, distance)`` of the rows with fewer than ``radius`` differing bits."""
        asked, postings, group = self._asked(queries, nprobe or self.nlist)
        return block_join(asked, postings, "hamming", radius=radius, group=group)

    def save(self, path: str) -> "BinaryIndex":
        """Write the index to a new folder and return the stored form."""
        self.spark.createDataFrame([(json.dumps({"spec": self.spec, "nlist": self.nlist, "cells": self.cells is not None}),)],
                                   "meta string").write.parquet(f"{path}/meta")
        if self.cells is not None:
            self.cells.to_rows(self.spark).coalesce(1).write.parquet(f"{path}/cells")
        empty = "list_id long, id long, vector array<long>"
        write_stored(self.postings if self.postings is not None else self.spark.createDataFrame([], empty), path, self.nlist)
        return BinaryIndex.load(self.spark, path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> "BinaryIndex":
        meta = json.loads(spark.read.parquet(f"{path}/meta").first()["meta"])
        cells = None
        if meta["cells"]:
            table = spark.read.parquet(f"{path}/cells").orderBy("list_id").toArrow()
            cells = BinaryCells(kernels.matrix(table["words"], np.int64))
        stored = read_stored(spark, path)
        return BinaryIndex(spark, cells, stored.drop(ivf.GROUP), stored, meta["spec"])


def train_binary_index(text: str, train: DataFrame, iterations: int = 10, init="hash", seed: int = 0) -> BinaryIndex:
    """``BIVF n`` or ``BFlat`` over rows of packed words."""
    if text == "BFlat":
        return BinaryIndex(train.sparkSession, spec=text)
    return BinaryIndex(train.sparkSession, fit_binary_cells(train, int(text.removeprefix("BIVF")), iterations, init, seed), spec=text)
