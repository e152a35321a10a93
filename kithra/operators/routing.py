"""Cells in two levels: few parents shared with every task, and their children as a table.

A clustering of 2^16 cells and more is too large to give to every task.  Here a
row finds its parent by the parents' book (about the square root of the cells),
is dealt to that parent, and meets only the parent's children there.  Training,
assigning and probing are the same join: rows and children grouped by parent,
where a parent that holds many rows is cut into several blocks and its children
are sent to each of them.  No step shares more than the parents.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..functions import arrays, kernels
from ..functions.arrowmap import add_arrays, with_arrow_column
from ..functions.hashing import keyed_hash
from ..session import materialize
from .codebooks import Codebook, fit_codebook, sample_for_training

BLOCK_ROWS = 1 << 16  # rows of one parent that meet its children in one task
CHILDREN = "parent int, list_id long, centre array<double>"
TRAIN_ROWS = 64  # training rows per cell, when the caller gives more


def _deal(rows: DataFrame, children: DataFrame, block_rows: int) -> tuple[DataFrame, DataFrame]:
    """Both sides with a block ``_b`` of their parent: written rows spread over its blocks, children sent to each."""
    counts = rows.groupBy("parent").agg(F.ceil(F.count(F.lit(1)) / F.lit(block_rows)).cast("int").alias("_n"))
    # one row per parent, and parents are a book of checked size
    many = F.broadcast(counts.filter("_n > 1"))
    n = F.coalesce("_n", F.lit(1))
    left = rows.join(many, "parent", "left").withColumn("_b", F.pmod(F.xxhash64(*rows.columns), n).cast("int")).drop("_n")
    right = children.join(many, "parent", "left").withColumn("_b", F.explode(F.sequence(F.lit(0), n - 1))).drop("_n")
    return left, right


@dataclass
class RoutedCells:
    """``parents`` is a clustering; ``children`` a written table ``(parent, list_id, centre)``."""

    parents: Codebook
    children: DataFrame
    nlist: int
    objective: list[float] = field(default_factory=list)
    block_rows: int = BLOCK_ROWS

    @property
    def spark(self) -> SparkSession:
        return self.children.sparkSession

    @property
    def dim(self) -> int:
        return self.parents.dim

    # -------------------------------------------------------------- rows → cells

    def _routed(self, rows: DataFrame, count: int, ip: bool = False) -> DataFrame:
        """Rows with their ``count`` nearest parents, one row for each."""
        centres = self.parents.centroids
        metric = kernels.metric_of("ip" if ip else "l2")
        count = min(count, len(centres))

        def near(v: pa.Array) -> pa.Array:
            best = kernels.TopK(len(v), count)
            best.scan(metric, kernels.matrix(v), centres, np.arange(len(centres)))
            return kernels.list_array(best.slots.astype(np.int32), pa.int32())

        return with_arrow_column(rows, "parent", "array<int>", "vector", near).withColumn("parent", F.explode("parent"))

    def assign(self, rows: DataFrame, ip: bool = False, centre: bool = False) -> DataFrame:
        """``rows`` (with ``vector``) and their cell ``list_id``: the nearest child of the nearest parent.

        With ``centre`` the cell's centroid is added as ``_centre``.
        """
        columns = rows.columns
        metric = kernels.metric_of("ip" if ip else "l2")
        left, right = _deal(materialize(self._routed(rows, 1, ip), "routed"), self.children, self.block_rows)
        schema = left.select(*columns).schema.add("list_id", T.LongType())
        if centre:
            schema = schema.add("_centre", T.ArrayType(T.DoubleType()))

        def nearest(lt: pa.Table, rt: pa.Table) -> pa.Table:
            lists, centres, v = _cells_of(rt, lt["vector"])
            best = kernels.TopK(len(v), 1)
            if len(v):
                best.scan(metric, v, centres, np.arange(len(centres)))
            place = best.slots[:, 0]
            out = lt.select(columns).append_column("list_id", pa.array(lists[place], pa.int64()))
            return out.append_column("_centre", kernels.list_array(centres[place], pa.float64())) if centre else out

        key = ["parent", "_b"]
        return left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(_only_rows(nearest, schema), schema)

    def probe(self, queries: DataFrame, nprobe: int, ip: bool = False, nroute: int | None = None) -> DataFrame:
        """``(query_id, vector, list_id)``: the nearest cells among the children of the nearest parents.

        ``nroute`` parents are followed, by default four times the parents that
        ``nprobe`` cells fill; all parents and all cells give every cell.
        """
        per_parent = max(1, self.nlist // len(self.parents.centroids))
        routes = nroute or 4 * -(-nprobe // per_parent)
        metric = kernels.metric_of("ip" if ip else "l2")
        rows = queries.select("query_id", arrays.doubles("vector").alias("vector"))
        left, right = _deal(materialize(self._routed(rows, routes, ip), "routed"), self.children, self.block_rows)

        def best_cells(lt: pa.Table, rt: pa.Table) -> pa.Table:
            lists, centres, v = _cells_of(rt, lt["vector"])
            count = min(nprobe, len(lists))
            best = kernels.TopK(len(v), count)
            if len(v):
                best.scan(metric, v, centres, lists)
            found = kernels.list_array(best.slots, pa.int64()), kernels.list_array(best.keys, pa.float64())
            return pa.table({"query_id": lt["query_id"], "vector": lt["vector"], "lists": found[0], "keys": found[1]})

        schema = "query_id long, vector array<double>, lists array<long>, keys array<double>"
        key = ["parent", "_b"]
        near = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(_only_rows(best_cells, schema), schema)
        cells = near.select("query_id", "vector", F.explode(F.arrays_zip("lists", "keys")).alias("c"))
        if routes >= len(self.parents.centroids) and nprobe >= self.nlist:
            return cells.select("query_id", "vector", F.col("c.lists").alias("list_id"))
        # a query's cells are at most nprobe for each parent it follows
        order = Window.partitionBy("query_id", F.xxhash64("vector"), "vector").orderBy("c.keys", "c.lists")
        ranked = cells.withColumn("_r", F.dense_rank().over(order)).filter(F.col("_r") <= nprobe)
        return ranked.select("query_id", "vector", F.col("c.lists").alias("list_id"))

    def with_centre(self, rows: DataFrame) -> DataFrame:
        """Adds ``_centre`` by ``list_id``; the children are joined as a table, not shared."""
        return rows.join(self.children.select("list_id", F.col("centre").alias("_centre")), "list_id")


def _cells_of(children: pa.Table, vectors):
    """Cell numbers and centres in order of the number, and the rows' matrix."""
    order = np.argsort(kernels.longs(children["list_id"]))
    centres = kernels.matrix(children["centre"])
    return kernels.longs(children["list_id"])[order], centres[order] if len(order) else centres, kernels.matrix(vectors)


def _only_rows(fn, schema):
    """``fn`` of the two sides of a group; a group of one side alone gives nothing."""
    from pyspark.sql.pandas.types import to_arrow_schema

    empty = to_arrow_schema(T._parse_datatype_string(schema) if isinstance(schema, str) else schema).empty_table()

    def both(lt: pa.Table, rt: pa.Table) -> pa.Table:
        return fn(lt, rt) if lt.num_rows and rt.num_rows else empty

    return both


# -------------------------------------------------------------------- training

def fit_routed(rows: DataFrame, nlist: int, parents: int | None = None, iterations: int = 10, parent_iterations: int = 10,
               seed: int = 0, train_rows: int | None = None, block_rows: int = BLOCK_ROWS) -> RoutedCells:
    """Train ``nlist`` cells on ``(id, vector)`` rows.

    Parents are clustered first.  Cells are shared out among them by the rows
    that each holds (largest remainders), start at rows of the parent in hash
    order, and move by Lloyd steps of all parents together.  At most
    ``train_rows`` rows (``TRAIN_ROWS`` a cell by default), chosen by a hash of the id, are trained
    on.  Empty cells keep their centre.  ``objective`` holds the squared error
    of every iteration, which never rises.
    """
    count = parents or max(1, int(round(nlist**0.5)))
    limit = train_rows or TRAIN_ROWS * nlist
    rows = materialize(sample_for_training(rows.select("id", arrays.doubles("vector").alias("vector")), limit, seed), "train")
    total = rows.count()
    if total < nlist:
        raise ValueError(f"{nlist} cells need at least {nlist} training rows, got {total}")
    book = fit_codebook(rows, 1, count, parent_iterations, "hash", seed)
    cells = RoutedCells(book, rows.sparkSession.createDataFrame([], CHILDREN), nlist, block_rows=block_rows)
    live = sorted(r["parent"] for r in cells._routed(rows, 1).select("parent").distinct().collect())
    # a parent without rows would have no children: it goes
    cells.parents = Codebook([0], [book.centroids[live]], book.objective)
    routed = materialize(cells._routed(rows, 1).select("id", "vector", "parent"), "routed")
    cells.children = materialize(_first_children(routed, nlist, seed), "children")
    cells.nlist = cells.children.count()
    for _ in range(iterations):
        cells = lloyd_step(routed, cells)
    return cells


def _first_children(routed: DataFrame, nlist: int, seed: int) -> DataFrame:
    """The first rows of each parent in hash order; the numbers of cells are shared out by the parents' rows."""
    # as many rows as there are parents
    sizes = {r["parent"]: r["n"] for r in routed.groupBy("parent").agg(F.count(F.lit(1)).alias("n")).collect()}
    share = shares(sizes, nlist)
    start, table = 0, []
    for parent in sorted(sizes):
        table.append((parent, share[parent], start, sizes[parent]))
        start += share[parent]
    lookup = F.broadcast(routed.sparkSession.createDataFrame(table, "parent int, _cells int, _start long, _rows long"))
    # rows far behind the last that is needed are dropped before they are ranked
    hashed = routed.join(lookup, "parent").withColumn("_h", keyed_hash("id", seed=seed + 1))
    near = F.col("_h") / float(1 << 32) * F.col("_rows") <= F.col("_cells") + 8 * F.sqrt("_cells") + 64
    order = Window.partitionBy("parent").orderBy("_h", "id", "vector")
    first = hashed.filter(near).withColumn("_r", F.row_number().over(order)).filter("_r <= _cells")
    return first.select("parent", (F.col("_start") + F.col("_r") - 1).alias("list_id"), F.col("vector").alias("centre"))


def shares(sizes: dict[int, int], total: int) -> dict[int, int]:
    """``total`` shared out by size: at least one each, no more than the size, largest remainders first."""
    all_rows = sum(sizes.values())
    out = {p: min(n, max(1, total * n // all_rows)) for p, n in sizes.items()}
    rest = sorted(sizes, key=lambda p: (-(total * sizes[p] % all_rows), p))
    while sum(out.values()) < min(total, all_rows):
        for p in rest:
            if sum(out.values()) < total and out[p] < sizes[p]:
                out[p] += 1
    return out


def lloyd_step(routed: DataFrame, cells: RoutedCells) -> RoutedCells:
    """One assign-and-average pass of all cells; routed rows ``(vector, parent)`` meet the children of their parent."""
    left, right = _deal(routed, cells.children, cells.block_rows)

    def fold(lt: pa.Table, rt: pa.Table) -> pa.Table:
        lists, centres, v = _cells_of(rt, lt["vector"])
        code, dist = kernels.nearest(v, centres)
        n = np.bincount(code[:, 0], minlength=len(lists))
        sums = np.zeros_like(centres)
        np.add.at(sums, code[:, 0], v)
        live = np.flatnonzero(n)
        sse = np.bincount(code[:, 0], weights=dist[:, 0], minlength=len(lists))
        return pa.table({"list_id": pa.array(lists[live], pa.int64()), "n": pa.array(n[live].astype(float)),
                         "sse": pa.array(sse[live]), "sums": kernels.list_array(sums[live], pa.float64())})

    schema = "list_id long, n double, sse double, sums array<double>"
    key = ["parent", "_b"]
    partial = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(_only_rows(fold, schema), schema)
    means = add_arrays(partial, ["list_id"], ["n", "sse"], "sums")
    moved = cells.children.join(means, "list_id", "left").select(
        "parent", "list_id", F.when(F.col("n").isNull(), F.col("centre")).otherwise(
            F.transform("sums", lambda x: x / F.col("n"))).alias("centre"), "sse")
    moved = materialize(moved, "children")
    error = moved.agg(F.sum("sse")).first()[0] or 0.0
    return RoutedCells(cells.parents, moved.drop("sse"), cells.nlist, [*cells.objective, error], cells.block_rows)


def routed_from(parents: Codebook, children: DataFrame) -> RoutedCells:
    """Cells from stored parts."""
    return RoutedCells(parents, children, children.count())
