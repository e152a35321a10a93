"""The block join: compare every query with every base row of its group.

One physical form serves exact search (a single group), inverted lists (group =
cell), compressed search and voting.  Two shapes:

* a query side of proven small size is broadcast and each base partition keeps
  its running top-k, so only ``queries · k`` rows per partition are shuffled;
* otherwise each group is cut into a grid of (query block × base block) tasks of
  bounded size.  A group holding a third of all rows just gets more grid cells.

Both shapes emit result rows only (k per query, or the pairs inside a radius),
never the compared pairs, and need no shared key order.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import kernels
from ..session import materialize

BROADCAST_BYTES = 64 << 20
QUERY_BLOCK = 1 << 16
BASE_BLOCK = 1 << 17
TASKS_PER_CORE = 4
SPREAD_QUERIES = 1 << 12  # queries from which on a small base is dealt to all cores
GROUP_ROWS_BROADCAST = 1 << 20  # rows of (group, blocks) we let every task hold

PAIR = "query_id long, id long, distance double"


def _pairs_table(qids, ids, key, metric) -> pa.Table:
    return pa.table({
        "query_id": pa.array(qids, pa.int64()),
        "id": pa.array(ids, pa.int64()),
        "distance": pa.array(metric.value(key).astype(np.float64), pa.float64()),
    })


def bounded_rows(df: DataFrame, column: str, budget: int = BROADCAST_BYTES):
    """Row count of ``df`` if its vectors fit ``budget`` bytes, else None.

    One job that reads no more rows than could fit.
    """
    limit = budget // 16 + 1
    seen = df.select(F.size(column).alias("d")).limit(limit).agg(F.count("*").alias("n"), F.max("d").alias("d")).first()
    size = seen["n"] * (8 * (seen["d"] or 0) + 8)
    return seen["n"] if seen["n"] < limit and size <= budget else None


def small_side(df: DataFrame, rows: int = GROUP_ROWS_BROADCAST) -> DataFrame:
    """Mark ``df`` for broadcast if it has at most ``rows`` (narrow) rows; else leave it to be shuffled."""
    df = df.persist()
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def top_k(pairs: DataFrame, k: int, similarity: bool = False) -> DataFrame:
    """Per-query best k, ties by id; Spark plans a rank limit before the shuffle."""
    key = F.col("distance").desc() if similarity else F.col("distance").asc()
    window = Window.partitionBy("query_id").orderBy(key, F.col("id").asc())
    return (
        pairs.withColumn("rank", F.row_number().over(window))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "id", "distance")
    )


def block_join(
    queries: DataFrame,
    base: DataFrame,
    metric="l2",
    k: int | None = None,
    radius: float | None = None,
    group: str | None = None,
    query_vector: str = "vector",
    base_vector: str = "vector",
    query_block: int = QUERY_BLOCK,
    base_block: int = BASE_BLOCK,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Nearest pairs ``(query_id, id, distance)`` inside each group.

    ``queries`` has ``query_id`` and a vector, ``base`` has ``id`` and a vector,
    both have ``group`` if one is named.  Give ``k`` or ``radius``.  With ``k``
    the rows still need ``top_k`` over the blocks; ``search`` below does both.
    """
    if (k is None) == (radius is None):
        raise ValueError("give exactly one of k and radius")
    metric = kernels.metric_of(metric)
    queries = queries.filter(F.col(query_vector).isNotNull())
    base = base.filter(F.col(base_vector).isNotNull())
    if group is None and bounded_rows(queries, query_vector, broadcast_bytes) is not None:
        return _broadcast_form(queries, base, metric, k, radius, query_vector, base_vector, broadcast_bytes)
    return _grid_form(queries, base, metric, k, radius, group, query_vector, base_vector, query_block, base_block)


def search(queries, base, k, metric="l2", **options) -> DataFrame:
    """Exact top-k per query: ``(query_id, rank, id, distance)``."""
    found = block_join(queries, base, metric, k=k, **options)
    return top_k(found, k, kernels.metric_of(metric).similarity)


def _broadcast_form(queries, base, metric, k, radius, query_vector, base_vector, broadcast_bytes):
    rows = queries.select(F.col("query_id").cast("long"), F.col(query_vector).alias("v")).toArrow()
    qids, q = kernels.longs(rows["query_id"]), kernels.matrix(rows["v"], metric.dtype)
    shared = queries.sparkSession.sparkContext.broadcast((qids, q))

    def scan(batches):
        qids, q = shared.value
        best = kernels.TopK(len(q), k) if k else None
        for batch in batches:
            if not batch.num_rows or not len(q):
                continue
            ids, b = kernels.longs(batch.column(0)), kernels.matrix(batch.column(1), metric.dtype)
            if k:
                best.scan(metric, q, b, ids)
            else:
                for qi, bj, key in kernels.within(metric, q, b, radius):
                    yield from _pairs_table(qids[qi], ids[bj], key, metric).to_batches()
        if k:
            qi, ids, key = best.flat()
            yield from _pairs_table(qids[qi], ids, key, metric).to_batches()

    rows = base.select(F.col("id").cast("long"), F.col(base_vector).alias("v"))
    cores = queries.sparkSession.sparkContext.defaultParallelism
    if int(str(rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) <= broadcast_bytes and len(q) > SPREAD_QUERIES:
        # a small base has few splits, but many queries make each of its rows dear
        rows = rows.repartition(cores)
    elif k:
        # every task hands on k rows per query: a few tasks per core are enough of them
        rows = rows.coalesce(TASKS_PER_CORE * cores)
    return rows.mapInArrow(scan, PAIR)


def computed_once(df: DataFrame) -> DataFrame:
    """Rows that Python makes (probes, codes) are written before they are counted and joined; scans are read twice instead."""
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return materialize(df, "rows") if "InArrow" in plan or "InPandas" in plan else df


def block_counts(df: DataFrame, group: str, rows: int, name: str) -> DataFrame:
    """Number of blocks of at most about ``rows`` rows per group."""
    return df.groupBy(group).agg(F.ceil(F.count("*") / F.lit(rows)).cast("int").alias(name))


def grid(left: DataFrame, right: DataFrame, group: str, left_rows: int, right_rows: int, left_key: Column, right_key: Column):
    """Cut every group into ``lb × rb`` cells; each row visits its row of cells.

    With up to ``GROUP_ROWS_BROADCAST`` groups the block counts are broadcast,
    which also drops rows whose group has no partner.  With more groups only
    those needing several cells are looked up: at most (rows / block rows).
    """
    if left is right:
        counts = block_counts(left, group, left_rows, "_nl").withColumn("_nr", F.col("_nl"))
    else:
        counts = block_counts(left, group, left_rows, "_nl").join(block_counts(right, group, right_rows, "_nr"), group, "full")
    counts = counts.persist()
    partners = counts.filter("_nl is not null and _nr is not null")
    if partners.limit(GROUP_ROWS_BROADCAST + 1).count() <= GROUP_ROWS_BROADCAST:
        lookup, how = F.broadcast(partners), "inner"
    else:
        lookup, how = counts.filter("_nl > 1 or _nr > 1"), "left"
        if lookup.limit(GROUP_ROWS_BROADCAST + 1).count() <= GROUP_ROWS_BROADCAST:
            lookup = F.broadcast(lookup)
    nl, nr = F.coalesce("_nl", F.lit(1)), F.coalesce("_nr", F.lit(1))
    lrows = left.join(lookup, group, how).select(
        *left.columns, F.pmod(left_key, nl).cast("int").alias("_lb"),
        F.explode(F.sequence(F.lit(0), nr - 1)).alias("_rb"),
    )
    rrows = right.join(lookup, group, how).select(
        *right.columns, F.pmod(right_key, nr).cast("int").alias("_rb"),
        F.explode(F.sequence(F.lit(0), nl - 1)).alias("_lb"),
    )
    return lrows, rrows


def _grid_form(queries, base, metric, k, radius, group, query_vector, base_vector, query_block, base_block):
    key = F.lit(0) if group is None else F.col(group)
    left = computed_once(queries.select(key.alias("_g"), F.col("query_id").cast("long"), F.col(query_vector).alias("v")))
    right = computed_once(base.select(key.alias("_g"), F.col("id").cast("long"), F.col(base_vector).alias("v")))
    # rows of one id (an image's descriptors) spread over the blocks as well
    left, right = grid(left, right, "_g", query_block, base_block, F.xxhash64("query_id", "v"), F.xxhash64("id", "v"))

    def compare(lt: pa.Table, rt: pa.Table) -> pa.Table:
        empty = _pairs_table(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0), metric)
        if not lt.num_rows or not rt.num_rows:
            return empty
        qids, q = kernels.longs(lt["query_id"]), kernels.matrix(lt["v"], metric.dtype)
        ids, b = kernels.longs(rt["id"]), kernels.matrix(rt["v"], metric.dtype)
        if k:
            best = kernels.TopK(len(q), k)
            for lo in range(0, len(b), 8192):
                best.scan(metric, q, b[lo:lo + 8192], ids[lo:lo + 8192])
            qi, found, key = best.flat()
            return _pairs_table(qids[qi], found, key, metric)
        parts = [
            _pairs_table(qids[qi], ids[bj], found, metric)
            for qi, bj, found in kernels.within(metric, q, b, radius)
        ]
        return pa.concat_tables(parts) if parts else empty

    cell = ["_g", "_lb", "_rb"]
    return left.groupBy(*cell).cogroup(right.groupBy(*cell)).applyInArrow(compare, PAIR)
