"""Global row numbers and exact order statistics without a one-task window."""

from __future__ import annotations

from bisect import bisect_right

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import materialize


def with_ordinal(df: DataFrame, order: list[str | Column], name: str = "ordinal", start: int = 0) -> DataFrame:
    """Adds 0, 1, 2, … in the given order, which should be total.

    Rows are range-partitioned and sorted; each partition is numbered on its
    own and shifted by the sizes of the partitions before it.  The partitioning
    samples its input, so it is written once and both passes read that.
    """
    order = [F.col(c) if isinstance(c, str) else c for c in order]
    keys = {f"_k{i}": c for i, c in enumerate(order)}
    ranged = df.withColumns(keys).repartitionByRange(*[F.col(k) for k in keys])
    parts = materialize(ranged.withColumn("_part", F.spark_partition_id()), "ordinal")
    sizes = parts.groupBy("_part").agg(F.count("*").alias("_n")).collect()  # one row per partition
    offsets, total = [], start
    for row in sorted(sizes, key=lambda r: r["_part"]):
        offsets.append((row["_part"], total))
        total += row["_n"]
    if not offsets:
        return df.withColumn(name, F.lit(0).cast("long"))
    table = df.sparkSession.createDataFrame(offsets, "_part int, _offset long")
    window = Window.partitionBy("_part").orderBy(*keys)
    return (
        parts.join(F.broadcast(table), "_part")
        .withColumn(name, F.col("_offset") + F.row_number().over(window) - 1)
        .drop("_part", "_offset", *keys)
    )


def quantiles(df: DataFrame, column: str, probabilities: list[float]) -> list[float]:
    """Exact quantiles with linear interpolation between order statistics."""
    values = df.select(F.col(column).cast("double").alias("x")).filter("x is not null")
    # equal values are counted, not numbered: the work is per distinct value
    counts = values.groupBy("x").agg(F.count("*").alias("n"))
    n = values.count()
    if n == 0:
        raise ValueError("no values")
    ranks = sorted({r for p in probabilities for r in (int(p * (n - 1)), min(int(p * (n - 1)) + 1, n - 1))})
    ordered, starts = _running_counts(counts)
    # a rank is looked for in the one partition that holds it
    first = [offset for _, offset in starts]
    wanted = [(starts[bisect_right(first, r) - 1][0], int(r)) for r in ranks]
    table = df.sparkSession.createDataFrame(wanted, "_part int, rank long")
    hits = (
        ordered.join(F.broadcast(table), "_part")
        .filter((F.col("rank") >= F.col("before")) & (F.col("rank") < F.col("before") + F.col("n")))
        .select("rank", "x").collect()
    )
    at = {h["rank"]: h["x"] for h in hits}
    out = []
    for p in probabilities:
        place = p * (n - 1)
        low = int(place)
        high = min(low + 1, n - 1)
        out.append(at[low] + (at[high] - at[low]) * (place - low))
    return out


def _running_counts(counts: DataFrame) -> tuple[DataFrame, list[tuple[int, int]]]:
    """Rows of (x, n) with ``_part`` and ``before`` = number of smaller values, and where each partition starts."""
    parts = materialize(counts.repartitionByRange("x").withColumn("_part", F.spark_partition_id()), "running")
    sizes = parts.groupBy("_part").agg(F.sum("n").alias("_n")).collect()  # one row per partition
    offsets, total = [], 0
    for row in sorted(sizes, key=lambda r: r["_part"]):
        offsets.append((row["_part"], total))
        total += row["_n"]
    table = counts.sparkSession.createDataFrame(offsets, "_part int, _offset long")
    window = Window.partitionBy("_part").orderBy("x").rowsBetween(Window.unboundedPreceding, -1)
    ordered = parts.join(F.broadcast(table), "_part").select(
        "_part", "x", "n", (F.col("_offset") + F.coalesce(F.sum("n").over(window), F.lit(0))).alias("before"))
    return ordered, offsets


def running_counts(counts: DataFrame) -> DataFrame:
    """(x, n) rows with ``before``, the number of smaller values."""
    return _running_counts(counts)[0].drop("_part")
