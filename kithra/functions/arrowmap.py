"""Add one Arrow-computed column to a DataFrame."""

from __future__ import annotations

import ctypes

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type


def with_arrow_column(df: DataFrame, name: str, data_type: str, source: str, compute) -> DataFrame:
    """``name = compute(source)``; ``compute`` maps a pyarrow array to an equally long one.

    Batches of the named column go through NumPy; all other columns pass
    unchanged.  Select what you need first: every column crosses to Python.
    """
    kept = [f for f in df.schema.fields if f.name != name]
    result = T.StructField(name, T._parse_datatype_string(data_type))
    empty = pa.array([], to_arrow_type(result.dataType))
    names = [f.name for f in kept]

    def run(batches):
        for batch in batches:
            column = compute(batch.column(source)) if batch.num_rows else empty
            yield pa.RecordBatch.from_arrays([batch.column(n) for n in names] + [column], names + [name])

    return df.mapInArrow(run, T.StructType(kept + [result]))


def add_arrays(partials: DataFrame, keys: list[str], counts: list[str], vector: str) -> DataFrame:
    """One row per ``keys``: the sums of ``counts`` and of the equally long arrays ``vector``, component by component.

    Partials stay one row each; no row per component is made.  They are added
    in sorted order, so the result does not depend on how they arrive.
    """
    every = F.sort_array(F.collect_list(vector))
    merged = partials.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in counts], every.alias(vector))
    total = F.aggregate(
        F.slice(vector, F.lit(2), F.size(vector)), F.get(vector, F.lit(0)), lambda s, x: F.zip_with(s, x, lambda a, b: a + b))
    return merged.withColumn(vector, total)


def release() -> None:
    """Give back what Arrow and, where there is one, glibc's allocator keep: a worker outlives its tasks."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)
