"""Joins against a key table when one key may hold a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOT_ROWS = 1 << 20
HOT_KEYS = 1 << 14  # keys that may be broadcast, with what their lookup rows carry


def lookup_join(df: DataFrame, lookup: DataFrame, on: str, count: str, hot_rows: int = HOT_ROWS, how="inner") -> DataFrame:
    """Join rows to a table with one row per key and the key's row ``count``.

    Keys above ``hot_rows`` are few (at most rows / hot_rows, and counted): their
    lookup rows are broadcast and their data rows never shuffled; all other
    keys, or all of them if too many are hot, go through an ordinary join.
    """
    hot = lookup.filter(F.col(count) > hot_rows)
    if not 0 < hot.limit(HOT_KEYS + 1).count() <= HOT_KEYS:
        return df.join(lookup, on, how)
    few = F.broadcast(hot)
    keys = F.broadcast(hot.select(on))
    cold = df.join(keys, on, "left_anti").join(lookup.filter(F.col(count) <= hot_rows), on, how)
    return df.join(few, on).unionByName(cold)
