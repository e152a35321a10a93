"""Joins on keys of which a few may hold a large share of the rows, and lookups of checked size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOT_KEYS = 1 << 15  # at most so many keys are broadcast, whatever the input
HOT_ROWS = 1 << 12  # a key below this is never called hot


def hot_join(rows: DataFrame, lookup: DataFrame, on: str, count: str = "n") -> DataFrame:
    """Inner join with a table that has one row per key and the key's row ``count``.

    Keys above both ``HOT_ROWS`` and total / ``HOT_KEYS`` rows can be no more
    than ``HOT_KEYS``; their lookup rows are broadcast and their data rows are
    not shuffled.  All other keys are joined as usual.  ``lookup`` is read more
    than once, so it should be a written table.
    """
    total, top = lookup.agg(F.sum(count), F.max(count)).first()
    limit = max(HOT_ROWS, (total or 0) // HOT_KEYS)
    if (top or 0) <= limit:
        return rows.join(lookup, on)
    hot = F.broadcast(lookup.filter(F.col(count) > limit))
    rest = rows.join(F.broadcast(lookup.filter(F.col(count) > limit).select(on)), on, "left_anti")
    return rows.join(hot, on).unionByName(rest.join(lookup.filter(F.col(count) <= limit), on))


SMALL_IDS = 2_000_000  # ids that may be broadcast: some tens of MB, whatever the input


def keep_ids(rows: DataFrame, ids: DataFrame, on, how: str = "left_semi") -> DataFrame:
    """Semi or anti join with a written table of distinct ids: broadcast while few, shuffled beyond."""
    few = ids.limit(SMALL_IDS + 1).count() <= SMALL_IDS
    return rows.join(F.broadcast(ids) if few else ids, on, how)
