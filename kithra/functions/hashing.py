"""Deterministic pseudo-randomness: a value depends on the key and the seed only.

Unlike ``rand()`` the result does not change with the partitioning, and any SQL
engine with ``md5`` can recompute it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HASH_RANGE = 1 << 32  # keyed_hash is a 32-bit unsigned number


def keyed_hash(*parts, seed: int = 0) -> Column:
    """First 32 bits of md5("p1:p2:…:seed") as a long."""
    text = F.concat_ws(":", *[_string(p) for p in parts], F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("long")


def keyed_uniform(*parts, seed: int = 0) -> Column:
    """A double in [0, 1)."""
    return keyed_hash(*parts, seed=seed) / F.lit(float(HASH_RANGE))


def token_hash31(token: Column) -> Column:
    """31-bit token hash: small enough that a·h + b fits a long."""
    return F.conv(F.substring(F.md5(token.cast("binary")), 1, 8), 16, 10).cast("long").bitwiseAND(F.lit(0x7FFFFFFF))


def _string(part) -> Column:
    col = F.col(part) if isinstance(part, str) else part
    if not isinstance(col, Column):
        col = F.lit(col)
    return col.cast("string")
