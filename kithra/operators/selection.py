"""Exact quantiles of every dimension of a vector column in a few counting passes.

A double becomes an unsigned integer of the same order.  Each pass counts, for
every dimension and wanted rank, the values whose leading bits are those found
so far by their next bits; the count that holds the rank gives these bits.  No
group holds a dimension's values, whatever their number and their ties.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import arrays, kernels
from ..functions.arrowmap import add_arrays
from ..session import materialize

STEP = 12  # bits of a pass
CHUNK = 1 << 12  # rows that are counted at once


def sortable(x: np.ndarray) -> np.ndarray:
    """Doubles → unsigned 64-bit integers of the same order; both zeros are one."""
    bits = np.ascontiguousarray(x + 0.0).view(np.uint64)
    return np.where(bits >> np.uint64(63), ~bits, bits | np.uint64(1 << 63))


def from_sortable(keys: np.ndarray) -> np.ndarray:
    bits = np.where(keys >> np.uint64(63), keys & np.uint64((1 << 63) - 1), ~keys)
    return np.ascontiguousarray(bits).view(np.float64)


def exact_quantiles(df: DataFrame, probabilities: list[float], vector: str = "vector") -> np.ndarray:
    """probabilities × dimensions; between two order statistics the value is interpolated.

    Null vectors, and components that are null or no number, do not count; a
    dimension without values gives NaN.
    """
    rows = materialize(df.select(arrays.doubles(vector).alias("v")).filter(F.col("v").isNotNull()), "values")
    sizes = _count(rows, None, None, 0)
    if sizes is None:
        return np.full((len(probabilities), 0), np.nan)
    n = sizes[0][:, 0]
    place = np.array(probabilities)[:, None] * np.maximum(n - 1, 0)[None, :]
    low = np.floor(place).astype(np.int64)
    # both neighbours of every place, as ranks to be found
    ranks = np.concatenate([low, np.minimum(low + 1, np.maximum(n - 1, 0)[None, :])])
    found = np.zeros(ranks.shape, np.uint64)
    done = 0
    while done < 64:
        step = min(STEP, 64 - done)
        counts = _count(rows, found, done, step)
        upto = counts.cumsum(axis=2)
        bin_ = (upto <= ranks[:, :, None]).sum(axis=2)
        bin_ = np.minimum(bin_, (1 << step) - 1)
        before = np.where(bin_ > 0, np.take_along_axis(upto, np.maximum(bin_ - 1, 0)[:, :, None], 2)[:, :, 0], 0)
        ranks = ranks - before
        found = (found << np.uint64(step)) | bin_.astype(np.uint64)
        done += step
    values = from_sortable(found)
    values[:, n == 0] = np.nan
    below, above = values[:len(probabilities)], values[len(probabilities):]
    between = place > low  # at a value itself nothing is added, also beside an infinite one
    return np.where(between, below + np.where(between, above - below, 0.0) * (place - low), below)


def _count(rows: DataFrame, found: np.ndarray | None, done: int | None, step: int) -> np.ndarray | None:
    """ranks × dimensions × 2^step counts of the next bits behind the bits found; with ``found`` None, of all values.

    Ranks that have the same bits so far share their counts.
    """
    firsts = [] if found is None else [int(np.flatnonzero((found[:r + 1] == found[r]).all(axis=1))[0]) for r in range(len(found))]
    wanted = sorted(set(firsts)) or [0]

    def fold(batches):
        total = None
        for batch in batches:
            for start in range(0, batch.num_rows, CHUNK):
                x = kernels.matrix(batch.column(0).slice(start, CHUNK))
                d = x.shape[1]
                total = np.zeros((len(wanted), d, 1 << step), np.int64) if total is None else total
                real = ~np.isnan(x)
                if found is None:
                    total[0, :, 0] += real.sum(axis=0)
                    continue
                keys = sortable(x)
                head = keys >> np.uint64(64 - done) if done else np.zeros_like(keys)
                part = (keys >> np.uint64(64 - done - step)) & np.uint64((1 << step) - 1)
                for i, r in enumerate(wanted):
                    row, dim = np.nonzero(real & (head == found[r][None, :]))
                    at = dim * (1 << step) + part[row, dim].astype(np.int64)
                    total[i] += np.bincount(at, minlength=d << step).reshape(d, 1 << step)
        if total is not None:
            for i in range(len(wanted)):
                yield pa.record_batch({"r": pa.array(np.full(total.shape[1], i), pa.int32()), "dim": pa.array(np.arange(total.shape[1]), pa.int32()),
                                       "n": pa.array(np.ones(total.shape[1], np.int64)), "counts": kernels.list_array(total[i], pa.int64())})

    partial = rows.mapInArrow(fold, "r int, dim int, n long, counts array<long>")
    # as many rows as there are ranks and dimensions
    merged = add_arrays(partial, ["r", "dim"], ["n"], "counts").toArrow()
    if not merged.num_rows:
        return None
    r, dim = kernels.longs(merged["r"]), kernels.longs(merged["dim"])
    out = np.zeros((len(wanted), dim.max() + 1, 1 << step), np.int64)
    out[r, dim] = kernels.matrix(merged["counts"], np.int64)
    return out if found is None else out[[wanted.index(f) for f in firsts]]
