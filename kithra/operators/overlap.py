"""Pairs of word sets that may be similar enough, found block by block.

A word is numbered by its hash, the numbers ordered by how many sets hold them;
words that share a number only make two sets look more alike, so no pair is
lost and the caller decides on the words themselves.  Sets are ordered by size
and cut into blocks.  One task takes two blocks and counts, in arrays, the
rarest words that their sets share: what leaves it are the pairs whose count
leaves the overlap possible, never the shared words.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.arrowmap import release
from ..functions.kernels import longs

NUMBERS = 1 << 21  # numbers that words are hashed to
BLOCK_ROWS = 1 << 17  # sets of one block
BLOCK_WORDS = 20 << 20  # prefix words of one block
SMALL_BLOCK = 1 << 20  # below so many prefix words a table is not cut
BLOCKS = 8  # into which smaller tables are cut, so that there is a cell for every core
EXTRA = 0.1  # share of its words that a set's prefix is longer than one shared word needs
SLICE = 1 << 15  # sets whose words are listed at once by a task
ASKING, ASKED, ALONE = 0, 1, 2  # sides of a cell; a block with itself has one
NEAR_ZERO = 1e-6  # rounding of a product of a size and the threshold

CODED = "set_id long, size int, unshared int, block int, ids binary"


def _least(size, share):
    """The least whole number above ``share`` of ``size``, or a little less."""
    return np.ceil(size * share - NEAR_ZERO).astype(np.int64)


def _extra(size, needed):
    """Shared words that a prefix promises, of a set that needs ``needed`` of them in all."""
    return np.maximum(np.minimum(np.ceil(size * EXTRA).astype(np.int64), needed), 1)


def prefix_length(size, share):
    """Length of the prefix of a set whose overlap must exceed ``share`` of its size."""
    needed = _least(size, share)
    return np.minimum(size - needed + _extra(size, needed), size)


def _numbered(column):
    return F.pmod(F.xxhash64(column), F.lit(NUMBERS)).cast("int")


def word_order(*tables: DataFrame) -> tuple[np.ndarray, int]:
    """Rank of every number, rarest first, and the first rank that two sets share."""
    tokens = None
    for sets in tables:
        own = sets.select(F.explode("words").alias("word")).select(_numbered("word").alias("number"))
        tokens = own if tokens is None else tokens.unionAll(own)
    found = tokens.groupBy("number").agg(F.count("*").alias("n")).toArrow()
    count = np.zeros(NUMBERS, np.int64)
    count[longs(found["number"])] = longs(found["n"])
    rank = np.empty(NUMBERS, np.int32)
    rank[np.argsort(count, kind="stable")] = np.arange(NUMBERS, dtype=np.int32)
    return rank, int((count < 2).sum())


class Blocks:
    """Cut of a table of sets by size; a size with many sets is cut by the hash of their ids."""

    def __init__(self, sets: DataFrame, share: float, block_rows: int):
        found = sets.groupBy(F.size("words").alias("size")).agg(F.count("*").alias("n")).toArrow()
        sizes, counts = longs(found["size"]), longs(found["n"])
        order = np.argsort(sizes)
        self.sizes, counts = sizes[order], counts[order]
        words = (counts * prefix_length(self.sizes, share)).astype(float)
        total = words.sum()
        n = max(np.ceil(total / BLOCK_WORDS), min(np.ceil(total / SMALL_BLOCK), BLOCKS), np.ceil(counts.sum() / block_rows))
        self.number = int(max(n, 1))
        self.weight = words * self.number / max(total, 1)
        self.start = np.cumsum(self.weight) - self.weight

    def of(self, size, spread):
        """Block of the sets of these sizes; ``spread`` lies in [0, 1)."""
        at = np.searchsorted(self.sizes, size)
        return np.minimum(self.start[at] + spread * self.weight[at], self.number - 1).astype(np.int32)

    def bounds(self) -> tuple[np.ndarray, np.ndarray]:
        """Least and largest size that each block may hold."""
        block = np.arange(self.number)
        low = np.searchsorted(self.start + self.weight, block - NEAR_ZERO, side="left")
        high = np.searchsorted(self.start, block + 1 + NEAR_ZERO, side="right") - 1
        last = max(len(self.sizes) - 1, 0)
        return (self.sizes[np.clip(low, 0, last)], self.sizes[np.clip(high, 0, last)]) if len(self.sizes) else (block, block)


def _packed(words, lengths) -> pa.Array:
    """Ascending words of each row as differences of three bytes: first the low bytes of a row, then the middle, then the high ones."""
    ends = np.cumsum(lengths)
    starts = ends - lengths
    place = np.arange(len(words)) - np.repeat(starts, lengths)
    step = np.diff(words, prepend=0)
    step[place == 0] = words[place == 0]
    out, at, wide = np.empty(3 * len(words), np.uint8), np.repeat(3 * starts, lengths) + place, np.repeat(lengths, lengths)
    for byte in range(3):
        out[at + byte * wide] = step >> 8 * byte & 255
    offsets = pa.py_buffer(np.r_[0, 3 * ends].astype(np.int32))
    return pa.Array.from_buffers(pa.binary(), len(lengths), [None, offsets, pa.py_buffer(out)])


def _unpacked(data: np.ndarray) -> np.ndarray:
    low, middle, high = data.reshape(3, -1).astype(np.int32)
    return np.cumsum(low | middle << 8 | high << 16)


def _coded(sets: DataFrame, order, blocks: Blocks, share: float) -> DataFrame:
    """``CODED`` rows: each set's prefix, without the words that no other set has."""
    rank, first = order
    shared = sets.sparkSession.sparkContext.broadcast(rank)
    rows = sets.select(
        F.col("set_id").cast("long"), (F.pmod(F.xxhash64("set_id", "words"), F.lit(1 << 20)) / F.lit(float(1 << 20))).alias("spread"),
        F.transform("words", _numbered).alias("ids"))

    def code(batches):
        for batch in batches:
            ids = batch.column(2)
            size = np.diff(ids.offsets.to_numpy())
            flat = shared.value[ids.flatten().to_numpy(zero_copy_only=False)]
            row = np.repeat(np.arange(len(size)), size)
            flat = np.sort(row * NUMBERS + flat) - row * NUMBERS
            unshared = np.bincount(row[flat < first], minlength=len(size))
            place = np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)
            keep = (flat >= first) & (place < np.repeat(prefix_length(size, share), size))
            kept = np.bincount(row[keep], minlength=len(size))
            ids = _packed(flat[keep], kept)
            out = pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(size, pa.int32()), pa.array(unshared, pa.int32()),
                pa.array(blocks.of(size, batch.column(1).to_numpy()), pa.int32()), ids],
                ["set_id", "size", "unshared", "block", "ids"])
            yield out.filter(pa.array(kept > 0))
        release()

    return rows.mapInArrow(code, CODED)


class _Side:
    """One block's sets, smallest first."""

    def __init__(self, rows: pa.Table, share: float):
        ids, size = longs(rows["set_id"]), longs(rows["size"])
        order = np.lexsort((ids, size))
        self.ids, self.size, self.unshared = ids[order], size[order], longs(rows["unshared"])[order]
        self.prefix = prefix_length(self.size, share)
        self.data, self.starts, self.ends = np.empty(0, np.uint8), np.empty(0, np.int64), np.empty(0, np.int64)
        if len(ids):
            packed = rows["ids"].combine_chunks()
            offsets = np.frombuffer(packed.buffers()[1], np.int32)[packed.offset:packed.offset + len(packed) + 1].astype(np.int64)
            self.data = np.frombuffer(packed.buffers()[2], np.uint8)
            self.starts, self.ends = offsets[:-1][order], offsets[1:][order]

    def words(self, row) -> np.ndarray:
        """The prefix, without the unshared words it begins with."""
        found = _unpacked(self.data[self.starts[row]:self.ends[row]])
        return found[:max(self.prefix[row] - self.unshared[row], 0)]


def _pairs(left: _Side, right: _Side, threshold: float, own: bool):
    """Rows of the pairs that may overlap enough; ``own``: of a block with itself, the later set of a pair on the left."""
    found = [(np.empty(0, np.int64),) * 2]
    # the prefix that ends first keeps its promise, and the smallest partner's promises least
    smallest = np.maximum(_least(left.size, threshold), 1)
    promised = np.minimum(_extra(left.size, _least(left.size, threshold)), _extra(smallest, _least(smallest, threshold)))
    for low in range(0, len(right.ids), SLICE):
        high = min(low + SLICE, len(right.ids))
        lists = [right.words(row) for row in range(low, high)]
        lengths = np.array([len(x) for x in lists])
        # a prefix without shared words is in no pair: nothing counts it
        last = np.array([x[-1] if len(x) else -1 for x in lists])
        words = np.concatenate(lists).astype(np.int32)
        posts = np.repeat(np.arange(high - low, dtype=np.int32), lengths)[np.argsort(words, kind="stable")]
        at = np.r_[0, np.cumsum(np.bincount(words, minlength=NUMBERS))]
        del lists, words
        size, rest = right.size[low:high], right.size[low:high] - right.prefix[low:high]
        near = np.flatnonzero((size[-1] > threshold * left.size - NEAR_ZERO) & (left.size > threshold * size[0] - NEAR_ZERO))
        for i in near[near > low].tolist() if own else near.tolist():
            mine = left.words(i)
            begin, end = at[mine], at[mine + 1]
            some = begin < end
            if not some.any():
                continue
            n, stop = left.size[i], min(i - low, high - low) if own else high - low
            seen = np.bincount(np.concatenate([posts[x:y] for x, y in zip(begin[some].tolist(), end[some].tolist())]), minlength=stop)
            hit = np.flatnonzero(seen[:stop] >= promised[i])
            if not len(hit):
                continue
            need = _least(n + size[hit], threshold / (1 + threshold))
            # what else can be shared stands behind the prefix that ends first
            behind = n - left.unshared[i] - np.searchsorted(mine, last[hit])
            more = np.where(last[hit] <= mine[-1], np.minimum(rest[hit], behind), n - left.prefix[i])
            hit = hit[(np.minimum(n, size[hit]) >= need) & (seen[hit] + more >= need)]
            found.append((np.full(len(hit), i), hit + low))
    return tuple(np.concatenate(x) for x in zip(*found))


def similar_sets(left: DataFrame, right: DataFrame | None, threshold: float, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Pairs ``(a, b)`` of sets ``(set_id, words)`` among which are all with a Jaccard above the threshold.

    ``right=None`` joins the sets with themselves, each pair once with a < b.
    Sets without an id or without words are in no pair.
    """
    spark, own = left.sparkSession, right is None
    tables = [t.select("set_id", "words").filter("set_id is not null and size(words) > 0") for t in ([left] if own else [left, right])]
    order = word_order(*tables)
    # of two sets of one table the larger asks; the smaller then needs a larger share
    asking, asked = threshold, 2 * threshold / (1 + threshold) if own else threshold
    blocks = [Blocks(t, asking, block_rows) for t in tables]
    coded = [_coded(t, order, b, asking) for t, b in zip(tables, blocks)]
    (low, high), (other_low, other_high) = blocks[0].bounds(), blocks[-1].bounds()
    cells, visits = 0, []
    for i in range(blocks[0].number):
        for j in range(i + 1 if own else blocks[1].number):
            if other_high[j] > threshold * low[i] - NEAR_ZERO and high[i] > threshold * other_low[j] - NEAR_ZERO:
                visits += [(0, i, cells, ALONE)] if own and i == j else [(0, i, cells, ASKING), (0 if own else 1, j, cells, ASKED)]
                cells += 1
    lookup = F.broadcast(spark.createDataFrame(visits, "_t int, block int, cell int, side int"))
    rows = None
    for number, table in enumerate(coded):
        part = table.join(lookup.filter(F.col("_t") == number).drop("_t"), "block").select("cell", "side", "set_id", "size", "unshared", "ids")
        rows = part if rows is None else rows.unionAll(part)

    def compare(table: pa.Table) -> pa.Table:
        side = longs(table["side"])
        one = table.filter(pa.array(side != ASKED))
        alone = bool((side == ALONE).any())
        a = _Side(one, asking)
        b = _Side(one if alone else table.filter(pa.array(side == ASKED)), asked)
        x, y = _pairs(a, b, threshold, alone)
        x, y = a.ids[x], b.ids[y]
        if own:
            x, y = np.minimum(x, y), np.maximum(x, y)
            x, y = x[x < y], y[x < y]
        release()
        return pa.table({"a": pa.array(x, pa.int64()), "b": pa.array(y, pa.int64())})

    return rows.groupBy("cell").applyInArrow(compare, "a long, b long")
