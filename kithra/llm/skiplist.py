"""Fill-in-the-middle: texts cut in three at two ranks of an indexable skip list.

A text's *units* are code points or the matches of a pattern; code points that
no match covers are units of their own.  A skip list over the units has express
lanes of ever fewer nodes; every link carries how many units and how many code
points it passes.  A descent adds these widths until the rank is reached, and
so turns a rank in units into a place in the text.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ship_package

MARKERS = ("<P>", "<S>", "<M>")  # before prefix, suffix and middle
SEED = 1
RATE = 90  # percent of the texts that are transformed
SPM_RATE = 20  # percent of those with the suffix first
STEP_BITS = 3  # a lane has about one node for 2**STEP_BITS of the lane below


class Lanes:
    """Which ranks stand on which lane: decided by a hash of the rank, so alike for all texts.

    ``ranks[k]`` are the nodes of lane k, rank 0 (the head) first; ``below[k]``
    is where each of them stands on lane k - 1.  Both grow on demand; a text
    with n units uses the nodes below n.
    """

    def __init__(self):
        self.size, self.ranks, self.below = 0, [], []

    def grow(self, n: int) -> None:
        if n <= self.size:
            return
        size = max(1024, 1 << (n - 1).bit_length())
        x = np.arange(size, dtype=np.uint64) + np.uint64(0x9E3779B97F4A7C15)
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
        x ^= x >> np.uint64(31)
        ranks, below, nodes, height = [], [np.zeros(0, np.int64)], np.arange(size), 0
        while len(nodes) > 1:
            ranks.append(nodes)
            height += 1
            high = (x[nodes] & np.uint64((1 << STEP_BITS * height) - 1)) == 0
            high[0] = True
            below.append(np.flatnonzero(high))
            nodes = nodes[high]
        self.size, self.ranks, self.below = size, ranks, below[:len(ranks)]


_LANES = Lanes()


class SkipList:
    """The skip list of one text: ``starts`` are the code point offsets of its units, and the text's length last."""

    def __init__(self, starts: np.ndarray):
        self.n = n = len(starts) - 1
        _LANES.grow(n)
        self.lanes = []
        for level, (ranks, below) in enumerate(zip(_LANES.ranks, _LANES.below)):
            count = int(np.searchsorted(ranks, n)) if level else n
            if level and count < 2:
                break
            ends = np.append(ranks[:count], n)
            self.lanes.append((np.diff(ends), np.diff(starts[ends]), below))

    def reach(self, rank: int) -> int:
        """Code points before the unit of this rank; ``rank`` n is the end of the text."""
        units = points = node = 0
        for level in range(len(self.lanes) - 1, -1, -1):
            unit_widths, point_widths, below = self.lanes[level]
            while node < len(unit_widths) and units + unit_widths[node] <= rank:
                units += int(unit_widths[node])
                points += int(point_widths[node])
                node += 1
            if level:
                if node == len(unit_widths):
                    return points  # the last link of a lane ends with the text
                node = int(below[node])
        return points


def unit_starts(text: str, pattern: re.Pattern | None) -> np.ndarray:
    """Code point offsets of the units, matched from left to right, and the length of the text."""
    if pattern is None:
        return np.arange(len(text) + 1)
    starts, at = [], 0
    for match in pattern.finditer(text):
        low, high = match.span()
        if high > low:
            starts.extend(range(at, low))
            starts.append(low)
            at = high
    starts.extend(range(at, len(text) + 1))
    return np.array(starts, np.int64)


def cut_places(text: str, ranks: tuple[int, int], pattern: re.Pattern | None) -> tuple[int, int, int]:
    """Units of the text, and the code points before its two cuts; ranks are taken modulo one more than its units."""
    units = SkipList(unit_starts(text, pattern))
    first, second = sorted(rank % (units.n + 1) for rank in ranks)
    return units.n, units.reach(first), units.reach(second)


def key_hash(key: str | Column, place: int, seed: int = SEED) -> Column:
    """The ``place``-th 32-bit number of sha256("seed:key"); a null key is written as nothing."""
    key = F.col(key) if isinstance(key, str) else key
    said = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))
    return F.conv(F.substring(F.sha2(said, 256), 8 * place + 1, 8), 16, 10).cast("long")


def check_markers(markers) -> None:
    """Markers must be found again: none inside another, and none able to overlap one or itself."""
    for a in markers:
        for b in markers:
            if not a or a is not b and a in b or any(a.endswith(b[:k]) for k in range(1, len(b)) if k < len(a)):
                raise ValueError(f"markers {a!r} and {b!r} could be mistaken in a text")


def fill_in_middle(docs: DataFrame, key: str = "doc_id", text: str = "text", unit: str | None = None, markers=MARKERS,
                   rate: int = RATE, spm_rate: int = SPM_RATE, seed: int = SEED) -> DataFrame:
    """Per row of ``docs``: key, n (units), form, prefix_chars, middle_chars (code points), output.

    ``unit`` is a regular expression, a code point if none is given.  Two
    hashes of the key choose the cuts, a third whether the text stays as it is
    (``plain``) and a fourth the order: ``psm`` is marked prefix, suffix and
    middle, ``spm`` marked suffix, prefix and middle.  Empty and null texts
    (taken as empty) and texts that hold a marker are plain, with null lengths.
    A null key hashes as an empty one; rows of one key are cut alike.  No row
    is shuffled, and other columns of ``docs`` are not looked at.
    """
    check_markers(markers)
    ship_package(docs.sparkSession)
    kind = docs.schema[key].dataType.simpleString()
    body = F.coalesce(text, F.lit(""))
    plain = (body == "") | (key_hash(key, 2, seed) % 100 >= rate)
    for mark in markers:
        plain = plain | F.contains(body, F.lit(mark))
    rows = docs.select(
        F.col(key).alias("key"), body.alias("text"), key_hash(key, 0, seed).alias("a"), key_hash(key, 1, seed).alias("b"),
        F.when(plain, "plain").when(key_hash(key, 3, seed) % 100 < spm_rate, "spm").otherwise("psm").alias("form"))
    before, after, between = markers

    def cut(batches):
        pattern = None if unit is None else re.compile(unit)
        for batch in batches:
            counts, prefix, middle, output = [], [], [], []
            for text, a, b, form in zip(*(batch.column(i).to_pylist() for i in range(1, 5))):
                if form == "plain":
                    counts.append(len(text) if pattern is None else len(unit_starts(text, pattern)) - 1)
                    prefix.append(None)
                    middle.append(None)
                    output.append(text)
                    continue
                n, low, high = cut_places(text, (a, b), pattern)
                counts.append(n)
                prefix.append(low)
                middle.append(high - low)
                head, tail = before + text[:low], after + text[high:]
                output.append((head + tail if form == "psm" else tail + head) + between + text[low:high])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), batch.column(4), pa.array(prefix, pa.int64()),
                 pa.array(middle, pa.int64()), pa.array(output, pa.string())],
                [key, "n", "form", "prefix_chars", "middle_chars", "output"])

    return rows.mapInArrow(cut, f"`{key}` {kind}, n long, form string, prefix_chars long, middle_chars long, output string")


def restored(output: str | Column = "output", form: str | Column = "form", markers=MARKERS) -> Column:
    """The text that an output was made from: its three parts are found by their markers and put in order."""
    output = F.col(output) if isinstance(output, str) else output
    form = F.col(form) if isinstance(form, str) else form
    before, after, between = markers

    def part(low: str, high: str | None) -> Column:
        rest = F.substring(output, F.instr(output, low) + len(low), F.char_length(output))
        return rest if high is None else F.substring(rest, F.lit(1), F.instr(rest, high) - 1)

    return (F.when(form == "psm", F.concat(part(before, after), part(between, None), part(after, between)))
            .when(form == "spm", F.concat(part(before, between), part(between, None), part(after, before)))
            .otherwise(output))
