"""Words, shingles and their hashes straight from Arrow string buffers.

Everything works on one flat byte array for many texts at once, so no Python
loop runs per word.  A word is ``[^\\x20\\x09-\\x0D]+``; A-Z count as a-z.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 18  # texts are taken together up to about this size; arrays of it stay in the cache

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_PRIME = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_INVERSE = pow(_PRIME, -1, 1 << 64)
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def texts_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the offsets of its rows; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    place = np.frombuffer(offsets, dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    if len(place) == 0:
        place = np.zeros(1, np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[place[0]:place[-1]], place - place[0]


def sliced(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first row, last row, bytes, offsets)`` of neighbouring texts of about ``limit`` bytes together."""
    data, offsets = texts_of(column)
    first, rows = 0, len(offsets) - 1
    while first < rows:
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), rows)
        yield first, last, data[offsets[first]:offsets[last]], offsets[first:last + 1] - offsets[first]
        first = last


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word, and where each text's words begin (one more than texts)."""
    if len(data) == 0:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    inside = ~SPACE[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    cut = offsets[:-1][offsets[:-1] < len(data)]
    begins[cut] = inside[cut]  # a text's first byte never continues the text before
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    last = offsets[1:][offsets[1:] > 0] - 1
    ends[last] = inside[last]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(ends) + 1, np.searchsorted(starts, offsets)


def word_counts(column: pa.Array) -> np.ndarray:
    out = np.zeros(len(column), np.int64)
    for first, last, data, offsets in sliced(column):
        out[first:last] = np.diff(word_spans(data, offsets)[2])
    return out


def mix(x: np.ndarray) -> np.ndarray:
    """Spread all bits of a 64-bit number over all bits of the result."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS[0]) < n + 1:
        for at, base in ((0, _PRIME), (1, _INVERSE)):
            steps = np.full(n + 1, base, dtype=np.uint64)
            steps[0] = 1
            _POWERS[at] = np.cumprod(steps)
    return _POWERS[0][:n + 1], _POWERS[1][:n + 1]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span, by differences of one running polynomial."""
    up, down = _powers(len(data))
    running = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:-1], out=running[1:])
    raw = (running[ends] - running[starts]) * down[starts]
    return mix(raw ^ ((ends - starts).astype(np.uint64) << np.uint64(48)))


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each lower-cased word, and where each text's words begin."""
    starts, ends, at = word_spans(data, offsets)
    return span_hashes(LOWER[data], starts, ends), at


def run_hashes(hashes: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """64-bit hash of each run of word hashes from ``low`` up to ``high`` (order counts)."""
    up, down = _powers(len(hashes))
    running = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(mix(hashes) * up[:len(hashes)], out=running[1:])
    return mix((running[high] - running[low]) * down[low] ^ mix((high - low).astype(np.uint64)))


def chained(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of ``width`` neighbouring word hashes (order counts)."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = hashes[:n].copy()
    for k in range(1, width):
        out = mix(out * np.uint64(0x2545F4914F6CDD1D) + hashes[k:k + n])
    return out


def shingle_sets(column: pa.Array, width: int) -> Iterator[np.ndarray]:
    """Each text's distinct shingle hashes, sorted; a shorter text is one shingle, an empty one has none."""
    for _, _, data, offsets in sliced(column):
        words, at = word_hashes(data, offsets)
        runs = chained(words, width)
        for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
            if b - a >= width:
                yield np.unique(runs[a:b - width + 1])
            elif b > a:
                yield chained(words[a:b], b - a)
            else:
                yield np.zeros(0, np.uint64)
