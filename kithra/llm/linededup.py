"""Repeated units of text: the earliest occurrence stays, the others go, offsets are kept.

Units are lines or paragraphs, and optionally the sentences inside them, so a
passage set into the middle of a line is found too.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize, ship_package
from . import bytewords
from .hotjoin import hot_join

UNITS = ("line", "sentence")  # or "paragraph"
MIN_WORDS = 1  # every unit that has a word; units of fewer words are never removed
STOP = np.zeros(256, bool)  # a sentence ends where blanks follow one of these
STOP[list(b".!?")] = True
BLANK = np.zeros(256, bool)
BLANK[list(b" \t")] = True


def breaks(data: np.ndarray, offsets: np.ndarray, unit: str) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the bytes between two units; a text's end is a break of no bytes.

    Lines end at line feeds, sentences also at the blanks after ``.``, ``!`` or
    ``?``, paragraphs at white space from one line feed to another.
    """
    text_start = np.zeros(len(data) + 1, bool)
    text_start[offsets] = True
    if unit == "paragraph":
        space = bytewords.SPACE[data]
        first = space & ~np.append(False, space[:-1]) | space & text_start[:-1]
        run = np.cumsum(first) - 1
        feeds = np.flatnonzero(data == 10)
        owner, low = np.unique(run[feeds], return_index=True)
        high = np.append(low[1:], len(feeds)) - 1
        many = high > low
        starts, ends = feeds[low[many]], feeds[high[many]] + 1
    else:
        starts = np.flatnonzero(data == 10)
        ends = starts + 1
        if unit == "sentence" and len(data):
            blank = BLANK[data]
            begins = np.flatnonzero(blank & np.append(False, STOP[data[:-1]]) & ~text_start[:-1])
            # a run of blanks ends before the next byte that is none, or with the text
            other = np.flatnonzero(np.append(~blank, True) | text_start)
            starts = np.concatenate([starts, begins])
            ends = np.concatenate([ends, other[np.searchsorted(other, begins, side="right")]])
    starts, ends = np.concatenate([starts, offsets]), np.concatenate([ends, offsets])
    order = np.lexsort((ends, starts))
    return starts[order], ends[order]


def unit_rows(data: np.ndarray, offsets: np.ndarray, kinds, min_words: int):
    """(text, start, end, digests) of the units that may be removed: byte offsets, and two 64-bit hashes of each.

    The hashes are of the unit's words, with A-Z as a-z, whatever white space
    lies between them.  A sentence that is a whole line is taken once.
    """
    spans = []
    for unit in kinds:
        starts, ends = breaks(data, offsets, unit)
        spans.append(np.stack([ends[:-1], starts[1:]], axis=1))
    spans = np.unique(np.concatenate(spans), axis=0)
    spans = spans[spans[:, 0] < spans[:, 1]]
    word_starts, word_ends, _ = bytewords.word_spans(data, offsets)
    words = bytewords.span_hashes(bytewords.LOWER[data], word_starts, word_ends)
    low, high = np.searchsorted(word_starts, spans[:, 0]), np.searchsorted(word_starts, spans[:, 1])
    enough = high - low >= max(min_words, 1)
    spans, low, high = spans[enough], low[enough], high[enough]
    digests = [bytewords.run_hashes(words ^ np.uint64(salt), low, high) for salt in (0, 0x3C6EF372FE94F82B)]
    return np.searchsorted(offsets, spans[:, 0], side="right") - 1, spans[:, 0], spans[:, 1], digests


def units(docs: DataFrame, key: str = "doc_id", text: str = "text", kinds=UNITS, min_words: int = MIN_WORDS) -> DataFrame:
    """(key, told, start, end, digest): the units that may be removed, with code point offsets.

    ``told`` tells rows of one key apart.
    """
    ship_package(docs.sparkSession)
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.filter(F.col(text).isNotNull()).select(F.col(key).alias("key"), F.xxhash64(text).alias("told"), F.col(text).alias("text"))

    def cut(batches):
        for batch in batches:
            for first, _, data, offsets in bytewords.sliced(batch.column(2)):
                row, starts, ends, digests = unit_rows(data, offsets, kinds, min_words)
                # code points before a byte, counted from its text's start
                points = np.append(0, np.cumsum((data & 0xC0) != 0x80))
                origin = points[offsets[row]]
                at = pa.array(row + first)
                both = np.stack(digests, axis=1).tobytes()
                packed = pa.FixedSizeBinaryArray.from_buffers(pa.binary(16), len(row), [None, pa.py_buffer(both)]).cast(pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(at), batch.column(1).take(at), pa.array((points[starts] - origin).astype(np.int32)),
                     pa.array((points[ends] - origin).astype(np.int32)), packed], ["key", "told", "start", "end", "digest"])

    return rows.mapInArrow(cut, f"key {kind}, told long, start int, end int, digest binary")


def repeated_spans(docs: DataFrame, key: str = "doc_id", text: str = "text", kinds=UNITS, min_words: int = MIN_WORDS) -> DataFrame:
    """(key, told, spans): units of each row of which an earlier one stands elsewhere, as (start, end) in order.

    Rank is (key with null first, told, start).  Spans of a line and of its
    sentences may overlap.  Rows of equal key and text are one document, whose
    spans are listed once, however often the row is repeated.
    """
    found = units(docs, key, text, kinds, min_words)
    rank = F.struct(F.col("key").isNotNull().alias("known"), "key", "told", "start", "end")
    firsts = found.groupBy("digest").agg(F.min(rank).alias("first"), F.max(rank).alias("last"), F.count("*").alias("n"))
    # only repeated digests are written: the rest never meets the units again
    again = materialize(firsts.filter("first < last").select("digest", "first", "n"), "repeated")
    later = hot_join(found.withColumn("rank", rank), again, "digest").filter("rank > first")
    return later.groupBy("key", "told").agg(F.array_sort(F.collect_set(F.struct("start", "end"))).alias("spans"))


def merged(spans) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in spans:
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((start, end))
    return out


def dedup_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", kinds=UNITS, min_words: int = MIN_WORDS) -> DataFrame:
    """Per row of ``docs``: key, n_bytes, n_removed (bytes), n_spans, spans, kept_sha256, kept.

    ``spans`` are the maximal removed runs as code point offsets of the
    original text, ``kept`` is what is left of it (breaks stay).  Null and
    empty texts have nothing to remove; an empty table gives none.  Texts of
    any length are whole; equal rows of one key give equal results.
    """
    spans = repeated_spans(docs, key, text, kinds, min_words)
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("_key"), F.xxhash64(text).alias("_told"), F.col(text).alias("_text"))
    joined = rows.join(spans, F.col("_key").eqNullSafe(F.col("key")) & (F.col("_told") == F.col("told")), "left")

    def finish(batches):
        for batch in batches:
            out = [[] for _ in range(6)]
            for text, found in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                text = text or ""
                removed = merged([(s["start"], s["end"]) for s in found or []])
                kept, at = [], 0
                for start, end in removed:
                    kept.append(text[at:start])
                    at = end
                left = "".join([*kept, text[at:]])
                size, rest = len(text.encode()), left.encode()
                for into, x in zip(out, (size, size - len(rest), len(removed),
                                         [{"start": s, "end": e} for s, e in removed], hashlib.sha256(rest).hexdigest(), left)):
                    into.append(x)
            types = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])),
                     pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(x, t) for x, t in zip(out, types)]],
                [key, "n_bytes", "n_removed", "n_spans", "spans", "kept_sha256", "kept"])

    return joined.select(F.col("_key"), F.col("_text"), F.col("spans")).mapInArrow(
        finish, f"`{key}` {kind}, n_bytes long, n_removed long, n_spans long, "
                "spans array<struct<start:int,end:int>>, kept_sha256 string, kept string")
