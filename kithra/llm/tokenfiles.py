"""Token-id files: frequency-ranked ids, byte-aligned lengths in separate control bytes.

A token folder holds two Parquet tables, so any store that Spark writes to can
hold it and a lost task leaves nothing half written:

* ``vocabulary`` (rank, id, count): ids by falling frequency over all texts.
* ``documents`` (key, part, seq, n_tokens, control, data): one row per text, in
  ascending key order (null first) along (part, seq).  ``data`` holds the ranks
  little-endian in 1 to 4 bytes each; ``control`` holds their lengths minus one,
  two bits each, four to a byte, the first in the lowest bits.
"""

from __future__ import annotations

import re
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import scratch_path, ship_package
from .bytewords import SPACE, sliced
from .workers import lean

END_ID = 2  # appended to every text
SLICE_BYTES = 8 << 20
ROWS_BYTES = 4 << 20  # ids that are handed on at once
SEPARATOR = " \x01 "

# Decoding tables by control byte: length of each of its four numbers.
LENGTHS = np.array([[(c >> 2 * k & 3) + 1 for k in range(4)] for c in range(256)], dtype=np.uint8)


# ------------------------------------------------------------------ numbers to bytes

def encode_numbers(numbers: np.ndarray) -> tuple[bytes, bytes]:
    """(control, data) of unsigned 32-bit numbers."""
    numbers = np.ascontiguousarray(numbers, dtype="<u4")
    length = 1 + (numbers > 0xFF).astype(np.uint8) + (numbers > 0xFFFF) + (numbers > 0xFFFFFF)
    code = np.zeros(-(-len(numbers) // 4) * 4, np.uint8)
    code[:len(numbers)] = length - 1
    code = code.reshape(-1, 4)
    control = code[:, 0] | code[:, 1] << 2 | code[:, 2] << 4 | code[:, 3] << 6
    used = np.arange(4, dtype=np.uint8) < length[:, None]
    return control.tobytes(), numbers.view(np.uint8).reshape(-1, 4)[used].tobytes()


def decode_numbers(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The numbers again; the lengths of each control byte come from a table."""
    length = LENGTHS[np.frombuffer(control, np.uint8)].reshape(-1)[:n]
    out = np.zeros((n, 4), np.uint8)
    out[np.arange(4, dtype=np.uint8) < length[:, None]] = np.frombuffer(data, np.uint8)
    return out.view("<u4").reshape(-1)


# ------------------------------------------------------------------ texts to ids

@lru_cache(maxsize=4)
def _tokenizer(path: str):
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


LETTER = np.zeros(256, bool)
LETTER[ord("a"):ord("z") + 1] = True
DIGIT = np.zeros(256, bool)
DIGIT[ord("0"):ord("9") + 1] = True
MARK = np.zeros(256, bool)  # ASCII marks but the apostrophe, which may belong to the letters after it
MARK[list(b'!"#$%&()*+,-./:;=?@[\\]^_`{}~')] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def word_tokenizer_pieces(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """Pieces whose ids, put together, are the text's ids, and where each text's pieces begin.

    For vocabularies that drop white space, take lower case, and end a word
    between a letter and a mark or at a digit: cutting there changes nothing.
    Right only where no character combines with its neighbour (below U+0300).
    """
    low = LOWER[data]
    space, letter, mark, digit = SPACE[low], LETTER[low], MARK[low], DIGIT[low]
    cut = np.zeros(len(low), bool)
    cut[1:] = (letter[:-1] & mark[1:]) | (mark[:-1] & letter[1:]) | digit[1:] | digit[:-1] | space[:-1]
    cut[offsets[:-1][offsets[:-1] < len(low)]] = True
    cut &= ~space
    kept = ~space
    begins = np.flatnonzero(cut[kept])
    small = low[kept]
    bounds = np.append(begins, len(small)).astype(np.int32)
    pieces = pa.StringArray.from_buffers(len(begins), pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(small)))
    return pieces, np.searchsorted(np.flatnonzero(cut), offsets)


# The byte-level alphabet: a byte that prints stands for itself, the others follow from 256.
_PRINTS = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTE_CHARS = {b: chr(256 + k) for k, b in enumerate(sorted(set(range(256)) - set(_PRINTS)))}
_PLAIN = re.compile("[a-zß-öø-ÿ]+")


def _piece_ids(tokenizer, pieces: list[str]) -> list[list[int]]:
    """Ids of each piece; letters below U+0100 go straight to the merges."""
    out: list = [None] * len(pieces)
    other = []
    model = tokenizer.model
    for k, piece in enumerate(pieces):
        if piece.isascii():
            if piece.isalpha():
                out[k] = [t.id for t in model.tokenize(piece)]
                continue
        elif _PLAIN.fullmatch(low := piece.lower()):
            out[k] = [t.id for t in model.tokenize(low.encode().decode("latin-1").translate(_BYTE_CHARS))]
            continue
        other.append(k)
    for k, found in zip(other, tokenizer.encode_batch_fast([pieces[k] for k in other], add_special_tokens=False)):
        out[k] = found.ids
    return out


@lru_cache(maxsize=4)
def _markers(path: str) -> tuple[bytes, ...]:
    """The vocabulary's added tokens in lower case; they match a raw text, before its case is folded."""
    return tuple(sorted({t.content.encode().lower() for t in _tokenizer(path).get_added_tokens_decoder().values() if t.content}))


def _whole_rows(data: np.ndarray, offsets: np.ndarray, markers) -> list[int]:
    """Texts that pieces do not fit: with U+0300 and above, which may combine, or an added token in any case."""
    at = [np.flatnonzero(data >= 0xCC)] if len(data) and int(data.max()) >= 0xCC else []
    low = LOWER[data].tobytes()
    for marker in markers:
        found, place = [], low.find(marker)
        while place >= 0:
            found.append(place)
            place = low.find(marker, place + 1)
        at.append(np.array(found, np.int64))
    return np.unique(np.searchsorted(offsets, np.concatenate(at), side="right") - 1).tolist() if at else []


def encode_texts(path: str, column: pa.Array, lower_words: bool):
    """Each text's ids without the end id, as uint32 arrays.

    ``lower_words`` says that the vocabulary is one that
    ``word_tokenizer_pieces`` fits; each distinct piece is then encoded once.
    Texts that hold an added token, in any case, are encoded whole.
    """
    tokenizer = _tokenizer(path)
    for first, last, data, offsets in sliced(column, SLICE_BYTES):
        if not lower_words:
            texts = [x or "" for x in column.slice(first, last - first).to_pylist()]
            for found in tokenizer.encode_batch_fast(texts, add_special_tokens=False):
                yield np.array(found.ids, np.uint32)
            continue
        whole = {}
        rows = _whole_rows(data, offsets, _markers(path))
        if rows:
            # such texts are encoded as they are; the rest of the slice goes on without them
            for r in rows:
                text = data[offsets[r]:offsets[r + 1]].tobytes().decode()
                whole[r] = np.array(tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)
            data = data.copy()
            for r in rows:
                data[offsets[r]:offsets[r + 1]] = 0x20
        pieces, at = word_tokenizer_pieces(data, offsets)
        coded = pieces.dictionary_encode()
        ids = _piece_ids(tokenizer, coded.dictionary.to_pylist())
        n = np.fromiter(map(len, ids), np.int64, len(ids))
        flat = np.fromiter((x for piece in ids for x in piece), np.uint32, int(n.sum()))
        begins = np.cumsum(n) - n
        which = coded.indices.to_numpy(zero_copy_only=False)
        del pieces, coded, ids, data
        # text by text: places for the ids of a whole slice would take many times its size
        for r in range(last - first):
            if r in whole:
                yield whole[r]
                continue
            own = which[at[r]:at[r + 1]]
            size = n[own]
            ends = np.cumsum(size)
            yield flat[np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(begins[own] - (ends - size), size)]


def encoded_rows(batches, tokenizer: str, end_id: int, lower_words: bool):
    """(key, text) to (key, wide, ids), in batches of about ``ROWS_BYTES``; ids of 16 or, if ``wide``, 32 bits."""
    for batch in batches:
        first, size, wide, ids = 0, 0, [], []

        def rows():
            return pa.RecordBatch.from_arrays(
                [batch.column(0).slice(first, len(ids)), pa.array(wide, pa.bool_()), pa.array(ids, pa.binary())], ["key", "wide", "ids"])

        for x in encode_texts(tokenizer, batch.column(1), lower_words):
            x = np.append(x, np.uint32(end_id))
            x = x.astype("<u2") if x.max() < 1 << 16 else x.astype("<u4")
            wide.append(x.itemsize == 4)
            ids.append(x.tobytes())
            size += x.nbytes
            if size >= ROWS_BYTES:
                yield rows()
                first, size, wide, ids = first + len(ids), 0, [], []
        if ids:
            yield rows()


# ------------------------------------------------------------------ writing and reading

def write_token_files(docs: DataFrame, path: str, tokenizer: str, key: str = "doc_id", text: str = "text",
                      end_id: int = END_ID, lower_words: bool = False) -> None:
    """Encode every whole text (null: empty), append ``end_id``, and write a token folder at ``path``.

    Texts are encoded once; the ids wait in the shared folder until the counts
    of all of them are known, and are then ranked, coded and put in key order.
    Equal keys keep their rows, in any order among them; other columns of
    ``docs`` play no part.  An empty table gives an empty folder.
    """
    spark = docs.sparkSession
    ship_package(spark)
    kind = docs.schema[key].dataType.simpleString()
    waiting = scratch_path(spark, "token-ids")

    def encode(batches):
        yield from encoded_rows(batches, tokenizer, end_id, lower_words)

    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    rows.mapInArrow(lean(encode), f"key {kind}, wide boolean, ids binary").write.option("compression", "zstd").parquet(waiting)
    raw = spark.read.parquet(waiting)

    def count(batches):
        total = np.zeros(0, np.int64)
        for batch in batches:
            for wide, ids in zip(batch.column(0).to_pylist(), batch.column(1)):
                found = np.bincount(np.frombuffer(ids.as_buffer(), "<u4" if wide else "<u2"))
                if len(found) > len(total):
                    total = np.pad(total, (0, len(found) - len(total)))
                total[:len(found)] += found
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["id", "count"])

    counts = raw.select("wide", "ids").mapInArrow(lean(count), "id long, count long").groupBy("id").agg(F.sum("count").alias("count"))
    # one row per id of the vocabulary, which has a fixed size
    ranked = [(r["id"], r["count"]) for r in counts.orderBy(F.desc("count"), "id").collect()]
    spark.createDataFrame([(k, i, c) for k, (i, c) in enumerate(ranked)], "rank long, id long, count long") \
        .coalesce(1).write.parquet(f"{path}/vocabulary")
    rank_of = np.zeros(max((i for i, _ in ranked), default=0) + 1, np.uint32)
    for k, (i, _) in enumerate(ranked):
        rank_of[i] = k
    shared = spark.sparkContext.broadcast(rank_of)

    def code(batches):
        ranks, seq = shared.value, 0
        for batch in batches:
            out = [[], [], []]
            for wide, ids in zip(batch.column(1).to_pylist(), batch.column(2)):
                ids = np.frombuffer(ids.as_buffer(), "<u4" if wide else "<u2")
                control, data = encode_numbers(ranks[ids])
                for into, x in zip(out, (len(ids), control, data)):
                    into.append(x)
            seqs = pa.array(np.arange(seq, seq + batch.num_rows))
            seq += batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(3), seqs, pa.array(out[0], pa.int64()),
                 pa.array(out[1], pa.binary()), pa.array(out[2], pa.binary())],
                ["key", "part", "seq", "n_tokens", "control", "data"])

    # the range partitioning looks at the waiting rows only; nothing is encoded twice
    ordered = raw.repartitionByRange("key").sortWithinPartitions("key").withColumn("part", F.spark_partition_id())
    ordered.mapInArrow(lean(code), f"key {kind}, part int, seq long, n_tokens long, control binary, data binary") \
        .write.parquet(f"{path}/documents")


def read_vocabulary(spark: SparkSession, path: str) -> np.ndarray:
    """Id of each rank; as long as the vocabulary."""
    rows = spark.read.parquet(f"{path}/vocabulary").orderBy("rank").select("id").collect()
    return np.array([r["id"] for r in rows], np.uint32)


def read_tokens(spark: SparkSession, path: str, key: str = "doc_id") -> DataFrame:
    """(key, start, n_tokens, ids): each text's ids and how many come before them."""
    return _read(spark, path, key, lambda ids: ids, pa.list_(pa.int64()), "ids array<long>")


def read_checks(spark: SparkSession, path: str, key: str = "doc_id") -> DataFrame:
    """(key, start, n_tokens, ids_crc32): the ids are decoded, and their little-endian 32-bit form is checked."""
    return _read(spark, path, key, lambda ids: zlib.crc32(ids.astype("<u4").tobytes()), pa.int64(), "ids_crc32 long")


def _read(spark, path, key, finish, kept, column) -> DataFrame:
    ship_package(spark)
    table = spark.read.parquet(f"{path}/documents")
    shared = spark.sparkContext.broadcast(read_vocabulary(spark, path))
    kind = table.schema["key"].dataType.simpleString()

    def decode(batches):
        for batch in batches:
            ids = [finish(shared.value[decode_numbers(c.as_buffer(), d.as_buffer(), n)]) for c, d, n in
                   zip(batch.column(4), batch.column(5), batch.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(ids, kept)], ["key", "part", "seq", "n_tokens", column.split()[0]])

    decoded = table.select("key", "part", "seq", "n_tokens", "control", "data").mapInArrow(
        lean(decode), f"key {kind}, part int, seq long, n_tokens long, {column}")
    # one total per written part, then a running sum inside the part
    parts = table.groupBy("part").agg(F.sum("n_tokens").alias("_n"))
    window = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = parts.select(F.col("part"), F.coalesce(F.sum("_n").over(window), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    return decoded.join(F.broadcast(before), "part").select(
        F.col("key").alias(key), (F.col("_before") + F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))).alias("start"),
        "n_tokens", column.split()[0])
