"""Benchmark decontamination by latent semantic retrieval.

Passages form a hashed TF-IDF matrix A, with document frequencies from all
texts.  A distributed pass over all of them sums the sketch AᵀAΩ for a random
Ω; from it the leading right singular vectors and values follow on the driver
(matrices of vocabulary bins × rank, a fixed size).  Every passage of every
text is projected.  Benchmark texts and passages meet in the latent space
scaled to unit variance, and in a random projection of what the leading
vectors leave of A, where rare words count.  Pairs of enough cosine are candidates; the longest common subsequence
of words and the answer part decide.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize, ship_package
from . import bytewords
from .hotjoin import keep_ids
from .workers import lean

BINS = 1 << 14  # hashed vocabulary
RANK = 24  # leading singular vectors
OVERSAMPLE = 8
REST = 96  # random directions for what those leave
STRIDE = 16  # words from one passage's start to the next
PASSAGE = 2  # strides that a passage covers
COSINE = 0.15  # least cosine in the latent space
BLEND, BLENDED = (0.12, 0.88), 0.33  # weights of the two cosines by their noise, and the least weighted sum
LCS = 0.7  # share of the item's words, in order, that alone decides
LCS_WITH_ANSWER = 0.5  # the same if the answer part is there too
ANSWER = 0.75  # share of the answer part's words
ANSWER_WORDS = 8  # without an answer column, an item's last words stand for it
FULL_WORDS = 24  # items of fewer words need less cosine, as the root of their share
ITEM_BLOCK = 4096  # items that one pass asks for
BLOCK = 16  # bins of one row of partial sums


# ------------------------------------------------------------------ passages of a batch

class Strides:
    """Words of neighbouring texts, in strides of ``STRIDE`` words that do not leave their text."""

    def __init__(self, first: int, hashes: np.ndarray, at: np.ndarray):
        self.first, self.hashes, self.at = first, hashes, at  # first row of the batch, words, where each text's words begin
        words = np.diff(at)
        self.per_text = -(-words // STRIDE)
        ends = np.cumsum(self.per_text)
        self.total = int(self.per_text.sum())
        self.text = np.repeat(np.arange(len(words)), self.per_text)
        nth = np.arange(self.total) - (ends - self.per_text)[self.text]
        self.opens = at[:-1][self.text] + nth * STRIDE  # first word
        self.size = np.minimum(at[1:][self.text] - self.opens, STRIDE)
        self.left = (self.per_text[self.text] - 1 - nth)  # strides after it in its text
        self.nth = nth
        # bins by stride and place; places past the text's end hold BINS
        padded = np.append(bins_of(hashes), BINS)
        place = np.arange(STRIDE)
        self.bins = padded[np.where(place < self.size[:, None], self.opens[:, None] + place, len(hashes))]

    def passage_sums(self, rows: np.ndarray) -> np.ndarray:
        """Sum of the words' ``rows`` (one per bin, a zero row last) over each passage."""
        one = np.take(rows, self.bins[:, 0], axis=0)
        for k in range(1, STRIDE):
            one += np.take(rows, self.bins[:, k], axis=0)
        return self.shifted(one, self.left, 1)

    def shifted(self, one: np.ndarray, room: np.ndarray, way: int) -> np.ndarray:
        """Each stride's row plus those of the next (``way`` 1) or last (-1) strides of a passage."""
        out = one.copy()
        for step in range(1, PASSAGE):
            inside = np.flatnonzero(room >= step)
            out[inside] += one[inside + way * step]
        return out


def strides(column: pa.Array):
    for first, _, data, offsets in bytewords.sliced(column):
        yield Strides(first, *bytewords.word_hashes(data, offsets))


def bins_of(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(40)).astype(np.int64) % BINS


def with_zero(rows: np.ndarray) -> np.ndarray:
    return np.vstack([rows, np.zeros((1, rows.shape[1]))]).astype(np.float32)


# ------------------------------------------------------------------ corpus statistics

def inverse_frequencies(docs: DataFrame, text: str) -> tuple[np.ndarray, int]:
    """Smoothed idf of each bin over the strides of all texts, and how many strides there are."""
    def count(batches):
        seen, total = np.zeros(BINS, np.int64), 0
        for batch in batches:
            for part in strides(batch.column(0)):
                held = np.sort(part.bins.astype(np.uint16), axis=1)
                fresh = held < BINS
                fresh[:, 1:] &= held[:, 1:] != held[:, :-1]
                seen += np.bincount(held[fresh], minlength=BINS)
                total += part.total
        used = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(used, -1)), pa.array(np.append(seen[used], total))], ["bin", "n"])

    rows = docs.select(F.col(text)).mapInArrow(lean(count), "bin long, n long").groupBy("bin").agg(F.sum("n").alias("n")).collect()
    found = np.zeros(BINS, np.int64)
    total = 0
    for r in rows:  # one row per bin
        if r["bin"] < 0:
            total = r["n"]
        else:
            found[r["bin"]] = r["n"]
    return np.log((total + 1) / (found + 0.5)).astype(np.float32), total


def gram_sketch(docs: DataFrame, text: str, idf: np.ndarray, omega: np.ndarray) -> np.ndarray:
    """AᵀAΩ over the passages of all texts; partial sums are added block by block, no task holds more than one sum."""
    spark = docs.sparkSession
    width = omega.shape[1]
    shared = spark.sparkContext.broadcast((idf, with_zero(omega * idf[:, None])))

    def partial(batches):
        weight, weighted = shared.value
        total = np.zeros((width, BINS + 1))
        for batch in batches:
            for part in strides(batch.column(0)):
                if not part.total:
                    continue
                # a word stands in the passage of its stride and in those that begin before it
                back = part.shifted(part.passage_sums(weighted), part.nth, -1)
                bins = part.bins.T.reshape(-1)  # place by place
                for one, column in zip(total, back.T):
                    one += np.bincount(bins, np.tile(column, STRIDE), BINS + 1)
        total = total[:, :BINS].T * weight[:, None]
        values = total.astype(np.float32).reshape(BINS // BLOCK, BLOCK * width)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(BINS // BLOCK)), pa.array([v.tobytes() for v in values], pa.binary())], ["block", "part"])

    def add(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, part in zip(batch.column(0).to_pylist(), batch.column(1)):
                values = np.frombuffer(part.as_buffer(), np.float32).astype(np.float64)
                sums[block] = sums[block] + values if block in sums else values
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.int64()), pa.array([v.tobytes() for v in sums.values()], pa.binary())], ["block", "part"])

    parts = docs.select(F.col(text)).mapInArrow(lean(partial), "block long, part binary")
    added = parts.repartition(F.col("block")).mapInArrow(lean(add), "block long, part binary").collect()  # BINS * width numbers
    out = np.zeros((BINS // BLOCK, BLOCK * width))
    for r in added:
        out[r["block"]] = np.frombuffer(r["part"], np.float64)
    return out.reshape(BINS, width)


@dataclass
class Latent:
    """Row ``bin`` of ``project`` is what one word of the bin adds to a passage: ``rank`` whitened latent components, then the rest's."""

    project: np.ndarray
    rank: int

    def unit(self, sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        halves = sums[:, :self.rank], sums[:, self.rank:]
        return tuple(x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12) for x in halves)


def fit(docs: DataFrame, text: str = "text", rank: int = RANK, rest: int = REST, seed: int = 0) -> Latent:
    """Document frequencies, then the basis, both from every passage of every text."""
    ship_package(docs.sparkSession)
    idf, total = inverse_frequencies(docs, text)
    rng = np.random.default_rng(seed)
    omega, directions = rng.normal(size=(BINS, rank + OVERSAMPLE)), rng.normal(size=(BINS, rest))
    left, scale = np.zeros((BINS, rank)), np.ones(rank)
    if total:
        sketch = gram_sketch(docs, text, idf, omega)
        if sketch.any():
            # one-pass form for a positive matrix G = AᵀA: G ≈ S (ΩᵀS)⁺ Sᵀ with S = GΩ
            core = omega.T @ sketch
            values, vectors = np.linalg.eigh((core + core.T) / 2)
            keep = values > values.max() * 1e-9
            root = sketch @ (vectors[:, keep] / np.sqrt(values[keep]))
            basis, singular, _ = np.linalg.svd(root, full_matrices=False)
            held = min(rank, len(singular))
            left[:, :held], scale[:held] = basis[:, :held], np.maximum(singular[:held], singular[0] * 1e-6)
    remainder = directions - left @ (left.T @ directions)
    return Latent(with_zero(idf[:, None] * np.hstack([left / scale, remainder])), rank)


# ------------------------------------------------------------------ items and verification

def words_of(text: str | None) -> np.ndarray:
    return bytewords.word_hashes(*bytewords.texts_of(pa.array([text or ""])))[0]


def lcs(masks: dict[int, int], size: int, words) -> int:
    """Length of the longest common subsequence with a text whose words have position ``masks``."""
    row = (1 << size) - 1
    full = row
    for word in words:
        mask = masks.get(word)
        if mask:
            hit = row & mask
            row = ((row + hit) | (row - hit)) & full
    return size - row.bit_count()


def masks_of(words: list[int]) -> dict[int, int]:
    out: dict[int, int] = {}
    for k, word in enumerate(words):
        out[word] = out.get(word, 0) | 1 << k
    return out


class Items:
    """A block of benchmark texts: word masks, and the latent vectors of their pieces."""

    def __init__(self, rows: list[tuple], latent: Latent):
        self.ids, self.words, self.masks, self.answers = [], [], [], []
        owners, pieces, sizes = [], [np.zeros((0, latent.project.shape[1]))], []
        length = STRIDE * PASSAGE
        for key, text, answer in rows:
            hashes = words_of(text)
            if not len(hashes):
                continue
            tail = words_of(answer) if answer else hashes[-ANSWER_WORDS:]
            self.ids.append(key)
            self.words.append(len(hashes))
            self.masks.append(masks_of(hashes.tolist()))
            self.answers.append((masks_of(tail.tolist()), len(tail)))
            last = max(len(hashes) - length, 0)
            for start in sorted({*range(0, last, STRIDE), last}):
                owners.append(len(self.ids) - 1)
                sizes.append(min(len(hashes), length))
                pieces.append(latent.project[bins_of(hashes[start:start + length])].sum(axis=0, keepdims=True))
        self.owners = np.array(owners, np.int64)
        # a short item fills less of a passage, so less cosine is asked for
        self.scale = np.sqrt(np.minimum(np.array(sizes) / FULL_WORDS, 1)).astype(np.float32)
        self.latent, self.rest = (x.astype(np.float32) for x in latent.unit(np.vstack(pieces)))

    def verify(self, item: int, words: list[int]) -> tuple[float, float] | None:
        """(share of the item's words in order, share of its answer part) if they say that the item is there."""
        size, masks = self.words[item], self.masks[item]
        known = [w for w in words if w in masks]
        if len(known) < LCS_WITH_ANSWER * size:
            return None  # no common subsequence can be longer
        share = lcs(masks, size, known) / size
        if share < LCS_WITH_ANSWER:
            return None
        answer, n = self.answers[item]
        tail = lcs(answer, n, words) / max(n, 1)
        return (share, tail) if share >= LCS or tail >= ANSWER else None


def leaks(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id",
          item_text: str = "text", answer: str | None = None, cosine: float = COSINE, blended: float = BLENDED, latent: Latent | None = None) -> DataFrame:
    """(key, item, lcs_share, answer_share, cosine, at_word): documents that hold a benchmark item or a paraphrase.

    One row per document key and item, the place of the longest common
    subsequence.  Null and empty texts hold nothing and are in nothing; rows
    that repeat a key are one document; empty tables give no rows.  The items
    are asked for in blocks of bounded size, each against all passages.
    """
    spark = docs.sparkSession
    ship_package(spark)
    latent = latent or fit(docs, text)
    columns = [F.col(item), F.col(item_text).cast("string"), (F.col(answer).cast("string") if answer else F.lit(None).cast("string")).alias("_answer")]
    asked = benchmark.select(*columns)
    blocks = max(1, -(-asked.count() // ITEM_BLOCK))
    found = None
    for block in range(blocks):
        rows = asked.filter(F.pmod(F.xxhash64(item), F.lit(blocks)) == block).collect()
        part = _leaks(docs, Items(sorted(map(tuple, rows), key=repr), latent), latent, key, text, item, benchmark.schema[item].dataType, cosine, blended)
        found = part if found is None else found.unionByName(part)
    best = F.max_by(F.struct("lcs_share", "answer_share", "cosine", "at_word"), F.struct("lcs_share", "answer_share", "cosine", -F.col("at_word")))
    return found.groupBy("_key", "_item").agg(best.alias("b")).select(
        F.col("_key").alias(key), F.col("_item").alias(item), "b.lcs_share", "b.answer_share", "b.cosine", "b.at_word")


def _leaks(docs, items: Items, latent: Latent, key, text, item, item_type, cosine, blended) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast((items, latent))
    length = STRIDE * PASSAGE

    def run(batches):
        items, latent = shared.value
        for batch in batches:
            keep, item_ids, out = [], [], []
            for part in strides(batch.column(1)):
                if not part.total or not len(items.owners):
                    continue
                latent_part, rest_part = latent.unit(part.passage_sums(latent.project))
                # one product gives the weighted sum of both cosines
                near = np.hstack([BLEND[0] * latent_part, BLEND[1] * rest_part]) @ np.hstack([items.latent, items.rest]).T
                where, piece = np.nonzero(near >= blended * items.scale)
                both = np.einsum("ij,ij->i", latent_part[where], items.latent[piece]) >= cosine * items.scale[piece]
                asked = {}
                for p, c in zip(where[both].tolist(), piece[both].tolist()):
                    pair = p, int(items.owners[c])
                    asked[pair] = max(asked.get(pair, -1.0), float(near[p, c]))
                for (p, k), cos in asked.items():
                    row, opens = int(part.text[p]), int(part.opens[p])
                    # an item that meets this passage lies within its own length around it
                    a = max(opens - items.words[k], int(part.at[row]))
                    b = min(opens + length + items.words[k], int(part.at[row + 1]))
                    shares = items.verify(k, part.hashes[a:b].tolist())
                    if shares:
                        keep.append(part.first + row)
                        item_ids.append(items.ids[k])
                        out.append((*shares, cos, opens - int(part.at[row])))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(keep, pa.int64())), pa.array(item_ids, item_arrow),
                 *[pa.array([x[i] for x in out], t) for i, t in enumerate((pa.float64(), pa.float64(), pa.float64(), pa.int64()))]],
                ["_key", "_item", "lcs_share", "answer_share", "cosine", "at_word"])

    from pyspark.sql.pandas.types import to_arrow_type

    item_arrow = to_arrow_type(item_type)
    schema = (f"_key {docs.schema[key].dataType.simpleString()}, _item {item_type.simpleString()}, lcs_share double, "
              "answer_share double, cosine double, at_word long")
    return docs.select(F.col(key), F.col(text)).mapInArrow(lean(run), schema)


def decontaminated(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", **options) -> DataFrame:
    """The documents in which no item was found; a null key stays."""
    held = leaks(docs, benchmark, key=key, **options).filter(F.col(key).isNotNull()).select(key).distinct()
    return keep_ids(docs, materialize(held, "leaky"), key, "left_anti").select(*docs.columns)
