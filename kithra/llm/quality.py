"""Quality scores by attention-based multiple-instance learning.

A document is a bag of passages.  Every passage of the whole text is encoded by
counts of its bytes and words, a small layer turns the counts into a passage
representation, gated attention weighs the passages of a document, and the
weighted mean is scored.  Weights are learned from document labels only: a first
model on a bounded sample, then from it one model for each block of all labelled
documents, whose weights are averaged.  Scoring runs over all documents in Arrow
batches.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import keyed_hash
from ..session import materialize, ship_package
from .hotjoin import SMALL_IDS, keep_ids
from .names import unused
from .workers import lean
from . import bytewords

PASSAGE_WORDS = 64
WORD_BINS = 64  # hashed words of a passage
TRAIN_DOCS = 6000  # bound of the sample: so many labelled documents at most
TRAIN_BYTES = 64 << 20  # and so many bytes of text, counted over whole documents
THRESHOLD = 0.3
HIDDEN, GATE = 24, 12
EPOCHS, BATCH, RATE, DECAY = 30, 128, 0.01, 1e-4
BLOCK_BYTES = 16 << 20  # text of the labelled documents that one task learns from at once
BLOCK_EPOCHS, BLOCK_RATE = 4, 0.002

# byte classes: lower, upper, digit, blank, line end, and single marks; other ASCII; first and later bytes of the rest
CLASSES = 20
_CLASS = np.full(256, 6, np.uint8)
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58] = 0, 1, 2
_CLASS[[32, 9, 11, 12]], _CLASS[[10, 13]] = 3, 4
_CLASS[0xC0:], _CLASS[0x80:0xC0] = 5, 7
for _k, _c in enumerate(b"!|.,#*%&$?@:"):
    _CLASS[_c] = 8 + _k
FEATURES = CLASSES + 9 + WORD_BINS


# ------------------------------------------------------------------ passages

def passage_features(column: pa.Array):
    """Yields (features, passages per text) for neighbouring texts; an empty text is one passage of zeros."""
    for first, last, data, offsets in bytewords.sliced(column):
        starts, ends, at = bytewords.word_spans(data, offsets)
        hashes = bytewords.span_hashes(bytewords.LOWER[data], starts, ends)
        words = np.diff(at)
        per_text = np.maximum(-(-words // PASSAGE_WORDS), 1)
        begin = np.cumsum(per_text) - per_text
        total = int(per_text.sum())
        out = np.zeros((total, FEATURES), np.float32)
        if len(starts):
            text = np.repeat(np.arange(last - first), words)
            passage = begin[text] + (np.arange(len(starts)) - at[text]) // PASSAGE_WORDS
            _fill(out, data, starts, ends, hashes, text, passage, total)
        yield out, per_text


def _fill(out, data, starts, ends, hashes, text, passage, total):
    # bytes from one word's start to the next word's belong to the word's passage
    opens = np.flatnonzero(np.diff(passage, prepend=-1))
    owner = passage[opens]
    edges = np.append(starts[opens], len(data))
    byte_owner = np.repeat(owner, np.diff(edges))
    kinds = np.bincount(byte_owner * CLASSES + _CLASS[data[edges[0]:]], minlength=total * CLASSES).reshape(total, CLASSES)
    size = np.maximum(kinds.sum(axis=1, keepdims=True), 1)
    out[:, :CLASSES] = kinds / size
    n = np.bincount(passage, minlength=total)
    safe = np.maximum(n, 1)
    length = (ends - starts).astype(np.float64)
    mean = np.bincount(passage, length, minlength=total) / safe
    square = np.bincount(passage, length * length, minlength=total) / safe
    same_passage = hashes ^ bytewords.mix(passage.astype(np.uint64))
    distinct = np.bincount(passage[np.unique(same_passage, return_index=True)[1]], minlength=total)
    follows = np.zeros(len(hashes), bool)
    follows[1:] = (hashes[1:] == hashes[:-1]) & (text[1:] == text[:-1])
    # words whose neighbourhood of three stands elsewhere in the text
    runs = bytewords.chained(hashes, 3)
    again = np.zeros(len(hashes), bool)
    inside = np.flatnonzero(text[2:] == text[:len(runs)]) if len(runs) else []  # runs that do not reach into the next text
    if len(inside):
        _, back, times = np.unique(runs[inside] ^ bytewords.mix(text[inside].astype(np.uint64)), return_inverse=True, return_counts=True)
        again[inside] = times[back] > 1
    k = CLASSES
    out[:, k] = np.log1p(n)
    out[:, k + 1] = mean
    out[:, k + 2] = np.sqrt(np.maximum(square - mean * mean, 0))
    out[:, k + 3] = distinct / safe
    out[:, k + 4] = np.bincount(passage, follows, minlength=total) / safe
    out[:, k + 5] = np.bincount(passage, again, minlength=total) / safe
    out[:, k + 6] = np.bincount(passage, length <= 2, minlength=total) / safe
    out[:, k + 7] = np.bincount(passage, length >= 16, minlength=total) / safe
    out[:, k + 8] = n > 0
    bins = np.bincount(passage * WORD_BINS + (hashes % np.uint64(WORD_BINS)).astype(np.int64), minlength=total * WORD_BINS)
    out[:, k + 9:] = np.sqrt(bins.reshape(total, WORD_BINS) / safe[:, None])


# ------------------------------------------------------------------ model

@dataclass
class Model:
    """``h = tanh(x W + b)``; attention ``softmax((tanh(h V) * sigmoid(h U)) w)``; score ``sigmoid(c . sum a h + d)``."""

    mean: np.ndarray
    scale: np.ndarray
    weights: dict[str, np.ndarray]

    def logits(self, features: np.ndarray, per_text: np.ndarray):
        """Score before the sigmoid, and the attention weight of each passage."""
        return _forward(self.weights, (features - self.mean) / self.scale, per_text)[:2]

    def scores(self, features: np.ndarray, per_text: np.ndarray) -> np.ndarray:
        return _sigmoid(self.logits(features, per_text)[0])


def _sigmoid(x):
    return 0.5 * (1 + np.tanh(0.5 * x))


def _forward(p, x, per_text):
    begin = np.cumsum(per_text) - per_text
    h = np.tanh(np.clip(x, -8, 8) @ p["W"] + p["b"])
    t, g = np.tanh(h @ p["V"]), _sigmoid(h @ p["U"])
    e = (t * g) @ p["w"]
    e = np.exp(e - np.repeat(np.maximum.reduceat(e, begin), per_text))
    a = e / np.repeat(np.add.reduceat(e, begin), per_text)
    z = np.add.reduceat(a[:, None] * h, begin, axis=0)
    return z @ p["c"] + p["d"][0], a, h, t, g, z


def _gradients(p, x, per_text, y):
    begin = np.cumsum(per_text) - per_text
    logit, a, h, t, g, z = _forward(p, x, per_text)
    dl = (_sigmoid(logit) - y) / len(y)
    dz = dl[:, None] * p["c"]
    wide = np.repeat(dz, per_text, axis=0)
    da = (wide * h).sum(axis=1)
    de = a * (da - np.repeat(np.add.reduceat(a * da, begin), per_text))
    dtg = de[:, None] * p["w"]
    dt, dg = dtg * g * (1 - t * t), dtg * t * g * (1 - g)
    dh = a[:, None] * wide + dt @ p["V"].T + dg @ p["U"].T
    dx = dh * (1 - h * h)
    return {"W": np.clip(x, -8, 8).T @ dx, "b": dx.sum(axis=0), "V": h.T @ dt, "U": h.T @ dg, "w": (t * g).T @ de,
            "c": z.T @ dl, "d": np.array([dl.sum()])}


def fit(features: np.ndarray, per_text: np.ndarray, labels: np.ndarray, seed: int = 0) -> Model:
    """Learn from bags; rows of ``features`` follow the bags.  Without both labels, every score is the share of ones."""
    ones = float(labels.mean()) if len(labels) else 0.5
    base = float(np.log(max(ones, 1e-6) / max(1 - ones, 1e-6)))
    rng = np.random.default_rng(seed)
    weights = {
        "W": rng.normal(0, FEATURES ** -0.5, (FEATURES, HIDDEN)), "b": np.zeros(HIDDEN), "V": rng.normal(0, 0.2, (HIDDEN, GATE)),
        "U": rng.normal(0, 0.2, (HIDDEN, GATE)), "w": rng.normal(0, 0.2, GATE), "c": np.zeros(HIDDEN), "d": np.array([base]),
    }
    if len(set(labels.tolist())) < 2:
        return Model(np.zeros(FEATURES), np.ones(FEATURES), weights)
    weights["c"] = rng.normal(0, 0.2, HIDDEN)
    mean, scale = features.mean(axis=0).astype(np.float64), features.std(axis=0) + 1e-3
    _descend(weights, (features - mean) / scale, per_text, labels, rng, EPOCHS, RATE)
    return Model(mean, scale, weights)


def _descend(weights, x, per_text, labels, rng, epochs: int, top: float) -> None:
    """Adam over shuffled bags; changes ``weights``."""
    begin = np.cumsum(per_text) - per_text
    first = {k: np.zeros_like(v) for k, v in weights.items()}
    second = {k: np.zeros_like(v) for k, v in weights.items()}
    step = 0
    for epoch in range(epochs):
        rate = top * 0.5 * (1 + np.cos(np.pi * epoch / epochs))
        order = rng.permutation(len(per_text))
        for k in range(0, len(order), BATCH):
            bags = order[k:k + BATCH]
            n = per_text[bags]
            rows = np.repeat(begin[bags] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            step += 1
            for name, grad in _gradients(weights, x[rows], n, labels[bags]).items():
                grad = grad + DECAY * weights[name]
                first[name] = 0.9 * first[name] + 0.1 * grad
                second[name] = 0.999 * second[name] + 0.001 * grad * grad
                weights[name] = weights[name] - rate * (first[name] / (1 - 0.9 ** step)) / (np.sqrt(second[name] / (1 - 0.999 ** step)) + 1e-8)


def restated(model: Model, mean: np.ndarray, scale: np.ndarray) -> Model:
    """The same model on features that are centred and scaled otherwise (equal but where features are clipped)."""
    weights = dict(model.weights)
    weights["b"] = weights["b"] + ((mean - model.mean) / model.scale) @ weights["W"]
    weights["W"] = weights["W"] * (scale / model.scale)[:, None]
    return Model(mean, scale, weights)


# ------------------------------------------------------------------ Spark

def held_out(key: str):
    """crc32 of the key as text, modulo 5, is 0; a null key is not held out."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _encoded(batches):
    """(at, key, label, text) to (at, key, label, passages, their features)."""
    for batch in batches:
        done = 0
        for features, per_text in passage_features(batch.column(3)):
            cuts = np.cumsum(per_text)[:-1]
            part = batch.slice(done, len(per_text))
            done += len(per_text)
            yield pa.RecordBatch.from_arrays(
                [*part.columns[:3], pa.array(per_text), pa.array([x.tobytes() for x in np.split(features, cuts)], pa.binary())],
                ["_at", "_key", "_label", "n", "features"])


def _marked(labels: DataFrame, key: str, label: str) -> DataFrame:
    marked = labels.filter(F.col(key).isNotNull() & F.col(label).isNotNull() & ~held_out(key))
    return marked.groupBy(F.col(key).alias("_key")).agg(F.max(label).cast("int").alias("_label"))


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
          train_docs: int = TRAIN_DOCS, seed: int = 0) -> Model:
    """Fit on at most ``train_docs`` labelled documents that are not held out, the smallest by a hash of the key.

    The sample is also bounded by ``TRAIN_BYTES`` of text: texts in it are
    whole, one that does not fit is passed over.  A key with several labels
    counts with the larger, one with several texts with one of them.
    """
    ship_package(docs.sparkSession)
    marked = _marked(labels, key, label)
    marked = marked.orderBy(keyed_hash("_key", seed=seed), "_key").limit(train_docs)
    asked = docs.select(F.col(key).alias("_doc"), F.col(text).alias("_text"))
    sample = asked.join(F.broadcast(marked), F.col("_doc") == F.col("_key"))  # at most train_docs rows
    rows = sample.select(keyed_hash("_key", seed=seed).alias("_at"), "_key", "_label", "_text")

    kind = docs.schema[key].dataType.simpleString()
    told = F.xxhash64("_text")
    size = F.coalesce(F.octet_length("_text"), F.lit(0))
    sized = rows.groupBy("_key").agg(F.min("_at").alias("_at"), F.min(F.struct(told.alias("told"), size.alias("size"))).alias("s"))
    # one row per key, so at most train_docs; a text that does not fit is passed over, and the next ones may fit
    kept, left = [], TRAIN_BYTES
    for r in sized.orderBy("_at", "_key").select("_key", "s.told", "s.size").collect():
        if r["size"] <= left:
            kept.append((r["_key"], r["told"]))
            left -= r["size"]
    chosen = docs.sparkSession.createDataFrame(kept, f"_k {rows.schema['_key'].dataType.simpleString()}, _told long")
    encoded = rows.join(F.broadcast(chosen), (F.col("_key") == F.col("_k")) & (told == F.col("_told"))).dropDuplicates(["_key"])
    found = encoded.select("_at", "_key", "_label", "_text").mapInArrow(
        lean(_encoded), f"_at long, _key {kind}, _label int, n long, features binary").collect()
    found.sort(key=lambda r: (r["_at"], r["_key"], r["n"], bytes(r["features"])))
    if not found:
        return fit(np.zeros((0, FEATURES), np.float32), np.zeros(0, np.int64), np.zeros(0))
    features = np.concatenate([np.frombuffer(r["features"], np.float32) for r in found]).reshape(-1, FEATURES)
    return fit(features, np.array([r["n"] for r in found]), np.array([float(r["_label"]) for r in found]), seed)


def learn(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", seed: int = 0) -> Model:
    """Fit on every labelled document that is not held out.

    ``train`` gives the first model.  If its sample cannot have held all of
    them, each block of about ``BLOCK_BYTES`` of text goes on from that model,
    with the mean and scale of all passages, and the blocks' weights are averaged
    by their numbers of documents.  Blocks follow a hash of the key, so they do
    not depend on how the rows are dealt out.
    """
    model = train(docs, labels, key, text, label, TRAIN_DOCS, seed)
    marked = materialize(_marked(labels, key, label), "marked")
    few = marked.limit(SMALL_IDS + 1).count() <= SMALL_IDS
    asked = docs.select(F.col(key).alias("_doc"), F.col(text).alias("_text"))
    rows = asked.join(F.broadcast(marked) if few else marked, F.col("_doc") == F.col("_key")).select("_key", "_label", "_text")
    told = F.xxhash64("_text")
    keys = materialize(rows.select("_key", "_label", told.alias("_told"), F.coalesce(F.octet_length("_text"), F.lit(0)).alias("size")), "labelled")
    n, size, kinds = keys.agg(F.count("*"), F.sum("size"), F.count_distinct("_label")).first()
    if n <= TRAIN_DOCS and (size or 0) <= TRAIN_BYTES or kinds < 2:
        return model
    # of a key with several texts one counts, the one that train takes
    several = materialize(keys.groupBy("_key").agg(F.count("*").alias("n"), F.min("_told").alias("_told")).filter("n > 1").select("_key", "_told"), "several")
    once = keep_ids(rows, several.select("_key"), "_key", "left_anti")
    more = keep_ids(rows.withColumn("_told", told), several, ["_key", "_told"]).groupBy("_key", "_told", "_label").agg(F.first("_text").alias("_text"))
    rows = once.unionByName(more.select(*once.columns))
    kind = rows.schema["_key"].dataType.simpleString()
    encoded = rows.select(keyed_hash("_key", seed=seed).alias("_at"), "_key", "_label", "_text").mapInArrow(
        lean(_encoded), f"_at long, _key {kind}, _label int, n long, features binary")
    encoded = materialize(encoded, "passages")

    def sums(batches):
        total = np.zeros((3, FEATURES))
        for batch in batches:
            for features in batch.column(0):
                x = np.frombuffer(features.as_buffer(), np.float32).reshape(-1, FEATURES).astype(np.float64)
                total += np.stack([np.full(FEATURES, len(x)), x.sum(axis=0), (x * x).sum(axis=0)])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size)), pa.array(total.reshape(-1))], ["at", "value"])

    def summed(parts: DataFrame, shape) -> np.ndarray:
        out = np.zeros(shape)
        for r in parts.groupBy("at").agg(F.sum("value").alias("value")).collect():  # one row per weight
            out.flat[r["at"]] = r["value"]
        return out

    total = summed(encoded.select("features").mapInArrow(lean(sums), "at long, value double"), (3, FEATURES))
    mean = total[1] / total[0]
    scale = np.sqrt(np.maximum(total[2] / total[0] - mean * mean, 0)) + 1e-3
    start = restated(model, mean, scale)
    names = sorted(start.weights)
    width = sum(start.weights[k].size for k in names)

    def block(table: pa.Table) -> pa.Table:
        table = table.sort_by([("_at", "ascending"), ("_key", "ascending")])
        x = np.concatenate([np.frombuffer(f.as_buffer(), np.float32) for f in table["features"]]).reshape(-1, FEATURES)
        weights = {k: v.copy() for k, v in start.weights.items()}
        rng = np.random.default_rng(seed)
        _descend(weights, (x - mean) / scale, table["n"].to_numpy(), table["_label"].to_numpy().astype(float), rng, BLOCK_EPOCHS, BLOCK_RATE)
        values = np.append(np.concatenate([weights[k].reshape(-1) for k in names]), 1.0) * len(table)
        return pa.table({"at": pa.array(np.arange(width + 1)), "value": pa.array(values)})

    blocks = F.pmod(F.xxhash64("_key"), F.lit(-(-size // BLOCK_BYTES) or 1))
    found = summed(encoded.groupBy(blocks.alias("block")).applyInArrow(block, "at long, value double"), width + 1)
    values, weights, at = found[:-1] / found[-1], {}, 0
    for k in names:
        shape = start.weights[k].shape
        weights[k] = values[at:at + start.weights[k].size].reshape(shape)
        at += start.weights[k].size
    return Model(mean, scale, weights)


def score(docs: DataFrame, model: Model, text: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with ``name``, the model's score of each whole text; null and empty texts are one empty passage.

    A column of that name is replaced; all others keep their names and values.
    """
    spark = docs.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast(model)
    kept = [f for f in docs.schema.fields if f.name != name]
    names = [f.name for f in kept]
    # a text that is kept goes to the worker once
    at = names.index(text) if text in names else len(kept)
    asked = [] if text in names else [F.col(f"`{text}`").alias(unused(docs.columns, "_scored"))]
    rows = docs.select(*[F.col(f"`{c}`") for c in names], *asked)

    def run(batches):
        for batch in batches:
            out = [shared.value.scores(x, n) for x, n in passage_features(batch.column(at))]
            column = pa.array(np.concatenate([*out, np.zeros(0)]))
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(names)], column], [*names, name])

    schema = docs.select(*[F.col(f"`{f.name}`") for f in kept]).schema.add(name, "double")
    return rows.mapInArrow(lean(run), schema)
