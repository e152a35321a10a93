"""Text corpora: cleaning, vocabularies, token layouts and embeddings."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import kernels
from ..functions.arrowmap import with_arrow_column
from ..functions.strings import normalize_question, words
from . import skew
from .ordinal import with_ordinal


def build_pair_corpus(pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Cleaned distinct ``(question1, question2, …)`` rows, and both columns stacked as ``text``."""
    cleaned = pairs.withColumns({c: normalize_question(c) for c in ("question1", "question2")}).dropDuplicates()
    stacked = cleaned.select(F.col("question1").alias("text")).unionAll(cleaned.select(F.col("question2").alias("text")))
    return cleaned, stacked


def distinct_items(df: DataFrame, subset: list[str], order: list[str]) -> DataFrame:
    """First row per ``subset`` in the given total order."""
    window = Window.partitionBy(*subset).orderBy(*order)
    return df.withColumn("_r", F.row_number().over(window)).filter("_r = 1").drop("_r")


def vocab_fit(texts: DataFrame, key: str = "id", text: str = "text") -> DataFrame:
    """``(word, word_id, occurrences)``; ids from 1 in the order of first appearance, 0 is unknown."""
    tokens = texts.select(F.col(key).alias("doc"), F.posexplode(words(text)).alias("pos", "word")).filter("word <> ''")
    first = tokens.groupBy("word").agg(F.min(F.struct("doc", "pos")).alias("at"), F.count("*").alias("occurrences"))
    return with_ordinal(first, [F.col("at.doc"), F.col("at.pos")], "word_id", start=1).select(
        "word", "word_id", "occurrences")


def vocab_transform(texts: DataFrame, vocab: DataFrame, length: int = 16, key: str = "id", text: str = "text") -> DataFrame:
    """``(key, ids)``: the first ``length`` words as ids, zero-padded."""
    kept = F.slice(F.filter(words(text), lambda w: w != ""), 1, length)
    tokens = texts.select(key, F.posexplode_outer(kept).alias("pos", "word"))
    coded = skew.lookup_join(tokens, vocab.select("word", "word_id", "occurrences"), "word", "occurrences", how="left")
    slots = coded.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("pos", F.coalesce("word_id", F.lit(0)).alias("c")))).alias("t"))
    ids = F.filter(F.col("t"), lambda s: s["pos"].isNotNull())["c"]
    return slots.select(key, F.concat(ids, F.array_repeat(F.lit(0).cast("long"), F.lit(length) - F.size(ids))).alias("ids"))


def word_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    from ..functions.strings import word_count

    return df.withColumns({f"{c}_words": word_count(c) for c in columns})


# fixed values: marks around the packed sides
FIRST, SEPARATOR = "[CLS]", "[SEP]"


def pack_pair_tokens(df: DataFrame, a: str, b: str, length: int) -> DataFrame:
    """Adds ``tokens``, ``type_ids`` and ``mask`` of ``[CLS] a [SEP] b [SEP]``.

    The longer side is cut until both fit ``length`` − 3; on equal length the
    second side is cut.  That loop ends at half of the room each, unless one
    side needs less.  With a null ``b`` the single side gets ``length`` − 2.
    """
    ta, tb = F.col(a), F.col(b)
    room = length - 3
    la, lb = F.size(ta), F.size(tb)
    over = la + lb > room
    keep_a = F.when(over, F.least(la, F.greatest(F.lit(room) - lb, F.lit(-(-room // 2))))).otherwise(la)
    keep_b = F.when(over, F.least(lb, F.greatest(F.lit(room) - la, F.lit(room // 2)))).otherwise(lb)
    pair = F.concat(F.array(F.lit(FIRST)), F.slice(ta, 1, keep_a), F.array(F.lit(SEPARATOR)), F.slice(tb, 1, keep_b), F.array(F.lit(SEPARATOR)))
    single = F.concat(F.array(F.lit(FIRST)), F.slice(ta, F.lit(1), F.least(la, F.lit(length - 2))), F.array(F.lit(SEPARATOR)))
    alone = tb.isNull()

    def padded(ones: Column, value: int, head: Column) -> Column:
        return F.concat(head, F.array_repeat(F.lit(value), ones))

    out = df.withColumn("tokens", F.when(alone, single).otherwise(pair))
    used = F.size("tokens")
    second = F.when(alone, F.lit(0)).otherwise(F.least(keep_b, lb) + 1)
    zeros = F.array_repeat(F.lit(0), F.lit(length) - used)
    return out.withColumn(
        "type_ids", F.concat(F.array_repeat(F.lit(0), used - second), F.array_repeat(F.lit(1), second), zeros)
    ).withColumn("mask", F.concat(F.array_repeat(F.lit(1), used), zeros))


VOCABULARY_BYTES = 1 << 30


def word_vectors(texts: DataFrame, dim: int = 64, window: int = 5, min_count: int = 1, seed: int = 0, text="text", iterations: int = 1) -> DataFrame:
    """``(word, vector)`` by skip-gram training (whole words, no sub-words)."""
    from pyspark.ml.feature import Word2Vec
    from pyspark.ml.functions import vector_to_array

    rows = texts.select(F.filter(words(text), lambda w: w != "").alias("_words"))
    # the trainer gathers the vocabulary and its vectors on the driver: check before, and drop no words in silence
    often = rows.select(F.explode("_words").alias("w")).groupBy("w").count().filter(F.col("count") >= min_count)
    size = often.count()
    if size * dim * 8 > VOCABULARY_BYTES:
        raise ValueError(f"{size} words of {dim} components exceed {VOCABULARY_BYTES} bytes; raise min_count")
    partitions = max(1, rows.rdd.getNumPartitions())
    model = Word2Vec(vectorSize=dim, windowSize=window, minCount=min_count, seed=seed, maxIter=iterations, numPartitions=partitions,
                     inputCol="_words", outputCol="_v").fit(rows)
    return model.getVectors().select("word", vector_to_array("vector").alias("vector"))


def lookup_word_vectors(vocab: DataFrame, vectors: DataFrame) -> DataFrame:
    """``(word_id, word, vector)``; words without a vector are dropped."""
    return vocab.select("word", "word_id").join(vectors, "word").select("word_id", "word", "vector")


def mean_word_embedding(texts: DataFrame, vectors: DataFrame, key="id", text="text") -> DataFrame:
    """``(key, vector)``: mean of the word vectors of every word of the text."""
    tokens = texts.select(key, F.explode(words(text)).alias("word"))
    # words are counted per text before the join: one row per distinct word
    counted = tokens.groupBy(key, "word").agg(F.count("*").alias("times"))
    cells = counted.join(vectors, "word").select(key, "times", F.posexplode("vector").alias("dim", "x"))
    sums = cells.groupBy(key, "dim").agg((F.sum(F.col("x") * F.col("times")) / F.sum("times")).alias("x"))
    return sums.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("dim", "x"))).alias("c")).select(
        key, F.col("c.x").alias("vector"))


def hashed_bag(texts: DataFrame, dim: int = 256, key="id", text="text") -> DataFrame:
    """``(key, vector)``: hashed word counts weighted by inverse document frequency."""
    from pyspark.ml.feature import IDF, HashingTF
    from pyspark.ml.functions import vector_to_array

    rows = texts.select(key, words(text).alias("_words"))
    tf = HashingTF(numFeatures=dim, inputCol="_words", outputCol="_tf").transform(rows)
    model = IDF(inputCol="_tf", outputCol="_tfidf").fit(tf)
    return model.transform(tf).select(key, vector_to_array("_tfidf").alias("vector"))


def hashed_words(texts: DataFrame, dim: int = 64, key="id", text="text") -> DataFrame:
    """``(key, vector)``: counts of words per hash bucket, whole text, no training.

    Row by row, without a shuffle; a batch's different words are hashed once.
    """
    def count(column: pa.Array) -> pa.Array:
        coded = column.flatten().dictionary_encode()
        hashes = [int(hashlib.md5(w.encode()).hexdigest()[:8], 16) & 0x7FFFFFFF for w in coded.dictionary.to_pylist()]
        bucket = np.array(hashes, np.int64)[coded.indices.to_numpy(zero_copy_only=False)] % dim if hashes else np.zeros(0, np.int64)
        row = np.repeat(np.arange(len(column)), np.diff(column.offsets.to_numpy()))
        cells = np.bincount(row * dim + bucket, minlength=len(column) * dim).astype(float)
        return kernels.list_array(cells.reshape(len(column), dim), pa.float64())

    rows = texts.filter(F.col(text).isNotNull()).select(key, words(text).alias("_words"))
    return with_arrow_column(rows, "vector", "array<double>", "_words", count).select(key, "vector")


ENCODERS = {"hashed_words": hashed_words, "hashed_bag": hashed_bag}


def register_encoder(name: str, encode) -> None:
    """Add a text encoder: ``encode(df, key=…, text=…) -> (key, vector)``."""
    ENCODERS[name] = encode


def encode_texts(df: DataFrame, encoder: str = "hashed_words", **options) -> DataFrame:
    if encoder not in ENCODERS:
        raise ValueError(f"unknown encoder {encoder!r}; known: {sorted(ENCODERS)}")
    return ENCODERS[encoder](df, **options)


def encode_one(spark, text: str, encoder: str = "hashed_words", **options) -> list[float]:
    row = spark.createDataFrame([(0, text)], "id long, text string")
    return encode_texts(row, encoder, **options).first()["vector"]


def semantic_search(queries: DataFrame, items: DataFrame, n: int = 4, encoder="hashed_words", **options) -> DataFrame:
    """Items nearest in meaning: ``(query_id, rank, id, text, score)``, score rounded to 3.

    ``queries`` is ``(query_id, text)``, ``items`` is ``(id, text)``.
    """
    from .knn import attach_attributes, knn_join

    asked = encode_texts(queries, encoder, key="query_id", **options)
    stored = encode_texts(items, encoder, key="id", **options)
    found = knn_join(asked, stored, n, "cosine")
    return attach_attributes(found, items.select("id", "text")).select(
        "query_id", "rank", "id", "text", F.round("distance", 3).alias("score"))


def dedup_lines(texts: DataFrame, others: list[DataFrame], key="id", text="text") -> list[DataFrame]:
    """Keep the first of equal texts, in this and in the aligned tables."""
    keep = texts.groupBy(text).agg(F.min(key).alias(key)).select(key)
    return [d.join(keep, key, "left_semi") for d in (texts, *others)]


def mean_pool(rows: DataFrame, layer: int = 0) -> DataFrame:
    """Mean over tokens of one layer's values: ``(linex_index, vector)``."""
    cells = rows.select("linex_index", F.explode("features").alias("f")).select(
        "linex_index", F.posexplode(F.get("f.layers", F.lit(layer))["values"]).alias("dim", "x"))
    means = cells.groupBy("linex_index", "dim").agg(F.avg("x").alias("x"))
    return means.groupBy("linex_index").agg(F.array_sort(F.collect_list(F.struct("dim", "x"))).alias("c")).select(
        "linex_index", F.col("c.x").alias("vector"))
