"""Lines that many documents share, found by levelled sorted runs of line digests.

A *run* is a table of line digests, bucketed and sorted by digest, with the
document that holds the line first and the number of documents that have it.
Documents come in batches.  A batch's digests are merged with the runs there
are: those that no run holds (an anti-join) get their holder from this batch,
the others keep the one they have; the batch is then written as a run of level 0.
As soon as a level has ``fanout`` runs they are merged into one of the next
level, so a batch meets few runs however many came before.  All runs share one
bucketing, so that a batch is shuffled once and the runs never are.

DataFrame functions only.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize, scratch_path
from .hotjoin import hot_join, keep_ids

MIN_CHARS = 40  # code points of a line that counts
MIN_DOCS = 5  # documents that make a line a shared one
BATCHES = 4  # parts that a table at rest is taken in
FANOUT = 2  # runs of a level that are merged into one of the next
BLANKS = " \t\n\x0b\f\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
DIGEST = ["high", "low"]


def line_key(line: Column) -> Column:
    """The line without white space at its ends, A-Z as a-z; other letters stay as they are."""
    bare = F.btrim(line, F.lit(BLANKS))
    # lower() has a fast path for texts of ASCII only, where both say the same
    return F.when(F.octet_length(bare) == F.char_length(bare), F.lower(bare)).otherwise(F.translate(bare, UPPER, LOWER))


def line_rows(docs: DataFrame, key: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS) -> DataFrame:
    """(key, told, pos, high, low): the lines long enough to count, by their place from 0 and a digest of 128 bits.

    ``told`` tells rows of one key apart.
    """
    rows = docs.filter(F.octet_length(text) >= min_chars).select(
        F.col(key).alias("key"), F.xxhash64(text).alias("told"), F.posexplode(F.split(text, "\n", -1)).alias("pos", "line"))
    keyed = rows.filter(F.octet_length("line") >= min_chars).select("key", "told", "pos", line_key(F.col("line")).alias("line"))
    return keyed.filter(F.char_length("line") >= min_chars).select(
        "key", "told", "pos", F.xxhash64("line").alias("high"), F.xxhash64(F.lit(1), "line").alias("low"))


def batch_digests(lines: DataFrame) -> DataFrame:
    """(high, low, holder, docs): a batch's lines with the largest key that has them and the number of keys.

    Rows of one key count once, rows without a key together as one.  A line of
    very many documents is folded in the map tasks.
    """
    return lines.select(*DIGEST, "key").distinct().groupBy(*DIGEST).agg(F.max("key").alias("holder"), F.count(F.lit(1)).alias("docs"))


class LineRuns:
    """The runs below ``path``; ``add`` takes batches, ``merged`` gives all lines.

    The first batch that has a line names its holder, so batches in falling
    order of key give each line to its largest key.
    """

    def __init__(self, spark: SparkSession, path: str, fanout: int = FANOUT):
        self.spark, self.path, self.fanout = spark, path, fanout
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[DataFrame]] = []
        self._names: list[str] = []

    def _write(self, rows: DataFrame) -> DataFrame:
        name = f"line_run_{uuid.uuid4().hex}"
        rows.write.bucketBy(self.buckets, *DIGEST).sortBy(*DIGEST).option("path", f"{self.path}/{name}").format("parquet").saveAsTable(name)
        self._names.append(name)
        return self.spark.table(name)

    @property
    def runs(self) -> list[DataFrame]:
        return [run for level in self.levels for run in level]

    def _put(self, run: DataFrame, level: int = 0) -> None:
        if level == len(self.levels):
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) >= self.fanout:
            merged = self._write(_merged(self.levels[level]))
            self.levels[level] = []
            self._put(merged, level + 1)

    def add(self, batch: DataFrame) -> None:
        """Merge a batch's digests (see ``batch_digests``) with the runs and add them as a run."""
        fresh = batch
        for run in self.runs:
            fresh = fresh.join(run.select(*DIGEST), DIGEST, "left_anti")
        rows = fresh
        if self.runs:
            # the rest of the batch only adds to the count of a line that has its holder
            known = batch.join(fresh.select(*DIGEST), DIGEST, "left_anti")
            rows = fresh.unionByName(known.withColumn("holder", F.lit(None).cast(batch.schema["holder"].dataType)))
        self._put(self._write(rows.repartition(self.buckets, *DIGEST)))

    def merged(self) -> DataFrame:
        """(high, low, holder, docs) of all lines added."""
        return _merged(self.runs)

    def forget(self) -> None:
        """Take the runs' names out of the catalog; their files stay below ``path``."""
        for name in self._names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")


def _merged(runs: list[DataFrame]) -> DataFrame:
    """One run's rows from several: a merge join of two bucketed tables, which moves no row between tasks."""
    out = runs[0]
    for run in runs[1:]:
        other = run.select(*DIGEST, F.col("holder").alias("_holder"), F.col("docs").alias("_docs"))
        out = out.join(other, DIGEST, "full").select(
            *DIGEST, F.greatest("holder", "_holder").alias("holder"),
            (F.coalesce("docs", F.lit(0)) + F.coalesce("_docs", F.lit(0))).alias("docs"))
    return out


def without(lines: Column, gone: Column) -> Column:
    """The array ``lines`` without the sorted places ``gone``: the stretches between them, put together."""
    def stretch(i: Column) -> Column:
        low = F.coalesce(F.get(gone, i - 1) + 1, F.lit(0))
        return F.slice(lines, low + 1, F.coalesce(F.get(gone, i), F.size(lines)) - low)

    return F.flatten(F.transform(F.sequence(F.lit(0), F.size(gone)), stretch))


def shared_places(docs: DataFrame, key: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS,
                  min_docs: int = MIN_DOCS, batches: int = BATCHES, fanout: int = FANOUT) -> DataFrame:
    """(key, told, gone): the sorted places of the lines that a row loses; rows that lose none are not there."""
    spark = docs.sparkSession
    cuts = docs.agg(F.percentile_approx(key, [i / batches for i in range(1, batches)], 1000)).first()[0]
    # the highest keys come first, rows without a key last
    number = sum((F.coalesce(F.col("key") <= F.lit(cut), F.lit(True)).cast("int") for cut in sorted(set(cuts or []))), F.lit(0))
    path = scratch_path(spark, "line-digests")
    line_rows(docs, key, text, min_chars).withColumn("batch", number).write.partitionBy("batch").parquet(path)
    kind = docs.schema[key].dataType.simpleString()
    lines = spark.read.schema(f"key {kind}, told long, pos int, high long, low long, batch int").parquet(path)
    runs = LineRuns(spark, scratch_path(spark, "line-runs"), fanout)
    for n in range(len(set(cuts or [])) + 1):
        runs.add(batch_digests(lines.filter(F.col("batch") == n)))
    shared = materialize(runs.merged().filter(F.col("docs") >= min_docs), "shared-lines")
    runs.forget()
    found = hot_join(lines.drop("batch"), shared, DIGEST, "docs").filter(~F.col("key").eqNullSafe(F.col("holder")))
    return found.groupBy("key", "told").agg(F.sort_array(F.collect_set("pos")).alias("gone"))


def drop_shared_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS,
                      min_docs: int = MIN_DOCS, batches: int = BATCHES, fanout: int = FANOUT) -> DataFrame:
    """Per row of ``docs``: key, n_lines, n_dropped, gone (places from 0), kept (the other lines).

    A line's key is the line without white space at its ends and with A-Z as
    a-z.  Keys of ``min_chars`` code points and more that ``min_docs`` documents
    have stay in the document with the largest ``key`` alone, there as often as
    they stand.  Null and empty texts are one empty line.  Rows that repeat a
    key are one document for the count; equal rows give equal results.  Rows
    without a key are together one document, below all others.  ``key`` must be
    a number.  Other columns of ``docs`` are not looked at.
    """
    gone = materialize(shared_places(docs, key, text, min_chars, min_docs, batches, fanout), "shared-places")
    rows = docs.select(F.col(key).alias("_key"), F.coalesce(text, F.lit("")).alias("_text"), F.xxhash64(text).alias("told"))
    # texts that lose nothing are not shuffled
    told = gone.select("told").distinct()
    untouched = keep_ids(rows, told, "told", "left_anti")
    touched = keep_ids(rows, told, "told").withColumnRenamed("told", "_told").join(
        gone, F.col("_key").eqNullSafe(F.col("key")) & (F.col("_told") == F.col("told")), "left")
    lines = F.split("_text", "\n", -1)
    none = F.array().cast("array<int>")
    some = F.coalesce("gone", none)
    out = touched.select("_key", F.size(lines).alias("n"), some.alias("gone"),
                         F.array_join(without(lines, some), "\n").alias("kept"))
    out = untouched.select("_key", F.size(lines).alias("n"), none.alias("gone"), F.col("_text").alias("kept")).unionByName(out)
    return out.select(F.col("_key").alias(key), F.col("n").cast("long").alias("n_lines"),
                      F.size("gone").cast("long").alias("n_dropped"), "gone", "kept")
