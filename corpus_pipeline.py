"""Training corpus: score, drop near copies, decontaminate, mix, and write token ids.

``STAGES`` are functions ``(spark, docs, sf_dir) -> DataFrame``.  Each stage's
rows are written as Parquet and read again as the next one's ``docs``; all but
the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kithra.llm import decontaminate, mixing, ngramjoin, quality, tokenfiles
from kithra.llm.catalog import table
from kithra.llm.hotjoin import keep_ids
from kithra.llm.names import unused
from kithra.llm.q_data import word_tokenizer
from kithra.session import materialize, scratch_path

NEAR_WIDTH, NEAR_PERCENT = 5, 80  # words of a shingle, similarity of near copies


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; it learns from the labels of ``docs``.

    Null and empty texts are scored like others, as one empty passage, and rows
    without a doc_id too; without labels every score is 0.5 and all stay.  An
    empty table stays empty; extra columns go through as they are.
    """
    model = quality.learn(docs, table(spark, sf_dir, "labels"))
    name = unused(docs.columns, "score")
    return quality.score(docs, model, name=name).filter(F.col(name) >= quality.THRESHOLD).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the smallest doc_id, and one row of it.

    Documents without words and rows without a doc_id are in no group and
    stay, but for rows that repeat a doc_id, of which one stays: the first by
    the text's hash, the text and the other columns.  An empty table stays
    empty; extra columns go through as they are.
    """
    classes = ngramjoin.ngram_jaccard_classes(docs, width=NEAR_WIDTH, percent=NEAR_PERCENT).filter("doc_id is not null")
    grouped = materialize(classes.groupBy("doc_id").agg(
        F.min(F.when(F.col("n_shingles") > 0, F.col("component_id"))).alias("component"), F.count("*").alias("n")), "groups")
    gone = materialize(grouped.filter("component < doc_id").select("doc_id"), "near-copies")
    kept = keep_ids(docs, gone, "doc_id", "left_anti")
    # rows that repeat a doc_id are one document; they are folded in the map tasks
    repeated = materialize(grouped.filter("n > 1").select("doc_id"), "repeated")
    row = F.struct("*")
    first = F.min_by("row", F.struct(F.xxhash64("row.text"), "row.text", F.to_json("row")))
    one = keep_ids(kept, repeated, "doc_id").select(row.alias("row")).groupBy("row.doc_id").agg(first.alias("row"))
    one = one.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
    return keep_ids(kept, repeated, "doc_id", "left_anti").select(*docs.columns).unionByName(one)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item.

    Null and empty texts hold none; a row without a doc_id stays; rows that
    repeat a doc_id are one document and go together.  An empty table stays
    empty; extra columns go through as they are.
    """
    return decontaminate.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it.

    A null source is a source of its own; texts without words count 0 and are
    drawn at their source's rate; equal rows share their copies in any order.
    An empty table stays empty; extra columns go through as they are.
    """
    return mixing.mixed(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mix, read again: doc_id, start, n_tokens and a checksum of the ids.

    Null and empty texts hold the end id alone; rows without a doc_id come
    first; an empty table gives no rows; extra columns are not written.
    """
    path = scratch_path(spark, "corpus-tokens")
    tokenfiles.write_token_files(docs, path, word_tokenizer(), lower_words=True)
    return tokenfiles.read_checks(spark, path)


STAGES = [
    ("quality", keep_good),
    ("near copies", drop_near_copies),
    ("decontamination", drop_leaks),
    ("mixing", mix_sources),
    ("token ids", write_tokens),
]

#: No stage but the mixing can be said in SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), "corpus-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
