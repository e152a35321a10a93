"""Text, CSV, JSON, file-tree and table sources; every schema is explicit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ordinal import with_ordinal

# fixed values: separators inside the key-value text format
GROUP, FIELD = "\x01", "\x02"

TOKEN_SCHEMA = (
    "linex_index int, features array<struct<token: string, layers: array<struct<index: int, values: array<double>>>>>"
)


def _floats(text: Column, separator: str) -> Column:
    return F.transform(F.split(text, separator), lambda x: x.cast("float"))


def read_kv_embeddings(spark: SparkSession, path: str) -> DataFrame:
    """``(key, vector)`` from ``key⇥f1⟨2⟩f2…``; only the first ⟨1⟩-group is the vector."""
    lines = spark.read.text(path)
    parts = F.split("value", "\t")
    return lines.select(parts[0].alias("key"), _floats(F.split(parts[1], GROUP)[0], FIELD).alias("vector"))


def read_space_vectors(spark, path) -> DataFrame:
    """``(vector)`` from one space-separated vector per line."""
    return spark.read.text(path).select(_floats(F.trim("value"), " +").alias("vector"))


def read_key_index(spark, path) -> DataFrame:
    """``(key, id)``"""
    return spark.read.csv(path, sep="\t", schema="key string, id long", quote="")


def read_topk_text(spark, path) -> DataFrame:
    """``(key, neighbours: array<struct<id, score>>)`` as ``write_topk_text`` leaves it."""
    parts = F.split("value", "\t")
    entries = F.filter(F.split(parts[1], GROUP), lambda e: e != "")
    pairs = F.transform(entries, lambda e: F.struct(
        F.split(e, FIELD)[0].alias("id"), F.split(e, FIELD)[1].cast("double").alias("score")))
    return spark.read.text(path).select(parts[0].alias("key"), pairs.alias("neighbours"))


def read_ratings(spark, path) -> DataFrame:
    """``(user, item, rating)``: the first three columns of a CSV with header."""
    schema = "user long, item long, rating double, timestamp long"
    return spark.read.csv(path, header=True, schema=schema, enforceSchema=True).select("user", "item", "rating")


def read_items(spark, path) -> DataFrame:
    """``(item, title, genres)`` with genres split."""
    rows = spark.read.csv(path, header=True, schema="item long, title string, genres string", escape='"')
    return rows.withColumn("genres", F.split("genres", r"\|"))


def read_token_embeddings(spark, path) -> DataFrame:
    """Nested token layers from JSON lines."""
    return spark.read.schema(TOKEN_SCHEMA).json(path)


def read_lines(spark, path) -> DataFrame:
    """``(id, text)``: right-stripped lines of a file by position."""
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("_f"), F.col("_metadata.file_block_start").alias("_b"),
        F.monotonically_increasing_id().alias("_m"), F.rtrim("value").alias("text"))
    # lines of one split keep their order; splits follow by file and offset
    return with_ordinal(lines, ["_f", "_b", "_m"], "id").select("id", "text")


def read_id_text(spark, path) -> DataFrame:
    """``(id, text)`` from ``id:text``, cut at the first colon."""
    lines = spark.read.text(path).select(F.rtrim("value").alias("v")).filter(F.instr("v", ":") > 0)
    return lines.select(
        F.regexp_extract("v", "^([^:]*):(.*)$", 1).cast("long").alias("id"),
        F.regexp_extract("v", "^([^:]*):(.*)$", 2).alias("text"))


def read_question_pairs(spark, path) -> DataFrame:
    """``(question1, question2, is_duplicate)``; nulls become empty."""
    rows = spark.read.csv(path, header=True, multiLine=True, quote='"', escape='"',
                          schema="question1 string, question2 string, is_duplicate int")
    return rows.fillna("", ["question1", "question2"])


def read_sentence_pairs(spark, path) -> DataFrame:
    """``(unique_id, text_a, text_b)`` from ``a ||| b`` lines; ``text_b`` is null without the bars."""
    lines = read_lines(spark, path)
    return split_sentence_pair(lines.withColumnRenamed("id", "unique_id"), "text").drop("text")


PAIR_PATTERN = r"^(.*) \|\|\| (.*)$"


def split_sentence_pair(df: DataFrame, column: str) -> DataFrame:
    text = F.trim(column)
    paired = text.rlike(PAIR_PATTERN)
    return df.withColumn("text_a", F.when(paired, F.regexp_extract(text, PAIR_PATTERN, 1)).otherwise(text)).withColumn(
        "text_b", F.when(paired, F.regexp_extract(text, PAIR_PATTERN, 2)))


def parse_embedding_text(text: Column | str) -> Column:
    """``(v1, v2, …)`` → array<double>"""
    col = F.col(text) if isinstance(text, str) else text
    return F.transform(F.split(F.trim(F.translate(col, "(),", "")), " +"), lambda x: x.cast("double"))


def read_embedding_table(spark, url: str, table: str = "frdata", **options) -> DataFrame:
    """``(filename, vector, bbox)`` of a JDBC table of embedding strings.

    Pass ``partitionColumn``, ``lowerBound``, ``upperBound`` and
    ``numPartitions`` to read it in parallel.
    """
    rows = spark.read.format("jdbc").options(url=url, dbtable=table, **options).load()
    return rows.select("filename", parse_embedding_text("embeddings").alias("vector"), "bbox")


def read_binary_files(spark, path: str, extensions: list[str] = ("jpg", "JPG")) -> DataFrame:
    """``(id, path, length, content)`` of the files with one of the extensions, recursively."""
    pattern = "*.{" + ",".join(extensions) + "}"
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(path)
    # numbered by path on the listing alone; the bytes are read only if used
    ids = with_ordinal(files.select("path"), ["path"], "id")
    return files.join(ids, "path").select("id", "path", "length", "content")


def class_directory_dataset(spark, root: str) -> DataFrame:
    """``(class, class_id, path)``: the sub-folder of a file is its class, classes sorted."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path")
    named = files.withColumn("class", F.regexp_extract("path", r"([^/]+)/[^/]+$", 1))
    classes = with_ordinal(named.select("class").distinct(), ["class"], "class_id")
    return named.join(classes, "class").select("class", "class_id", "path")


def read_adjlist(spark, path) -> DataFrame:
    """``(src, position, dst)`` from ``base,n1,n2,…`` lines."""
    ids = F.transform(F.split("value", ","), lambda x: x.cast("long"))
    rows = spark.read.text(path).filter(F.length("value") > 0).select(ids.alias("ids"))
    return rows.select(F.col("ids")[0].alias("src"), F.posexplode(F.slice("ids", F.lit(2), F.size("ids"))).alias("position", "dst"))
