"""Postings on disk: folders of neighbouring cells, each sorted by cell and id."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from .ivf import GROUP, cell_group


def write_stored(rows: DataFrame, path: str, nlist: int) -> None:
    """Write postings below ``path/postings``, one folder per group of cells.

    Rows are dealt by ranges of (cell, id), so an oversize cell spans several
    files of its folder, and a task writes few folders.
    """
    laid = rows.withColumn(GROUP, cell_group("list_id", nlist)).repartitionByRange("list_id", "id").sortWithinPartitions(GROUP, "list_id", "id")
    laid.write.partitionBy(GROUP).parquet(f"{path}/postings")
    # an empty table writes no file: its columns are kept beside
    rows.limit(0).coalesce(1).write.parquet(f"{path}/columns")


def read_stored(spark: SparkSession, path: str) -> DataFrame:
    """The postings with their ``cell_group``, the partition column."""
    schema = spark.read.parquet(f"{path}/columns").schema
    return spark.read.schema(schema.add(GROUP, IntegerType())).parquet(f"{path}/postings")
