"""Registry of queries and the SQL text that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ship_package, spread

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(tables) -> DataFrame`` under ``name``."""

    def wrap(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = lambda spark, sf_dir: fn(Tables(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return wrap


class Tables:
    """The Parquet tables of one folder, plus the shapes derived from them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        ship_package(spark)
        self.spark, self.dir = spark, sf_dir

    def __call__(self, name: str) -> DataFrame:
        df = self.spark.read.parquet(f"{self.dir.rstrip('/')}/{name}.parquet")
        # texts are expensive per row: one file must not keep the other cores idle
        return spread(df) if name in ("documents", "pages", "conversations") else df

    @property
    def vectors(self) -> DataFrame:
        """(id, vector)"""
        return self("embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))

    @property
    def queries(self) -> DataFrame:
        """(query_id, vector): every stored vector asks."""
        return self("embeddings").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("vector"))

    @property
    def labelled(self) -> DataFrame:
        """(id, vector, label)"""
        return self("embeddings").select(
            F.col("vec_id").alias("id"), F.col("embedding").alias("vector"), F.col("label")
        )

    @property
    def documents(self) -> DataFrame:
        """(id, text)"""
        return self("documents").select(F.col("doc_id").alias("id"), "text")

    @property
    def ratings(self) -> DataFrame:
        """(user, item, rating): order customer, ordered part, 1 + quantity mod 5."""
        lines = self("lineitem").select(
            "l_orderkey", F.col("l_partkey").alias("item"), (F.lit(1.0) + F.col("l_quantity") % 5).alias("rating")
        )
        orders = self("orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("user"))
        return lines.join(orders, "l_orderkey").select("user", "item", "rating")
