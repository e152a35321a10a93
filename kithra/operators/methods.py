"""Search methods by name: each finds neighbours, makes pairs and saves them."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.writers import write_pairs
from . import knn, setjoin


@dataclass(frozen=True)
class SearchMethod:
    name: str
    search: Callable[..., DataFrame]

    def create_pairs(self, source: DataFrame, **options) -> DataFrame:
        """``(i, j)`` of every row and its neighbours."""
        found = self.search(source, source, **options).filter("query_id <> id")
        return found.select(F.col("query_id").alias("i"), F.col("id").alias("j"))

    def save(self, pairs: DataFrame, path: str) -> None:
        write_pairs(pairs, path)


def _vectors(queries: DataFrame, source: DataFrame, k: int = 5, metric="l2") -> DataFrame:
    return knn.knn_join(knn.as_queries(queries), source, k, metric)


def _texts(method: str):
    def search(queries: DataFrame, source: DataFrame, k: int = 5, lemma_threshold=0.4, text_threshold=0.2, **options) -> DataFrame:
        return setjoin.text_neighbours(queries, source, k, lemma_threshold, text_threshold, method=method, **options)

    return search


METHODS = {m.name: m for m in (
    SearchMethod("vectorsearch", _vectors),
    SearchMethod("wordsetsearch", _texts("exact")),
    SearchMethod("minhashsearch", _texts("lsh")),
)}


def method_named(part: str) -> SearchMethod:
    """The one method whose name contains ``part``, whatever its case."""
    found = [m for name, m in METHODS.items() if part.lower() in name]
    if len(found) != 1:
        raise ValueError(f"{part!r} names {len(found)} of {sorted(METHODS)}")
    return found[0]
