"""Registered queries against their SQL twins.

A spread of families by default; KITHRA_ALL=1 runs every one.
"""

import os

import duckdb
import pytest

import __spark_entry__ as entry_point
from check import TABLES, rows_of

SF = "/root/testdata/sf0.001"
QUICK = [
    "knn_join_l2", "knn_join_canberra", "mutual_nn", "ivf_knn_three_probes", "ivf_dedup_knn", "pairwise_distances", "prewhiten",
    "e2m_gram", "kmeans_two_iterations", "pq_knn", "ivfpq_knn", "residual_pq_codes", "index_change_log", "normalize_question",
    "vocabulary_ids", "jaccard_join", "minhash_lsh_join", "vote_match", "nms_union", "val_at_far", "topk_text",
]
ALL = sorted(entry_point.queries())
NAMES = ALL if os.environ.get("KITHRA_ALL") else QUICK


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return con


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, sql, name):
    df = entry_point.queries()[name](spark, SF)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    text = entry_point.oracle_sql().get(name)
    if text is None:
        assert got
        return
    cursor = sql.execute(text)
    columns = [c[0] for c in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    assert got == rows_of(columns, cursor.fetchall())


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0


def test_every_oracle_has_a_query():
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())
