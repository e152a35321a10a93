"""The data source of vector files."""

import os

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from kithra.sources import vecs, vecsource


def rows_of(df):
    return [(r["id"], list(r["vector"])) for r in df.orderBy("id").collect()]


@pytest.mark.parametrize("fmt, dtype", [("fvecs", "<f4"), ("ivecs", "<i4"), ("bvecs", "u1")])
def test_bytes_of_the_format(spark, tmp_path, fmt, dtype):
    x = (np.arange(60).reshape(20, 3) * 4).astype(dtype)
    raw = b"".join(np.array([3], "<i4").tobytes() + row.tobytes() for row in x)
    path = f"{tmp_path}/one.{fmt}"
    with open(path, "wb") as out:
        out.write(raw)
    want = [(i, row.tolist()) for i, row in enumerate(x)]
    assert rows_of(vecs.read_vecs(spark, path, fmt)) == want
    assert rows_of(vecs._read_records(spark, path, fmt)) == want
    cut = spark.read.format(fmt).option("splitbytes", 40).load(path)
    assert rows_of(cut) == want and cut.rdd.getNumPartitions() > 3
    vecs.write_vecs(cut.repartition(1), f"{tmp_path}/out", fmt)
    (file,) = [f for f in os.listdir(f"{tmp_path}/out") if not f.startswith(("_", "."))]
    with open(f"{tmp_path}/out/{file}", "rb") as back:
        assert back.read() == raw


def test_ranges_cover_every_record_once(tmp_path):
    x = np.random.default_rng(0).normal(size=(101, 5)).astype("<f4")
    for n, part in enumerate(np.array_split(x, 3)):
        with open(f"{tmp_path}/part-{n}.fvecs", "wb") as out:
            out.write(b"".join(np.array([5], "<i4").tobytes() + row.tobytes() for row in part))
    open(f"{tmp_path}/_draft.fvecs", "wb").write(b"unfinished")
    for split in (1, 24, 25, 100, 1 << 20):
        reader = vecsource.VectorReader("fvecs", {"path": str(tmp_path), "splitbytes": split})
        parts = reader.partitions()
        got = [(i, v) for p in parts for b in reader.read(p) for i, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist())]
        assert [i for i, _ in got] == list(range(101)) and np.allclose([v for _, v in got], x)
        assert len(parts) == sum(-(-len(part) // max(1, split // 24)) for part in np.array_split(x, 3))


def test_a_failed_job_leaves_nothing(spark, tmp_path):
    vecsource.register(spark)
    path = f"{tmp_path}/vectors"
    good = spark.range(40).select("id", F.array(F.col("id").cast("float")).alias("vector"))
    vecs.write_fvecs(good, path)
    before = sorted(os.listdir(path))
    bad = good.withColumn("vector", F.when(F.col("id") == 33, F.array(F.lit(1.0), F.lit(2.0))).otherwise(F.col("vector")).cast("array<float>"))
    with pytest.raises(PySparkException):
        bad.repartitionByRange(4, "id").write.format("fvecs").mode("append").save(path)
    assert sorted(os.listdir(path)) == before
    assert vecs.read_fvecs(spark, path).count() == 40
    good.filter("id < 3").write.format("fvecs").mode("overwrite").save(path)
    assert sorted(list(r["vector"]) for r in vecs.read_fvecs(spark, path).collect()) == [[0.0], [1.0], [2.0]]


def test_files_that_are_none(spark, tmp_path):
    path = f"{tmp_path}/bad.fvecs"
    with open(path, "wb") as out:
        out.write(np.array([4], "<i4").tobytes() + b"1234567")
    with pytest.raises(PySparkException):
        vecs.read_fvecs(spark, path).count()
    with pytest.raises(PySparkException):
        vecs.read_fvecs(spark, f"{tmp_path}/nothing").count()
    reader = vecsource.VectorReader("fvecs", {"path": path})
    with pytest.raises(ValueError):
        reader.partitions()
