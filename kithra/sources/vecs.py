"""Fixed-length binary vector files: int32 dimension, then the values of one vector.

``fvecs`` holds float32, ``ivecs`` int32 and ``bvecs`` uint8 values, all
little-endian.  Records have one length, so files split at record borders.
They are read and written by the data source of ``vecsource``; stores that only
Spark's own readers reach are read as fixed-length records.
"""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import kernels
from ..functions.arrowmap import with_arrow_column
from ..session import ship_package
from . import vecsource
from .vecsource import FORMATS


def _dimension(spark: SparkSession, path: str, width: int) -> int:
    """The first record's header; only its first bytes are read."""
    length = 4 if width == 4 else 1
    head = b"".join(bytes(r) for r in spark.sparkContext.binaryRecords(path, length).take(4 // length))
    if len(head) < 4:
        raise ValueError(f"{path} holds no vectors")
    return struct.unpack("<i", head)[0]


def _known(path: str) -> bool:
    """Whether pyarrow reaches the path's store."""
    try:
        vecsource.file_system(path)
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError):
        return False
    return True


def read_vecs(spark: SparkSession, path: str, fmt: str) -> DataFrame:
    """``(id, vector)``; the id is the record's position, files of a folder in order of name."""
    where = _qualified(spark, path)
    if not _known(where):
        return _read_records(spark, path, fmt)
    ship_package(spark)
    vecsource.register(spark)
    return spark.read.format(fmt).load(where)


def _read_records(spark: SparkSession, path: str, fmt: str) -> DataFrame:
    """The same through Spark's reader of fixed-length records, for stores that only Spark reaches."""
    width, dtype = FORMATS[fmt]
    dim = _dimension(spark, path, width)
    records = spark.sparkContext.binaryRecords(path, 4 + width * dim).zipWithIndex()
    rows = spark.createDataFrame(records.map(lambda r: (r[1], bytearray(r[0]))), "id long, record binary")
    out = "array<int>" if fmt == "ivecs" else "array<float>"
    kind = pa.int32() if fmt == "ivecs" else pa.float32()

    def decode(column: pa.Array) -> pa.Array:
        raw = np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), -1)
        heads = raw[:, :4].copy().view("<i4")[:, 0]
        if (heads != dim).any():
            raise ValueError("records of different dimension")
        values = raw[:, 4:].copy().view(dtype)
        return kernels.list_array(values.astype(np.int32 if fmt == "ivecs" else np.float32), kind)

    return with_arrow_column(rows, "vector", out, "record", decode).select("id", "vector")


def read_fvecs(spark, path):
    return read_vecs(spark, path, "fvecs")


def read_ivecs(spark, path):
    return read_vecs(spark, path, "ivecs")


def read_bvecs(spark, path):
    return read_vecs(spark, path, "bvecs")


def _qualified(spark, path: str) -> str:
    """The path with the scheme of the cluster's default file system, where readers look too."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    uri = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(hadoop).toString()
    return "file://" + uri[5:] if uri.startswith("file:/") and not uri.startswith("file://") else uri


def write_vecs(df: DataFrame, path: str, fmt: str) -> DataFrame:
    """Write ``(id, vector)`` ordered by id as part files below ``path``; returns ``(file, rows)`` of all files there.

    The files take their names when all tasks have ended; a failed job leaves none.
    """
    spark = df.sparkSession
    where = _qualified(spark, path)
    ship_package(spark)
    vecsource.register(spark)
    rows = df.select(F.col("id").cast("long").alias("id"), F.col("vector").cast("array<int>" if fmt == "ivecs" else "array<float>").alias("vector"))
    rows.repartitionByRange("id").sortWithinPartitions("id").write.format(fmt).mode("append").save(where)
    return vec_files(spark, where, fmt)


def vec_files(spark: SparkSession, path: str, fmt: str) -> DataFrame:
    """``(file, rows)`` of the vector files at ``path``, from their headers."""
    found: dict[str, int] = {}
    for part in vecsource.VectorReader(fmt, {"path": _qualified(spark, path)}).partitions():
        name = part.file.rsplit("/", 1)[-1]
        found[name] = found.get(name, 0) + part.count
    return spark.createDataFrame(sorted(found.items()), "file string, rows long")


def write_fvecs(df, path):
    return write_vecs(df, path, "fvecs")


def write_ivecs(df, path):
    return write_vecs(df, path, "ivecs")


def load_benchmark(spark, folder: str, name: str, topk: int = 20, metric: str = "euclid", fmt: str = "fvecs"):
    """(base, train, queries, truth) of a benchmark folder; train and truth are None if absent."""
    from ..operators.index import _exists

    if fmt not in ("fvecs", "bvecs"):
        raise ValueError("fmt must be fvecs or bvecs")
    root = f"{folder.rstrip('/')}/{name}/"

    def load(file, kind):
        return read_vecs(spark, root + file, kind) if _exists(spark, root + file) else None

    base, queries = load(f"{name}_base.{fmt}", fmt), load(f"{name}_query.{fmt}", fmt)
    if base is None or queries is None:
        raise FileNotFoundError(f"no base or query vectors below {root}")
    return base, load(f"{name}_learn.{fmt}", fmt), queries, load(f"{topk}_{name}_{metric}_groundtruth.ivecs", "ivecs")
