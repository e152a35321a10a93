"""An index as tables: a small trained model and a postings table.

Every operation returns a new index over a new postings DataFrame; nothing is
changed in place.  On disk an index is a folder of Parquet tables with relative
names only, so it can be moved:

    meta/      one row: dimension, metric, kinds of the trained parts
    model/     (component, i, values): centroids, codebooks, matrices
    cells/     (parent, list_id, centre), where the cells have two levels
    postings/  (list_id, id, vector | codes), in folders of neighbouring cells
    log/       rows added or removed since, one folder per batch of a writer
"""

from __future__ import annotations

import hashlib
import json
import time
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import arrays, kernels
from ..session import materialize
from . import codecs, ivf, knn
from .blockjoin import block_join, search, small_side
from .codebooks import Codebook, assign
from .layout import read_stored, write_stored
from .linear import Chain, L2Norm, Linear, Pad, Remap
from .ordinal import with_ordinal
from .routing import RoutedCells, routed_from

NO_LIST = 0  # list of an index without cells


@dataclass
class SignBits:
    """Codec of sign bits of a projection; searched by Hamming distance."""

    projection: Linear
    thresholds: list[float] | None = None

    def encode(self, df, vector="vector", codes="codes"):
        rows = self.projection.transform(df.withColumn("_p", arrays.doubles(vector)), "_p")
        cut = None if self.thresholds is None else arrays.constant_vector(self.thresholds)
        return rows.withColumn(codes, arrays.pack_words(arrays.binarize("_p", cut))).drop("_p")


@dataclass
class VectorIndex:
    """``coarse`` cells and ``codec`` codes are optional; ``second`` re-ranks."""

    spark: SparkSession
    dim: int
    metric: str = "l2"
    transform: Chain = field(default_factory=Chain)
    coarse: Codebook | RoutedCells | None = None
    codec: object | None = None
    second: Codebook | None = None
    postings: DataFrame | None = None
    spec: str = ""
    stored: DataFrame | None = None  # the same rows as they lie on disk, with their folder

    # ------------------------------------------------------------- building

    @property
    def nlist(self) -> int:
        if self.coarse is None:
            return 1
        return self.coarse.nlist if isinstance(self.coarse, RoutedCells) else self.coarse.ks ** self.coarse.m

    @property
    def by_residual(self) -> bool:
        """Codes inside cells describe the residual to the cell's centroid."""
        return self.coarse is not None and self.codec is not None and not isinstance(self.codec, SignBits)

    def _columns(self) -> list[str]:
        if self.codec is None:
            return ["list_id", "id", "vector"]
        return ["list_id", "id", "codes"] + (["codes2"] if self.second else [])

    def _cells(self, rows: DataFrame) -> DataFrame:
        """Adds the row's cell."""
        if self.coarse is None:
            return rows.withColumn("list_id", F.lit(NO_LIST).cast("long"))
        if isinstance(self.coarse, RoutedCells):
            return self.coarse.assign(rows, self.metric in ("ip", "cosine"))
        if self.coarse.m > 1:
            return ivf.imi_cells(rows, self.coarse)
        if self.metric in ("ip", "cosine"):
            kernel_rows = rows.select(F.col("id").alias("query_id"), "vector")
            out = ivf.probe(kernel_rows, self.coarse.centroids, 1, self.metric).withColumnRenamed("query_id", "id")
        else:
            out = assign(rows, self.coarse.centroids, distance=None)
        return out.withColumn("list_id", F.col("list_id").cast("long"))

    def _with_centre(self, rows: DataFrame) -> DataFrame:
        """Adds ``_centre``, the centroid of the row's cell."""
        book = self.coarse
        if isinstance(book, RoutedCells):
            return book.with_centre(rows)
        if book.m == 1:
            table = book.to_rows(self.spark).select(F.col("code").cast("long").alias("list_id"), F.col("word").alias("_centre"))
            return rows.join(F.broadcast(table), "list_id")  # a model of checked size
        # the cell number is the codes of its segments, written in base ks
        digits = [F.floor(F.col("list_id") / book.ks ** (book.m - 1 - m)) % book.ks for m in range(book.m)]
        return book.decode(rows.withColumn("_cell", F.array(*[d.cast("int") for d in digits])), "_cell", "_centre").drop("_cell")

    def _prepare(self, rows: DataFrame) -> DataFrame:
        rows = rows.select(*[c for c in ("id", "query_id") if c in rows.columns], arrays.doubles("vector").alias("vector"))
        rows = rows.filter(F.col("vector").isNotNull())
        if self.metric == "cosine":
            rows = rows.withColumn("vector", arrays.l2_normalize("vector"))
        return self.transform.transform(rows)

    def encode(self, rows: DataFrame) -> DataFrame:
        """``(id, vector)`` → postings rows."""
        rows = self._prepare(rows)
        routed = self.by_residual and isinstance(self.coarse, RoutedCells)
        # a row that meets its cell's centroid takes it along
        rows = self.coarse.assign(rows, self.metric in ("ip", "cosine"), centre=True) if routed else self._cells(rows)
        if self.codec is None:
            return rows.select(*self._columns())
        if self.by_residual:
            rows = (rows if routed else self._with_centre(rows)).withColumn("vector", arrays.subtract("vector", "_centre")).drop("_centre")
        rows = self.codec.encode(rows, "vector", "codes")
        if self.second:
            rows = self.codec.decode(rows, "codes", "_known")
            rows = rows.withColumn("_rest", arrays.subtract("vector", "_known")).drop("_known")
            rows = self.second.encode(rows, "_rest", "codes2")
        return rows.select(*self._columns())

    def add_with_ids(self, rows: DataFrame) -> "VectorIndex":
        new = self.encode(rows)
        return self._with(new if self.postings is None else self.postings.unionByName(new))

    def add(self, rows: DataFrame, order: list) -> "VectorIndex":
        """Append ``vector`` rows; ids go on after the highest one, in the given order."""
        numbered = with_ordinal(rows, order, "_new", start=self.next_id)
        return self.add_with_ids(numbered.select(F.col("_new").alias("id"), "vector"))

    # ---------------------------------------------------------- maintenance

    @property
    def ntotal(self) -> int:
        return 0 if self.postings is None else self.postings.count()

    @property
    def next_id(self) -> int:
        """One more than the highest id, so ids left after a removal are not given twice."""
        top = None if self.postings is None else self.postings.agg(F.max("id")).first()[0]
        return 0 if top is None else top + 1

    def _with(self, postings: DataFrame) -> "VectorIndex":
        return replace(self, postings=postings, stored=None)

    def remove_ids(self, ids: DataFrame | Column) -> "VectorIndex":
        """Remove the ids of a table, or the rows a boolean column selects; other ids stay."""
        if isinstance(ids, Column):
            return self._with(knn.remove_where(self.postings, ids))
        gone = small_side(ids.select("id").distinct())
        return self._with(self.postings.join(gone, "id", "left_anti").select(*self._columns()))

    def remove_sequential(self, ids: DataFrame | Column) -> "VectorIndex":
        """The same where ids are positions: later ids move down."""
        left = self.remove_ids(ids).postings.withColumnRenamed("id", "_old")
        return self._with(with_ordinal(left, ["_old"], "id").select(*self._columns()))

    def replace_vectors(self, rows: DataFrame) -> "VectorIndex":
        """Remove the given ids and add them with new vectors (cells and codes anew)."""
        return self.remove_ids(rows.select("id")).add_with_ids(rows)

    def update_vectors(self, rows: DataFrame) -> "VectorIndex":
        """Like ``replace_vectors``, but every id must be present."""
        self._require(rows.select("id"))
        return self.replace_vectors(rows)

    def _require(self, ids: DataFrame) -> None:
        missing = ids.join(self.postings.select("id"), "id", "left_anti").limit(1).collect()
        if missing:
            raise KeyError(f"id {missing[0]['id']} is not in the index")

    def reconstruct(self, ids: DataFrame) -> DataFrame:
        """``(id, vector)`` as stored (decoded, in the transformed space); a missing id is an error."""
        self._require(ids)
        wanted = self.postings.join(small_side(ids.select("id").distinct()), "id", "left_semi")
        return self._decoded(wanted).select("id", "vector")

    def _decoded(self, postings: DataFrame, second: bool = True) -> DataFrame:
        if self.codec is None:
            return postings
        if isinstance(self.codec, SignBits):
            raise ValueError("sign bits cannot be decoded")
        rows = self.codec.decode(postings, "codes", "vector")
        if self.second and second:
            rows = self.second.decode(rows, "codes2", "_more").withColumn("vector", arrays.add("vector", "_more")).drop("_more")
        if self.by_residual:
            rows = self._with_centre(rows).withColumn("vector", arrays.add("vector", "_centre")).drop("_centre")
        return rows

    def merge(self, other: "VectorIndex", id_offset: int = 0) -> "VectorIndex":
        """Take over the rows of an index with the same trained model, ids shifted."""
        if other.model_arrow().to_pydict() != self.model_arrow().to_pydict() or not self._same_cells(other):
            raise ValueError("merging needs the same trained model")
        return self._with(self.postings.unionByName(other.postings.withColumn("id", F.col("id") + id_offset)))

    def _same_cells(self, other: "VectorIndex") -> bool:
        """Whether two-level cells have the same children; cells of one level are part of the model."""
        routed = [isinstance(index.coarse, RoutedCells) for index in (self, other)]
        if not any(routed):
            return True
        if not all(routed) or self.nlist != other.nlist:
            return False
        same = self.coarse.children.join(other.coarse.children, ["list_id", "parent", "centre"])
        return same.count() == self.nlist

    def copy_subset(self, selector: Column) -> "VectorIndex":
        return self._with(self.postings.filter(selector))

    def slice_lists(self, low: int, high: int) -> "VectorIndex":
        """The cells low ≤ list_id < high."""
        return self.copy_subset((F.col("list_id") >= low) & (F.col("list_id") < high))

    def stack(self, *others: "VectorIndex") -> "VectorIndex":
        out = self.postings
        for other in others:
            out = out.unionByName(other.postings)
        return self._with(out)

    def list_content(self, list_id: int) -> DataFrame:
        return self.postings.filter(F.col("list_id") == list_id)

    def clone(self) -> "VectorIndex":
        return replace(self)

    def stats(self) -> DataFrame:
        """One row: ntotal, nlist, d, metric, is_trained, code_bytes, encoding."""
        nlist = self.nlist
        # bytes of one stored row
        if self.codec is None:
            size = 8 * self.dim_stored
        elif isinstance(self.codec, SignBits):
            size = -(-self.codec.projection.dim_out // 8)
        else:
            size = codecs.ByteCodec(self.codec).code_size + (codecs.ByteCodec(self.second).code_size if self.second else 0)
        rows = self.postings if self.postings is not None else self.spark.createDataFrame([], "id long")
        return rows.agg(F.count("*").alias("ntotal")).select(
            "ntotal", F.lit(nlist).cast("long").alias("nlist"), F.lit(self.dim).alias("d"), F.lit(self.metric).alias("metric"),
            F.lit(True).alias("is_trained"), F.lit(size).alias("code_bytes"), F.lit(self.encoding).alias("encoding"))

    @property
    def dim_stored(self) -> int:
        dim = self.dim
        for stage in self.transform.stages:
            if isinstance(stage, Linear):
                dim = stage.dim_out
            elif isinstance(stage, Pad):
                dim = stage.dim
            elif isinstance(stage, Remap):
                dim = len(stage.positions)
        return dim

    @property
    def encoding(self) -> str:
        return "Flat" if self.codec is None else type(self.codec).__name__

    # ---------------------------------------------------------------- search

    def _probe(self, queries: DataFrame, nprobe: int) -> DataFrame:
        if isinstance(self.coarse, RoutedCells):
            rows = self.coarse.probe(queries, nprobe, self.metric in ("ip", "cosine"))
        elif self.coarse.m > 1:
            rows = ivf.imi_probe(queries, self.coarse, nprobe)
        else:
            rows = ivf.probe(queries, self.coarse.centroids, nprobe, self.metric)
        return rows.withColumn("list_id", F.col("list_id").cast("long"))

    def search(self, queries: DataFrame, k: int, nprobe: int = 1, k_factor: int = 4, **options) -> DataFrame:
        """``(query_id, rank, id, distance)``, best first."""
        asked = self._prepare(queries)
        kernel = "ip" if self.metric == "cosine" else self.metric
        group = None if self.coarse is None else "list_id"
        if isinstance(self.codec, SignBits):
            coded = self.codec.encode(asked, "vector", "codes").select("query_id", F.col("codes").alias("vector"))
            return search(coded, self.postings, k, "hamming", base_vector="codes", **options)
        if self.second:
            first = replace(self, second=None).search(queries, k * k_factor, nprobe, **options)
            found = self.postings.join(small_side(first.select("id").distinct()), "id", "left_semi")
            return knn.refine(first, asked, self._decoded(found).select("id", "vector"), k, kernel)
        postings = self.postings
        if group:
            asked, postings = self._probed(asked, nprobe)
        if isinstance(self.codec, Codebook) and self.metric == "l2":
            if self.by_residual:
                asked = self._with_centre(asked).withColumn("vector", arrays.subtract("vector", "_centre")).drop("_centre")
            metric = kernels.AsymmetricCode(self.codec.parts)
            return search(asked, postings, k, metric, group=group, base_vector="codes", **options)
        return search(asked, self._decoded(postings), k, kernel, group=group, **options)

    def _probed(self, asked: DataFrame, nprobe: int) -> tuple[DataFrame, DataFrame]:
        """Queries with their cells, and the rows of these cells: only they are read, decoded and compared."""
        asked = materialize(self._probe(asked, nprobe), "probes")
        return asked, ivf.probed_only(asked, self.postings if self.stored is None else self.stored, self.nlist)

    def range_search(self, queries: DataFrame, radius: float, nprobe: int | None = None) -> DataFrame:
        """``(query_id, id, distance)`` of the rows nearer than ``radius``."""
        asked = self._prepare(queries)
        kernel = "ip" if self.metric == "cosine" else self.metric
        group = None
        postings = self.postings
        if self.coarse is not None and nprobe and nprobe < self.nlist:
            group = "list_id"
            asked, postings = self._probed(asked, nprobe)
        return block_join(asked, self._decoded(postings), kernel, radius=radius, group=group)

    def search_deduplicated(self, queries: DataFrame, k: int, members: DataFrame, nprobe: int = 1) -> DataFrame:
        """Search representatives, then name their members ``(rep, id)``."""
        return ivf.expand_members(self.search(queries, k, nprobe), members, k)

    # ----------------------------------------------------------- persistence

    def _parts(self):
        """Trained arrays by component name, and the kinds needed to rebuild them."""
        parts, kinds = {}, {"stages": [], "codec": None}
        for n, stage in enumerate(self.transform.stages):
            name = type(stage).__name__
            entry = {"kind": name}
            if isinstance(stage, Linear):
                parts[f"stage{n}.matrix"] = stage.matrix
                if stage.bias is not None:
                    parts[f"stage{n}.bias"] = np.atleast_2d(stage.bias)
            elif isinstance(stage, Pad):
                entry["dim"] = stage.dim
            elif isinstance(stage, Remap):
                entry["positions"] = list(map(int, stage.positions))
            kinds["stages"].append(entry)
        kinds["routed"] = isinstance(self.coarse, RoutedCells)
        for name, book in (("coarse", self.coarse.parents if kinds["routed"] else self.coarse), ("second", self.second)):
            if book is not None:
                parts.update(_book_parts(name, book))
        codec = self.codec
        if isinstance(codec, Codebook):
            kinds["codec"] = {"kind": "Codebook"}
            parts.update(_book_parts("codec", codec))
        elif isinstance(codec, codecs.ScalarQuantizer):
            kinds["codec"] = {"kind": "ScalarQuantizer", "bits": codec.bits}
            parts["codec.low"], parts["codec.high"] = np.atleast_2d(codec.low), np.atleast_2d(codec.high)
        elif isinstance(codec, codecs.HalfPrecision):
            kinds["codec"] = {"kind": "HalfPrecision", "dim": codec.dim}
        elif isinstance(codec, SignBits):
            kinds["codec"] = {"kind": "SignBits"}
            parts["codec.projection"] = codec.projection.matrix
            if codec.thresholds is not None:
                parts["codec.thresholds"] = np.atleast_2d(codec.thresholds)
        elif isinstance(codec, codecs.ResidualCodec):
            kinds["codec"] = {"kind": "ResidualCodec", "layers": len(codec.layers)}
            for i, book in enumerate(codec.layers):
                parts.update(_book_parts(f"codec.layer{i}", book))
        elif codec is not None:
            raise ValueError(f"cannot store a {type(codec).__name__}")
        return parts, kinds

    def model_arrow(self) -> pa.Table:
        """``(component, i, values)`` rows of the trained model."""
        parts, _ = self._parts()
        rows = [(name, i, row.tolist()) for name, a in sorted(parts.items()) for i, row in enumerate(np.asarray(a, float))]
        columns = list(zip(*rows)) if rows else [[], [], []]
        return pa.table({
            "component": pa.array(columns[0], pa.string()), "i": pa.array(columns[1], pa.int32()),
            "values": pa.array(columns[2], pa.list_(pa.float64()))})

    def _meta(self) -> str:
        _, kinds = self._parts()
        return json.dumps({"dim": self.dim, "metric": self.metric, "spec": self.spec, **kinds})

    def to_bytes(self) -> DataFrame:
        """The trained model as one ``(meta, model)`` row; the postings stay a table."""
        if isinstance(self.coarse, RoutedCells):
            raise ValueError("cells of two levels are a table of their own: use save")
        sink = pa.BufferOutputStream()
        table = self.model_arrow()
        with pa.ipc.new_stream(sink, table.schema) as writer:
            writer.write_table(table)
        row = [(self._meta(), bytearray(sink.getvalue().to_pybytes()))]
        return self.spark.createDataFrame(row, "meta string, model binary")

    @staticmethod
    def from_bytes(row: DataFrame, postings: DataFrame | None = None) -> "VectorIndex":
        found = row.first()
        table = pa.ipc.open_stream(pa.BufferReader(bytes(found["model"]))).read_all()
        return _rebuild(row.sparkSession, found["meta"], table, postings)

    def save(self, path: str) -> "VectorIndex":
        """Write the index to a new folder and return the stored form."""
        model = self.model_arrow()
        self.spark.createDataFrame([(self._meta(),)], "meta string").write.parquet(f"{path}/meta")
        self.spark.createDataFrame(model).coalesce(1).write.parquet(f"{path}/model")
        if isinstance(self.coarse, RoutedCells):
            self.coarse.children.repartitionByRange("parent").write.parquet(f"{path}/cells")
        rows = self.postings if self.postings is not None else self.spark.createDataFrame([], "list_id long, id long, vector array<double>")
        write_stored(rows, path, self.nlist)
        return VectorIndex.load(self.spark, path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> "VectorIndex":
        meta = spark.read.parquet(f"{path}/meta").first()["meta"]
        model = spark.read.parquet(f"{path}/model").toArrow()
        children = spark.read.parquet(f"{path}/cells") if json.loads(meta).get("routed") else None
        postings, stored = read_postings(spark, path)
        return replace(_rebuild(spark, meta, model, postings, children), stored=stored)


def _book_parts(name: str, book: Codebook) -> dict:
    out = {f"{name}.starts": np.atleast_2d(np.array(book.starts, float))}
    out.update({f"{name}.words{m}": w for m, w in enumerate(book.words)})
    return out


def _rebuild(spark, meta: str, model: pa.Table, postings, children: DataFrame | None = None) -> VectorIndex:
    info = json.loads(meta)
    grouped: dict[str, list] = {}
    for row in sorted(model.to_pylist(), key=lambda r: (r["component"], r["i"])):
        grouped.setdefault(row["component"], []).append(row["values"])
    parts = {name: np.array(rows, float) for name, rows in grouped.items()}

    def book(name):
        if f"{name}.starts" not in parts:
            return None
        starts = [int(s) for s in parts[f"{name}.starts"][0]]
        return Codebook(starts, [parts[f"{name}.words{m}"] for m in range(len(starts))])

    stages = []
    for n, entry in enumerate(info["stages"]):
        if entry["kind"] == "Linear":
            bias = parts.get(f"stage{n}.bias")
            stages.append(Linear(parts[f"stage{n}.matrix"], None if bias is None else bias[0]))
        else:
            stages.append({"L2Norm": lambda: L2Norm(), "Pad": lambda: Pad(entry["dim"]),
                           "Remap": lambda: Remap(entry["positions"])}[entry["kind"]]())
    kind = info["codec"] or {}
    codec = None
    if kind.get("kind") == "Codebook":
        codec = book("codec")
    elif kind.get("kind") == "ScalarQuantizer":
        codec = codecs.ScalarQuantizer(kind["bits"], parts["codec.low"][0].tolist(), parts["codec.high"][0].tolist())
    elif kind.get("kind") == "HalfPrecision":
        codec = codecs.HalfPrecision(kind["dim"])
    elif kind.get("kind") == "SignBits":
        cut = parts.get("codec.thresholds")
        codec = SignBits(Linear(parts["codec.projection"]), None if cut is None else cut[0].tolist())
    elif kind.get("kind") == "ResidualCodec":
        codec = codecs.ResidualCodec([book(f"codec.layer{i}") for i in range(kind["layers"])])
    coarse = book("coarse") if children is None else routed_from(book("coarse"), children)
    return VectorIndex(spark, info["dim"], info["metric"], Chain(stages), coarse, codec, book("second"), postings, info["spec"])


# ------------------------------------------------------------------ change log

def _exists(spark: SparkSession, path: str) -> bool:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop)


def _batch_path(path: str, kind: str, stream: str, batch: int) -> str:
    return f"{path}/log/{kind}/stream=s{hashlib.sha256(stream.encode()).hexdigest()[:32]}/batch={batch}"


def _log(rows: DataFrame, path: str, kind: str, stream: str, batch: int) -> None:
    """Write a batch as a folder of its own, unless an earlier run of it has written rows.

    Spark moves a job's files in place when all of it is done, so a run that
    failed is replaced by the next.  ``version`` (the writer's clock) orders
    additions and removals of one id.
    """
    spark, target = rows.sparkSession, _batch_path(path, kind, stream, batch)
    ended = _exists(spark, target) and not _exists(spark, f"{target}/_temporary")
    if not ended or not spark.read.schema("id long").parquet(target).limit(1).count():
        rows.withColumn("version", F.lit(time.time_ns() // 1000).cast("long")).write.mode("overwrite").parquet(target)


def _read_log(spark: SparkSession, path: str, kind: str, schema) -> DataFrame | None:
    root = f"{path}/log/{kind}"
    return spark.read.schema(schema).parquet(root) if _exists(spark, root) else None


def read_postings(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame | None]:
    """Stored postings with the change log applied: a removal drops what was there before it.

    The second table is the postings as they lie on disk, where nothing has
    been added or removed since.
    """
    stored = read_stored(spark, path)
    base = stored.drop(ivf.GROUP)
    columns = base.columns
    base = base.withColumn("version", F.lit(-1).cast("long"))
    added = _read_log(spark, path, "added", base.schema)
    removed = _read_log(spark, path, "removed", "id long, version long")
    if added is None and removed is None:
        return base.select(*columns), stored
    if added is not None:
        base = base.unionByName(added.select(*base.columns))
    if removed is not None:
        # only a removal after the row counts; the last one per id is enough
        last = removed.groupBy("id").agg(F.max("version").alias("gone"))
        base = base.join(last, "id", "left").filter(F.col("gone").isNull() | (F.col("gone") < F.col("version")))
    return base.select(*columns), None


def log_added(index: VectorIndex, path: str, rows: DataFrame, batch: int, stream: str = "") -> None:
    """Append ``(id, vector)`` rows as batch ``batch`` of the writer ``stream``."""
    _log(index.encode(rows), path, "added", stream, batch)


def log_removed(path: str, ids: DataFrame, batch: int, stream: str = "") -> None:
    """Remove ids as batch ``batch`` of the writer ``stream``."""
    _log(ids.select(F.col("id").cast("long")).distinct(), path, "removed", stream, batch)


def compact(index_path: str, new_path: str, spark: SparkSession) -> VectorIndex:
    """Fold the change log into a fresh folder."""
    return VectorIndex.load(spark, index_path).save(new_path)


TABLES = ("meta", "model", "cells", "columns", "log/added", "log/removed", "postings")


def copy_index(spark: SparkSession, path: str, new_path: str) -> VectorIndex:
    """Copy an index, change log included, table by table as Spark jobs, and open the copy.

    Nothing inside names its place.  Folders stay folders, so the copy is laid out alike.
    """
    for name in TABLES:
        if not _exists(spark, f"{path}/{name}"):
            continue
        if name == "postings":
            rows, folders = read_stored(spark, path), [ivf.GROUP]
        else:
            rows = spark.read.parquet(f"{path}/{name}")
            folders = ["stream", "batch"] if name.startswith("log") else []
        rows.write.partitionBy(*folders).parquet(f"{new_path}/{name}")
    return VectorIndex.load(spark, new_path)


# -------------------------------------------------------------------- catalog

@dataclass
class IndexCatalog:
    """Named indexes with their item texts below one folder."""

    spark: SparkSession
    root: str

    def _path(self, name: str, part: str) -> str:
        return f"{self.root.rstrip('/')}/{name}/{part}"

    def _names(self) -> DataFrame:
        schema = "name string, version long, deleted boolean"
        path = f"{self.root.rstrip('/')}/_names"
        return self.spark.read.schema(schema).parquet(path) if _exists(self.spark, path) else self.spark.createDataFrame([], schema)

    def list(self) -> DataFrame:
        """``(name, version)`` of the live indexes."""
        last = self._names().groupBy("name").agg(F.max_by("deleted", "version").alias("deleted"), F.max("version").alias("version"))
        return last.filter(~F.col("deleted")).select("name", "version")

    def _record(self, name: str, version: int, deleted: bool = False) -> None:
        row = self.spark.createDataFrame([(name, version, deleted)], "name string, version long, deleted boolean")
        row.coalesce(1).write.mode("append").parquet(f"{self.root.rstrip('/')}/_names")

    def _version(self, name: str) -> int:
        found = self._names().filter(F.col("name") == name).agg(F.max("version")).first()[0]
        return -1 if found is None else found

    def _live(self, name: str) -> int:
        found = self.list().filter(F.col("name") == name).first()
        if found is None:
            raise KeyError(f"no index named {name!r}")
        return found["version"]

    def create(self, name: str, index: VectorIndex, items: DataFrame) -> None:
        """Store a named index with its items ``(id, text)``."""
        if self.list().filter(F.col("name") == name).limit(1).count():
            raise ValueError(f"an index named {name!r} exists")
        self.save(name, index, items)

    def save(self, name: str, index: VectorIndex, items: DataFrame) -> None:
        version = self._version(name) + 1
        items.select("id", "text").write.parquet(self._path(name, f"v{version}/items"))
        index.save(self._path(name, f"v{version}/index"))
        self._record(name, version)

    def load(self, name: str) -> tuple[VectorIndex, DataFrame]:
        version = self._live(name)
        return (VectorIndex.load(self.spark, self._path(name, f"v{version}/index")),
                self.spark.read.parquet(self._path(name, f"v{version}/items")))

    def add(self, name: str, texts: DataFrame, vectors: DataFrame, ids: DataFrame | None = None) -> None:
        """Add items ``(key, text)`` with vectors ``(key, vector)``.

        Without ``ids`` ``(key, id)`` they go on after the highest stored id.
        """
        index, items = self.load(name)
        if ids is None:
            top = items.agg(F.max("id")).first()[0]
            ids = with_ordinal(texts.select("key"), ["key"], "id", start=0 if top is None else top + 1)
        elif ids.count() != texts.count():
            raise ValueError("as many ids as items are needed")
        named = texts.join(ids, "key").select("id", "text")
        rows = vectors.join(ids, "key").select("id", "vector")
        root = self._path(name, f"v{self._live(name)}")
        # new rows go beside the old ones; nothing stored is written again
        log_added(index, f"{root}/index", rows, time.time_ns(), "catalog")
        named.write.mode("append").parquet(f"{root}/items")

    def delete(self, name: str) -> None:
        self._record(name, self._live(name) + 1, deleted=True)

    def search(self, name: str, queries: DataFrame, k: int, **options) -> DataFrame:
        index, items = self.load(name)
        return knn.attach_attributes(index.search(queries, k, **options), items)
