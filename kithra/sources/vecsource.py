"""Vector files as a Spark data source: ``spark.read.format("fvecs").load(path)``.

Formats ``fvecs``, ``ivecs`` and ``bvecs`` (see ``vecs``).  A file is cut into
byte ranges at record borders, each one partition that reads its range alone
and hands on Arrow batches.  The writer makes one draft file per task and moves
the drafts in place when all tasks have ended, so that a failed job leaves
nothing to read.

Paths go through ``pyarrow.fs``, which knows local and shared folders and the
common object stores; ``vecs.read_vecs`` falls back to Spark's own readers for
others.
"""

from __future__ import annotations

import posixpath
import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

# fixed values: bytes per component and NumPy type of each format
FORMATS = {"fvecs": (4, "<f4"), "ivecs": (4, "<i4"), "bvecs": (1, "u1")}
SPLIT_BYTES = 64 << 20  # bytes of a partition, about
BATCH_BYTES = 4 << 20  # bytes of an Arrow batch, about


def file_system(path: str):
    """``(system, path inside it)``; an error for schemes that pyarrow does not know."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if ":/" in path else (fs.LocalFileSystem(), path)


def vector_files(path: str, fmt: str) -> list[tuple[str, int]]:
    """(file, size) of a file, or of a folder's files that are no drafts, in order of name."""
    from pyarrow import fs

    system, root = file_system(path)
    info = system.get_file_info(root)
    if info.type == fs.FileType.NotFound:
        raise FileNotFoundError(path)
    if info.type == fs.FileType.File:
        return [(info.path, info.size)]
    found = [f for f in system.get_file_info(fs.FileSelector(root)) if f.type == fs.FileType.File]
    return sorted((f.path, f.size) for f in found if not f.base_name.startswith(("_", ".")) and f.size)


@dataclass
class Range(InputPartition):
    """Records ``first`` … ``first + count`` of a file; ``start`` is the id of the first."""

    file: str
    first: int
    count: int
    start: int
    dim: int


class VectorReader(DataSourceReader):
    def __init__(self, fmt: str, options):
        self.fmt, self.path = fmt, options["path"]
        self.split = int(options.get("splitbytes", SPLIT_BYTES))

    def partitions(self):
        system, _ = file_system(self.path)
        width, _ = FORMATS[self.fmt]
        out, start, known = [], 0, None
        for file, size in vector_files(self.path, self.fmt):
            with system.open_input_file(file) as source:
                head = source.read(4)
            dim = int(np.frombuffer(head, "<i4")[0]) if len(head) == 4 else 0
            length = 4 + width * dim
            if dim <= 0 or size % length:
                raise ValueError(f"{file} is no {self.fmt} file: {size} bytes, dimension {dim}")
            if known is not None and dim != known:
                raise ValueError(f"{file} has dimension {dim}, others {known}")
            known = dim
            records, step = size // length, max(1, self.split // length)
            out += [Range(file, low, min(step, records - low), start + low, dim) for low in range(0, records, step)]
            start += records
        if not out:
            raise ValueError(f"{self.path} holds no vectors")
        return out

    def read(self, part: Range):
        system, _ = file_system(self.path)
        width, dtype = FORMATS[self.fmt]
        length = 4 + width * part.dim
        step = max(1, BATCH_BYTES // length)
        kind = np.int32 if self.fmt == "ivecs" else np.float32
        with system.open_input_file(part.file) as source:
            for low in range(0, part.count, step):
                n = min(step, part.count - low)
                raw = np.frombuffer(source.read_at(n * length, (part.first + low) * length), np.uint8).reshape(n, length)
                if (np.ascontiguousarray(raw[:, :4]).view("<i4")[:, 0] != part.dim).any():
                    raise ValueError(f"{part.file} has records of different dimension")
                values = np.ascontiguousarray(raw[:, 4:]).view(dtype).astype(kind)
                lists = pa.ListArray.from_arrays(
                    pa.array(np.arange(0, n * part.dim + 1, part.dim, dtype=np.int32)), pa.array(values.reshape(-1)))
                ids = pa.array(np.arange(part.start + low, part.start + low + n), pa.int64())
                yield pa.RecordBatch.from_arrays([ids, lists], ["id", "vector"])


@dataclass
class Written(WriterCommitMessage):
    draft: str
    name: str
    rows: int


class VectorWriter(DataSourceArrowWriter):
    def __init__(self, fmt: str, options, overwrite: bool):
        self.fmt, self.path, self.overwrite = fmt, options["path"], overwrite
        self.job = uuid.uuid4().hex

    def write(self, iterator):
        system, root = file_system(self.path)
        system.create_dir(root, recursive=True)
        context = TaskContext.get()
        name = f"part-{context.partitionId():06d}-{self.job}.{self.fmt}"
        draft = posixpath.join(root, f"_{name}.{context.taskAttemptId()}")
        _, dtype = FORMATS[self.fmt]
        rows = 0
        with system.open_output_stream(draft) as sink:
            for batch in iterator:
                vectors = batch.column(batch.schema.get_field_index("vector"))
                if not len(vectors):
                    continue
                sizes = np.diff(vectors.offsets.to_numpy())
                if vectors.null_count or sizes.min() != sizes.max() or not sizes[0]:
                    raise ValueError("vectors of one file must share one dimension and be non-null")
                x = vectors.flatten().to_numpy(zero_copy_only=False).astype(dtype).reshape(len(sizes), -1)
                head = np.full((len(x), 1), x.shape[1], "<i4").view(np.uint8).reshape(len(x), 4)
                body = np.ascontiguousarray(x).view(np.uint8).reshape(len(x), -1)
                sink.write(np.hstack([head, body]).tobytes())
                rows += len(x)
        return Written(draft, posixpath.join(root, name), rows)

    def commit(self, messages):
        """All tasks have ended: files that were there go if told so, and the drafts take their names."""
        system, root = file_system(self.path)
        before = [f for f, _ in vector_files(self.path, self.fmt)] if self.overwrite else []
        for message in messages:
            if message is None:
                continue
            if message.rows:
                system.move(message.draft, message.name)
            else:
                system.delete_file(message.draft)
        for file in before:
            system.delete_file(file)

    def abort(self, messages):
        """The job has failed: drafts go, what was there before stays."""
        from pyarrow import fs

        system, root = file_system(self.path)
        if system.get_file_info(root).type == fs.FileType.Directory:
            for info in system.get_file_info(fs.FileSelector(root)):
                if info.base_name.startswith("_part-") and self.job in info.base_name:
                    system.delete_file(info.path)


class VectorSource(DataSource):
    FMT = "fvecs"

    @classmethod
    def name(cls):
        return cls.FMT

    def schema(self):
        return "id long, vector array<int>" if self.FMT == "ivecs" else "id long, vector array<float>"

    def reader(self, schema):
        return VectorReader(self.FMT, self.options)

    def writer(self, schema, overwrite):
        return VectorWriter(self.FMT, self.options, overwrite)


class Fvecs(VectorSource):
    FMT = "fvecs"


class Ivecs(VectorSource):
    FMT = "ivecs"


class Bvecs(VectorSource):
    FMT = "bvecs"


def register(spark: SparkSession) -> None:
    """Make the three formats known to this session."""
    for source in (Fvecs, Ivecs, Bvecs):
        spark.dataSource.register(source)
