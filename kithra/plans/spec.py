"""The configuration string of an index, e.g. ``PCAR16,IVF50,SQ8``.

A comma list of: ``IDMap``; transforms ``PCA|PCAR|PCAW|PCAWR n``, ``OPQ m[_d]``,
``RR n``, ``L2norm``, ``ITQ n``, ``Pad n``; cells ``IVF n``, ``IVF nR[parents]``
(cells in two levels, also taken by ``IVF n`` where one level is too large to
share), ``IMI2x bits``; codes ``Flat``, ``PQ m[x bits][+z]``, ``SQ4|SQ6|SQ8|SQfp16``,
``LSH[r][t]``, ``Residual l[x bits]``.  ``BIVF n`` and ``BFlat`` alone index bit
vectors (arrays of packed words).
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field, replace

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import arrays
from ..operators import codecs
from ..operators.binary import BinaryIndex, train_binary_index
from ..operators.codebooks import fit_codebook
from ..operators.index import SignBits, VectorIndex
from ..operators.linear import ITQ, PCA, Chain, L2Norm, Linear, Pad, RandomRotation, column_of, median_thresholds, random_rotation
from ..operators.routing import fit_routed
from ..session import materialize


@dataclass
class OPQ:
    """Stage: the rotation of an optimized product codebook, after PCA to ``dim`` if given."""

    m: int
    dim: int | None = None
    iterations: int = 5

    def fit(self, df, column="vector") -> Linear:
        first = PCA(self.dim).fit(df, column) if self.dim else None
        rows = first.transform(df, column) if first else df
        fitted = codecs.OptimizedProduct(self.m, 16, self.iterations, 1).fit(rows.select("id", F.col(column).alias("vector")))
        return first.then(fitted.rotation) if first else fitted.rotation


@dataclass
class IndexSpec:
    text: str
    stages: list = field(default_factory=list)
    cells: tuple | None = None  # ("IVF", n) | ("IVFR", n, parents) | ("IMI", m, bits)
    code: tuple = ("Flat",)
    second: tuple | None = None

    def needs_training(self) -> bool:
        return bool(self.stages or self.cells) or self.code[0] not in ("Flat", "LSH")


_STAGES = [
    (r"PCA(W?)(R?)(\d+)", lambda m: PCA(int(m[3]), -0.5 if m[1] else 0.0, bool(m[2]))),
    (r"PCA(R)(W)(\d+)", lambda m: PCA(int(m[3]), -0.5, True)),
    (r"OPQ(\d+)(?:_(\d+))?", lambda m: OPQ(int(m[1]), int(m[2]) if m[2] else None)),
    (r"RR(\d+)", lambda m: RandomRotation(int(m[1]))),
    (r"L2[nN]orm", lambda m: L2Norm()),
    (r"ITQ(\d+)", lambda m: ITQ(int(m[1]))),
    (r"Pad(\d+)", lambda m: Pad(int(m[1]))),
]
_CELLS = [
    (r"IVF(\d+)", lambda m: ("IVF", int(m[1]))),
    (r"IVF(\d+)R(\d*)", lambda m: ("IVFR", int(m[1]), int(m[2]) if m[2] else None)),
    (r"IMI(\d+)x(\d+)", lambda m: ("IMI", int(m[1]), int(m[2]))),
]
_CODES = [
    (r"Flat", lambda m: ("Flat",)),
    (r"PQ(\d+)(?:x(\d+))?(?:\+(\d+))?", lambda m: ("PQ", int(m[1]), int(m[2] or 8), int(m[3]) if m[3] else None)),
    (r"SQ(4|6|8)", lambda m: ("SQ", int(m[1]))),
    (r"SQfp16", lambda m: ("FP16",)),
    (r"LSH(r?)(t?)", lambda m: ("LSH", bool(m[1]), bool(m[2]))),
    (r"Residual(\d+)(?:x(\d+))?", lambda m: ("Residual", int(m[1]), int(m[2] or 8))),
]


def _match(rules, word):
    for pattern, make in rules:
        found = re.fullmatch(pattern, word)
        if found:
            return make(found)
    return None


def parse_spec(text: str) -> IndexSpec:
    spec = IndexSpec(text)
    words = [w.strip() for w in text.split(",") if w.strip()]
    if words and words[0] == "IDMap":
        words = words[1:]  # ids are always explicit here
    coded = False
    for word in words:
        stage, cells, code = _match(_STAGES, word), _match(_CELLS, word), _match(_CODES, word)
        if cells and spec.cells is None and not coded:
            spec.cells = cells
        elif code and not coded:
            spec.code, coded = code, True
        elif stage and spec.cells is None and not coded:
            spec.stages.append(stage)
        else:
            raise ValueError(f"cannot read {word!r} in {text!r}")
    return spec


SHARED_CELLS_BYTES = 64 << 20  # cells of one level up to this size are shared with every task


def train_index(text: str, train: DataFrame, metric: str = "l2", iterations: int = 10, seed: int = 0, init="hash") -> VectorIndex | BinaryIndex:
    """Train an empty index described by ``text`` on ``(id, vector)`` rows."""
    if re.fullmatch(r"BIVF\d+|BFlat", text):
        return train_binary_index(text, train, iterations, init, seed)
    spec = parse_spec(text)
    spark = train.sparkSession
    rows = train.select("id", arrays.doubles("vector").alias("vector")).filter(F.col("vector").isNotNull())
    dim = rows.select(F.size("vector")).first()[0]
    index = VectorIndex(spark, dim, metric, spec=text)
    if metric == "cosine":
        rows = rows.withColumn("vector", arrays.l2_normalize("vector"))
    if spec.stages:
        index = replace(index, transform=Chain(spec.stages).fit(rows))
        rows = materialize(index.transform.transform(rows), "train")
    inner = index.dim_stored
    if spec.cells and (spec.cells[0] == "IVFR" or spec.cells[0] == "IVF" and 8 * inner * spec.cells[1] > SHARED_CELLS_BYTES):
        parents = spec.cells[2] if spec.cells[0] == "IVFR" else None
        index = replace(index, coarse=fit_routed(rows, spec.cells[1], parents, iterations, iterations, seed))
    elif spec.cells and spec.cells[0] == "IVF":
        index = replace(index, coarse=fit_codebook(rows, 1, spec.cells[1], iterations, init, seed))
    elif spec.cells and spec.cells[0] == "IMI":
        index = replace(index, coarse=fit_codebook(rows, spec.cells[1], 1 << spec.cells[2], iterations, init, seed))
    kind = spec.code
    if kind[0] == "LSH":
        bits = inner
        projection = random_rotation(inner, bits, seed) if kind[1] else Linear(np.eye(inner))
        cut = None
        if kind[2]:
            cut = column_of(median_thresholds(projection.transform(rows)), "threshold").tolist()
        return replace(index, codec=SignBits(projection, cut))
    if kind[0] == "Flat":
        return index
    if index.coarse is not None:
        found = index._with_centre(index._cells(rows))
        rows = materialize(found.select("id", arrays.subtract("vector", "_centre").alias("vector")), "train")
    if kind[0] == "SQ":
        codec = codecs.ScalarQuantizer(kind[1]).fit(rows)
    elif kind[0] == "FP16":
        codec = codecs.HalfPrecision(inner)
    elif kind[0] == "PQ":
        codec = fit_codebook(rows, kind[1], 1 << kind[2], iterations, init, seed)
    else:
        codec = codecs.ResidualQuantizer(kind[1], 1, 1 << kind[2], iterations, init, seed).fit(rows)
    index = replace(index, codec=codec)
    if kind[0] == "PQ" and kind[3]:
        known = codec.compress(rows.withColumn("_known", F.col("vector")), "_known")
        rest = known.select("id", arrays.subtract("vector", "_known").alias("vector"))
        index = replace(index, second=fit_codebook(rest, kind[3], 1 << kind[2], iterations, init, seed + 1))
    return index
