"""Vector maps and product codes as ``pyspark.ml`` stages.

They chain in a ``Pipeline`` with any other stage and are saved with it:
parameters with the stage's metadata, what was learned as a Parquet table
beside it.  Input columns hold arrays of numbers of one length.
"""

from __future__ import annotations

import numpy as np
from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasOutputCol, HasSeed
from pyspark.ml.util import (
    DefaultParamsReadable,
    DefaultParamsReader,
    DefaultParamsWritable,
    DefaultParamsWriter,
    MLReadable,
    MLReader,
    MLWritable,
    MLWriter,
)
from pyspark.sql import DataFrame

from ..functions import arrays
from . import linear
from .codebooks import Codebook
from .codecs import ProductQuantizer

#: kind of a trained map → its training, given the stage
TRAINING = {
    "pca": lambda s, df, column: linear.PCA(s.getOrDefault("dim"), s.getOrDefault("power")).fit(df, column),
    "itq": lambda s, df, column: linear.ITQ(s.getOrDefault("dim"), seed=s.getSeed()).fit(df, column),
    "rotation": lambda s, df, column: linear.RandomRotation(s.getOrDefault("dim"), s.getSeed()).fit(df, column),
    "projection": lambda s, df, column: linear.random_projection(len(df.select(column).first()[0]), s.getOrDefault("dim"), s.getSeed()),
    "whiten": lambda s, df, column: linear.MahalanobisWhiten().fit(df, column),
}


class _Columns(HasInputCol, HasOutputCol):
    """Input and output column; "vector" and "vector" unless they are set."""

    def _columns(self, output: str = "vector"):
        self._setDefault(inputCol="vector", outputCol=output)


class UnitLength(Transformer, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """Scales every vector to length 1."""

    @keyword_only
    def __init__(self, *, inputCol="vector", outputCol="vector"):
        super().__init__()
        self._columns()
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.withColumn(self.getOutputCol(), arrays.l2_normalize(self.getInputCol()))


# ------------------------------------------------------------------ what was learned

class _TableWriter(MLWriter):
    def __init__(self, stage):
        super().__init__()
        self.stage = stage

    def saveImpl(self, path: str) -> None:
        # the table first: a folder with metadata is complete
        self.stage._table(self.sparkSession).write.parquet(f"{path}/data")
        DefaultParamsWriter.saveMetadata(self.stage, path, self.sparkSession)


class _TableReader(MLReader):
    def __init__(self, kind):
        super().__init__()
        self.kind = kind

    def load(self, path: str):
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        stage = self.kind()
        stage._learn(self.sparkSession.read.parquet(f"{path}/data"))
        stage._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(stage, metadata)
        return stage


class _Learned(Model, _Columns, MLWritable, MLReadable):
    """A model kept as one table: ``_table(spark)`` gives it, ``_learn(df)`` takes it."""

    def write(self) -> MLWriter:
        return _TableWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _TableReader(cls)


class LinearModel(_Learned):
    """vector · matrix + bias."""

    def __init__(self, matrix=None, bias=None):
        super().__init__()
        self._columns()
        self.map = None if matrix is None else linear.Linear(np.asarray(matrix, float), None if bias is None else np.asarray(bias, float))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return linear.apply_linear(dataset, self.map.matrix, self.map.bias, self.getInputCol(), self.getOutputCol())

    def _table(self, spark) -> DataFrame:
        rows = [(i, row.tolist()) for i, row in enumerate(self.map.matrix)]
        if self.map.bias is not None:
            rows.append((-1, np.asarray(self.map.bias, float).tolist()))
        return spark.createDataFrame(rows, "component int, weights array<double>")

    def _learn(self, table: DataFrame) -> None:
        rows = {r["component"]: r["weights"] for r in table.collect()}
        bias = rows.pop(-1, None)
        self.map = linear.Linear(np.array([rows[i] for i in sorted(rows)]), None if bias is None else np.array(bias))


class LinearFit(Estimator, _Columns, HasSeed, DefaultParamsReadable, DefaultParamsWritable):
    """Learns a linear map: ``kind`` is one of ``TRAINING``, ``dim`` its number of outputs ("whiten" keeps all).

    ``power`` multiplies principal components by their eigenvalue to that power.
    """

    kind = Param(Params._dummy(), "kind", "which map is learned", TypeConverters.toString)
    dim = Param(Params._dummy(), "dim", "components of the output", TypeConverters.toInt)
    power = Param(Params._dummy(), "power", "power of the eigenvalues", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, inputCol="vector", outputCol="vector", kind="pca", dim=None, power=0.0, seed=0):
        super().__init__()
        self._columns()
        self._setDefault(kind="pca", power=0.0, seed=0)
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> LinearModel:
        kind = self.getOrDefault("kind")
        if kind not in TRAINING:
            raise ValueError(f"kind must be one of {', '.join(TRAINING)}")
        if kind != "whiten" and not self.isDefined("dim"):
            raise ValueError(f"{kind} needs dim")
        found = TRAINING[kind](self, dataset, self.getInputCol())
        return self._copyValues(LinearModel(found.matrix, found.bias))


class ProductModel(_Learned):
    """Product codes; ``decode`` gives the vectors that they stand for."""

    def __init__(self, book: Codebook | None = None):
        super().__init__()
        self._columns("codes")
        self.book = book

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return self.book.encode(dataset, self.getInputCol(), self.getOutputCol())

    def decode(self, dataset: DataFrame, outputCol: str = "decoded") -> DataFrame:
        return self.book.decode(dataset, self.getOutputCol(), outputCol)

    def _table(self, spark) -> DataFrame:
        return self.book.to_rows(spark)

    def _learn(self, table: DataFrame) -> None:
        self.book = Codebook.from_rows(table)


class ProductFit(Estimator, _Columns, HasSeed, DefaultParamsReadable, DefaultParamsWritable):
    """Learns ``m`` codebooks of ``ks`` words; the starting words are chosen by a hash of ``idCol``."""

    m = Param(Params._dummy(), "m", "sub-spaces", TypeConverters.toInt)
    ks = Param(Params._dummy(), "ks", "codewords of a sub-space", TypeConverters.toInt)
    iterations = Param(Params._dummy(), "iterations", "rounds of training", TypeConverters.toInt)
    idCol = Param(Params._dummy(), "idCol", "column of the ids", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, inputCol="vector", outputCol="codes", idCol="id", m=8, ks=256, iterations=20, seed=0):
        super().__init__()
        self._columns("codes")
        self._setDefault(idCol="id", m=8, ks=256, iterations=20, seed=0)
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> ProductModel:
        codec = ProductQuantizer(self.getOrDefault("m"), self.getOrDefault("ks"), self.getOrDefault("iterations"), seed=self.getSeed())
        return self._copyValues(ProductModel(codec.fit(dataset, self.getInputCol(), self.getOrDefault("idCol"))))
