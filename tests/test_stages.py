"""Stages of pyspark.ml: fit, save, load."""

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel

from kithra.operators import linear, stages


@pytest.fixture
def rows(spark):
    x = np.random.default_rng(4).normal(size=(300, 12)) * np.arange(1, 13) + 3
    return spark.createDataFrame([(i, v.tolist(), "kept") for i, v in enumerate(x)], "id long, vector array<double>, note string").repartition(3)


def table(df, column="vector"):
    return np.array([r[column] for r in df.select("id", column).orderBy("id").collect()])


@pytest.mark.parametrize("kind, dim", [("pca", 3), ("itq", 4), ("rotation", 12), ("projection", 20), ("whiten", None)])
def test_maps_are_saved_with_their_pipeline(rows, tmp_path, kind, dim):
    fit = stages.LinearFit(kind=kind, inputCol="unit", outputCol="out", seed=3, **({} if dim is None else {"dim": dim}))
    model = Pipeline(stages=[stages.UnitLength(outputCol="unit"), fit]).fit(rows)
    model.write().save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m"))
    got = again.transform(rows)
    assert got.columns == ["id", "vector", "note", "unit", "out"]
    assert np.array_equal(table(got, "out"), table(model.transform(rows), "out"))
    assert [s.uid for s in again.stages] == [s.uid for s in model.stages]
    assert table(got, "out").shape == (300, dim or 12)


def test_chain_of_unit_pca_unit(rows, tmp_path):
    plan = Pipeline(stages=[stages.UnitLength(), stages.LinearFit(dim=2), stages.UnitLength()])
    found = table(plan.fit(rows).transform(rows))
    x = table(rows)
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    _, _, axes = np.linalg.svd(x - x.mean(0), full_matrices=False)
    want = (x - x.mean(0)) @ axes[:2].T
    want /= np.linalg.norm(want, axis=1, keepdims=True)
    assert np.allclose(np.abs(found), np.abs(want), atol=1e-7)
    chain = linear.Chain([linear.L2Norm(), linear.PCA(2), linear.L2Norm()]).fit(rows)
    assert np.allclose(found, table(chain.transform(rows)), atol=1e-9)
    plan.write().save(str(tmp_path / "p"))
    assert np.allclose(table(Pipeline.load(str(tmp_path / "p")).fit(rows).transform(rows)), found, atol=1e-9)


def test_product_codes(rows, tmp_path):
    model = stages.ProductFit(m=3, ks=8, iterations=3).fit(rows)
    path = str(tmp_path / "q")
    model.save(path)
    with pytest.raises(Exception):
        model.save(path)  # nothing is overwritten unasked
    model.write().overwrite().save(path)
    again = stages.ProductModel.load(path)
    codes = again.transform(rows)
    assert np.array_equal(table(codes, "codes"), table(model.transform(rows), "codes"))
    assert np.array_equal(table(again.decode(codes), "decoded"), table(model.decode(codes), "decoded"))
    other = model.copy({model.outputCol: "short"}).transform(rows)
    assert np.array_equal(table(other, "short"), table(codes, "codes"))


def test_what_is_missing_is_said(rows):
    with pytest.raises(ValueError, match="kind"):
        stages.LinearFit(kind="other", dim=2).fit(rows)
    with pytest.raises(ValueError, match="dim"):
        stages.LinearFit(kind="pca").fit(rows)
