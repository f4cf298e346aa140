"""The sparse fits against MLlib's own, and against plain arithmetic."""

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier, MultilayerPerceptronClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from slawatch.operators import risk_model
from slawatch.operators import sparse_fit as S


@pytest.fixture(scope="module")
def rows(spark):
    """Sparse and dense vectors; a column of many values, some below zero."""
    rnd, out = np.random.default_rng(7), []
    for i in range(1200):
        x = np.where(rnd.random(9) < 0.3, rnd.integers(1, 4, 9), 0).astype(float)
        x[8] = round(float(rnd.normal()), 2)
        p = 1 / (1 + np.exp(-(x[0] - 2 * x[1] * (x[2] > 0) + 1.5 * (x[8] > 0.2) - 0.3)))
        dense = Vectors.dense(x)
        at = np.flatnonzero(x).tolist()
        out.append((float(rnd.random() < p), dense if i % 3 == 0 else Vectors.sparse(9, at, x[at].tolist())))
    return spark.createDataFrame(out, ["label", "features"]).repartition(3).cache()


def _p(model, rows):
    got = model.transform(rows).select("label", "features", vector_to_array("probability").getItem(1).alias("p"))
    return got.toPandas().assign(k=lambda d: d.features.map(lambda v: tuple(v.toArray()))).sort_values(["k", "label"]).p.to_numpy()


def test_trees_equal_mllibs(spark, rows, tmp_path):
    params = dict(maxIter=6, maxDepth=4, seed=1)
    want, got = GBTClassifier(**params).fit(rows), S.BoostedTrees(**params).fit(rows)
    assert np.abs(_p(want, rows) - _p(got, rows)).max() < 1e-9
    assert got.treeWeights == want.treeWeights and got.numFeatures == 9
    for a, b in zip(got.trees, want.trees):
        assert a.numNodes == b.numNodes and a.depth == b.depth
    # Impurities of all nodes, the leaves' too.
    lines = [[x for x in t._java_obj.rootNode().impurityStats().stats()] for t in (got.trees[0], want.trees[0])]
    assert np.allclose(*lines)
    got.write().overwrite().save(str(tmp_path / "m"))
    assert np.abs(_p(type(got).load(str(tmp_path / "m")), rows) - _p(got, rows)).max() == 0


def test_trees_of_one_class(spark, rows):
    one = rows.withColumn("label", F.lit(1.0))
    assert (_p(S.BoostedTrees(maxIter=3).fit(one), one) > 0.5).all()


def test_net_fits_as_well_as_mllibs(spark, rows, tmp_path):
    params = dict(layers=[9, 5, 2], maxIter=60, seed=3)
    want, got = MultilayerPerceptronClassifier(**params).fit(rows), S.NeuralNet(**params).fit(rows)
    y = np.array([r.label for r in rows.select("label", "features").collect()])
    packed = S._packed(rows, "features", "label")
    loss = {k: S._loss(packed, (9, 5, 2), m.weights.toArray())[0] for k, m in (("want", want), ("got", got))}
    assert loss["got"] <= loss["want"] + 0.01 < np.log(2) and len(y) == 1200
    # The loss is that of MLlib's own probabilities for these weights.
    p = got.transform(rows).select("label", vector_to_array("probability").alias("p")).collect()
    assert abs(-np.mean([np.log(r.p[int(r.label)]) for r in p]) - loss["got"]) < 1e-5
    got.write().overwrite().save(str(tmp_path / "m"))
    assert type(got).load(str(tmp_path / "m")).weights == got.weights


def test_slope_of_the_net(spark, rows):
    packed, layers = S._packed(rows, "features", "label"), (9, 5, 2)
    w = np.random.default_rng(1).normal(size=9 * 5 + 5 + 10 + 2) / 2
    _, slope = S._loss(packed, layers, w)
    for i in (0, 17, 44, 47, 52, 60, 61):
        e = np.zeros(len(w))
        e[i] = 1e-2
        assert abs((S._loss(packed, layers, w + e)[0] - S._loss(packed, layers, w - e)[0]) / 2e-2 - slope[i]) < 2e-4


def test_rows_stay_sparse(spark):
    """What a fit keeps of a row is its entries, not its width."""
    wide = 200_000
    rows = spark.createDataFrame([(float(i % 2), Vectors.sparse(wide, [i, 100_000 + i % 2], [1.0, 2.0])) for i in range(300)], ["label", "features"])
    packed = S._packed(rows, "features", "label")
    held = packed.select(F.sum(sum(F.length(c) for c in packed.columns)).alias("n")).first().n
    assert held < 300 * 100
    model = S.BoostedTrees(maxIter=2, maxDepth=2).fit(rows)
    assert (model.transform(rows).filter("prediction <> label").count()) == 0


def test_the_models_are_fitted_over_sparse_rows():
    kinds = risk_model._classifiers(10, 1)
    assert isinstance(kinds["boosted_trees"], S.BoostedTrees) and isinstance(kinds["neural_net"], S.NeuralNet)
