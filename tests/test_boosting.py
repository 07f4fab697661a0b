"""Trees grown side by side are those that ``pyspark.ml`` grows one by one."""

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier, OneVsRest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from obsloom.operators import boosting as B
from obsloom.operators import training as TR
from obsloom.session import work_path


@pytest.fixture(scope="module")
def vectors(spark):
    draw = np.random.default_rng(7)
    a, b, c, noise = draw.normal(size=(4, 600))
    labels = np.clip(np.floor(a + b * c + noise), -1, 1) + 1
    rows = [tuple(float(v) for v in row) for row in zip(labels, 1 + draw.random(600), a, b, c)]
    df = spark.createDataFrame(rows, "label double, weight double, a double, b double, c double")
    wide = VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(df)
    return wide.select("label", "weight", "features").repartition(1).cache()


def plain(rounds, depth):
    single = GBTClassifier(maxIter=rounds, stepSize=0.1, maxDepth=depth, seed=42)
    return OneVsRest(classifier=single, weightCol="weight")


def shape(model):
    """A tree's cuts, and what its ends give."""
    lines = model.toDebugString.split("\n")[1:]
    ends = [float(line.split()[-1]) for line in lines if "Predict" in line]
    return [line for line in lines if "Predict" not in line], ends


def assert_alike(models, expected):
    assert len(models) == len(expected)
    for one, other in zip(models, expected):
        assert one.treeWeights == other.treeWeights and len(one.trees) == len(other.trees)
        for a, b in zip(one.trees, other.trees):
            (cuts, ends), (cuts_b, ends_b) = shape(a), shape(b)
            assert cuts == cuts_b and np.allclose(ends, ends_b, rtol=1e-9)


def test_boosted_classes_are_those_of_one_fit_after_the_other(vectors):
    expected = plain(6, 3).fit(vectors)
    found = TR.boosted_trees(6, 0.1, 3, classes=3).setLabelCol("label").fit(vectors)
    assert_alike(found.models, expected.models)
    rows = [[r["prediction"] for r in m.transform(vectors).select("prediction").collect()] for m in (found, expected)]
    assert rows[0] == rows[1]
    assert np.allclose(found.models[0].featureImportances.toArray(), expected.models[0].featureImportances.toArray())


def test_two_classes_are_one_ensemble_that_can_be_saved(spark, vectors):
    two = vectors.withColumn("label", (F.col("label") > 0).cast("double")).cache()
    expected = GBTClassifier(maxIter=5, stepSize=0.1, maxDepth=2, seed=42, weightCol="weight").fit(two)
    found = TR.boosted_trees(5, 0.1, 2).setLabelCol("label").fit(two)
    assert_alike([found], [expected])
    path = work_path(spark, "boosted")
    found.write().save(path)
    assert_alike([GBTClassificationModel.load(path)], [expected])
    with pytest.raises(Exception, match="(?i)label"):
        TR.boosted_trees(2, 0.1, 2).setLabelCol("label").fit(vectors)


@pytest.mark.parametrize("here", [10, 1 << 18])
def test_larger_tables_give_the_same_trees(monkeypatch, vectors, here):
    """Rows of several blocks and partitions, in the tasks or in passes, with margins kept and taken anew on the way."""
    for name, value in {"BLOCK": 100, "HERE": here, "KEPT": 2, "ANEW": 4, "SENT": 1 << 15}.items():
        monkeypatch.setattr(B, name, value)
    settings = [(7, 3), (5, 2)]
    made = [TR.boosted_trees(n, 0.1, d, classes=3).setLabelCol("label") for n, d in settings]
    found = B.grow_together(made, vectors.repartition(3), told=True)
    for grown, setting, estimator in zip(found, settings, made):
        expected = plain(*setting).fit(vectors).models
        models = [B.as_model(vectors.sparkSession, grown, e, B._single(estimator)) for e in grown.ensembles]
        assert_alike(models, expected)
        tree, other = models[0].trees[-1]._java_obj.rootNode(), expected[0].trees[-1]._java_obj.rootNode()
        assert np.isclose(tree.impurity(), other.impurity()) and tree.impurityStats().rawCount() == 600
    scored = B.predictions(vectors, "features", ["label"], [(found[0], 7), (found[0], 3)]).collect()
    expected = plain(3, 3).fit(vectors).transform(vectors).select("prediction").collect()
    assert [r["p1"] for r in scored] == [r["prediction"] for r in expected] and len({r["p0"] for r in scored}) > 1


def test_other_settings_are_left_to_spark(vectors):
    usual = TR.boosted_trees(2, 0.1, 2, classes=3).setLabelCol("label")
    other = TR.boosted_trees(2, 0.1, 2, classes=3).setLabelCol("label")
    other.getClassifier().setMinInstancesPerNode(250)
    assert B.alike(usual, vectors) and B.alike(other, vectors) is None
    assert all(tree.numNodes <= 3 for m in other.fit(vectors).models for tree in m.trees)
