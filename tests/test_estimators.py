"""The ``pyspark.ml`` estimators: grids, persistence, typed classes, warm start, sparse vectors, importances."""

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.linalg import Vectors
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import functions as F

from grove.plans.estimator import ForestClassificationModel, ForestClassifier, ForestRegressionModel, ForestRegressor

OPTIONS = {"max_leaf": 6, "opt_interval": 6, "min_samples_leaf": 5}


@pytest.fixture(scope="module")
def table(spark):
    x = np.random.default_rng(2).uniform(0, 1, (150, 3)).round(2)
    rows = [(Vectors.dense(v), float(v[0] * 3 + v[1]), int(v[1] > 0.5) * 10, int(v[0] * 3)) for v in x]
    return spark.createDataFrame(rows, ["features", "y", "two", "three"]).cache()


def test_regressor_is_written_and_read(spark, table, tmp_path):
    model = Pipeline(stages=[ForestRegressor(labelCol="y", options=OPTIONS)]).fit(table)
    model.write().save(f"{tmp_path}/m")
    back = PipelineModel.load(f"{tmp_path}/m")
    assert isinstance(back.stages[0], ForestRegressionModel)
    a, b = ([r["prediction"] for r in m.transform(table).collect()] for m in (model, back))
    assert a == b and back.stages[0].getOrDefault("options") == OPTIONS
    assert model.stages[0].score(table) > 0.8


@pytest.mark.parametrize("label", ["two", "three"])
def test_classes_keep_their_type(spark, table, tmp_path, label):
    model = ForestClassifier(labelCol=label, options={**OPTIONS, "n_iter": 2}).fit(table)
    model.save(f"{tmp_path}/m")
    back = ForestClassificationModel.load(f"{tmp_path}/m")
    assert back.classes == model.classes and all(isinstance(c, int) for c in back.classes)
    rows = back.transform(table).select("prediction", "probability", label).collect()
    assert rows == model.transform(table).select("prediction", "probability", label).collect()
    assert all(isinstance(r["prediction"], int) for r in rows) and back.score(table) > 0.85


def test_grid_over_single_parameters(spark, table):
    forest = ForestRegressor(labelCol="y", options=OPTIONS)
    grid = ParamGridBuilder().addGrid(forest.l2, [0.01, 5.0]).addGrid(forest.max_leaf, [2, 6]).build()
    assert [forest.copy(p)._config().max_leaf for p in grid] == [2, 6, 2, 6]
    best = CrossValidator(estimator=forest, estimatorParamMaps=grid[:2], evaluator=RegressionEvaluator(labelCol="y"), numFolds=2, seed=1).fit(table)
    assert best.bestModel.forest.n_leaves > 2
    with pytest.raises(ValueError):
        forest.copy({forest.n_estimators: 3})._config()


def test_warm_start(spark, table):
    first = ForestRegressor(labelCol="y", options=OPTIONS).fit(table)
    more = ForestRegressor(labelCol="y", options={**OPTIONS, "max_leaf": 12}).setInitModel(first).fit(table)
    assert more.forest.n_leaves > first.forest.n_leaves and more.score(table) >= first.score(table) - 1e-9
    small = ForestClassifier(labelCol="three", options={**OPTIONS, "n_iter": 1}).fit(table)
    large = ForestClassifier(labelCol="three", options={**OPTIONS, "n_iter": 1, "max_leaf": 10}).setInitModel(small).fit(table)
    assert all(b.n_leaves > a.n_leaves for a, b in zip(small.forests, large.forests))


def test_sparse_vectors_become_maps(spark):
    rng = np.random.default_rng(5)
    rows = []
    for _ in range(120):
        held = sorted(rng.choice(1000, 2, replace=False).tolist() + [2000 + int(rng.integers(2))])
        rows.append((Vectors.sparse(5000, held, [1.0] * 3), float(2001 in held)))
    df = spark.createDataFrame(rows, ["features", "y"])
    model = ForestRegressor(labelCol="y", options={**OPTIONS, "max_leaf": 4}).fit(df)
    assert model.sparse_features and model.score(df) > 0.9
    assert int(np.argmax(model.feature_importances)) in (2000, 2001)
    assert abs(model.feature_importances.sum() - 1) < 1e-9


def test_importances(spark, table):
    got = ForestRegressor(labelCol="y", options=OPTIONS).fit(table).feature_importances
    assert len(got) == 3 and got[0] > got[2] and abs(got.sum() - 1) < 1e-9
    assert table.where(F.col("y") < 0).count() == 0
