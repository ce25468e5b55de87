"""``pyspark.ml`` estimators: forests in pipelines and cross-validators, with single parameters and persistence.

Every training parameter of the two engines is a ``Param`` of its own name, so grids can vary it; ``options`` sets several at
once, and single ones win. Models are written as two Parquet tables of nodes and facts, with typed class labels beside them.
"""

from __future__ import annotations

from dataclasses import fields

import numpy as np
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol, HasWeightCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grove.forest import Forest, load_forests, save_forests
from grove.operators.prepare import clean_features
from grove.operators.score import binary_proba, multi_proba, predict_class, score_array
from grove.plans.binned import BinnedParams
from grove.plans.fit import fit_classifier, fit_forest
from grove.plans.leafwise import LeafwiseParams

ENGINES = {"leafwise": LeafwiseParams, "binned": BinnedParams}


class _ForestParams(HasFeaturesCol, HasLabelCol, HasPredictionCol, HasWeightCol):
    engine = Param(Params._dummy(), "engine", "leafwise or binned", TypeConverters.toString)
    options = Param(Params._dummy(), "options", "several training parameters at once", TypeConverters.identity)
    calcProb = Param(Params._dummy(), "calcProb", "sigmoid or softmax", TypeConverters.toString)
    layout = Param(Params._dummy(), "layout", "what vectors become: dense, sparse, or auto (sparse if any vector is)", TypeConverters.toString)

    def __init__(self):
        super().__init__()
        self._setDefault(engine="leafwise", options={}, calcProb="sigmoid", layout="auto")

    def _config(self, **defaults):
        kind = ENGINES.get(self.getOrDefault("engine"))
        if kind is None:
            raise ValueError("engine must be leafwise or binned")
        names = [f.name for f in fields(kind)]
        strangers = sorted(p.name for p in self._paramMap if p.name in TRAINING and p.name not in names)
        if strangers:
            raise ValueError(f"the {self.getOrDefault('engine')} engine has no {strangers}")
        single = {n: self.getOrDefault(n) for n in names if self.isSet(n)}
        return kind(**{**(defaults if kind is LeafwiseParams else {}), **self.getOrDefault("options"), **single})

    def _layout(self, df: DataFrame) -> str:
        """``dense`` or ``sparse``; for vectors the data decides unless it is set."""
        kind = df.schema[self.getFeaturesCol()].dataType.typeName()
        if kind in ("map", "array"):
            return "sparse" if kind == "map" else "dense"
        wanted = self.getOrDefault("layout")
        if wanted not in ("auto", "dense", "sparse"):
            raise ValueError("layout must be auto, dense or sparse")
        if wanted != "auto":
            return wanted
        kinds = F.unwrap_udt(F.col(self.getFeaturesCol()))["type"]
        return "sparse" if df.agg(F.max(kinds == 0)).first()[0] else "dense"

    def _features(self, df: DataFrame, layout: str) -> Column:
        """Arrays and maps as they are; vectors as an ARRAY, or a MAP that holds what a sparse vector holds."""
        name = self.getFeaturesCol()
        if df.schema[name].dataType.typeName() in ("map", "array"):
            return F.col(name)
        if layout == "dense":
            from pyspark.ml.functions import vector_to_array

            return vector_to_array(F.col(name))
        parts = F.unwrap_udt(F.col(name))
        full = F.transform(parts["values"], lambda _, i: i)
        return F.map_from_arrays(F.when(parts["type"] == 0, parts["indices"]).otherwise(full), parts["values"])

    def _table(self, df: DataFrame, layout: str) -> DataFrame:
        weight = F.col(self.getWeightCol()) if self.isSet("weightCol") else F.lit(1.0)
        rows = df.select(self._features(df, layout).alias("features"), F.col(self.getLabelCol()).alias("label"), weight.cast("double").alias("weight"))
        return clean_features(rows)


# A Param for every training parameter of either engine.
TRAINING = {f.name: kind for kind in ENGINES.values() for f in fields(kind)}
for _name in TRAINING:
    _owners = " and ".join(e for e, kind in ENGINES.items() if _name in {f.name for f in fields(kind)})
    setattr(_ForestParams, _name, Param(Params._dummy(), _name, f"training parameter of the {_owners} engine", TypeConverters.identity))


class _ForestEstimator(Estimator, _ForestParams, DefaultParamsWritable, DefaultParamsReadable):
    """``setInitModel`` continues the training of a fitted model; it isn't written with the parameters."""

    def __init__(self, *args, **kwargs):
        super().__init__()
        self._init_model = None

    def _take(self, given: dict) -> None:
        self._set(**{k: v for k, v in given.items() if v is not None})

    def setInitModel(self, model):
        self._init_model = model
        return self

    def copy(self, extra=None):
        out = super().copy(extra)
        out._init_model = self._init_model
        return out


class _ModelWriter(MLWriter):
    def __init__(self, model):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        model, spark = self.model, self.sparkSession
        DefaultParamsWriter.saveMetadata(model, path, spark, {"sparseFeatures": model.sparse_features})
        save_forests(spark, model.forests, f"{path}/forests")
        if model.classes is not None:
            rows = spark.createDataFrame(list(enumerate(model.classes)), ["position", "class"])
            rows.coalesce(1).write.parquet(f"{path}/classes")


class _ModelReader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str):
        spark = self.sparkSession
        metadata = DefaultParamsReader.loadMetadata(path, spark)
        forests = sorted(load_forests(spark, f"{path}/forests"), key=lambda f: f.class_id)
        classes = None
        if issubclass(self.cls, ForestClassificationModel):
            classes = [r["class"] for r in spark.read.parquet(f"{path}/classes").orderBy("position").collect()]
        model = self.cls(forests, classes)
        model.sparse_features = metadata["sparseFeatures"]
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model


class _ForestModel(Model, _ForestParams, MLWritable, MLReadable):
    def __init__(self, forests: list[Forest], classes: list | None = None):
        super().__init__()
        self.forests, self.classes = forests, classes
        self.sparse_features = False

    def write(self) -> MLWriter:
        return _ModelWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _ModelReader(cls)

    @property
    def feature_importances(self) -> np.ndarray:
        """Share of the split gain per feature, averaged over the classes."""
        out = np.zeros(max(f.n_features for f in self.forests))
        for forest in self.forests:
            own = np.zeros(len(out))
            for tree in forest.trees:
                for node in tree.nodes:
                    if node.left >= 0:
                        own[node.feature] += node.gain
            out += own / (own.sum() or 1.0) / len(self.forests)
        return out

    def _work(self, dataset: DataFrame) -> DataFrame:
        x = self._features(dataset, "sparse" if self.sparse_features else "dense")
        return clean_features(dataset.withColumn("_grove_x", x), "_grove_x")


class ForestRegressionModel(_ForestModel):
    @property
    def forest(self) -> Forest:
        return self.forests[0]

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return self.forest.transform(self._work(dataset), "_grove_x", out=self.getPredictionCol()).drop("_grove_x")

    def score(self, dataset: DataFrame) -> float:
        """R^2 on a labelled table."""
        y, p = F.col(self.getLabelCol()).cast("double"), F.col(self.getPredictionCol())
        facts = self.transform(dataset).agg(F.sum((y - p) * (y - p)).alias("rest"), F.var_pop(y).alias("var"), F.count(y).alias("n")).first()
        return 1 - facts["rest"] / (facts["var"] * facts["n"])


class ForestRegressor(_ForestEstimator):
    @keyword_only
    def __init__(self, *, featuresCol="features", labelCol="label", predictionCol="prediction", weightCol=None, engine="leafwise", options=None, layout=None):
        super().__init__()
        self._take(self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> ForestRegressionModel:
        layout = self._layout(dataset)
        table = self._table(dataset, layout).withColumn("label", F.col("label").cast("double"))
        fitted = fit_forest(table, self._config(), init_model=self._init_model.forest if self._init_model else None)
        model = ForestRegressionModel([fitted.forest])
        model.path, model.log, model.sparse_features = fitted.path, fitted.log, layout == "sparse"
        return self._copyValues(model)


class ForestClassificationModel(_ForestModel):
    def _transform(self, dataset: DataFrame) -> DataFrame:
        work = self._work(dataset)
        if len(self.classes) == 2:
            proba = binary_proba(self.forests[0].score(work, "_grove_x"))
        else:
            proba = multi_proba(score_array(work, self.forests, "_grove_x"), self.getOrDefault("calcProb"))
        scored = work.withColumn("probability", proba)
        return scored.withColumn(self.getPredictionCol(), predict_class(F.col("probability"), self.classes)).drop("_grove_x")

    def score(self, dataset: DataFrame) -> float:
        """Share of rows whose class is predicted."""
        right = F.col(self.getPredictionCol()) == F.col(self.getLabelCol())
        return self.transform(dataset).agg(F.avg(right.cast("double"))).first()[0]


class ForestClassifier(_ForestEstimator):
    @keyword_only
    def __init__(self, *, featuresCol="features", labelCol="label", predictionCol="prediction", weightCol=None, engine="leafwise", options=None, calcProb="sigmoid", layout=None):
        super().__init__()
        self._take(self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> ForestClassificationModel:
        if self.getOrDefault("calcProb") not in ("sigmoid", "softmax"):
            raise ValueError("calcProb must be sigmoid or softmax")
        layout = self._layout(dataset)
        table = self._table(dataset, layout).withColumnRenamed("label", "class")
        # The classifier's own defaults.
        config = self._config(max_leaf=1000, loss="Log", normalize=False)
        start = self._init_model
        fitted = fit_classifier(table, "class", config, start.classes if start else None, init_models=start.forests if start else None)
        model = ForestClassificationModel(fitted.forests, fitted.classes)
        model.sparse_features = layout == "sparse"
        return self._copyValues(model)
