"""Paths of models on test data, cross-validation and parameter sweeps."""

from __future__ import annotations

import itertools
from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from grove.forest import Forest
from grove.operators.metrics import evaluate
from grove.operators.score import transform_many
from grove.plans.binned import BinnedParams
from grove.plans.fit import fit_forest
from grove.plans.leafwise import LeafwiseParams


def path_facts(spark, path: Sequence[Forest]) -> DataFrame:
    rows = [(f.model_id, f.seq, len(f.trees), f.n_leaves) for f in path]
    return spark.createDataFrame(rows, "model_id string, seq int, trees int, leaves int")


def evaluate_path(test: DataFrame, path: Sequence[Forest], loss: str = "LS", engine: str = "leafwise") -> DataFrame:
    """One metric row per model of a path, from one scan of the test table."""
    scored = transform_many(test, path, ["label", "weight"])
    metrics = evaluate(scored, loss, by=["model_id", "seq"], engine=engine)
    return metrics.join(F.broadcast(path_facts(test.sparkSession, path)), ["model_id", "seq"])


def cross_validate(folded: DataFrame, params: LeafwiseParams | BinnedParams) -> DataFrame:
    """Mean metrics per step of the path over the folds of a table with ``fold``.

    A training run per fold is a loop over the number of folds, never over rows.
    """
    source = folded.persist(StorageLevel.MEMORY_AND_DISK)
    engine = "leafwise" if isinstance(params, LeafwiseParams) else "binned"
    parts = None
    for fold in sorted(r[0] for r in source.select("fold").distinct().collect()):
        train = source.filter(F.col("fold") != fold).select("features", "label", "weight")
        test = source.filter(F.col("fold") == fold).select("features", "label", "weight")
        part = evaluate_path(test, fit_forest(train, params).path, params.loss, engine).withColumn("fold", F.lit(fold))
        parts = part if parts is None else parts.unionByName(part)
    return parts.groupBy("seq").agg(
        F.count(F.lit(1)).alias("folds"),
        F.avg("accuracy").alias("accuracy"),
        F.avg("rmse").alias("rmse"),
        F.avg("mean_loss").alias("mean_loss"),
    )


def sweep(
    train: DataFrame, test: DataFrame, base: LeafwiseParams | BinnedParams, grid: dict[str, Sequence]
) -> DataFrame:
    """Several runs that share one base configuration; metrics of each final model."""
    train = train.persist(StorageLevel.MEMORY_AND_DISK)
    engine = "leafwise" if isinstance(base, LeafwiseParams) else "binned"
    names = sorted(grid)
    models, configs, bins = [], [], None
    for run, values in enumerate(itertools.product(*(grid[n] for n in names))):
        config = dict(zip(names, values))
        # Bins depend on few parameters: one set serves all runs that do not change those.
        shared = bins if not {"max_bins", "min_child_weight", "data_l2", "sparse_max_features", "sparse_min_occurrences"} & set(names) else None
        fitted = fit_forest(train, replace(base, **config), bins=shared)
        bins = fitted.bins
        forest = fitted.forest
        forest.model_id, forest.seq = f"run{run}", 1
        models.append(forest)
        configs.append((forest.model_id, str(config)))
    train.unpersist()
    named = train.sparkSession.createDataFrame(configs, "model_id string, config string")
    return evaluate_path(test, models, base.loss, engine).join(F.broadcast(named), "model_id")
