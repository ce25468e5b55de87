"""Scores to probabilities, classes, several models at once, and leaf features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grove.forest import Forest


def _sigmoid(s: Column) -> Column:
    return 1 / (1 + F.exp(-s))


def binary_proba(score: Column) -> Column:
    """``[p, 1 - p]``; the first class is the positive one."""
    p = _sigmoid(score)
    return F.array(p, 1 - p)


def multi_proba(scores: Column, calc: str = "sigmoid") -> Column:
    """Class probabilities of an array of one-vs-rest scores."""
    if calc == "sigmoid":
        raw = F.transform(scores, _sigmoid)
    elif calc == "softmax":
        raw = F.transform(scores, lambda s: F.exp(s - F.array_max(scores)))
    else:
        raise ValueError(f"calc must be sigmoid or softmax, not {calc!r}")
    total = F.aggregate(raw, F.lit(0.0), lambda a, x: a + x)
    return F.transform(raw, lambda p: p / F.when(total == 0, F.lit(1.0)).otherwise(total))


def predict_class(proba: Column, classes: Sequence) -> Column:
    """The class of largest probability, the first one on a tie."""
    at = F.array_position(proba, F.array_max(proba)).cast("int")
    return F.element_at(F.array(*[F.lit(c) for c in classes]), at)


def binary_flag(score: Column, threshold: float = 0.0) -> Column:
    return score > threshold


def transform_many(df: DataFrame, models: Sequence[Forest], key: Sequence[str], features: str = "features") -> DataFrame:
    """Long form ``(key..., model_id, seq, score)``: all models in one scan."""
    entries = [
        F.struct(F.lit(m.model_id).alias("model_id"), F.lit(m.seq).alias("seq"), m.score(df, features).alias("score"))
        for m in models
    ]
    return df.select(*key, F.explode(F.array(*entries)).alias("m")).select(*key, "m.*")


def score_array(df: DataFrame, models: Sequence[Forest], features: str = "features") -> Column:
    return F.array(*[m.score(df, features) for m in models])


def leaf_long(indexed: DataFrame, forest: Forest, key: Sequence[str]) -> DataFrame:
    """``(key..., tree, node, leaf_id)``; ids run over the nodes of all trees."""
    sizes = [len(t.nodes) for t in forest.trees]
    offsets = F.array(*[F.lit(sum(sizes[:i])) for i in range(len(sizes))])
    long = indexed.select(*key, F.posexplode("leaves").alias("tree", "node"))
    return long.withColumn("leaf_id", F.element_at(offsets, F.col("tree") + 1) + F.col("node"))


def leaf_features(df: DataFrame, forest: Forest, value: float = 1.0, features: str = "features", out: str = "leaf_features") -> DataFrame:
    """MAP<INT, DOUBLE> with ``value`` at the number of every reached leaf whose weight is not zero."""
    numbers, next_id = [], 0
    for tree in forest.trees:
        ids = []
        for node in tree.nodes:
            ids.append(next_id if node.weight != 0 else -1)
            next_id += node.weight != 0
        numbers.append(F.array(*[F.lit(i) for i in ids]))
    indexed = forest.leaf_index(df, features, "_leaves")
    named = F.zip_with("_leaves", F.array(*numbers), lambda leaf, ids: F.element_at(ids, leaf + 1))
    entries = F.transform(F.filter(named, lambda i: i >= 0), lambda i: F.struct(i, F.lit(float(value))))
    return indexed.withColumn(out, F.map_from_entries(entries)).drop("_leaves")


def leaf_members(indexed: DataFrame) -> DataFrame:
    """Rows per leaf of every tree."""
    return indexed.select(F.posexplode("leaves").alias("tree", "node")).groupBy("tree", "node").agg(
        F.count(F.lit(1)).alias("n")
    )
