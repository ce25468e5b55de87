"""Reports on a node table (as written by a forest); only ``leaf_profile`` touches rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KEYS = ["model_id", "class_id", "tree"]


def leaf_paths(nodes: DataFrame, max_depth: int | None = None) -> DataFrame:
    """One row per leaf and ancestor: the test at the ancestor and the side taken."""
    if max_depth is None:
        max_depth = nodes.agg(F.max("depth")).first()[0] or 0
    inner = F.broadcast(
        nodes.filter("left >= 0").select(*KEYS, F.col("node").alias("up"), "feature", "cut", "left", F.col("depth").alias("at"), F.col("parent").alias("next"))
    )
    current = nodes.filter("left < 0 AND parent >= 0").select(
        *KEYS, F.col("node").alias("leaf"), F.col("weight").alias("leaf_weight"), F.col("node").alias("here"), F.col("parent").alias("up")
    )
    steps = None
    for _ in range(max_depth):
        met = current.join(inner, [*KEYS, "up"])
        step = met.select(
            *KEYS, "leaf", "leaf_weight", "feature", "cut", F.col("at").alias("depth"),
            F.when(F.col("left") == F.col("here"), F.lit("<=")).otherwise(F.lit(">")).alias("side"),
        )
        steps = step if steps is None else steps.unionByName(step)
        current = met.filter("next >= 0").select(
            *KEYS, "leaf", "leaf_weight", F.col("up").alias("here"), F.col("next").alias("up")
        )
    if steps is None:
        return current.join(inner, [*KEYS, "up"]).select(
            *KEYS, "leaf", "leaf_weight", "feature", "cut", F.col("at").alias("depth"), F.lit("<=").alias("side")
        ).limit(0)
    return steps


def feature_importance(nodes: DataFrame) -> DataFrame:
    """Share of the split gain per feature; several classes are averaged."""
    gains = nodes.filter("left >= 0").groupBy("model_id", "class_id", "feature").agg(F.sum("gain").alias("gain"))
    share = gains.withColumn("share", F.col("gain") / F.sum("gain").over(Window.partitionBy("model_id", "class_id")))
    classes = nodes.groupBy("model_id").agg(F.count_distinct("class_id").alias("classes"))
    summed = share.groupBy("model_id", "feature").agg(F.sum("share").alias("share"))
    return summed.join(F.broadcast(classes), "model_id").select(
        "model_id", "feature", (F.col("share") / F.col("classes")).alias("importance")
    )


def path_importance(nodes: DataFrame) -> DataFrame:
    """Per feature: tests of it on all leaf paths and the absolute leaf weight behind them."""
    return leaf_paths(nodes).groupBy("model_id", "feature").agg(
        F.count(F.lit(1)).alias("uses"), F.sum(F.abs("leaf_weight")).alias("abs_weight")
    )


def _name(names: Sequence[str] | None) -> Column:
    if not names:
        return F.col("feature").cast("string")
    return F.element_at(F.array(*[F.lit(n) for n in names]), F.col("feature") + 1)


def rules(nodes: DataFrame, names: Sequence[str] | None = None, digits: int = 5) -> DataFrame:
    """Rule text of every leaf, root test first; a tree of one node has the rule ROOT."""
    test = F.concat(_name(names), "side", F.round("cut", digits).cast("string"))
    ordered = F.sort_array(F.collect_list(F.struct("depth", test.alias("test"))))
    texts = leaf_paths(nodes).groupBy(*KEYS, "leaf").agg(ordered.alias("tests"))
    texts = texts.select(*KEYS, "leaf", F.array_join(F.col("tests.test"), ";").alias("rule"))
    leaves = nodes.filter("left < 0").select(*KEYS, F.col("node").alias("leaf"), "weight")
    return leaves.join(texts, [*KEYS, "leaf"], "left").withColumn("rule", F.coalesce("rule", F.lit("ROOT")))


def ranked_rules(nodes: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """Leaves of non-zero weight: positive ones from the largest down, then negative from the lowest up."""
    used = rules(nodes, names).filter("weight <> 0").withColumn("sign", F.signum("weight").cast("int"))
    return used.orderBy(F.desc("sign"), F.desc(F.abs("weight")), *KEYS, "leaf")


def feature_cooccurrence(nodes: DataFrame) -> DataFrame:
    """Pairs of tests on the same leaf path (``feature_a <= feature_b``), counted.

    A path is as long as its tree is deep, so the pairs of one leaf are few.
    """
    paths = leaf_paths(nodes).select(*KEYS, "leaf", "depth", "feature")
    other = paths.select(*KEYS, "leaf", F.col("depth").alias("depth_b"), F.col("feature").alias("other"))
    pairs = paths.join(other, [*KEYS, "leaf"]).filter("depth < depth_b")
    return pairs.groupBy(
        "model_id", F.least("feature", "other").alias("feature_a"), F.greatest("feature", "other").alias("feature_b")
    ).agg(F.count(F.lit(1)).alias("n"))


def first_use(nodes: DataFrame) -> DataFrame:
    return nodes.filter("left >= 0").groupBy("model_id", "feature").agg(F.min("tree").alias("first_tree"))


def distinct_rules(nodes: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """Each rule once: how many leaves carry it and whether any of them has a weight."""
    return rules(nodes, names).groupBy("model_id", "rule").agg(
        F.count(F.lit(1)).alias("leaves"), F.max((F.col("weight") != 0).cast("int")).alias("weighted")
    )


def forest_stats(nodes: DataFrame) -> DataFrame:
    per_tree = nodes.groupBy(*KEYS).agg(
        F.count_if(F.col("left") < 0).alias("leaves"), F.max("depth").alias("depth")
    )
    return per_tree.groupBy("model_id", "class_id").agg(
        F.count(F.lit(1)).alias("trees"),
        F.sum("leaves").alias("leaves"),
        F.max("depth").alias("max_depth"),
        F.avg("depth").alias("avg_depth"),
        F.max("leaves").alias("max_leaves"),
        F.avg("leaves").alias("avg_leaves"),
    )


def leaf_profile(indexed: DataFrame, nodes: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """Rows, weight and mean label per leaf of a table that carries ``leaves, label, weight``."""
    reached = indexed.select("label", "weight", F.posexplode("leaves").alias("tree", "leaf"))
    counts = reached.groupBy("tree", "leaf").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("weight").alias("row_weight"), F.avg("label").alias("mean_label")
    )
    texts = rules(nodes, names).select("tree", "leaf", "rule", F.col("weight").alias("leaf_weight"))
    return counts.join(F.broadcast(texts), ["tree", "leaf"])
