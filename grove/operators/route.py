"""Routing binned rows through a table of splits, and the score changes that follow."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def route(rows: DataFrame, splits: DataFrame) -> DataFrame:
    """Move the rows of every split node to its child: ``bin <= cut bin`` goes left.

    ``rows`` has ``node, bins`` (ARRAY, or MAP where absent is bin 0); ``splits`` has one row per split
    node: ``node, feature, bin, left, right``. Other rows stay where they are.
    """
    chosen = F.broadcast(splits.select("node", "feature", F.col("bin").alias("_cut"), F.col("left").alias("_l"), F.col("right").alias("_r")))
    joined = rows.join(chosen, "node", "left")
    cell = F.coalesce(F.expr("bins[feature]"), F.lit(0))
    moved = F.when(F.col("feature").isNull(), F.col("node")).when(cell <= F.col("_cut"), F.col("_l")).otherwise(F.col("_r"))
    return joined.withColumn("node", moved).drop("feature", "_cut", "_l", "_r")


def update_scores(routed: DataFrame, changes: DataFrame) -> DataFrame:
    """Add each node's weight change: ``changes`` has ``node, delta`` (new weight minus the parent's)."""
    small = F.broadcast(changes.select("node", "delta"))  # one row per new leaf
    joined = routed.join(small, "node", "left")
    return joined.withColumn("score", F.col("score") + F.coalesce("delta", F.lit(0.0))).drop("delta")
