"""Fully-corrective leaf weights: statistics per leaf, the leaf Gram matrix, and single steps."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grove.functions import gains
from grove.functions.trees import Access, FlatForest

MAX_GRAM = 4096  # columns of the Gram matrix that the LS correction keeps from tree to tree
BATCH_CELLS = 4_000_000
#: Rows of the Gram matrix that one job sums: a task holds this many times the number of columns.
GRAM_BLOCK = 2048
CORRECTIONS = ("exact", "quadratic")
#: The leaf-wise engine's quadratic sweep runs over the Gram matrix of all leaves, which the driver holds (2 GB here).
QUADRATIC_LEAVES = 16_384


def check_gram(leaves: int) -> None:
    """The leaf-wise engine's bound; the binned engine only builds the columns of the trees in turn, a few thousand."""
    if leaves > QUADRATIC_LEAVES:
        raise ValueError(f"the quadratic correction holds the Gram matrix of {leaves} leaves; use correction='exact' beyond {QUADRATIC_LEAVES}")


def leaf_stats(rows: DataFrame) -> DataFrame:
    """Sums of ``g, h, n`` per (tree, leaf) of a table with ``leaves ARRAY<INT>, g, h, n``."""
    reached = rows.select("g", "h", "n", F.posexplode("leaves").alias("tree", "leaf"))
    return reached.groupBy("tree", "leaf").agg(
        F.sum("g").alias("g"), F.sum("h").alias("h"), F.sum("n").cast("bigint").alias("n")
    )


def newton_step(stats: DataFrame, nlam: float, gamma: float = 1.0, eta: float = 0.5, nsig: float = 0.0, max_delta: float = 0.0) -> DataFrame:
    """One damped step per leaf; ``stats`` has ``g, h, weight, depth``. Adds ``delta, new_weight``."""
    power: Column = F.pow(F.lit(float(gamma)), F.col("depth"))
    w, scale = F.col("weight"), F.col("h") + nlam * power
    delta = (F.col("g") - nlam * power * w) * eta / scale
    if nsig > 0:
        pull = nsig * power * eta / scale
        pulled = F.when(w + delta > 0, delta - pull).otherwise(delta + pull)
        delta = F.when((w + delta) * (w + pulled) <= 0, -w).otherwise(pulled)
    if max_delta > 0:
        delta = F.greatest(F.lit(-max_delta), F.least(F.lit(max_delta), delta))
    return stats.withColumn("delta", delta).withColumn("new_weight", w + F.col("delta"))


def soft_step(stats: DataFrame, l1: float, l2: float) -> DataFrame:
    """The closed-form update of the binned engine; ``stats`` has ``g, h, weight``."""
    _, x = gains.solve_l1l2(F.col("h"), F.col("weight") * F.col("h") + F.col("g"), l1, l2)
    return stats.withColumn("new_weight", x).withColumn("delta", F.col("new_weight") - F.col("weight"))


def gram_long(rows: DataFrame) -> DataFrame:
    """Weight shared by every two leaves ``a <= b`` of a table with ``leaves ARRAY<INT>`` (global ids) and
    ``weight``, plus per leaf the sum of ``weight * label`` (on the diagonal)."""
    pairs = rows.select(
        "weight",
        "label",
        "leaves",
        F.explode("leaves").alias("a"),
    ).select("weight", "label", "a", F.explode("leaves").alias("b"))
    return pairs.filter("a <= b").groupBy("a", "b").agg(
        F.sum("weight").alias("shared"),
        F.sum(F.when(F.col("a") == F.col("b"), F.col("weight") * F.col("label"))).alias("wy"),
    )


def gram_update(
    rows: DataFrame, trees: Sequence, access: Access, columns: list[tuple[int, int]], new: list[int]
) -> tuple[np.ndarray, np.ndarray]:
    """Rows ``new`` of the Gram matrix over ``columns`` (tree, node), and their sums of ``moment``.

    ``rows`` has ``bins``, the ``weight`` of the products and the ``moment`` to sum. Each task multiplies its own membership matrix in Arrow batches; only sums are shuffled.
    """
    flat = FlatForest(trees, access.binned)
    fills = access.fills(flat.used)
    column_of = {c: i for i, c in enumerate(columns)}
    longest = max((t.max_depth() for t in trees), default=0) + 1
    # For each node the columns that hold its rows: its own and those of its ancestors.
    held = np.full((len(flat.left), longest), -1, np.int32)
    for t, tree in enumerate(trees):
        for i in range(len(tree.nodes)):
            at, k = i, 0
            while at >= 0:
                held[flat.starts[t] + i, k] = column_of.get((t, at), -1)
                at, k = tree.nodes[at].parent, k + 1
    width = len(columns)
    step = max(1, BATCH_CELLS // max(1, width))

    def summed(chosen: np.ndarray):
        def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            shared, target = np.zeros((len(chosen), width)), np.zeros(len(chosen))
            for batch in batches:
                for lo in range(0, batch.num_rows, step):
                    part = batch.slice(lo, step)
                    w = part.column("weight").to_numpy(zero_copy_only=False)
                    moment = part.column("moment").to_numpy(zero_copy_only=False)
                    leaves = flat.leaves(flat.matrix(part.column("bins"), fills))
                    z = np.zeros((len(w), width + 1))
                    rows_ = np.arange(len(w))[:, None]
                    for k in range(longest):
                        z[rows_, held[leaves, k]] = 1.0  # -1 is the spare last column
                    z = z[:, :width]
                    own = z[:, chosen]
                    shared += (own * w[:, None]).T @ z
                    target += own.T @ moment
            a, b = np.nonzero(shared)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([a, np.arange(len(chosen))]).astype(np.int32)),
                    pa.array(np.concatenate([b, np.full(len(chosen), -1)]).astype(np.int32)),
                    pa.array(np.concatenate([shared[a, b], target])),
                ],
                names=["a", "b", "s"],
            )

        return partial

    # One job for each block of GRAM_BLOCK rows of the matrix: tasks and the driver hold a block at a time.
    shared, target = np.zeros((len(new), width)), np.zeros(len(new))
    for lo in range(0, len(new), GRAM_BLOCK):
        chosen = np.array(new[lo : lo + GRAM_BLOCK], int)
        parts = rows.select("weight", "moment", "bins").mapInArrow(summed(chosen), "a int, b int, s double")
        pdf = parts.groupBy("a", "b").agg(F.sum("s").alias("s")).toPandas()  # at most GRAM_BLOCK x columns cells
        a, b, s = pdf["a"].to_numpy(int), pdf["b"].to_numpy(int), pdf["s"].to_numpy(float)
        shared[lo + a[b >= 0], b[b >= 0]] = s[b >= 0]
        target[lo + a[b < 0]] = s[b < 0]
    return shared, target
