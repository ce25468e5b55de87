"""Derivative histograms per (node, feature, bin): the heavy aggregation of every training round."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# From this many dense features on, exploding every row costs more than an Arrow batch.
ARROW_FEATURES = 32
ARROW_CELLS = 5_000_000

_PARTIAL = "node int, feature int, bin int, g double, h double, n bigint"


def _sum_cells(cells: DataFrame) -> DataFrame:
    return cells.groupBy("node", "feature", "bin").agg(
        F.sum("g").alias("g"), F.sum("h").alias("h"), F.sum("n").cast("bigint").alias("n")
    )


def node_totals(rows: DataFrame) -> DataFrame:
    return rows.groupBy("node").agg(
        F.sum("g").alias("g"), F.sum("h").alias("h"), F.sum("n").cast("bigint").alias("n")
    )


def node_histogram(rows: DataFrame, n_nodes: int | None = None, sizes: list[int] | None = None) -> DataFrame:
    """``rows`` has ``node, bins ARRAY<INT>, g, h, n``.

    With known node count and bin counts, wide rows are summed per task in Arrow batches and only the
    partial sums are shuffled; otherwise the bins are exploded and the hash aggregate does the same.
    """
    if n_nodes and sizes and len(sizes) >= ARROW_FEATURES and n_nodes * sum(sizes) <= ARROW_CELLS:
        return _sum_cells(_partial_sums(rows, n_nodes, sizes))
    cells = rows.select("node", "g", "h", "n", F.posexplode("bins").alias("feature", "bin"))
    return _sum_cells(cells)


def _partial_sums(rows: DataFrame, n_nodes: int, sizes: list[int]) -> DataFrame:
    starts = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    width = int(starts[-1])

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g, h = np.zeros(n_nodes * width), np.zeros(n_nodes * width)
        n = np.zeros(n_nodes * width)
        for batch in batches:
            if batch.num_rows == 0:
                continue
            node = batch.column("node").to_numpy(zero_copy_only=False).astype(np.int64)
            bins = batch.column("bins").flatten().to_numpy(zero_copy_only=False).reshape(len(node), -1)
            code = (node[:, None] * width + starts[:-1][None, :] + bins).ravel()
            for total, name in ((g, "g"), (h, "h"), (n, "n")):
                value = batch.column(name).to_numpy(zero_copy_only=False).astype(float)
                total += np.bincount(code, np.repeat(value, bins.shape[1]), minlength=len(total))
        seen = np.flatnonzero(n)
        inside = seen % width
        feature = np.searchsorted(starts, inside, side="right") - 1
        yield pa.RecordBatch.from_arrays(
            [
                pa.array((seen // width).astype(np.int32)),
                pa.array(feature.astype(np.int32)),
                pa.array((inside - starts[feature]).astype(np.int32)),
                pa.array(g[seen]),
                pa.array(h[seen]),
                pa.array(n[seen].astype(np.int64)),
            ],
            names=["node", "feature", "bin", "g", "h", "n"],
        )

    return rows.select("node", "bins", "g", "h", "n").mapInArrow(partial, _PARTIAL)


def node_histogram_sparse(rows: DataFrame, absent: DataFrame | None = None, totals: bool = False) -> DataFrame:
    """``rows`` has ``node, bins MAP<INT, INT>, g, h, n``; absence is the node total minus what is present.

    Only present entries are exploded. ``absent`` (``feature, absent``) names the bin that stands for
    absence, else it is 0. A feature that no row of a node holds has no cut there and is left out; with
    ``totals`` every node also gets a row of its totals under feature -1, from which it can be filled in.
    """
    present = _sum_cells(rows.select("node", "g", "h", "n", F.explode("bins").alias("feature", "bin")))
    per_node = node_totals(rows)
    whole = F.broadcast(per_node.select("node", F.col("g").alias("tg"), F.col("h").alias("th"), F.col("n").alias("tn")))
    sums = present.groupBy("node", "feature").agg(
        F.sum("g").alias("g"), F.sum("h").alias("h"), F.sum("n").cast("bigint").alias("n")
    )
    if absent is None:
        sums = sums.withColumn("absent", F.lit(0))
    else:
        sums = sums.join(absent, "feature")
    rest = sums.join(whole, "node").select(
        "node",
        "feature",
        F.col("absent").cast("int").alias("bin"),
        (F.col("tg") - F.col("g")).alias("g"),
        (F.col("th") - F.col("h")).alias("h"),
        (F.col("tn") - F.col("n")).alias("n"),
    )
    hist = present.unionByName(rest.filter("n > 0"))
    if totals:
        hist = hist.unionByName(per_node.select("node", F.lit(-1).alias("feature"), F.lit(0).alias("bin"), "g", "h", "n"))
    return hist


def sibling_histogram(parent: DataFrame, child: DataFrame) -> DataFrame:
    """The other child's histogram: parent minus child, both keyed by (feature, bin)."""
    c = child.select("feature", "bin", F.col("g").alias("cg"), F.col("h").alias("ch"), F.col("n").alias("cn"))
    joined = parent.join(c, ["feature", "bin"], "left").na.fill(0, ["cg", "ch", "cn"])
    return joined.select(
        "feature",
        "bin",
        (F.col("g") - F.col("cg")).alias("g"),
        (F.col("h") - F.col("ch")).alias("h"),
        (F.col("n") - F.col("cn")).alias("n"),
    ).filter("n > 0")
