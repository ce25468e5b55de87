"""The training rows of one run: binned, scored, and as few as exactness allows."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grove.forest import Tree
from grove.functions.losses import derivative_sql
from grove.functions.trees import Access, forest_sql, forest_value, number, tree_case
from grove.operators.binning import KEPT_BOUNDARIES, BinSet, apply_bins
from grove.operators.histogram import node_histogram, node_histogram_sparse
from grove.session import cut_lineage

# Histograms of one job are held by the driver up to this many cells and bins of a feature; beyond it the search is a job too.
DRIVER_CELLS = 10_000_000
DRIVER_BINS = KEPT_BOUNDARIES + 1
# Pending trees are folded into the stored score before their expression gets long.
PENDING_NODES = 100
SMALL_TABLE = 8_000_000
BATCH_CELLS = 500_000  # present cells of a partition that is binned


def binned_rows(table: DataFrame, bins: BinSet, n_rows: int) -> DataFrame:
    """``(label, weight, n, bins, score)`` with one row per training row."""
    if bins.sparse:
        # A Python worker holds a partition of maps in one batch, up to 10,000 rows of any width: partitions follow the cells.
        cells = table.agg(F.sum(F.greatest(F.size("features"), F.lit(0)))).first()[0] or 0
        table = table.repartition(max(table.sparkSession.sparkContext.defaultParallelism, -(-cells // BATCH_CELLS)))
    elif n_rows <= SMALL_TABLE:
        # A table of few input splits would leave most cores idle in every later job.
        table = table.repartition(table.sparkSession.sparkContext.defaultParallelism)
    return apply_bins(table, bins).select(
        "label", "weight", F.lit(1).cast("bigint").alias("n"), "bins", F.lit(0.0).alias("score")
    )


def collapse(rows: DataFrame, loss: str) -> DataFrame:
    """Rows with equal bins always share their score, so they can be trained on as one.

    Under LS only their weight, weighted mean label and count matter; other losses need equal labels
    too. The derivative sums, and so the forest, stay the same.
    """
    if loss == "LS":
        merged = rows.groupBy("bins").agg(
            (F.sum(F.col("weight") * F.col("label")) / F.sum("weight")).alias("label"),
            F.sum("weight").alias("weight"),
            F.sum("n").cast("bigint").alias("n"),
        )
    else:
        merged = rows.groupBy("bins", "label").agg(F.sum("weight").alias("weight"), F.sum("n").cast("bigint").alias("n"))
    return merged.select("label", "weight", "n", "bins", F.lit(0.0).alias("score"))


def maybe_collapse(rows: DataFrame, loss: str, n_rows: int) -> DataFrame:
    if rows.schema["bins"].dataType.typeName() != "array":
        return rows
    key = F.xxhash64("bins") if loss == "LS" else F.xxhash64("bins", "label")
    distinct = rows.agg(F.approx_count_distinct(key)).first()[0]
    if distinct >= 0.5 * n_rows:
        return rows
    return collapse(rows, loss)


class TrainingRows:
    """Rows whose current score is the stored column plus the trees changed since it was stored.

    ``fixed`` is written once; ``df`` is the same rows with the stored score, kept in memory or on disk.
    """

    def __init__(self, df: DataFrame, bins: BinSet, loss: str, engine: str):
        self.fixed = cut_lineage(df)
        self.df = self.fixed
        self.spark = df.sparkSession
        self.bins, self.loss, self.engine = bins, loss, engine
        self.sparse = bins.sparse
        self.access = Access("bins", self.sparse, True, absent=bins.default_bin)
        self.features = bins.features if self.sparse else list(range(max(bins.features) + 1))
        sizes = bins.sizes()
        self.sizes = [sizes.get(f, 1) for f in self.features]
        self.position = {f: i for i, f in enumerate(self.features)}
        self.absent = None
        if self.sparse:
            known = [(f, bins.default_bin(f)) for f in self.features]
            self.absent = self.spark.createDataFrame(known, "feature int, absent int")
        self.pending: list[Tree] = []
        self.shift = 0.0
        self.inner_square = 0.0  # squared label mass inside collapsed rows; only the reported loss needs it

    def close(self) -> None:
        self.df.unpersist()
        self.fixed.unpersist()

    # ------------------------------------------------------------ scores

    def score_sql(self) -> str:
        """The current score; ``settle`` keeps the pending trees few."""
        return forest_sql(self.pending, self.access, "score")

    def settle(self, constant: float, trees: list[Tree], growing: int) -> None:
        """Store the score anew once the finished pending trees get many."""
        done = self.pending[: len(self.pending) - growing]
        if sum(len(t.nodes) for t in done) > PENDING_NODES:
            self.rescore(constant, trees, growing)

    def rescore(self, constant: float, trees: list[Tree], growing: int, keep_old: bool = False) -> None:
        """Store the score of all trees but the last ``growing`` ones.

        It is always derived from the fixed rows and the current forest, so nothing is written and the
        lineage stays one step long however often this is called. ``keep_old`` leaves the table of
        before in place, for a return to it.
        """
        done = trees[: len(trees) - growing]
        old = self.df
        self.df = self.fixed.withColumn("score", forest_value(done, self.access, constant)).persist()
        if old is not self.fixed and not keep_old:
            old.unpersist()
        self.pending = list(trees[len(done) :])

    def derivative_sql(self, s: str = "_s") -> tuple[str, str]:
        g, h = derivative_sql(self.loss, s, "label", self.engine, self.shift)
        return f"weight * ({g})", f"weight * ({h})"

    def scored(self, *extra: str) -> DataFrame:
        """The stored rows with their current score ``_s`` (and more SQL expressions)."""
        return self.df.selectExpr("label", "weight", "n", "bins", f"{self.score_sql()} AS _s", *extra)

    def moments(self) -> DataFrame:
        """``weight, moment, bins`` for the Gram matrix of squared loss."""
        return self.df.selectExpr("weight", "weight * label AS moment", "bins")

    def slopes(self) -> DataFrame:
        """The same of the loss's second-order expansion at the current scores: ``h`` as weight, ``g`` as moment."""
        g, h = self.derivative_sql()
        return self.scored().selectExpr(f"CAST({h} AS DOUBLE) AS weight", f"CAST({g} AS DOUBLE) AS moment", "bins")

    def mean_margin(self) -> float:
        row = self.scored().selectExpr("sum(_s * label * n) / sum(n) AS m").first()
        return float(np.clip(row["m"] or 0.0, -500.0, 500.0))

    # ------------------------------------------------------------ sums

    def fits_driver(self, n_nodes: int) -> bool:
        widest = max(self.sizes)
        return widest <= DRIVER_BINS and n_nodes * len(self.features) * widest <= DRIVER_CELLS

    def histogram(self, slot: str, deltas: list[float], totals: bool = True) -> DataFrame:
        """Histogram per slot; ``slot`` is SQL (NULL: not wanted), ``deltas`` are added to its scores.

        ``totals`` is for ``collect_histogram``, which completes sparse histograms with them.
        """
        score = "_s"
        if any(deltas):
            score = f"(_s + element_at(array({', '.join(map(number, deltas))}), node + 1))"
        g, h = self.derivative_sql(score)
        placed = self.scored(f"CAST({slot} AS INT) AS node").where("node IS NOT NULL")
        rows = placed.selectExpr("node", "bins", f"{g} AS g", f"{h} AS h", "n")
        if self.sparse:
            return node_histogram_sparse(rows, self.absent, totals)
        return node_histogram(rows, len(deltas), self.sizes)

    def collect_histogram(self, hist: DataFrame, n_slots: int) -> np.ndarray:
        """``[slot, (g, h, n), feature position, bin]``; the caller has checked ``fits_driver``."""
        out = np.zeros((n_slots, 3, len(self.features), max(self.sizes)))
        # As columns: a row object for each cell would take many times their memory here and in the JVM.
        found = hist.select("node", "feature", "bin", "g", "h", "n").toArrow()
        node, feature, bin_, *sums = (c.to_numpy() for c in found.columns)
        held = feature >= 0
        cells = node[held], np.searchsorted(self.features, feature[held]), bin_[held]
        for k, values in enumerate(sums):
            out[cells[0], k, cells[1], cells[2]] = values[held]
        if self.sparse:
            absent = np.array([self.bins.default_bin(f) for f in self.features])
            for r in np.flatnonzero(~held):
                unheld = np.flatnonzero(out[node[r], 2].sum(axis=1) == 0)
                for k, values in enumerate(sums):
                    out[node[r], k, unheld, absent[unheld]] = values[r]
        return out

    def group_sums(self, tree: Tree, group: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """``g`` and ``h`` sums of disjoint nodes of one tree."""
        inside = {n: i for i, n in enumerate(group)}
        slot = tree_case(tree, self.access, lambda i: str(inside[i]) if i in inside else ("-1" if tree.nodes[i].left < 0 else None))
        g, h = self.derivative_sql()
        per_slot = self.scored(f"{slot} AS slot").where("slot >= 0").groupBy("slot")
        sums = per_slot.agg(F.expr(f"sum({g}) AS g"), F.expr(f"sum({h}) AS h")).collect()
        gs, hs = np.zeros(len(group)), np.zeros(len(group))
        for r in sums:
            gs[r["slot"]], hs[r["slot"]] = r["g"], r["h"]
        return gs, hs


def frontier_sql(tree: Tree, access: Access, wanted: dict[int, int], ahead: dict[int, tuple[int, int, int, int]]) -> str:
    """Slot of each row: ``wanted`` maps leaves to slots, ``ahead`` maps leaves that are split in advance
    to ``(feature, bin, left slot, right slot)``; everything else is NULL."""

    class _Test:
        def __init__(self, feature: int, bin_: int):
            self.feature, self.bin = feature, bin_

    def leaf(i: int) -> str | None:
        if i in ahead:
            feature, bin_, left, right = ahead[i]
            return f"CASE WHEN {access.test(_Test(feature, bin_))} THEN {left} ELSE {right} END"
        if i in wanted:
            return str(wanted[i])
        return "NULL" if tree.nodes[i].left < 0 else None

    return tree_case(tree, access, leaf)


def best_of(
    stats: np.ndarray,
    gain: Callable,
    min_rows: int = 0,
    min_sample: float | None = None,
    allowed: np.ndarray | None = None,
    tie: float = 0.0,
    tiny: float = 1e-10,
    relative: float = 1e-9,
) -> dict | None:
    """The best cut of one node's histogram ``[(g, h, n), feature, bin]``, as ``best_splits`` chooses it."""
    g, h, n = stats
    left = stats.cumsum(axis=2)
    total = left[:, :, -1:]
    right = total - left
    valid = (n > 0) & (left[2] > 0) & (right[2] > 0.5)
    if min_rows > 0:
        valid &= (left[2] >= min_rows) & (right[2] >= min_rows)
    if min_sample is not None:
        least = min_sample * total[1] / (total[2] + tiny)
        valid &= (left[1] >= least) & (right[1] >= least)
    if allowed is not None:
        valid &= allowed[:, None]
    if not valid.any():
        return None
    f, b = np.nonzero(valid)
    found = gain(left[0][f, b], left[1][f, b], right[0][f, b], right[1][f, b])
    value = found["gain"]
    top = value.max()
    if not top > tie:
        return None
    at = int(np.argmax(value >= top - max(tie, relative * top)))
    out = {k: float(v[at]) if np.ndim(v) else float(v) for k, v in found.items()}
    out.update(position=int(f[at]), bin=int(b[at]), n_left=int(left[2][f[at], b[at]]), n_right=int(right[2][f[at], b[at]]))
    return out
