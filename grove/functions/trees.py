"""Routing through trees: as a CASE expression for small forests, as Arrow batches for large ones."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from grove.operators.prepare import VALUE_MIN

# Beyond this many nodes one generated method gets too large to be compiled well.
CASE_NODES = 150


def number(x: float) -> str:
    """A double literal that keeps every bit."""
    x = float(x)
    if not math.isfinite(x):
        return f"double('{'NaN' if x != x else 'Infinity' if x > 0 else '-Infinity'}')"
    return f"{x!r}D"


class Access:
    """How a node reads its feature from a row: raw values or bins, dense array or sparse map."""

    def __init__(self, column: str, sparse: bool, binned: bool, missing: str = "lowest", absent: Callable | None = None):
        self.column, self.sparse, self.binned, self.missing = column, sparse, binned, missing
        self.absent = absent  # bin of an absent feature; 0 without it

    def test(self, node) -> str:
        """SQL that is true when the row goes left."""
        cell = f"{self.column}[{node.feature}]"
        if self.binned:
            if self.sparse:
                cell = f"coalesce({cell}, {self.absent_bin(node.feature)})"
            return f"{cell} <= {node.bin}"
        fill = "0.0D" if self.sparse and self.missing == "zero" else number(VALUE_MIN)
        low = number(VALUE_MIN)
        return f"coalesce(nanvl(cast({cell} as double), {low}), {fill}) <= {number(node.cut)}"

    def absent_bin(self, feature: int) -> int:
        return self.absent(feature) if self.absent else 0

    def fills(self, features: Sequence[int]) -> np.ndarray:
        """What each feature is when a sparse row does not hold it."""
        if self.binned:
            return np.array([self.absent_bin(int(f)) for f in features], float)
        return np.full(len(features), 0.0 if self.missing == "zero" else VALUE_MIN)


def tree_case(tree, access: Access, leaf: Callable[[int], str | None], at: int = 0) -> str:
    """Nested CASE over a tree; ``leaf`` gives the SQL of each leaf (or of an inner node to stop at)."""
    node = tree.nodes[at]
    if node.left < 0:
        return leaf(at)
    stop = leaf(at)
    if stop is not None:
        return stop
    left, right = tree_case(tree, access, leaf, node.left), tree_case(tree, access, leaf, node.right)
    if left == right:
        return left
    return f"CASE WHEN {access.test(node)} THEN {left} ELSE {right} END"


class FlatForest:
    """Node arrays of several trees, for vectorised descent inside Arrow tasks."""

    def __init__(self, trees: Sequence, binned: bool):
        starts = np.cumsum([0] + [len(t.nodes) for t in trees])
        nodes = [(s, n) for s, t in zip(starts, trees) for n in t.nodes]
        self.starts = starts
        self.feature = np.array([max(n.feature, 0) for _, n in nodes], np.int32)
        self.cut = np.array([float(n.bin if binned else n.cut) for _, n in nodes])
        here = np.arange(len(nodes))
        leaf = np.array([n.left < 0 for _, n in nodes], bool)
        # A leaf points at itself, so descent may run a fixed number of steps.
        self.left = np.where(leaf, here, [s + n.left for s, n in nodes]) if nodes else here
        self.right = np.where(leaf, here, [s + n.right for s, n in nodes]) if nodes else here
        self.weight = np.array([n.weight for _, n in nodes], float)
        self.depths = [t.max_depth() for t in trees]
        self.used = np.unique(self.feature[~leaf]) if nodes else np.zeros(0, np.int32)
        position = np.zeros(int(self.feature.max(initial=0)) + 1, np.int32)
        position[self.used] = np.arange(len(self.used))
        self.slot = position[self.feature]

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """Node index (over all trees) reached in each tree; ``x`` holds the used features only."""
        out = np.empty((len(x), len(self.depths)), np.int32)
        rows = np.arange(len(x))
        for t, depth in enumerate(self.depths):
            at = np.full(len(x), self.starts[t], np.int64)
            for _ in range(depth):
                go_left = x[rows, self.slot[at]] <= self.cut[at]
                at = np.where(go_left, self.left[at], self.right[at])
            out[:, t] = at
        return out

    def matrix(self, column: pa.Array, fills: np.ndarray) -> np.ndarray:
        """The used features of an ARRAY or MAP column as a dense matrix; missing cells get ``fills``."""
        if isinstance(column, pa.ChunkedArray):
            column = column.combine_chunks()
        if len(column) == 0 or len(self.used) == 0:
            return np.zeros((len(column), max(1, len(self.used))))
        if pa.types.is_map(column.type):
            first = column.offsets[0].as_py()
            offsets = column.offsets.to_numpy() - first
            count = int(offsets[-1])
            keys = column.keys.slice(first, count).to_numpy(zero_copy_only=False)
            items = column.items.slice(first, count)
            null = items.is_null().to_numpy(zero_copy_only=False)
            values = items.to_numpy(zero_copy_only=False).astype(float)
            values = np.where(np.isnan(values), VALUE_MIN, values)
            at = np.minimum(np.searchsorted(self.used, keys), len(self.used) - 1)
            hit = (self.used[at] == keys) & ~null  # NULL is as good as absent
            row = np.repeat(np.arange(len(column)), np.diff(offsets))
            x = np.tile(fills, (len(column), 1))
            x[row[hit], at[hit]] = values[hit]
            return x
        x = column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)[:, self.used].astype(float)
        return np.where(np.isnan(x), VALUE_MIN, x)


def at_leaves(tree, sql: Callable[[int], str]) -> Callable[[int], str | None]:
    """A ``leaf`` function for ``tree_case`` that never stops at inner nodes."""
    return lambda i: sql(i) if tree.nodes[i].left < 0 else None


def forest_sql(trees: Sequence, access: Access, base: str) -> str:
    terms = [base] + [tree_case(t, access, at_leaves(t, lambda i, t=t: number(t.nodes[i].weight))) for t in trees]
    return " + ".join(f"({term})" for term in terms)


def forest_value(trees: Sequence, access: Access, constant: float = 0.0) -> Column:
    """Constant plus the weight of the leaf reached in every tree."""
    trees = list(trees)
    if sum(len(t.nodes) for t in trees) <= CASE_NODES:
        return F.expr(forest_sql(trees, access, number(constant)))
    flat = FlatForest(trees, access.binned)
    fills = access.fills(flat.used)

    @F.arrow_udf("double")
    def score(column: pa.Array) -> pa.Array:
        leaves = flat.leaves(flat.matrix(column, fills))
        return pa.array(constant + flat.weight[leaves].sum(axis=1))

    return score(F.col(access.column))


def forest_leaves(trees: Sequence, access: Access) -> Column:
    """ARRAY<INT>: the node reached in each tree."""
    trees = list(trees)
    if sum(len(t.nodes) for t in trees) <= CASE_NODES:
        return F.expr(f"array({', '.join(tree_case(t, access, at_leaves(t, str)) for t in trees)})").cast("array<int>")
    flat = FlatForest(trees, access.binned)
    fills = access.fills(flat.used)

    @F.arrow_udf("array<int>")
    def reach(column: pa.Array) -> pa.Array:
        leaves = flat.leaves(flat.matrix(column, fills)) - flat.starts[:-1].astype(np.int32)
        offsets = pa.array(np.arange(0, leaves.size + 1, len(trees), dtype=np.int32))
        return pa.ListArray.from_arrays(offsets, pa.array(leaves.astype(np.int32).ravel()))

    return reach(F.col(access.column))
