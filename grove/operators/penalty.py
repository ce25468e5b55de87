"""Tree-structured penalties: every node carries an implied weight, and all of them are penalised.

The implied weights depend linearly on the leaf weights, so a tree is described by one matrix: the
derivative of each node's implied weight by each leaf's weight. These are model-sized numbers.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

PASSES = 20  # fixed value: averaging passes of the "opt" penalty


@dataclass
class Shape:
    """Structure of one tree as arrays."""

    parent: np.ndarray
    left: np.ndarray
    right: np.ndarray
    depth: np.ndarray

    @staticmethod
    def of(tree) -> Shape:
        nodes = tree.nodes
        return Shape(*(np.array([getattr(n, c) for n in nodes], int) for c in ("parent", "left", "right", "depth")))

    def leaves(self) -> np.ndarray:
        return np.flatnonzero(self.left < 0)

    def with_split(self, at: int) -> Shape:
        """The tree as it would be if leaf ``at`` had two children, appended at the end."""
        n = len(self.parent)
        left, right = self.left.copy(), self.right.copy()
        left[at], right[at] = n, n + 1
        return Shape(
            np.append(self.parent, [at, at]),
            np.append(left, [-1, -1]),
            np.append(right, [-1, -1]),
            np.append(self.depth, [self.depth[at] + 1] * 2),
        )


def derivative_matrix(shape: Shape, kind: str, gamma: float, first: int | None = None) -> np.ndarray:
    """Rows: leaves in id order; columns: implied weight of each node. ``first`` is averaged first."""
    leaves = shape.leaves()
    n = len(shape.parent)
    if kind == "sib":
        out = np.zeros((len(leaves), n))
        for i, at in enumerate(leaves):
            share = 0.5
            while at >= 0:
                up = shape.parent[at]
                out[i, at] = share if up >= 0 else 2 * share
                if up >= 0:
                    sibling = shape.right[up] if shape.left[up] == at else shape.left[up]
                    out[i, sibling] = -share
                at, share = up, share / 2
        return out
    if kind != "opt":
        raise ValueError(f"unknown penalty {kind!r}")
    level = np.zeros((n, len(leaves)))
    level[leaves, np.arange(len(leaves))] = 1.0
    inner = [i for i in range(n) if shape.left[i] >= 0 and i != first]
    order = ([first] if first is not None else []) + inner
    for _ in range(PASSES if len(order) > 1 else 1):
        for i in order:
            up = level[shape.parent[i]] if shape.parent[i] >= 0 else 0.0
            level[i] = (up + gamma * (level[shape.left[i]] + level[shape.right[i]])) / (1 + 2 * gamma)
    above = np.where((shape.parent >= 0)[:, None], level[shape.parent], 0.0)
    return (level - above).T


def leaf_terms(matrix: np.ndarray, weights: np.ndarray, factor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and second derivative of the penalty by each leaf's weight."""
    implied = weights @ matrix
    return matrix @ (factor * implied), (matrix * matrix) @ factor


@dataclass
class SplitTerms:
    """Penalty change of giving two new leaves the weights ``p + d0`` and ``p + d1``:
    ``offset + lin (d0 + d1) + quad (d0^2 + d1^2) / 2 + cross d0 d1``."""

    d_r: float
    dd_r: float
    offset: float
    lin: float
    quad: float
    cross: float


def split_terms(shape: Shape, weights: np.ndarray, at: int, kind: str, gamma: float) -> SplitTerms:
    """``weights`` by node id (only leaves count)."""
    now = derivative_matrix(shape, kind, gamma)
    factor = gamma ** shape.depth.astype(float)
    implied = weights[shape.leaves()] @ now
    then_shape = shape.with_split(at)
    then = derivative_matrix(then_shape, kind, gamma, first=at)
    then_factor = gamma ** then_shape.depth.astype(float)
    then_weights = np.append(weights, [weights[at]] * 2)
    leaves = then_shape.leaves()
    then_implied = then_weights[leaves] @ then
    left = then[np.searchsorted(leaves, len(weights))]
    right = then[np.searchsorted(leaves, len(weights) + 1)]
    lin = float(np.sum(then_factor * then_implied * left))
    quad = float(np.sum(then_factor * left * left))
    return SplitTerms(
        d_r=lin,
        dd_r=quad,
        offset=float(np.sum(then_factor * then_implied**2) - np.sum(factor * implied**2)) / 2,
        lin=lin,
        quad=quad,
        cross=float(np.sum(then_factor * left * right)),
    )


def node_penalty(nodes: DataFrame, kind: str, gamma: float = 1.0) -> DataFrame:
    """Per leaf of a node table: ``d_r`` and ``dd_r``; one small group per tree."""

    def per_tree(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("node")
        shape = Shape(*(pdf[c].to_numpy(int) for c in ("parent", "left", "right", "depth")))
        leaves = shape.leaves()
        matrix = derivative_matrix(shape, kind, gamma)
        d_r, dd_r = leaf_terms(matrix, pdf["weight"].to_numpy(float)[leaves], gamma ** shape.depth.astype(float))
        out = pdf.iloc[leaves][["model_id", "class_id", "tree", "node"]].copy()
        return out.assign(d_r=d_r, dd_r=dd_r)

    return nodes.groupBy("model_id", "class_id", "tree").applyInPandas(
        per_tree, "model_id string, class_id int, tree int, node int, d_r double, dd_r double"
    )
