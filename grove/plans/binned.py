"""Tree-by-tree growth: best-first trees from level-wise jobs, then corrections of older trees.

A node's gain depends only on its own rows and its own starting prediction, so open nodes are scored
ahead of need, one job per level, and the best-first order with its stopping rules is replayed on the
driver afterwards.
"""

from __future__ import annotations

import copy
from dataclasses import asdict, dataclass

import numpy as np
from pyspark.sql import functions as F

from grove.forest import Forest, Node, Tree
from grove.functions import gains
from grove.functions.losses import check_loss
from grove.operators.correct import CORRECTIONS, MAX_GRAM, gram_update
from grove.operators.splits import BINNED_TIE, best_splits, split_candidates, split_gain
from grove.plans.leafwise import _change_tree
from grove.plans.rows import TrainingRows, best_of, frontier_sql

# How many older updates and how many of the newest trees one correction covers.
OLDER_UPDATES = 80
NEWEST_TREES = 20


@dataclass
class BinnedParams:
    n_estimators: int = 500
    max_depth: int = 6
    max_leaf: int = 50
    tree_gain_ratio: float = 1.0
    min_samples_leaf: int | float = 5
    loss: str = "LS"
    l1: float = 1.0
    l2: float = 1000.0
    opt_algorithm: str = "corrective"  # or "greedy": plain boosting with learning_rate
    learning_rate: float = 0.001
    correction: str = "exact"  # or "quadratic": one pass over the rows a correction, whatever the number of trees
    save_frequency: int | None = None
    max_bins: int | None = None  # None: 65,000 for arrays, 200 for maps
    min_child_weight: float = 5.0
    data_l2: float = 2.0
    sparse_max_features: int = 80_000
    sparse_min_occurrences: int = 5

    def check(self) -> None:
        check_loss(self.loss, "binned")
        for name in ("n_estimators", "max_depth", "max_leaf", "max_bins"):
            value = getattr(self, name)
            if name == "max_bins" and value is None:
                continue
            if not isinstance(value, int) or isinstance(value, bool) or value < 1:
                raise ValueError(f"{name} must be a positive integer")
        if self.correction not in CORRECTIONS:
            raise ValueError(f"correction must be one of {CORRECTIONS}")
        if not 0 < self.tree_gain_ratio <= 1:
            raise ValueError("tree_gain_ratio must be in (0, 1]")
        if self.l1 < 0 or self.l2 < 0 or self.data_l2 < 0:
            raise ValueError("penalties must not be negative")
        if self.learning_rate <= 0:
            raise ValueError("learning_rate must be positive")
        if self.opt_algorithm not in ("corrective", "greedy"):
            raise ValueError("opt_algorithm must be corrective or greedy")
        m = self.min_samples_leaf
        if isinstance(m, float) and not 0 < m <= 0.5 or isinstance(m, int) and m < 1:
            raise ValueError("min_samples_leaf must be an integer from 1 or a float in (0, 0.5]")

    def min_sample(self, n: int) -> float:
        m = self.min_samples_leaf
        return float(np.ceil(m * n)) if isinstance(m, float) else float(m)


def replay(scored: dict[str, dict | None], p: BinnedParams) -> tuple[list[str], list[str]]:
    """Best-first growth over a table of scored nodes: the paths split, in order, and the leaves that lack a score to go on.

    Growth ends at ``max_leaf`` leaves, without any gain, or once the open gains sum to less than ``tree_gain_ratio`` of the root's.
    """
    leaves, order = [""], []
    while True:
        lacking = [x for x in leaves if x not in scored and len(x) < p.max_depth]
        if lacking:
            return order, lacking
        open_ = {x: scored[x]["gain"] for x in leaves if scored.get(x)}
        spent = bool(order) and sum(open_.values()) < p.tree_gain_ratio * scored[""]["gain"]
        if not open_ or spent or len(leaves) >= p.max_leaf:
            return order, []
        best = max(open_, key=open_.get)  # the oldest of equal ones
        order.append(best)
        leaves = [x for x in leaves if x != best] + [best + "0", best + "1"]


class BinnedTrainer:
    """Trees of one class, or of ``classes`` one-vs-rest problems in one pass over the rows.

    With classes, every row is there once per class with that class's label and bins, and its last bin is the class.
    Each tree of the forest is then a fixed skeleton of class tests with one grown subtree per class: every job
    (histograms, corrections, scores) serves all classes at once, and each class's subtree is grown, limited and
    corrected exactly as its own forest would be.
    """

    def __init__(
        self, rows: TrainingRows, params: BinnedParams, n_rows: int, n_features: int, init: list[Tree] | None = None,
        classes: int = 1, class_bins: list | None = None,
    ):
        params.check()
        self.rows, self.p, self.n_rows, self.n_features = rows, params, n_rows, n_features
        self.classes, self.class_bins = classes, class_bins
        self.class_feature = len(rows.features) - 1 if classes > 1 else None
        self.min_sample = params.min_sample(n_rows)
        self.trees: list[Tree] = init or []
        self.cursor = 0
        self.path: list[Forest] = []
        self.paths: list[list[Forest]] = [[] for _ in range(classes)]
        self.log: list[dict] = []
        self._shared: np.ndarray = np.zeros((0, 0))
        self._target: np.ndarray = np.zeros(0)
        self._columns: list[tuple[int, int]] = []
        if self.trees:
            if classes > 1:
                raise ValueError("an initial model trains one class at a time")
            if len(self.trees) >= params.n_estimators:
                raise ValueError("the initial model is already as large as the final one may be")
            rows.rescore(0.0, self.trees, 0)

    def _skeleton(self) -> tuple[Tree, list[int]]:
        """The class tests of a tree and the node that each class's subtree grows from: class c goes left at test c."""
        tree = Tree([Node(n=self.n_rows * self.classes)])
        roots, at = [], 0
        for c in range(self.classes - 1):
            left, right = tree.split(at, self.class_feature, c, 0.0, {"n": self.n_rows}, {"n": self.n_rows * (self.classes - 1 - c)})
            roots.append(left)
            at = right
        roots.append(at)
        return tree, roots

    # ------------------------------------------------------------ one tree

    def _score(self, tree: Tree, at: list[dict[str, int]], scored: list[dict], wanted: list[list[str]], early: list[list[str]]) -> None:
        """Add to each class's ``scored`` the best splits of its leaves ``wanted`` and of both children of its scored
        leaves ``early``, all in one job. Nodes go by their path below the class's root: a digit a level, 0 for left."""
        keys = [(c, x) for c in range(self.classes) for x in [*wanted[c], *(y + side for y in early[c] for side in "01")]]
        slots, ahead, starts = {}, {}, []  # slots in the order of keys; starts: the weight each slot's scores start from
        for c in range(self.classes):
            for x in wanted[c]:
                slots[at[c][x]] = len(starts)
                starts.append(tree.nodes[at[c][x]].weight)
            for x in early[c]:
                found = scored[c][x]
                ahead[at[c][x]] = (self.rows.features[found["position"]], found["bin"], len(starts), len(starts) + 1)
                starts += [found["w_left"], found["w_right"]]
        collected = self.rows.fits_driver(len(keys))
        sql = frontier_sql(tree, self.rows.access, slots, ahead)
        hist = self.rows.histogram(sql, starts, totals=collected)
        l1, l2 = self.p.l1, self.p.l2
        for c, x in keys:
            scored[c][x] = None
        if collected:
            found = self.rows.collect_histogram(hist, len(keys))
            for s, (c, x) in enumerate(keys):
                p0 = starts[s]
                total = found[s][:2, 0, :].sum(axis=1)
                whole, x0 = gains.solve_l1l2(total[1], p0 * total[1] + total[0], l1, l2)

                def gain(gl, hl, gr, hr, p0=p0, whole=whole, x0=x0):
                    a, xl = gains.solve_l1l2(hl, p0 * hl + gl, l1, l2)
                    b, xr = gains.solve_l1l2(hr, p0 * hr + gr, l1, l2)
                    return {"gain": whole - (a + b), "w_left": xl, "w_right": xr, "w_node": float(x0)}

                scored[c][x] = best_of(found[s], gain, min_sample=self.min_sample, tie=BINNED_TIE)
            return
        facts = self.rows.spark.createDataFrame(
            [(s, 0, float(w)) for s, w in enumerate(starts)], "node int, depth int, weight double"
        )
        cand = split_candidates(hist, min_sample=self.min_sample, n_bins=max(self.rows.sizes))
        cuts = split_gain(cand, "binned", l1=l1, l2=l2, node_facts=facts)
        for r in best_splits(cuts, BINNED_TIE).collect():
            c, x = keys[r["node"]]
            scored[c][x] = {
                "gain": r["gain"], "w_left": r["left_weight"], "w_right": r["right_weight"], "w_node": r["node_weight"],
                "position": self.rows.position[r["feature"]], "bin": r["bin"], "n_left": r["n_left"], "n_right": r["n_right"],
            }

    def _built(self, order: list[list[str]], scored: list[dict]) -> tuple[Tree, list[dict[str, int]]]:
        """The tree after each class's splits ``order``, and the node number of each path of each class. Scored nodes
        have their own best weight."""
        if self.classes == 1:
            tree, roots = Tree([Node(n=self.n_rows)]), [0]
        else:
            tree, roots = self._skeleton()
        at = [{"": r} for r in roots]
        for c in range(self.classes):
            for x in order[c]:
                found = scored[c][x]
                at[c][x + "0"], at[c][x + "1"] = tree.split(
                    at[c][x], self.rows.features[found["position"]], found["bin"], found["gain"],
                    {"weight": found["w_left"], "n": found["n_left"]}, {"weight": found["w_right"], "n": found["n_right"]},
                )
            for x, i in at[c].items():
                if scored[c].get(x):
                    tree.nodes[i].weight = scored[c][x]["w_node"]
        return tree, at

    def grow_tree(self) -> Tree:
        """Rounds of a job that scores what each class's replay lacks, with one level ahead below every scored leaf.

        A class whose replay has ended waits for the others without adding to the jobs.
        """
        k = self.classes
        scored: list[dict[str, dict | None]] = [{} for _ in range(k)]
        order, lacking = [[] for _ in range(k)], [[""] for _ in range(k)]
        while any(lacking):
            tree, at = self._built(order, scored)
            early = [
                [x for x in at[c] if scored[c].get(x) and x + "0" not in at[c] and x + "0" not in scored[c] and len(x) + 1 < self.p.max_depth]
                if lacking[c] else []
                for c in range(k)
            ]
            self._score(tree, at, scored, lacking, early)
            for c in range(k):
                if lacking[c]:
                    order[c], lacking[c] = replay(scored[c], self.p)
        tree, _ = self._built(order, scored)
        for node in tree.nodes:
            if node.left >= 0:
                node.weight = 0.0
        return tree

    # ------------------------------------------------------------ the forest

    def run(self) -> list[Forest]:
        p = self.p
        corrective = p.opt_algorithm == "corrective"
        while len(self.trees) < p.n_estimators:
            tree = self.grow_tree()
            if not corrective:
                for node in tree.nodes:
                    node.weight *= p.learning_rate
            self.trees.append(tree)
            self.rows.pending = [*self.rows.pending, copy.deepcopy(tree)]  # later changes are added apart
            if corrective:
                self.correct()
            self.rows.settle(0.0, self.trees, 0)
            if p.save_frequency and len(self.trees) % p.save_frequency == 0 and len(self.trees) < p.n_estimators:
                self._emit()
        self._emit()
        return self.path if self.classes == 1 else self.paths

    def _emit(self) -> None:
        if self.classes == 1:
            forest = Forest(
                self.trees, 0.0, self.n_features, "lowest", self.p.loss, "binned", seq=len(self.path) + 1, config=asdict(self.p)
            ).copy()
            self.path.append(forest.set_cuts(self.rows.bins))
            return
        _, roots = self._skeleton()
        for c, root in enumerate(roots):
            trees = [_subtree(tree, root) for tree in self.trees]
            forest = Forest(trees, 0.0, self.n_features, "lowest", self.p.loss, "binned", class_id=c, seq=len(self.paths[c]) + 1, config=asdict(self.p))
            self.paths[c].append(forest.copy().set_cuts(self.class_bins[c]))

    def _order(self) -> list[int]:
        """Trees to update: the next few in turn as far as they are older, then the newest in order."""
        count = len(self.trees)
        oldest_new = max(0, count - NEWEST_TREES)
        turn = [k % count for k in range(self.cursor, self.cursor + OLDER_UPDATES)]
        self.cursor += OLDER_UPDATES
        return [t for t in turn if t < oldest_new] + list(range(oldest_new, count))

    def correct(self) -> None:
        order = self._order()
        total = sum(len(t.leaves()) for t in self.trees)
        before = [[n.weight for n in t.nodes] for t in self.trees]
        if self.p.correction == "quadratic" or self.p.loss == "LS" and total > MAX_GRAM:
            self._correct_by_quadratic(order)  # exact under LS: one pass a correction at any size
        elif self.p.loss == "LS":
            self._correct_by_gram(order)
        else:
            self._correct_by_jobs(order)
            return
        changed = []
        for tree, old in zip(self.trees, before):
            leaves = tree.leaves()
            delta = np.array([tree.nodes[i].weight - old[i] for i in leaves])
            if np.any(delta):
                changed.append(_change_tree(tree, leaves, delta))
        self.rows.pending = [*self.rows.pending, *changed]

    def _update(self, tree: Tree, leaves: list[int], g: np.ndarray, h: np.ndarray) -> np.ndarray:
        w = np.array([tree.nodes[i].weight for i in leaves])
        _, x = gains.solve_l1l2(h, w * h + g, self.p.l1, self.p.l2)
        for i, value in zip(leaves, x):
            tree.nodes[i].weight = float(value)
        return x - w

    def _correct_by_gram(self, order: list[int]) -> None:
        """LS: one job counts what the newest tree shares with all others; the sweep needs no rows."""
        columns = [(t, i) for t, tree in enumerate(self.trees) for i in tree.leaves()]
        known = len(self._columns)
        new = list(range(known, len(columns)))
        block, wy = gram_update(self.rows.moments(), self.trees, self.rows.access, columns, new)
        shared, target = np.zeros((len(columns), len(columns))), np.zeros(len(columns))
        shared[:known, :known], target[:known] = self._shared, self._target
        shared[new, :], shared[:, new], target[new] = block, block.T, wy
        self._columns, self._shared, self._target = columns, shared, target
        w = np.array([self.trees[t].nodes[i].weight for t, i in columns])
        starts = np.cumsum([0] + [len(t.leaves()) for t in self.trees])
        cover = np.diag(shared)
        for t in order:
            span = slice(starts[t], starts[t + 1])
            g = target[span] - shared[span] @ w
            w[span] += self._update(self.trees[t], self.trees[t].leaves(), g, cover[span])

    def _correct_by_quadratic(self, order: list[int]) -> None:
        """Gradient and curvature of the leaves of the trees in turn at the current scores; the updates run on that
        expansion. Exact under LS. Only those trees' columns are built (at most ``OLDER_UPDATES + NEWEST_TREES`` trees),
        in blocks of rows, so neither the number of trees nor of rows makes it refuse or take more jobs."""
        turn = sorted(set(order))
        trees = [self.trees[t] for t in turn]
        columns = [(k, i) for k, tree in enumerate(trees) for i in tree.leaves()]
        curve, slope = gram_update(self.rows.slopes(), trees, self.rows.access, columns, list(range(len(columns))))
        starts = dict(zip(turn, np.cumsum([0] + [len(t.leaves()) for t in trees])))
        cover, moved = np.diag(curve), np.zeros(len(columns))
        for t in order:
            span = slice(starts[t], starts[t] + len(self.trees[t].leaves()))
            g = slope[span] - curve[span] @ moved
            moved[span] += self._update(self.trees[t], self.trees[t].leaves(), g, cover[span])

    def _correct_by_jobs(self, order: list[int]) -> None:
        rows = self.rows
        for t in order:
            tree = self.trees[t]
            leaves = tree.leaves()
            g, h = rows.group_sums(tree, leaves)
            change = _change_tree(tree, leaves, self._update(tree, leaves, g, h))
            rows.pending = [*rows.pending, change]
            rows.settle(0.0, self.trees, 0)


def _subtree(tree: Tree, root: int) -> Tree:
    """The nodes below ``root`` (itself included) as a tree of their own, numbered in the order they were made."""
    inside, stack = [], [root]
    while stack:
        i = stack.pop()
        inside.append(i)
        if tree.nodes[i].left >= 0:
            stack += [tree.nodes[i].left, tree.nodes[i].right]
    inside.sort()
    number = {i: k for k, i in enumerate(inside)}
    out, depth = Tree([copy.copy(tree.nodes[i]) for i in inside]), tree.nodes[root].depth
    for node in out.nodes:
        node.parent = number.get(node.parent, -1)
        node.depth -= depth
        if node.left >= 0:
            node.left, node.right = number[node.left], number[node.right]
    return out
