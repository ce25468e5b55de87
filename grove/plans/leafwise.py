"""Leaf-by-leaf growth over the whole forest with corrections of all leaf weights in between.

The candidates of a step are the leaves of the newest trees plus one unsplit root, which stands for the
next tree. Between two corrections a leaf's histogram changes only when the leaf is split, so one job
collects the histograms of all leaves that lack one together with those of children that are likely to
be asked for, and the choices are replayed on the driver. The root's histogram costs no job: the leaves
of the newest tree partition the rows, so it is the sum of theirs.
"""

from __future__ import annotations

import math
from dataclasses import asdict, dataclass

import numpy as np
from pyspark.sql import functions as F

from grove.forest import Forest, Node, Tree
from grove.functions import gains
from grove.functions.losses import CLASSIFICATION, EXPO_FAMILY, check_loss, loss_sql
from grove.operators.correct import CORRECTIONS, MAX_GRAM, check_gram, gram_update
from grove.operators.penalty import Shape, derivative_matrix, leaf_terms, split_terms
from grove.operators.splits import RANGE_BINS, best_splits, split_candidates, split_gain
from grove.plans.rows import PENDING_NODES, TrainingRows, best_of, frontier_sql

ROOT = (-1, 0)
AHEAD = 16  # leaves split in advance per job


@dataclass
class LeafwiseParams:
    max_leaf: int = 500
    max_tree: int | None = None
    loss: str = "LS"
    algorithm: str = "l2"  # l2, opt or sib
    l2: float = 0.1
    sl2: float | None = None
    l1: float = 0.0
    reg_depth: float = 1.0
    normalize: bool = True
    min_samples_leaf: int | float = 10
    n_iter: int | None = None
    n_tree_search: int = 1
    opt_interval: int = 100
    test_interval: int = 100
    learning_rate: float = 0.5
    max_depth: int | None = None
    max_leaf_tree: int | None = None
    passive_root: bool = False
    internal_nodes: bool = False
    correction: str = "exact"  # or "quadratic": one pass over the rows a sweep, whatever the number of trees
    intercept: bool = False
    exit_delta: float = 0.0
    feature_ratio: float | None = None
    seed: int = 1
    max_bins: int | None = None  # None: a bin for every distinct value

    def check(self) -> None:
        check_loss(self.loss, "leafwise")
        positive = {"max_leaf": self.max_leaf, "opt_interval": self.opt_interval, "test_interval": self.test_interval, "n_tree_search": self.n_tree_search}
        for name, value in positive.items():
            if not isinstance(value, int) or isinstance(value, bool) or value < 1:
                raise ValueError(f"{name} must be a positive integer")
        if self.n_iter is not None and self.n_iter < 1:
            raise ValueError("n_iter must be at least 1")
        if self.algorithm not in ("l2", "opt", "sib"):
            raise ValueError("algorithm must be l2, opt or sib")
        if self.correction not in CORRECTIONS:
            raise ValueError(f"correction must be one of {CORRECTIONS}")
        if self.reg_depth < 1:
            raise ValueError("reg_depth must be at least 1")
        if self.l2 < 0 or self.l1 < 0 or (self.sl2 is not None and self.sl2 < 0):
            raise ValueError("penalties must not be negative")
        if not 0 < self.learning_rate <= 1:
            raise ValueError("learning_rate must be in (0, 1]")
        m = self.min_samples_leaf
        if isinstance(m, float) and not 0 < m <= 0.5 or isinstance(m, int) and m < 1:
            raise ValueError("min_samples_leaf must be an integer from 1 or a float in (0, 0.5]")
        if self.internal_nodes and self.algorithm != "l2":
            raise ValueError("internal_nodes works with the l2 algorithm only")
        if self.max_tree is not None and self.max_tree < 1:
            raise ValueError("max_tree must be positive")

    @property
    def sweeps(self) -> int:
        if self.n_iter is not None:
            return self.n_iter
        return 10 if self.loss == "LS" else 5

    def min_rows(self, n: int) -> int:
        m = self.min_samples_leaf
        return int(np.ceil(m * n)) if isinstance(m, float) else m


def adjusted_test_interval(test: int, opt: int) -> int:
    """The multiple of the correction interval next to ``test``; below it, its least divisor that reaches ``test``."""
    if test > opt:
        return opt * math.floor(test / opt + 0.5)
    return min(d for d in range(test, opt + 1) if opt % d == 0)


class _Timer:
    """Rings when a count has reached the next multiple of its interval."""

    def __init__(self, interval: int, start: int):
        self.interval = interval
        self.next = (start // interval + 1) * interval

    def rings(self, count: int) -> bool:
        if count < self.next:
            return False
        self.next = (count // self.interval + 1) * self.interval
        return True


class LeafwiseTrainer:
    def __init__(
        self, rows: TrainingRows, params: LeafwiseParams, n_rows: int, constant: float, n_features: int,
        init: list[Tree] | None = None, init_constant: float | None = None,
    ):
        params.check()
        self.rows, self.p, self.n_rows = rows, params, n_rows
        self.fixed_constant, self.var_constant = constant, 0.0
        self.n_features = n_features
        facts = rows.df.agg(
            F.sum("weight").alias("w"), F.sum(F.col("weight") * F.col("label")).alias("wy"),
            F.sum(F.col("weight") * F.col("label") * F.col("label")).alias("wyy"),
        ).first()
        self.nn, self.wy, self.wyy = facts["w"], facts["wy"], facts["wyy"] + rows.inner_square
        self.min_rows = params.min_rows(n_rows)
        self.max_tree = params.max_tree or max(1, params.max_leaf // 2)
        self.trees: list[Tree] = init or []
        self.stats: dict[tuple[int, int], np.ndarray] = {}
        self.ready: dict[tuple[int, int], dict | None] = {}  # splits chosen by a job (large histograms)
        self.ahead: dict[tuple[int, int], tuple] = {}
        self.chosen: dict[tuple, dict | None] = {}  # best splits found in self.stats; they hold until weights change
        self.root_rest: np.ndarray | None = None  # the root's sums without the leaf that was split last
        self.scale = 1.0
        self.corrected = True
        self.step = 0
        self.log: list[dict] = []
        self.path: list[Forest] = []
        self._gram: tuple[list, np.ndarray, np.ndarray] | None = None
        if self.trees:
            self.var_constant = (init_constant or 0.0) - constant
            self.leaf_count = sum(len(t.leaves()) for t in self.trees)
            if self.leaf_count >= params.max_leaf or len(self.trees) >= self.max_tree:
                raise ValueError("the initial model is already as large as the final one may be")
            rows.rescore(self.var_constant, self.trees, self._growing())
        else:
            self.leaf_count = 0
        self._refresh_shift()

    # ------------------------------------------------------------ helpers

    def _growing(self) -> int:
        return min(self.p.n_tree_search, len(self.trees))

    def _refresh_shift(self) -> None:
        if self.p.loss == "Expo":
            self.rows.shift = self.rows.mean_margin()
            self.scale = float(np.exp(self.rows.shift))

    def _forget(self) -> None:
        self.stats.clear()
        self.ready.clear()
        self.ahead.clear()
        self.chosen.clear()
        self.root_rest = None

    def _splittable(self, node: Node) -> bool:
        if self.p.max_depth and node.depth >= self.p.max_depth:
            return False
        return node.n >= 2 * self.min_rows

    def _window(self) -> range:
        return range(len(self.trees) - self._growing(), len(self.trees))

    def _node(self, key: tuple[int, int]) -> Node:
        return Node(n=self.n_rows) if key == ROOT else self.trees[key[0]].nodes[key[1]]

    # ------------------------------------------------------------ gains

    def _strength(self) -> tuple[float, float]:
        l2 = self.p.l2 if self.p.sl2 is None else self.p.sl2
        return self.nn * l2 * self.scale, self.nn * self.p.l1 * self.scale

    def _split_facts(self, key: tuple[int, int]) -> dict:
        node = self._node(key)
        facts = {"depth": node.depth, "weight": node.weight}
        if self.p.algorithm != "l2":
            tree = Tree([node]) if key == ROOT else self.trees[key[0]]
            weights = np.array([n.weight for n in tree.nodes])
            terms = split_terms(Shape.of(tree), weights, max(key[1], 0), self.p.algorithm, self.p.reg_depth)
            facts.update(vars(terms))
        return facts

    def _kind(self) -> str:
        if self.p.algorithm != "l2":
            return "minpen"
        if self.p.internal_nodes:
            return "internal"
        return "l1l2" if self.p.l1 > 0 else "l2"

    def _gain(self, key: tuple[int, int]):
        facts, (nlam, nsig), kind = self._split_facts(key), self._strength(), self._kind()
        p, gamma = facts["weight"], self.p.reg_depth
        outer = nlam * gamma ** facts["depth"]
        inner = outer * gamma
        outer1 = nsig * gamma ** facts["depth"]
        inner1 = outer1 * gamma

        def side(g, h):
            if kind == "internal":
                return gains.side_internal(g, h, inner)
            if kind == "l1l2":
                return gains.side_l1l2(g, h, p, outer, inner, outer1, inner1)
            if kind == "minpen":
                return gains.side_penalty(g, h, p, nlam, facts["d_r"], facts["dd_r"])
            return gains.side_l2(g, h, p, outer, inner)

        def gain(gl, hl, gr, hr):
            (a, wl), (b, wr) = side(gl, hl), side(gr, hr)
            total = a + b
            if kind == "minpen":
                d0, d1 = wl - p, wr - p
                change = facts["offset"] + facts["lin"] * (d0 + d1) + facts["quad"] * (d0 * d0 + d1 * d1) / 2 + facts["cross"] * d0 * d1
                total = total - 2 * nlam * change
            return {"gain": total, "w_left": wl, "w_right": wr}

        return gain

    def _allowed(self) -> np.ndarray | None:
        if not self.p.feature_ratio:
            return None
        count = len(self.rows.features)
        keep = max(1, int(count * self.p.feature_ratio))
        mask = np.zeros(count, bool)
        mask[np.random.default_rng((self.p.seed, self.step)).choice(count, keep, replace=False)] = True
        return mask

    def _candidate(self, key: tuple[int, int], allowed) -> dict | None:
        if key in self.ready:
            return self.ready[key]
        if key not in self.stats:
            return None
        memo = (key, None if allowed is None else self.step)
        if memo not in self.chosen:
            self.chosen[memo] = best_of(self.stats[key], self._gain(key), self.min_rows, allowed=allowed)
        return self.chosen[memo]

    # ------------------------------------------------------------ histograms

    def _ensure(self) -> None:
        """Histograms of every open leaf of the window and of the root."""
        window = self._window()
        if not window:
            if ROOT not in self.stats and ROOT not in self.ready:
                self._collect("0", [ROOT], [0.0], {})
            return
        newest = window[-1]
        for t in window:
            tree = self.trees[t]
            missing = [i for i in tree.leaves() if (t, i) not in self.stats and (t, i) not in self.ready]
            if not missing:
                continue
            keys = [(t, i) for i in missing]
            wanted = {i: s for s, i in enumerate(missing)}
            deltas = [0.0] * len(keys)
            early: dict[int, tuple] = {}
            if t == newest and self.p.n_tree_search == 1 and not self.ready:
                for i in self._likely(t, tree):
                    c = self._candidate((t, i), None)
                    if c is None or not self.rows.fits_driver(len(keys) + 2):
                        continue
                    own = 0.0 if self.p.internal_nodes else tree.nodes[i].weight
                    early[i] = (self.rows.features[c["position"]], c["bin"], len(keys), len(keys) + 1)
                    keys += [("ahead", i, 0), ("ahead", i, 1)]
                    deltas += [c["w_left"] - own, c["w_right"] - own]
            self._collect(frontier_sql(tree, self.rows.access, wanted, early), keys, deltas, early)
        if ROOT not in self.stats and ROOT not in self.ready:
            if self.ready:
                self._collect("0", [ROOT], [0.0], {})
            else:
                # Exact for every loss: each leaf's sums are at the current scores of its rows. Only the last split's children are new.
                leaves = self.trees[newest].leaves()
                rest, new = (0.0, leaves) if self.root_rest is None else (self.root_rest, [i for i in leaves if (newest, i) in self.new_leaves])
                self.stats[ROOT] = rest + sum(self.stats[newest, i] for i in new)

    def _likely(self, t: int, tree: Tree) -> list[int]:
        """Open leaves whose split may be asked for next, best first."""
        if self.p.feature_ratio:
            return []
        if self.p.max_leaf_tree and len(tree.leaves()) + 1 >= self.p.max_leaf_tree:
            return []
        known = [i for i in tree.leaves() if (t, i) in self.stats and self._splittable(tree.nodes[i])]
        scored = [(self._candidate((t, i), None), i) for i in known]
        scored = sorted(((c["gain"], i) for c, i in scored if c), reverse=True)
        return [i for _, i in scored[:AHEAD]]

    def _collect(self, slot: str, keys: list, deltas: list[float], early: dict) -> None:
        collected = self.rows.fits_driver(len(keys))
        hist = self.rows.histogram(slot, deltas, totals=collected)
        if collected:
            found = self.rows.collect_histogram(hist, len(keys))
            for s, key in enumerate(keys):
                if key[0] == "ahead":
                    self.ahead[key[1:]] = (early[key[1]][:2], deltas[s], found[s])
                else:
                    self.stats[key] = found[s]
            return
        # Too many cells for the driver: the search itself is part of the job, one row per node returns.
        facts = [{"node": s, **self._split_facts(k)} for s, k in enumerate(keys)]
        names = list(facts[0])
        kinds = {"node": "int", "depth": "int"}
        schema = ", ".join(f"{n} {kinds.get(n, 'double')}" for n in names)
        table = self.rows.spark.createDataFrame(
            [tuple(f[n] if n in kinds else float(f[n]) for n in names) for f in facts], schema
        )
        nlam, nsig = self._strength()
        allowed = self._allowed()
        if allowed is not None:
            hist = hist.filter(F.col("feature").isin([f for f, a in zip(self.rows.features, allowed) if a]))
        widest = max(self.rows.sizes)
        kept = hist.persist() if widest > RANGE_BINS else hist  # many bins are read several times
        scored = split_gain(
            split_candidates(kept, self.min_rows, n_bins=widest), self._kind(), nlam, nsig, self.p.reg_depth, node_facts=table
        )
        for key in keys:
            self.ready[key] = None
        for r in best_splits(scored).collect():
            self.ready[keys[r["node"]]] = {
                "gain": r["gain"], "w_left": r["left_weight"], "w_right": r["right_weight"], "bin": r["bin"],
                "position": self.rows.position[r["feature"]], "n_left": r["n_left"], "n_right": r["n_right"],
            }
        if widest > RANGE_BINS:
            kept.unpersist()

    # ------------------------------------------------------------ growth

    def _search(self) -> tuple[tuple[int, int], dict] | None:
        self._ensure()
        allowed = self._allowed()
        best: tuple[tuple[int, int], dict] | None = None
        for t in self._window():
            tree = self.trees[t]
            leaves = tree.leaves()
            if self.p.max_leaf_tree and len(leaves) >= self.p.max_leaf_tree:
                continue
            for i in leaves:
                if not self._splittable(tree.nodes[i]):
                    continue
                c = self._candidate((t, i), allowed)
                if c and (best is None or c["gain"] > best[1]["gain"]):
                    best = ((t, i), c)
        if (best is None or not self.p.passive_root) and self._splittable(Node(n=self.n_rows)):
            c = self._candidate(ROOT, allowed)
            if c and (best is None or c["gain"] > best[1]["gain"]):
                best = (ROOT, c)
        return best

    def _split(self, key: tuple[int, int], c: dict) -> None:
        at_root = key == ROOT
        if at_root:
            self.trees.append(Tree([Node(n=self.n_rows)]))
            self.rows.pending.append(self.trees[-1])
            key = (len(self.trees) - 1, 0)
        t, i = key
        tree = self.trees[t]
        old = 0.0 if self.p.internal_nodes else tree.nodes[i].weight
        children = tree.split(
            i, self.rows.features[c["position"]], c["bin"], c["gain"],
            {"weight": c["w_left"], "n": c["n_left"]}, {"weight": c["w_right"], "n": c["n_right"]},
        )
        if self.p.internal_nodes:
            # Leaves carry the sum along their path while training; inner weights are kept beside it.
            for child in children:
                tree.nodes[child].own = tree.nodes[child].weight
                tree.nodes[child].weight += tree.nodes[i].weight
        else:
            tree.nodes[i].weight = 0.0
        self.leaf_count += 2 if at_root else 1
        self.corrected = False
        self.step += 1
        parent, root = self.stats.pop(key, None), self.stats.pop(ROOT, None)
        self.chosen = {} if self.p.algorithm != "l2" else {k: x for k, x in self.chosen.items() if k[0] not in (key, ROOT)}
        self.new_leaves = {(t, child) for child in children}
        self.root_rest = root - parent if root is not None and parent is not None and not at_root else None
        if at_root:
            self.rows.settle(self.var_constant, self.trees, self._growing())
        if at_root or self.p.n_tree_search > 1 or self.ready:
            self._forget()  # every candidate is searched anew
        else:
            chosen = (tree.nodes[i].feature, c["bin"])
            for side, child in enumerate(children):
                kept = self.ahead.pop((i, side), None)
                step = (c["w_left"], c["w_right"])[side] - old
                if kept and kept[0] == chosen and kept[1] == step:
                    self.stats[t, child] = kept[2]

    def run(self) -> list[Forest]:
        """Grow to the end; returns the path of models, the last one being the final forest."""
        p = self.p
        opt = _Timer(p.opt_interval, self.leaf_count)
        test = _Timer(adjusted_test_interval(p.test_interval, p.opt_interval), self.leaf_count)
        while True:
            best = self._search()
            if best is None or (best[0] == ROOT and len(self.trees) >= self.max_tree):
                break
            self._split(*best)
            if self.leaf_count >= p.max_leaf:
                break
            if opt.rings(self.leaf_count):
                self.correct()
            if test.rings(self.leaf_count):
                self._emit()
        if not self.corrected:
            self.correct()
        self._emit()
        return self.path

    def _emit(self) -> None:
        """A model of the path: a copy whose weights are corrected as if training ended here."""
        if self.corrected:
            trees, constant = self.trees, self.var_constant
            forest = self._forest(trees, constant)
        else:
            kept = [[(n.weight, getattr(n, "own", 0.0)) for n in t.nodes] for t in self.trees]
            constant, df, pending = self.var_constant, self.rows.df, self.rows.pending
            shift, scale = self.rows.shift, self.scale
            self.correct(branch=True)
            forest = self._forest(self.trees, self.var_constant)
            for tree, weights in zip(self.trees, kept):
                for node, (w, own) in zip(tree.nodes, weights):
                    node.weight, node.own = w, own
            self.var_constant, self.rows.pending = constant, pending
            self.rows.shift, self.scale = shift, scale
            if self.rows.df is not df:
                self.rows.df.unpersist()  # never the fixed rows: a branch that moved has its own scores
                self.rows.df = df
        self.path.append(forest)

    def _forest(self, trees: list[Tree], constant: float) -> Forest:
        forest = Forest(
            trees, self.fixed_constant + constant, self.n_features, "zero" if self.rows.sparse else "lowest",
            self.p.loss, "leafwise", seq=len(self.path) + 1, config=asdict(self.p),
        ).copy()
        for tree in forest.trees:
            for node in tree.nodes:
                if node.left >= 0:
                    node.weight = 0.0
        return forest.set_cuts(self.rows.bins)

    # ------------------------------------------------------------ correction

    def _groups(self) -> list[tuple[int, list[int]]]:
        """Disjoint nodes of one tree that may be updated together, in sweep order."""
        if not self.p.internal_nodes:
            return [(t, tree.leaves()) for t, tree in enumerate(self.trees)]
        out = []
        for t, tree in enumerate(self.trees):
            for d in range(1, tree.max_depth() + 1):
                out.append((t, [i for i, n in enumerate(tree.nodes) if n.depth == d]))
        return out

    def correct(self, branch: bool = False) -> None:
        """Sweeps of damped Newton steps over the weights of all trees."""
        if not self.trees:
            self.corrected = True
            return
        groups = self._groups()
        columns = [(t, i) for t, group in groups for i in group]
        own = "own" if self.p.internal_nodes else "weight"
        w = np.array([getattr(self.trees[t].nodes[i], own, 0.0) for t, i in columns])
        if self.p.correction == "quadratic":
            w = self._correct_by_quadratic(groups, columns, w, branch)
        elif self.p.loss == "LS" and len(columns) <= MAX_GRAM:
            w = self._correct_by_gram(groups, columns, w)
        else:
            w = self._correct_by_jobs(groups, columns, w, branch)
        self._write_weights(columns, w)
        if not branch:
            self.rows.rescore(self.var_constant, self.trees, self._growing())
            self._refresh_shift()
            self._forget()
            self.corrected = True

    def _write_weights(self, columns: list, w: np.ndarray) -> None:
        for (t, i), value in zip(columns, w):
            node = self.trees[t].nodes[i]
            if self.p.internal_nodes:
                node.own = float(value)
            else:
                node.weight = float(value)
        if self.p.internal_nodes:
            for tree in self.trees:
                for node in tree.nodes:  # parents come before their children
                    above = tree.nodes[node.parent].weight if node.parent >= 0 else 0.0
                    node.weight = above + getattr(node, "own", 0.0)

    def _steps(self, t: int, group: list[int], g: np.ndarray, h: np.ndarray, w: np.ndarray, nlam: float, nsig: float) -> np.ndarray:
        """New weights of one group from its derivative sums."""
        eta, limit = self.p.learning_rate, 1.0 if self.p.loss in EXPO_FAMILY else 0.0
        depth = np.array([self.trees[t].nodes[i].depth for i in group], float)
        power = self.p.reg_depth**depth
        if self.p.algorithm != "l2":
            shape = Shape.of(self.trees[t])
            matrix = derivative_matrix(shape, self.p.algorithm, self.p.reg_depth)
            factor = self.p.reg_depth ** shape.depth.astype(float)
            new = w.copy()
            for k in range(len(group)):  # the penalty moves with every leaf
                d_r, dd_r = leaf_terms(matrix, new, factor)
                scale = h[k] + nlam * dd_r[k]
                delta = (g[k] - nlam * d_r[k]) * eta / (scale if scale != 0 else 1.0)
                new[k] += np.clip(delta, -limit, limit) if limit else delta
            return new
        scale = h + nlam * power
        scale = np.where(scale == 0, 1.0, scale)
        delta = (g - nlam * power * w) * eta / scale
        if nsig > 0:
            pull = nsig * power * eta / scale
            pulled = np.where(w + delta > 0, delta - pull, delta + pull)
            delta = np.where((w + delta) * (w + pulled) <= 0, -w, pulled)
        if limit:
            delta = np.clip(delta, -limit, limit)
        return w + delta

    def _strengths_now(self, shift: float) -> tuple[float, float]:
        scale = float(np.exp(shift)) if self.p.loss == "Expo" else 1.0
        return self.nn * self.p.l2 * scale, self.nn * self.p.l1 * scale

    def _correct_by_gram(self, groups: list, columns: list, w: np.ndarray) -> np.ndarray:
        """LS needs the rows once: only leaves that are new since the last correction are counted."""
        shared, target = self._gram_matrix(columns)
        cover = np.diag(shared).copy()
        nlam, nsig = self._strengths_now(0.0)
        spans, lo = [], 0
        for t, group in groups:
            spans.append((t, group, slice(lo, lo + len(group))))
            lo += len(group)
        const = self.var_constant
        for sweep in range(self.p.sweeps):
            moved = []
            for t, group, span in spans:
                g = target[span] - shared[span] @ w - const * cover[span]
                new = self._steps(t, group, g, cover[span], w[span], nlam, nsig)
                moved.append(new - w[span])
                w[span] = new
            if self.p.intercept:
                delta = (self.wy - cover @ w - const * self.nn - nlam * const) * self.p.learning_rate / (self.nn + nlam)
                const += delta
                moved.append(np.array([delta]))
            residual = self.wyy - 2 * (w @ target) - 2 * const * self.wy + w @ shared @ w + 2 * const * (cover @ w) + const * const * self.nn
            if self._record(sweep, w, moved, residual / 2 / self.nn):
                break
        self.var_constant = const
        return w

    def _gram_matrix(self, columns: list) -> tuple[np.ndarray, np.ndarray]:
        old_columns, old_shared, old_target = self._gram or ([], np.zeros((0, 0)), np.zeros(0))
        at = {c: i for i, c in enumerate(old_columns)}
        kept = [i for i, c in enumerate(columns) if c in at]
        new = [i for i, c in enumerate(columns) if c not in at]
        shared, target = np.zeros((len(columns), len(columns))), np.zeros(len(columns))
        source = [at[columns[i]] for i in kept]
        shared[np.ix_(kept, kept)] = old_shared[np.ix_(source, source)]
        target[kept] = old_target[source]
        if new:
            block, wy = gram_update(self.rows.moments(), self.trees, self.rows.access, columns, new)
            shared[new, :] = block
            shared[:, new] = block.T
            target[new] = wy
        self._gram = (list(columns), shared, target)
        return shared, target

    def _correct_by_jobs(self, groups: list, columns: list, w: np.ndarray, branch: bool) -> np.ndarray:
        """One job per tree and sweep; a tree's leaves are disjoint, so each update is exact."""
        rows = self.rows
        kept_df = rows.df
        lo, spans = 0, []
        for t, group in groups:
            spans.append((t, group, slice(lo, lo + len(group))))
            lo += len(group)
        for sweep in range(self.p.sweeps):
            if self.p.loss == "Expo":
                rows.shift = rows.mean_margin()
            nlam, nsig = self._strengths_now(rows.shift)
            moved = []
            for t, group, span in spans:
                g, h = rows.group_sums(self.trees[t], group)
                new = self._steps(t, group, g, h, w[span], nlam, nsig)
                delta = new - w[span]
                moved.append(delta)
                w[span] = new
                change = _change_tree(self.trees[t], group, delta)
                rows.pending = [*rows.pending, change]
                if sum(len(c.nodes) for c in rows.pending) > PENDING_NODES:
                    self._write_weights(columns, w)
                    rows.rescore(self.var_constant, self.trees, 0, keep_old=branch and rows.df is kept_df)
            if self.p.intercept:
                g, h = rows.derivative_sql()
                sums = rows.scored().selectExpr(f"sum({g}) AS g", f"sum({h}) AS h").first()
                delta = (sums["g"] - nlam * self.var_constant) * self.p.learning_rate / (sums["h"] + nlam)
                self.var_constant += delta
                moved.append(np.array([delta]))
                rows.pending = [*rows.pending, Tree([Node(weight=delta)])]
            mean_loss, extra = self._monitor()
            if self._record(sweep, w, moved, mean_loss, extra):
                break
        return w

    def _correct_by_quadratic(self, groups: list, columns: list, w: np.ndarray, branch: bool) -> np.ndarray:
        """One job a sweep: the loss is expanded to second order at the sweep's start, and the sweep runs on its leaf Gram matrix.

        Exact under LS. Elsewhere a sweep's later trees see the change that earlier ones made to the gradient, not to the curvature.
        """
        check_gram(len(columns))
        rows, kept_df = self.rows, self.rows.df
        starts = np.cumsum([0, *(len(group) for _, group in groups)])
        for sweep in range(self.p.sweeps):
            if self.p.loss == "Expo":
                rows.shift = rows.mean_margin()
            nlam, nsig = self._strengths_now(rows.shift)
            curve, slope = gram_update(rows.slopes(), self.trees, rows.access, columns, list(range(len(columns))))
            before, cover, moved = w.copy(), np.diag(curve).copy(), []
            for k, (t, group) in enumerate(groups):
                span = slice(starts[k], starts[k + 1])
                g = slope[span] - curve[span] @ (w - before)
                new = self._steps(t, group, g, cover[span], w[span], nlam, nsig)
                moved.append(new - w[span])
                w[span] = new
            self._write_weights(columns, w)
            rows.rescore(self.var_constant, self.trees, 0, keep_old=branch and rows.df is kept_df)
            if self.p.intercept:
                sums = rows.slopes().agg(F.sum("moment").alias("g"), F.sum("weight").alias("h")).first()
                delta = (sums["g"] - nlam * self.var_constant) * self.p.learning_rate / (sums["h"] + nlam)
                self.var_constant += delta
                moved.append(np.array([delta]))
                rows.pending = [*rows.pending, Tree([Node(weight=delta)])]
            mean_loss, extra = self._monitor()
            if self._record(sweep, w, moved, mean_loss, extra):
                break
        return w

    def _monitor(self) -> tuple[float, dict]:
        loss = loss_sql(self.p.loss, "_s", "label")
        row = self.rows.scored().selectExpr(
            f"sum(weight * ({loss})) / {self.nn!r}D AS loss", "sum(IF(_s > 0, n, 0)) AS called",
            "sum(IF(label > 0, n, 0)) AS positive", "sum(IF(_s > 0 AND label > 0, n, 0)) AS hits",
        ).first()
        extra = {}
        if self.p.loss in CLASSIFICATION:
            hits = row["hits"] or 0
            extra = {"precision": hits / (row["called"] or 1), "recall": hits / (row["positive"] or 1)}
        return row["loss"], extra

    def _record(self, sweep: int, w: np.ndarray, moved: list, mean_loss: float, extra: dict | None = None) -> bool:
        changes = np.abs(np.concatenate(moved))
        changed = np.count_nonzero(changes)
        delta = float(changes.sum() / changed) if changed else 0.0
        self.log.append({
            "step": self.step, "sweep": sweep + 1, "trees": len(self.trees), "leaves": self.leaf_count, "delta": delta,
            "loss": float(mean_loss), "abs_weight": float(np.abs(w).sum()), "sq_weight": float((w * w).sum()),
            "precision": (extra or {}).get("precision"), "recall": (extra or {}).get("recall"),
        })
        return self.p.exit_delta > 0 and delta < self.p.exit_delta


def _change_tree(tree: Tree, group: list[int], delta: np.ndarray) -> Tree:
    """The tree cut at ``group``, holding only the changes of its weights."""
    change = {i: float(d) for i, d in zip(group, delta)}
    out = Tree([])

    def copy(at: int, parent: int, depth: int) -> int:
        node = tree.nodes[at]
        here = len(out.nodes)
        stop = at in change or node.left < 0
        out.nodes.append(Node(parent, depth, node.feature, node.cut, node.bin, weight=change.get(at, 0.0) if stop else 0.0))
        if not stop:
            out.nodes[here].left = copy(node.left, here, depth + 1)
            out.nodes[here].right = copy(node.right, here, depth + 1)
        return here

    copy(0, -1, 0)
    return out
