"""Plain row-by-row versions of the engines, for small fixtures only."""

from __future__ import annotations

import numpy as np


def derivs(loss, s, y, shift=0.0):
    if loss == "LS":
        return y - s, np.ones_like(s)
    if loss == "Log":
        e = np.exp(-s * y)
        return y * e / (1 + e), e / (1 + e) ** 2
    if loss == "Expo":
        e = np.exp(-(s * y - shift))
        return y * e, e
    raise ValueError(loss)


class Leaf:
    def __init__(self, rows, depth, weight=0.0, path=()):
        self.rows, self.depth, self.weight, self.path, self.q = rows, depth, weight, path, 0.0


def implied(shape, weights, kind, gamma, first=None):
    """Implied node weights of a tree given as ``{node: (parent, left, right, depth)}``."""
    level = {n: (weights[n] if v[1] < 0 else 0.0) for n, v in shape.items()}
    inner = [n for n, v in shape.items() if v[1] >= 0]
    if kind == "opt":
        order = sorted(inner, key=lambda n: (n != first, n))
        for _ in range(20 if len(inner) > 1 else 1):
            for n in order:
                p, l, r, _ = shape[n]
                level[n] = ((level[p] if p >= 0 else 0.0) + gamma * (level[l] + level[r])) / (1 + 2 * gamma)
        return {n: level[n] - (level[v[0]] if v[0] >= 0 else 0.0) for n, v in shape.items()}
    out = dict.fromkeys(shape, 0.0)
    for n, v in shape.items():
        if v[1] >= 0:
            continue
        at, share = n, 0.5
        while at >= 0:
            p = shape[at][0]
            out[at] += weights[n] * (share if p >= 0 else 2 * share)
            if p >= 0:
                sib = shape[p][2] if shape[p][1] == at else shape[p][1]
                out[sib] -= weights[n] * share
            at, share = p, share / 2
    return out


def penalty(shape, weights, kind, gamma, first=None):
    v = implied(shape, weights, kind, gamma, first)
    return sum(gamma ** shape[n][3] * v[n] ** 2 / 2 for n in shape)


def leafwise(x, y, w, p):
    """Forest growth with full recomputation after every step; ``p`` are LeafwiseParams."""
    n, d = x.shape
    const = y.mean() if p.normalize else 0.0
    y = y - const
    score = np.zeros(n)
    nn = w.sum()
    trees: list[dict] = []  # node -> dict
    count, corrected = 0, True
    sl2 = p.l2 if p.sl2 is None else p.sl2
    state = {"shift": 0.0}

    def refresh():
        if p.loss == "Expo":
            state["shift"] = float(np.clip((score * y).mean(), -500, 500))

    refresh()

    def shape_of(tree):
        return {i: (v["parent"], v["left"], v["right"], v["depth"]) for i, v in tree.items()}

    def best(tree, i):
        node = tree[i]
        rows = node["rows"]
        if len(rows) < 2 * p.min_samples_leaf:
            return None
        g, h = derivs(p.loss, score[rows], y[rows], state["shift"])
        g, h = g * w[rows], h * w[rows]
        scale = np.exp(state["shift"]) if p.loss == "Expo" else 1.0
        P = nn * sl2 * scale * p.reg_depth ** node["depth"]
        c = P * p.reg_depth
        found = None
        pw = node["weight"]
        if p.algorithm != "l2":
            shape = shape_of(tree)
            now = {k: v["weight"] for k, v in tree.items()}
            size = len(shape)
            split = dict(shape)
            split[i] = (shape[i][0], size, size + 1, shape[i][3])
            split[size] = (i, -1, -1, shape[i][3] + 1)
            split[size + 1] = (i, -1, -1, shape[i][3] + 1)

            def change(a, b):
                new = {**now, size: pw + a, size + 1: pw + b}
                return penalty(split, new, p.algorithm, p.reg_depth, i) - penalty(shape, now, p.algorithm, p.reg_depth)

            e = 1e-4
            up, mid, down = change(e, 0), change(0, 0), change(-e, 0)
            d_r, dd_r = (up - down) / (2 * e), (up - 2 * mid + down) / e**2
        for f in range(d):
            v = x[rows, f]
            for cut in np.unique(v)[:-1]:
                le = v <= cut
                if le.sum() < p.min_samples_leaf or (~le).sum() < p.min_samples_leaf:
                    continue
                gain, q = 0.0, []
                for m in (le, ~le):
                    G, H = g[m].sum(), h[m].sum()
                    if p.algorithm != "l2":
                        step = (G - nn * sl2 * scale * d_r) / (H + nn * sl2 * scale * dd_r)
                        gain += 2 * step * G - step * step * H
                        q.append(pw + step)
                    elif p.internal_nodes:
                        q.append(G / (H + c))
                        gain += q[-1] ** 2 * (H + c)
                    else:
                        step = (G - c * pw) / (H + c)
                        gain += step**2 * (H + c) + (P - 2 * c) * pw**2 / 2
                        q.append(step + pw)
                if p.algorithm != "l2":
                    gain -= 2 * nn * sl2 * scale * change(q[0] - pw, q[1] - pw)
                if gain > 0 and (found is None or gain > found[0] * (1 + 1e-9)):
                    found = (gain, f, cut, q, rows[le], rows[~le])
        return found

    def correct():
        for _ in range(p.sweeps):
            shift = float(np.clip((score * y).mean(), -500, 500)) if p.loss == "Expo" else 0.0
            nlam = nn * p.l2 * (np.exp(shift) if p.loss == "Expo" else 1.0)
            for tree in trees:
                if p.internal_nodes:
                    order = sorted((i for i in tree if tree[i]["depth"] > 0), key=lambda i: (tree[i]["depth"], i))
                else:
                    order = [i for i in tree if tree[i]["left"] < 0]
                for i in order:
                    node = tree[i]
                    rows = node["rows"]
                    g, h = derivs(p.loss, score[rows], y[rows], shift)
                    G, H = (g * w[rows]).sum(), (h * w[rows]).sum()
                    own = "own" if p.internal_nodes else "weight"
                    if p.algorithm != "l2":
                        shape = shape_of(tree)
                        now = {k: v["weight"] for k, v in tree.items()}
                        e = 1e-4
                        at = lambda t: penalty(shape, {**now, i: now[i] + t}, p.algorithm, p.reg_depth)
                        d_r, dd_r = (at(e) - at(-e)) / (2 * e), (at(e) - 2 * at(0) + at(-e)) / e**2
                        delta = (G - nlam * d_r) * p.learning_rate / (H + nlam * dd_r)
                    else:
                        lam = nlam * p.reg_depth ** node["depth"]
                        delta = (G - lam * node[own]) * p.learning_rate / (H + lam)
                    if p.loss != "LS":
                        delta = np.clip(delta, -1, 1)
                    node[own] += delta
                    score[rows] += delta
        refresh()

    next_opt = p.opt_interval
    while True:
        best_found = None
        for t in range(max(0, len(trees) - p.n_tree_search), len(trees)):
            for i in [i for i in trees[t] if trees[t][i]["left"] < 0]:
                c = best(trees[t], i)
                if c and (best_found is None or c[0] > best_found[1][0]):
                    best_found = ((t, i), c)
        root = {0: dict(rows=np.arange(n), depth=0, weight=0.0, own=0.0, parent=-1, left=-1, right=-1)}
        c = best(root, 0)
        if c and (best_found is None or c[0] > best_found[1][0]):
            best_found = (("new", 0), c)
        if best_found is None:
            break
        (t, i), (gain, f, cut, q, le, gt) = best_found
        if t == "new":
            if len(trees) >= (p.max_tree or max(1, p.max_leaf // 2)):
                break
            trees.append(root)
            t = len(trees) - 1
        tree = trees[t]
        node = tree[i]
        old = 0.0 if p.internal_nodes else node["weight"]
        base = len(tree)
        node.update(left=base, right=base + 1, feature=f, cut=cut, gain=gain)
        if not p.internal_nodes:
            node["weight"] = 0.0
        for k, (rows, weight) in enumerate(((le, q[0]), (gt, q[1]))):
            tree[base + k] = dict(rows=rows, depth=node["depth"] + 1, weight=weight, own=weight, parent=i, left=-1, right=-1)
            score[rows] += weight - old
        count += 2 if i == 0 and t == len(trees) - 1 and base == 1 else 1
        corrected = False
        if count >= p.max_leaf:
            break
        if count >= next_opt:
            correct()
            corrected = True
            next_opt = (count // p.opt_interval + 1) * p.opt_interval
    if not corrected:
        correct()
    return score + const, trees


def soft(y, w, l1, l2):
    w = w + l2 + 1e-10
    x = y / w
    b = l1 / w
    x = x - b if x > b else x + b if x < -b else 0.0
    return 0.5 * w * x * x - x * y + l1 * abs(x), x


def binned_derivs(loss, s, y):
    if loss == "LS":
        return y - s, np.ones_like(s)
    if loss == "LOGISTIC":
        q = 1 / (1 + np.exp(-s))
        return (y > 0) - q, q * (1 - q)
    m = s * y
    return np.where(m > 1, 0.0, y - s), np.where(m > 1, np.maximum(0.1, 1 - 5 * (m - 1)), 1.0)


def binned(x, y, w, p):
    """Best-first trees with corrections, one node at a time."""
    n, d = x.shape
    score = np.zeros(n)
    forest = []
    cursor = 0

    def evaluate(node):
        rows, p0 = node["rows"], node["weight"]
        g, h = binned_derivs(p.loss, score[rows] + p0, y[rows])
        g, h = g * w[rows], h * w[rows]
        G, H = g.sum(), h.sum()
        whole, x0 = soft(p0 * H + G, H, p.l1, p.l2)
        found = None
        least = p.min_samples_leaf * H / (len(rows) + 1e-10)
        for f in range(d):
            v = x[rows, f]
            for cut in np.unique(v)[:-1]:
                le = v <= cut
                hl, gl = h[le].sum(), g[le].sum()
                if hl < least or H - hl < least:
                    continue
                a, xl = soft(p0 * hl + gl, hl, p.l1, p.l2)
                b, xr = soft(p0 * (H - hl) + G - gl, H - hl, p.l1, p.l2)
                gain = whole - a - b
                if gain > (found[0] if found else 0) + max(1e-6, 1e-9 * (found[0] if found else 0)):
                    found = (gain, xl, xr, rows[le], rows[~le])
        node["best"], node["gain"] = found, found[0] if found else 0.0
        if found:
            node["weight"] = x0

    for _ in range(p.n_estimators):
        nodes = [dict(rows=np.arange(n), weight=0.0, depth=0, leaf=True)]
        evaluate(nodes[0])
        queue = [0]
        total = nodes[0]["gain"]
        least = p.tree_gain_ratio * total
        first = True
        while queue and len(queue) < p.max_leaf:
            i = max(queue, key=lambda k: (nodes[k]["gain"], -k))
            queue.remove(i)
            if total < least and not first:
                continue
            first = False
            total -= nodes[i]["gain"]
            if nodes[i]["depth"] >= p.max_depth or not nodes[i]["best"]:
                continue
            _, xl, xr, le, gt = nodes[i]["best"]
            nodes[i]["leaf"] = False
            for rows, weight in ((le, xl), (gt, xr)):
                child = dict(rows=rows, weight=weight, depth=nodes[i]["depth"] + 1, leaf=True, best=None, gain=0.0)
                if child["depth"] < p.max_depth:
                    evaluate(child)
                nodes.append(child)
                queue.append(len(nodes) - 1)
                total += child["gain"]
        tree = [v for v in nodes if v["leaf"]]
        rate = p.learning_rate if p.opt_algorithm == "greedy" else 1.0
        for leaf in tree:
            leaf["weight"] *= rate
            score[leaf["rows"]] += leaf["weight"]
        forest.append(tree)
        if p.opt_algorithm != "corrective":
            continue
        newest = min(20, len(forest))
        order = []
        for _ in range(80):
            k = cursor % len(forest)
            cursor += 1
            if k < len(forest) - newest:
                order.append(k)
        for k in order + list(range(len(forest) - newest, len(forest))):
            sums = []
            for leaf in forest[k]:
                g, h = binned_derivs(p.loss, score[leaf["rows"]], y[leaf["rows"]])
                sums.append(((g * w[leaf["rows"]]).sum(), (h * w[leaf["rows"]]).sum()))
            for leaf, (G, H) in zip(forest[k], sums):
                _, new = soft(leaf["weight"] * H + G, H, p.l1, p.l2)
                score[leaf["rows"]] += new - leaf["weight"]
                leaf["weight"] = new
    return score, forest
