"""Split gains. Each formula is plain arithmetic, so it serves columns and numpy arrays alike.

``g``/``h`` are the derivative sums of a side, ``p`` the weight of the node to be split, ``outer`` and
``inner`` its L2 strength at its own depth and at its children's, ``outer1``/``inner1`` those of L1.
Every function returns ``(gain of the side, weight of the side)``.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

TINY = 1e-10  # fixed value: keeps the binned engine's denominators positive


def choose(condition, yes, no):
    if isinstance(condition, Column):
        as_column = lambda v: v if isinstance(v, Column) else F.lit(v)
        return F.when(condition, as_column(yes)).otherwise(as_column(no))
    return np.where(condition, yes, no)


def shrink(x, by):
    """Soft threshold."""
    return choose(x > by, x - by, choose(x < -by, x + by, 0.0))


def size_of(x):
    return F.abs(x) if isinstance(x, Column) else np.abs(x)


def side_l2(g, h, p, outer, inner):
    step = (g - inner * p) / (h + inner)
    return step * step * (h + inner) + (outer - 2 * inner) * p * p / 2, step + p


def side_internal(g, h, inner):
    weight = g / (h + inner)
    return weight * weight * (h + inner), weight


def side_l1l2(g, h, p, outer, inner, outer1, inner1):
    target = g + h * p
    weight = shrink(target, inner1) / (h + inner)
    before = p * p * (h + outer) - 2 * p * target + 2 * outer1 * size_of(p)
    return before + weight * weight * (h + inner), weight


def side_penalty(g, h, p, nlam, d_r, dd_r):
    """Step of one side under a tree penalty; the penalty's own change is subtracted by the caller."""
    step = (g - nlam * d_r) / (h + nlam * dd_r)
    return 2 * step * g - step * step * h, step + p


def solve_l1l2(h, y, l1, l2):
    """``(objective, x)`` of the shrunk minimiser of ``h x^2 / 2 - x y`` with L1 and L2 terms."""
    w = h + l2 + TINY
    x = shrink(y / w, l1 / w)
    return 0.5 * w * x * x - x * y + l1 * size_of(x), x
