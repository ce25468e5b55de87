"""Cut candidates, their gains and the best split per node, on histogram tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from grove.functions import gains
from grove.operators.folds import drawn
from grove.session import cut_lineage

RELATIVE_TIE = 1e-9  # sums of different task orders differ in the last bits
SLOT_BITS = 16  # ranges of drawn numbers that a share of the features is counted by
BINNED_TIE = 1e-6  # fixed value: gains this close are equal to the binned engine
RANGE_BINS = 250_000  # bins of one feature in one node that a task runs over


def _sums_by_range(hist: DataFrame) -> DataFrame:
    """Running and whole sums of every node and feature whose bins are too many for one window: sums run inside a range
    of bins, and the sums of the ranges before are added."""
    ranged = hist.withColumn("_range", F.expr(f"bin div {RANGE_BINS}"))
    running = Window.partitionBy("node", "feature", "_range").orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    local = ranged.select("node", "feature", "_range", "bin", *[F.sum(c).over(running).alias(f"_{c}") for c in "ghn"])
    whole = Window.partitionBy("node", "feature")
    before = whole.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranged.groupBy("node", "feature", "_range").agg(*[F.sum(c).alias(c) for c in "ghn"]).select(
        "node",
        "feature",
        "_range",
        *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"_{c}_before") for c in "ghn"],
        *[F.sum(c).over(whole).alias(f"{c}_total") for c in "ghn"],
    )
    # The windows have the rows in the order of this merge.
    return local.join(offsets.hint("merge"), ["node", "feature", "_range"]).select(
        "node",
        "feature",
        "bin",
        *[(F.col(f"_{c}") + F.col(f"_{c}_before")).alias(f"{c}_left") for c in "ghn"],
        *[f"{c}_total" for c in "ghn"],
    )


def split_candidates(hist: DataFrame, min_rows: int = 0, min_sample: float | None = None, n_bins: int = 0) -> DataFrame:
    """Left and right sums of every cut ``bin <= b``.

    ``min_rows`` bounds the rows of both sides; ``min_sample`` bounds both sides' share of ``h``. A window
    here covers the bins of one feature in one node; where ``n_bins``, the most of a feature, are many, a range of them.
    """
    if n_bins > RANGE_BINS:
        sums = _sums_by_range(hist)
    else:
        inside = Window.partitionBy("node", "feature")
        running = inside.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
        sums = hist.select(
            "node",
            "feature",
            "bin",
            *[F.sum(c).over(running).alias(f"{c}_left") for c in "ghn"],
            *[F.sum(c).over(inside).alias(f"{c}_total") for c in "ghn"],
        )
    cand = sums.filter("n_left < n_total").select(
        "*", *[(F.col(f"{c}_total") - F.col(f"{c}_left")).alias(f"{c}_right") for c in "ghn"]
    )
    if min_rows > 0:
        cand = cand.filter((F.col("n_left") >= min_rows) & (F.col("n_right") >= min_rows))
    if min_sample is not None:
        least = min_sample * F.col("h_total") / (F.col("n_total") + gains.TINY)
        cand = cand.filter((F.col("h_left") >= least) & (F.col("h_right") >= least))
    return cand


def split_gain(
    cand: DataFrame,
    kind: str,
    nlam: float = 0.0,
    nsig: float = 0.0,
    gamma: float = 1.0,
    l1: float = 0.0,
    l2: float = 0.0,
    node_facts: DataFrame | None = None,
) -> DataFrame:
    """Add ``gain, left_weight, right_weight``.

    ``node_facts`` holds ``node, depth, weight`` (default: roots of weight 0) and, for ``minpen``, the
    penalty terms ``d_r, dd_r, offset, lin, quad, cross`` of a split of that node. One row per node.
    """
    if node_facts is not None:
        cand = cand.join(F.broadcast(node_facts), "node")
    else:
        cand = cand.withColumns({"depth": F.lit(0), "weight": F.lit(0.0)})
    gl, hl, gr, hr = (F.col(c) for c in ("g_left", "h_left", "g_right", "h_right"))
    p = F.col("weight")
    power: Column = F.pow(F.lit(float(gamma)), F.col("depth"))
    outer, inner = nlam * power, nlam * gamma * power
    if kind == "l2":
        left, right = gains.side_l2(gl, hl, p, outer, inner), gains.side_l2(gr, hr, p, outer, inner)
    elif kind == "internal":
        left, right = gains.side_internal(gl, hl, inner), gains.side_internal(gr, hr, inner)
    elif kind == "l1l2":
        strength = (outer, inner, nsig * power, nsig * gamma * power)
        left, right = gains.side_l1l2(gl, hl, p, *strength), gains.side_l1l2(gr, hr, p, *strength)
    elif kind == "minpen":
        d_r, dd_r = F.col("d_r"), F.col("dd_r")
        left = gains.side_penalty(gl, hl, p, nlam, d_r, dd_r)
        right = gains.side_penalty(gr, hr, p, nlam, d_r, dd_r)
        d0, d1 = left[1] - p, right[1] - p
        change = (
            F.col("offset")
            + F.col("lin") * (d0 + d1)
            + F.col("quad") * (d0 * d0 + d1 * d1) / 2
            + F.col("cross") * d0 * d1
        )
        left = (left[0] - 2 * nlam * change, left[1])
    elif kind == "binned":
        gt, ht = F.col("g_total"), F.col("h_total")
        whole = gains.solve_l1l2(ht, p * ht + gt, l1, l2)
        left = gains.solve_l1l2(hl, p * hl + gl, l1, l2)
        right = gains.solve_l1l2(hr, p * hr + gr, l1, l2)
        out = cand.withColumn("node_weight", whole[1])
        return out.withColumns(
            {"gain": whole[0] - (left[0] + right[0]), "left_weight": left[1], "right_weight": right[1]}
        )
    else:
        raise ValueError(f"unknown gain {kind!r}")
    return cand.withColumns({"gain": left[0] + right[0], "left_weight": left[1], "right_weight": right[1]})


def best_splits(scored: DataFrame, tie: float = 0.0) -> DataFrame:
    """The split of largest gain per node; ties go to the lowest feature, then the lowest cut."""
    scored = scored.filter(F.col("gain") > tie)
    top = scored.groupBy("node").agg(F.max("gain").alias("_top"))
    near = scored.join(F.broadcast(top), "node").filter(
        F.col("gain") >= F.col("_top") - F.greatest(F.lit(tie), RELATIVE_TIE * F.col("_top"))
    )
    carried = [c for c in near.columns if c not in ("node", "_top", "feature", "bin")]
    best = near.groupBy("node").agg(F.min_by(F.struct("feature", "bin", *carried), F.struct("feature", "bin")).alias("b"))
    return best.select("node", "b.*")


def sample_features(features: DataFrame, ratio: float, seed: int, step: int = 0) -> DataFrame:
    """A seeded share of the features (at least one); ``features`` has one row per feature.

    The last rank is looked up in counts of equal ranges of the drawn numbers, so only one range's rows are sorted.
    """
    known = cut_lineage(features.withColumn("_drawn", drawn("feature", seed + step)))
    slot = F.shiftright("_drawn", 60 - SLOT_BITS)
    counts = sorted((r["slot"], r["n"]) for r in known.groupBy(slot.alias("slot")).agg(F.count(F.lit(1)).alias("n")).collect())
    keep = max(1, int(sum(n for _, n in counts) * ratio))
    for last, n in counts:
        if keep <= n:
            break
        keep -= n
    else:  # no features, or all of them
        return known.drop("_drawn")
    rest = known.where(slot == last).orderBy("_drawn", "feature").limit(keep)
    return known.where(slot < last).unionByName(rest).drop("_drawn")
