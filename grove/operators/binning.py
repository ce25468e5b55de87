"""Supervised binning: value summaries, greedy best-first cuts, applying and describing bins.

A feature with boundaries ``b_0 < b_1 < ...`` maps a value to the number of boundaries below it, so
``value <= b_0`` is bin 0. Gains use the L2-shrunk mean of the target on both sides of a cut.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from grove.functions.trees import number
from grove.operators.prepare import VALUE_MIN
from grove.operators.ranking import TARGET_ROWS, running_sums
from grove.session import cut_lineage

# Defaults of both layouts.
MIN_BUCKET_WEIGHT = 5.0
BIN_L2 = 2.0
SPARSE_MAX_BINS = 200
SPARSE_MAX_FEATURES = 80_000
SPARSE_MIN_OCCURRENCES = 5
DENSE_MAX_BINS = 65_000

# A feature with more distinct values than this is cut by distributed rounds, not in one task.
LOCAL_VALUES = 500_000
MAX_BOUNDARIES = 20_000_000  # of the whole set but those kept in tables: it is held by the driver and by every worker
KEPT_BOUNDARIES = 500_000  # the boundaries of a dense feature that has more stay in a table
CASE_BOUNDARIES = 300
INLINE_BOUNDARIES = 16
BROADCAST_BINS = 2_000_000  # bins that a join with long rows sends to every worker
SALTS = 16
ROUND_VALUES = 500_000  # values that one task of a round of cuts searches
WIDE = 64  # a map of at most as many features becomes an array by one expression each


# ---------------------------------------------------------------- summaries


def _cells(table: DataFrame) -> DataFrame:
    """Long form ``(feature, value, weight, label)`` of a training table."""
    if table.schema["features"].dataType.typeName() == "map":
        exploded = F.explode("features").alias("feature", "value")
    else:
        exploded = F.posexplode("features").alias("feature", "value")
    return table.select("weight", "label", exploded)


def value_summary(table: DataFrame, rescale: bool = True) -> DataFrame:
    """Per feature and distinct value: sums of ``w`` and ``w * y`` and the row count.

    With ``rescale`` the weights are first multiplied by ``max(1, rows / sum of weights)``.
    """
    sums = _cells(table).groupBy(F.col("feature").cast("int").alias("feature"), "value").agg(
        F.sum("weight").alias("w"), F.sum(F.col("weight") * F.col("label")).alias("wy"), F.count(F.lit(1)).alias("n")
    )
    if not rescale:
        return sums
    factor = table.agg(F.greatest(F.lit(1.0), F.count(F.lit(1)) / F.sum("weight")).alias("_f"))
    scaled = sums.crossJoin(F.broadcast(factor))  # one row
    return scaled.select(
        "feature", "value", (F.col("w") * F.col("_f")).alias("w"), (F.col("wy") * F.col("_f")).alias("wy"), "n"
    )


def select_features(table: DataFrame, min_occurrences: int = SPARSE_MIN_OCCURRENCES) -> DataFrame:
    """Features present in at least ``min_occurrences`` rows, with the number of rows."""
    counts = _cells(table).groupBy("feature").agg(F.count(F.lit(1)).alias("occurrences"))
    return counts.filter(F.col("occurrences") >= max(1, min_occurrences))


def sparse_value_summary(
    table: DataFrame, min_occurrences: int = SPARSE_MIN_OCCURRENCES, absent_value: float = VALUE_MIN
) -> DataFrame:
    """Value summary of the selected features plus one row per feature for the rows without it."""
    return _add_absent(value_summary(table, rescale=False), table, min_occurrences, absent_value)


def _add_absent(summary: DataFrame, table: DataFrame, min_occurrences: int, absent_value: float) -> DataFrame:
    totals = table.agg(
        F.sum("weight").alias("_w"), F.sum(F.col("weight") * F.col("label")).alias("_wy"), F.count(F.lit(1)).alias("_n")
    )
    per_feature = summary.groupBy("feature").agg(F.sum("w").alias("fw"), F.sum("wy").alias("fwy"), F.sum("n").alias("fn"))
    kept = per_feature.filter(F.col("fn") >= max(1, min_occurrences))
    absent = (
        kept.crossJoin(F.broadcast(totals))  # one row
        .filter(F.col("_w") > F.col("fw") + 1e-5)
        .select(
            "feature",
            F.lit(absent_value).alias("value"),
            (F.col("_w") - F.col("fw")).alias("w"),
            (F.col("_wy") - F.col("fwy")).alias("wy"),
            (F.col("_n") - F.col("fn")).alias("n"),
        )
    )
    present = summary.join(kept.select("feature"), "feature", "left_semi")
    both = present.unionByName(absent)
    # A present value may itself be the one that stands for absence.
    return both.groupBy("feature", "value").agg(F.sum("w").alias("w"), F.sum("wy").alias("wy"), F.sum("n").alias("n"))


# ---------------------------------------------------------------- cuts


def _cut_gain(wl, yl, wt, yt, l2):
    """Works on columns and on numpy arrays alike."""
    wr, yr = wt - wl, yt - yl
    return yl * yl / (wl + l2) + yr * yr / (wr + l2) - yt * yt / (wt + 2 * l2)


def best_cut(
    summary: DataFrame,
    min_bucket_weight: float = MIN_BUCKET_WEIGHT,
    l2: float = BIN_L2,
    keys: tuple[str, ...] = ("feature",),
    target_rows: int = TARGET_ROWS,
) -> DataFrame:
    """The one best cut of every group of ``keys``: gain, boundary and weights of both sides."""
    ranked = running_sums(summary, keys, "value", ["w", "wy"], target_rows)
    wl, wt = F.col("cum_w"), F.col("tot_w")
    least = max(min_bucket_weight, 1e-3) - 1e-10
    gains = ranked.filter(F.col("next_value").isNotNull() & (wl >= least) & (wt - wl >= least)).select(
        *keys,
        _cut_gain(wl, F.col("cum_wy"), wt, F.col("tot_wy"), max(l2, 1e-10)).alias("gain"),
        (0.5 * (F.col("value") + F.col("next_value"))).alias("cut"),
        wl.alias("left_w"),
        (wt - wl).alias("right_w"),
    )
    best = gains.filter("gain > 0").groupBy(*keys).agg(
        F.max_by(F.struct("gain", "cut", "left_w", "right_w"), F.struct(F.col("gain"), -F.col("cut"))).alias("b")
    )
    return best.select(*keys, "b.*")


def _greedy(x: np.ndarray, weight: np.ndarray, target: np.ndarray, max_bins: int, least: float, l2: float) -> tuple[list[float], float]:
    """Best-first cuts of one feature whose distinct values, in order, fit one task."""
    w = np.concatenate([[0.0], np.cumsum(weight)])
    y = np.concatenate([[0.0], np.cumsum(target)])

    def search(b: int, e: int) -> tuple[float, int]:
        if e - b < 2:
            return 0.0, -1
        wl, yl, wt, yt = w[b + 1 : e] - w[b], y[b + 1 : e] - y[b], w[e] - w[b], y[e] - y[b]
        gain = _cut_gain(wl, yl, wt, yt, l2)
        gain[(wl < least) | (wt - wl < least)] = 0.0
        at = int(np.argmax(gain))
        return float(gain[at]), b + 1 + at

    cuts: list[float] = []
    total = 0.0
    gain, at = search(0, len(x))
    queue = [(-gain, 0, len(x), at)]
    while queue and len(cuts) + 1 < max_bins:
        negative, b, e, at = heapq.heappop(queue)
        if negative >= 0:
            break
        total -= negative
        cuts.append(0.5 * (x[at - 1] + x[at]))
        for lo, hi in ((b, at), (at, e)):
            gain, cut = search(lo, hi)
            heapq.heappush(queue, (-gain, lo, hi, cut))
    return sorted(cuts), total


def _fit_local(summary: DataFrame, max_bins: int, least: float, l2: float) -> DataFrame:
    """Greedy cuts feature by feature; a task walks over its share of the features in order."""

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def fitted(features: list, parts: list[np.ndarray]) -> pa.RecordBatch:
            found = [_greedy(*np.ascontiguousarray(p.T), max_bins, least, l2) for p in parts]
            columns = [pa.array(features, pa.int32()), pa.array([c for c, _ in found], pa.list_(pa.float64())), pa.array([g for _, g in found], pa.float64())]
            return pa.RecordBatch.from_arrays(columns, names=["feature", "boundaries", "gain"])

        open_feature, held = None, []  # the feature that may go on in the next batch
        for batch in batches:
            if batch.num_rows == 0:
                continue
            names = batch.column("feature").to_numpy(zero_copy_only=False)
            cells = np.column_stack([batch.column(c).to_numpy(zero_copy_only=False) for c in ("value", "w", "wy")])
            features, parts = [], []
            for part in np.split(np.arange(len(names)), np.flatnonzero(np.diff(names)) + 1):
                name = int(names[part[0]])
                if open_feature is not None and name != open_feature:
                    features.append(open_feature)
                    parts.append(np.concatenate(held))
                    held = []
                open_feature = name
                held.append(cells[part])
            if features:
                yield fitted(features, parts)
        if open_feature is not None:
            yield fitted([open_feature], [np.concatenate(held)])

    ordered = summary.select("feature", "value", "w", "wy").repartition("feature").sortWithinPartitions("feature", "value")
    return ordered.mapInArrow(per_task, "feature int, boundaries array<double>, gain double")


def _bucket_of(boundaries: str, value: str) -> Column:
    return F.expr(f"size(filter({boundaries}, b -> b < {value}))")


def _best_in_buckets(ranked: DataFrame, wanted: dict[int, np.ndarray], least: float, l2: float) -> DataFrame:
    """The best cut of every wanted bucket: ``feature, bucket, gain, cut, at_w, at_wy``, the sums up to the cut.

    ``wanted`` has a feature's disjoint buckets in order, a row ``lo, hi, w, wy, w, wy`` each: its ends and the feature's sums up to these.
    """

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("value", "next_value", "cum_w", "cum_wy")]
            names = batch.column("feature").to_numpy(zero_copy_only=False)
            for f in np.unique(names):
                if int(f) not in wanted:
                    continue
                value, after, cw, cy = (np.asarray(c[names == f], float) for c in columns)
                lo, hi, lw, ly, hw, hy = wanted[int(f)].T
                bucket = np.searchsorted(lo, value, side="left") - 1
                keep = (bucket >= 0) & (after <= hi[bucket])  # false where there is no next value
                value, after, cw, cy, bucket = value[keep], after[keep], cw[keep], cy[keep], bucket[keep]
                wl, wt = cw - lw[bucket], hw[bucket] - lw[bucket]
                with np.errstate(divide="ignore", invalid="ignore"):
                    gain = _cut_gain(wl, cy - ly[bucket], wt, hy[bucket] - ly[bucket], l2)
                fit = (wl >= least) & (wt - wl >= least) & (gain > 0)
                cut = 0.5 * (value + after)
                order = np.flatnonzero(fit)[np.lexsort((cut[fit], -gain[fit], bucket[fit]))]
                first = order[np.unique(bucket[order], return_index=True)[1]]
                found = [np.full(len(first), f, np.int32), bucket[first].astype(np.int32), gain[first], cut[first], cw[first], cy[first]]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in found], names=["feature", "bucket", "gain", "cut", "at_w", "at_wy"])

    cells = ranked.select(F.col("feature").cast("int").alias("feature"), "value", "next_value", "cum_w", "cum_wy")
    found = cells.mapInArrow(per_task, "feature int, bucket int, gain double, cut double, at_w double, at_wy double")
    best = F.max_by(F.struct("gain", "cut", "at_w", "at_wy"), F.struct(F.col("gain"), -F.col("cut"))).alias("b")
    return found.groupBy("feature", "bucket").agg(best).select("feature", "bucket", "b.*")


def _fit_distributed(summary: DataFrame, max_bins: int, least: float, l2: float, target_rows: int) -> list[tuple]:
    """The same greedy cuts by rounds: each round scores all open buckets of all features at once.

    A bucket's gain depends on its own values only, so buckets may be scored before the greedy order
    asks for them, and the order is replayed afterwards on the few scored buckets. Running sums are made once;
    a bucket's own are their differences to those at its lower end, so a round neither sorts nor shuffles the values.
    """
    kept = cut_lineage(running_sums(summary.select("feature", "value", "w", "wy"), ["feature"], "value", ["w", "wy"], target_rows))
    # Rounds are many and short: few partitions, each of many values.
    ranked = kept.coalesce(max(kept.sparkSession.sparkContext.defaultParallelism, -(-kept.count() // ROUND_VALUES)))
    # Per feature: scored buckets as (lo, hi) -> (gain, cut); every round scores the current leaves.
    whole = ranked.groupBy("feature").agg(F.max("tot_w").alias("w"), F.max("tot_wy").alias("wy")).collect()
    features = [r["feature"] for r in whole]
    scored: dict[int, dict[tuple, tuple]] = {f: {} for f in features}
    sums = {r["feature"]: {-np.inf: (0.0, 0.0), np.inf: (r["w"], r["wy"])} for r in whole}  # up to every cut found

    def replay(f: int) -> tuple[list[float], float, list[tuple]]:
        """Cuts reached so far and the buckets whose score is missing."""
        cuts, total, missing = [], 0.0, []
        whole = (-np.inf, np.inf)
        queue: list[tuple] = []

        def push(bucket: tuple) -> None:
            if bucket in scored[f]:
                gain, cut = scored[f][bucket]
                heapq.heappush(queue, (-gain, bucket, cut))
            else:
                missing.append(bucket)

        push(whole)
        while queue and not missing and len(cuts) + 1 < max_bins:
            negative, (lo, hi), cut = heapq.heappop(queue)
            if negative >= 0:
                break
            total -= negative
            cuts.append(cut)
            push((lo, cut))
            push((cut, hi))
        if missing:  # score the other open buckets' children ahead of need as well
            for negative, (lo, hi), cut in queue[: max_bins - len(cuts)]:
                if negative < 0:
                    missing += [b for b in ((lo, cut), (cut, hi)) if b not in scored[f]]
        return sorted(cuts), total, missing

    while True:
        wanted = {f: replay(f)[2] for f in features}
        wanted = {f: m for f, m in wanted.items() if m}
        if not wanted:
            break
        buckets = {f: sorted(set(m)) for f, m in wanted.items()}
        edges = {f: np.array([(lo, hi, *sums[f][lo], *sums[f][hi]) for lo, hi in b], float) for f, b in buckets.items()}
        found = _best_in_buckets(ranked, edges, least, l2).collect()
        best = {(r["feature"], r["bucket"]): r for r in found}
        for f, some in buckets.items():
            for i, bucket in enumerate(some):
                r = best.get((f, i))
                scored[f][bucket] = (r["gain"], r["cut"]) if r else (0.0, None)
                if r:
                    sums[f][r["cut"]] = r["at_w"], r["at_wy"]
    kept.unpersist()
    return [(f, *replay(f)[:2]) for f in features]


# ---------------------------------------------------------------- the set of bins


class KeptBoundaries:
    """The sorted boundaries of a feature that has too many for the driver and the workers: a table ``boundary, at`` (0, 1, ...).

    It stands where an array would; only a loop or ``np.asarray`` collects it.
    """

    def __init__(self, df: DataFrame, size: int):
        self.df, self.size = df, size
        self.known: dict[int, float] = {}

    def __len__(self) -> int:
        return self.size

    def __array__(self, dtype=None, copy=None) -> np.ndarray:
        _check_boundaries(self.size)
        return np.sort(self.df.select("boundary").toArrow().column("boundary").to_numpy()).astype(dtype or float)

    def __iter__(self) -> Iterator[float]:
        return iter(np.asarray(self))

    def values(self, at: Iterable[int]) -> dict[int, float]:
        """The boundaries at some places."""
        missing = sorted(set(map(int, at)) - set(self.known))
        if missing:
            self.known.update(self.df.where(F.col("at").isin(missing)).select("at", "boundary").collect())
        return self.known

    def places(self, cuts: Iterable[float]) -> dict[float, int]:
        """The first places of boundaries that are known to be there."""
        found = self.df.where(F.col("boundary").isin(sorted(map(float, cuts)))).groupBy("boundary").agg(F.min("at")).collect()
        return {r[0]: int(r[1]) for r in found}

    def with_cuts(self, cuts: Iterable[float]) -> KeptBoundaries:
        added = self.df.sparkSession.createDataFrame([(float(c),) for c in cuts], "value double")
        values = self.df.select(F.col("boundary").alias("value")).unionByName(added).distinct()
        kept = cut_lineage(_ranked(values.withColumn("feature", F.lit(0)), TARGET_ROWS).withColumnRenamed("value", "boundary"))
        size = kept.count()
        return KeptBoundaries(kept.unpersist(), size)


@dataclass
class BinSet:
    """Boundaries per feature, an array or ``KeptBoundaries`` each. ``sparse`` sets hold the kept features only.

    An absent sparse cell is the lowest bin, or the bin of value 0 when ``missing`` is ``zero``.
    """

    boundaries: dict[int, np.ndarray | KeptBoundaries]
    gains: dict[int, float] = field(default_factory=dict)
    sparse: bool = False
    missing: str = "lowest"

    def default_bin(self, feature: int) -> int:
        if self.missing == "lowest" or not self.sparse:
            return 0
        return int(np.searchsorted(self.boundaries[feature], 0.0, side="left"))

    @property
    def features(self) -> list[int]:
        return sorted(self.boundaries)

    def sizes(self) -> dict[int, int]:
        return {f: len(b) + 1 for f, b in self.boundaries.items()}

    @property
    def kept(self) -> dict[int, KeptBoundaries]:
        return {f: b for f, b in self.boundaries.items() if isinstance(b, KeptBoundaries)}

    def cut_values(self, cuts: Iterable[tuple[int, int]]) -> dict[tuple[int, int], float]:
        """The values of cuts ``(feature, bin)``; those in a table are looked up by one job a feature."""
        cuts = set(cuts)
        edges = {f: b.values(i for g, i in cuts if g == f) for f, b in self.kept.items()}
        return {(f, i): float((edges[f] if f in edges else self.boundaries[f])[i]) for f, i in cuts}

    def cut_bins(self, cuts: Iterable[tuple[int, float]]) -> dict[tuple[int, float], int]:
        """The bins of cuts ``(feature, value)``."""
        cuts = set(cuts)
        places = {f: b.places(c for g, c in cuts if g == f) for f, b in self.kept.items()}
        return {(f, c): places[f][c] if f in places else int(np.searchsorted(self.boundaries[f], c)) for f, c in cuts}

    def to_df(self, spark: SparkSession) -> DataFrame:
        """One row per bin: ``(lo, hi]``."""
        rows = []
        for f in self.features:
            edges = [float("-inf"), *map(float, self.boundaries[f]), float("inf")]
            rows += [(f, i, edges[i], edges[i + 1], float(self.gains.get(f, 0.0))) for i in range(len(edges) - 1)]
        return spark.createDataFrame(rows, "feature int, bin int, lo double, hi double, gain double")

    def save(self, spark: SparkSession, path: str) -> None:
        kind = F.lit("sparse" if self.sparse else "dense").alias("layout")
        self.to_df(spark).select("*", kind, F.lit(self.missing).alias("missing")).write.mode("overwrite").parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> BinSet:
        df = spark.read.parquet(path)
        grouped = df.groupBy("feature", "gain", "layout", "missing").agg(
            F.sort_array(F.collect_list(F.when(F.col("hi") < float("inf"), F.col("hi")))).alias("boundaries")
        )
        rows = grouped.collect()
        return BinSet(
            {r["feature"]: np.array(r["boundaries"], float) for r in rows},
            {r["feature"]: r["gain"] for r in rows},
            any(r["layout"] == "sparse" for r in rows),
            "zero" if any(r["missing"] == "zero" for r in rows) else "lowest",
        )


def _check_boundaries(total: int) -> None:
    if total > MAX_BOUNDARIES:
        raise ValueError(f"{total} boundaries, which every worker would hold: set max_bins (coarser bins) or max_features")


def _collect_bins(fitted: DataFrame, sparse: bool, extra: list[tuple]) -> BinSet:
    """Boundaries for the driver and the workers; their number is known before any is collected."""
    kept = cut_lineage(fitted)
    _check_boundaries((kept.agg(F.sum(F.size("boundaries"))).first()[0] or 0) + sum(len(r[1]) for r in extra))
    rows = [tuple(r) for r in kept.collect()] + extra
    kept.unpersist()
    return BinSet({r[0]: np.array(r[1], float) for r in rows}, {r[0]: float(r[2]) for r in rows}, sparse)


def _ranked(values: DataFrame, target_rows: int) -> DataFrame:
    """``feature, value, next_value, at`` of distinct values: the place of each in its feature."""
    ones = values.select("feature", "value", F.lit(1).cast("bigint").alias("one"))
    return running_sums(ones, ["feature"], "value", ["one"], target_rows).select("feature", "value", "next_value", (F.col("cum_one") - 1).alias("at"))


def _midpoints(summary: DataFrame, max_bins: int | None, target_rows: int = TARGET_ROWS, ranked: bool = False) -> DataFrame:
    """``feature, boundary`` (with ``ranked`` also its place ``at``): midpoints between neighbouring distinct values of the features
    of at most ``max_bins`` values, one row each. Neighbours come from running windows inside ordered buckets, so no task holds a whole feature."""
    if max_bins is not None:
        few = summary.groupBy("feature").agg(F.count(F.lit(1)).alias("_v")).filter(F.col("_v") <= max_bins)
        summary = summary.join(few, "feature", "left_semi")
    if ranked:
        ordered = _ranked(summary, target_rows)
    else:
        ordered = running_sums(summary.select("feature", "value"), ["feature"], "value", [], target_rows)
    middle = (0.5 * (F.col("value") + F.col("next_value"))).alias("boundary")
    return ordered.where(F.col("next_value").isNotNull()).select("feature", middle, *(["at"] if ranked else []))


def _collect_midpoints(long: DataFrame, features: list[int], sparse: bool, wide: Iterable[int] = ()) -> BinSet:
    """The boundaries of a ``feature, boundary`` table, counted before any is collected; rows come from every task.

    Those of ``wide`` features stay in the table, which has their places ``at`` then.
    """
    kept = cut_lineage(long)
    sizes = {r["feature"]: r["n"] for r in kept.where(F.col("feature").isin(*wide)).groupBy("feature").agg(F.count(F.lit(1)).alias("n")).collect()} if wide else {}
    few = kept.where(~F.col("feature").isin(*wide)) if wide else kept
    _check_boundaries(few.count())
    rows = few.select("feature", "boundary").toArrow()
    kept.unpersist()
    names, edges = rows.column("feature").to_numpy(), rows.column("boundary").to_numpy()
    order = np.lexsort((edges, names))
    names, edges = names[order], edges[order]
    starts = np.flatnonzero(np.diff(names, prepend=names[:1] - 1))
    found = {int(names[s]): e for s, e in zip(starts, np.split(edges, starts[1:]))}
    found |= {f: KeptBoundaries(kept.where(F.col("feature") == f).select("boundary", "at"), sizes[f]) for f in wide}
    return BinSet({f: found.get(f, np.zeros(0)) for f in features}, dict.fromkeys(features, 0.0), sparse)


def fit_fine_bins(
    table: DataFrame,
    max_bins: int | None = None,
    min_occurrences: int = 1,
    local_values: int = LOCAL_VALUES,
    target_rows: int = TARGET_ROWS,
) -> BinSet:
    """Every distinct value its own bin; with ``max_bins``, features of more values than that get greedy bins instead.

    For sparse tables an absent cell counts as the value 0. Boundaries of a dense feature stay in a table where they are many.
    """
    sparse = table.schema["features"].dataType.typeName() == "map"
    summary = cut_lineage(value_summary(table, rescale=not sparse))
    if sparse:
        summary = cut_lineage(_add_absent(summary, table, min_occurrences, 0.0))
    counts = {r["feature"]: r["_v"] for r in summary.groupBy("feature").agg(F.count(F.lit(1)).alias("_v")).collect()}  # one row a feature
    fine_features = sorted(f for f, v in counts.items() if max_bins is None or v <= max_bins)
    wide = [] if sparse else [f for f in fine_features if counts[f] - 1 > KEPT_BOUNDARIES]
    fine = _collect_midpoints(_midpoints(summary, max_bins, target_rows, bool(wide)), fine_features, sparse, wide)
    many = None
    if max_bins is not None:
        many = summary.groupBy("feature").agg(F.count(F.lit(1)).alias("_v")).filter(F.col("_v") > max_bins)
    if many is not None and not many.isEmpty():
        rest = summary.join(many, "feature", "left_semi")
        fitted, extra = _fit(rest, max_bins, 1.0, BIN_L2, local_values, target_rows)
        greedy = _collect_bins(fitted, sparse, extra)
        fine.boundaries.update(greedy.boundaries)
        fine.gains.update(greedy.gains)
    summary.unpersist()
    if sparse:
        fine.missing = "zero"
        fine.boundaries = {f: b for f, b in fine.boundaries.items() if len(b)}
    return fine


def _fit(summary: DataFrame, max_bins: int, least: float, l2: float, local_values: int, target_rows: int):
    sizes = summary.groupBy("feature").agg(F.count(F.lit(1)).alias("values"))
    large = [r["feature"] for r in sizes.filter(F.col("values") > local_values).collect()]
    least, l2 = max(least, 1e-3) - 1e-10, max(l2, 1e-10)
    if not large:
        return _fit_local(summary, max_bins, least, l2), []
    in_large = F.col("feature").isin(large)
    extra = _fit_distributed(summary.filter(in_large), max_bins, least, l2, target_rows)
    return _fit_local(summary.filter(~in_large), max_bins, least, l2), extra


def fit_bins(
    table: DataFrame,
    max_bins: int = DENSE_MAX_BINS,
    min_bucket_weight: float = MIN_BUCKET_WEIGHT,
    l2: float = BIN_L2,
    rescale: bool = True,
    local_values: int = LOCAL_VALUES,
    target_rows: int = TARGET_ROWS,
) -> BinSet:
    """Greedy best-first bins of every dense feature; exact for any number of distinct values."""
    summary = cut_lineage(value_summary(table, rescale))
    fitted, extra = _fit(summary, max_bins, min_bucket_weight, l2, local_values, target_rows)
    bins = _collect_bins(fitted, False, extra)
    summary.unpersist()
    return bins


def fit_sparse_bins(
    table: DataFrame,
    max_bins: int = SPARSE_MAX_BINS,
    min_bucket_weight: float = MIN_BUCKET_WEIGHT,
    l2: float = BIN_L2,
    min_occurrences: int = SPARSE_MIN_OCCURRENCES,
    max_features: int = SPARSE_MAX_FEATURES,
    local_values: int = LOCAL_VALUES,
    target_rows: int = TARGET_ROWS,
) -> BinSet:
    """Bins of a MAP column; only the ``max_features`` features of largest positive gain are kept."""
    present = cut_lineage(value_summary(table, rescale=False))
    summary = cut_lineage(_add_absent(present, table, min_occurrences, VALUE_MIN))
    present.unpersist()
    fitted, extra = _fit(summary, max_bins, min_bucket_weight, l2, local_values, target_rows)
    if extra:
        fitted = fitted.unionByName(fitted.sparkSession.createDataFrame(extra, fitted.schema))
    bins = _collect_bins(top_features(fitted, max_features), True, [])
    summary.unpersist()
    return bins


def top_features(fitted: DataFrame, max_features: int) -> DataFrame:
    return fitted.filter("gain > 0").orderBy(F.desc("gain"), "feature").limit(max_features)


# ---------------------------------------------------------------- applying bins


def _case_search(value: str, edges: list[float], lo: int = 0, hi: int | None = None) -> str:
    hi = len(edges) if hi is None else hi
    if lo == hi:
        return str(lo)
    mid = (lo + hi) // 2
    low, high = _case_search(value, edges, lo, mid), _case_search(value, edges, mid + 1, hi)
    return f"CASE WHEN {value} <= {number(edges[mid])} THEN {low} ELSE {high} END"


def _case_of_feature(edges: list[np.ndarray], lo: int, hi: int) -> str:
    """The bin of value ``x`` of feature ``i``, by halves of the features."""
    if hi - lo == 1:
        return _case_search("x", [float(e) for e in edges[lo]])
    mid = (lo + hi) // 2
    return f"CASE WHEN i < {mid} THEN {_case_of_feature(edges, lo, mid)} ELSE {_case_of_feature(edges, mid, hi)} END"


def dense_bins(bins: BinSet, features: str = "features") -> Column:
    """ARRAY<DOUBLE> to ARRAY<INT>."""
    width = max(bins.boundaries, default=-1) + 1
    edges = [np.asarray(bins.boundaries.get(f, ()), float) for f in range(width)]
    if sum(map(len, edges)) <= CASE_BOUNDARIES:
        if sum(map(len, edges)) <= INLINE_BOUNDARIES:
            parts = [_case_search(f"{features}[{f}]", [float(e) for e in edges[f]]) for f in range(width)]
            return F.expr(f"array({', '.join(parts)})").cast("array<int>")
        # A lambda is evaluated apart from the generated loop, whose method the JVM would not compile with all these cuts in it.
        cells = ", ".join(f"{features}[{f}]" for f in range(width))
        return F.expr(f"transform(array({cells}), (x, i) -> {_case_of_feature(edges, 0, width)})").cast("array<int>")

    @F.arrow_udf("array<int>")
    def search(column: pa.Array) -> pa.Array:
        x = column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)
        found = np.empty(x.shape, np.int32)
        for f in range(x.shape[1]):
            found[:, f] = np.searchsorted(edges[f], x[:, f], side="left")
        offsets = pa.array(np.arange(0, found.size + 1, x.shape[1], dtype=np.int32))
        return pa.ListArray.from_arrays(offsets, pa.array(found.ravel()))

    return search(F.col(features))


def sparse_bins(spark: SparkSession, bins: BinSet, features: str = "features") -> Column:
    """MAP<INT, DOUBLE> to MAP<INT, INT> of kept features whose bin is not that of absence."""
    names = np.array(bins.features, np.int64)
    sizes = np.array([len(bins.boundaries[f]) for f in bins.features], np.int64)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    flat = np.concatenate([bins.boundaries[f] for f in bins.features]) if len(names) else np.zeros(0)
    absent = np.array([bins.default_bin(f) for f in bins.features], np.int32)
    shared = spark.sparkContext.broadcast((names, starts, flat, absent))  # at most MAX_BOUNDARIES values

    @F.arrow_udf("map<int,int>")
    def search(column: pa.Array) -> pa.Array:
        names, starts, flat, absent = shared.value
        first = column.offsets[0].as_py()
        offsets = column.offsets.to_numpy() - first
        count = int(offsets[-1])
        keys = column.keys.slice(first, count).to_numpy(zero_copy_only=False)
        x = column.items.slice(first, count).to_numpy(zero_copy_only=False)
        found = np.zeros(count, np.int32)
        kept = np.zeros(count, bool)
        if len(names) and count:
            at = np.minimum(np.searchsorted(names, keys), len(names) - 1)
            # One binary search over all cells at once, each within its own feature's boundaries.
            lo, hi = starts[at], starts[at + 1]
            while np.any(lo < hi):
                mid = (lo + hi) // 2
                below = (lo < hi) & (flat[np.minimum(mid, len(flat) - 1)] < x)
                lo, hi = np.where(below, mid + 1, lo), np.where(below, hi, np.minimum(mid, hi))
            found = (lo - starts[at]).astype(np.int32)
            kept = (names[at] == keys) & (found != absent[at])
        counts = np.concatenate([[0], np.cumsum(kept)])[offsets].astype(np.int32)
        return pa.MapArray.from_arrays(
            pa.array(counts), pa.array(keys[kept].astype(np.int32)), pa.array(found[kept].astype(np.int32))
        )

    return search(F.col(features))


def apply_bins(table: DataFrame, bins: BinSet, features: str = "features", out: str = "bins") -> DataFrame:
    spark = table.sparkSession
    kept = bins.kept
    if not kept:
        column = sparse_bins(spark, bins, features) if bins.sparse else dense_bins(bins, features)
        return table.withColumn(out, column)
    placed = _placed_values(table, kept, features)
    others = BinSet({f: np.zeros(0) if f in kept else b for f, b in bins.boundaries.items()})
    joined, cases = table, ""
    for f, edges in kept.items():
        own = placed.where(F.col("feature") == f).select(F.col("value").alias(f"_value{f}"), F.col("bin").alias(f"_bin{f}"))
        joined = joined.join(own.hint("merge"), F.col(features)[f].cast("double") == F.col(f"_value{f}"), "left")
        cases += f" WHEN {f} THEN coalesce(_bin{f}, {len(edges)})"  # a null is no less than any cut
    binned = joined.withColumn(out, dense_bins(others, features)).withColumn(out, F.expr(f"transform({out}, (b, i) -> CASE i{cases} ELSE b END)"))
    return binned.drop(*(f"{name}{f}" for f in kept for name in ("_value", "_bin")))


def _placed_values(table: DataFrame, kept: dict[int, KeptBoundaries], features: str) -> DataFrame:
    """``feature, value, bin`` of every distinct value of some features: the number of boundaries below it, as a running count."""
    cells = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(features)[f].cast("double").alias("value")) for f in kept])
    marks = table.select(F.explode(cells).alias("c")).select("c.*", F.lit(0).cast("bigint").alias("m"), F.lit(True).alias("here")).where("value IS NOT NULL")
    for f, edges in kept.items():
        marks = marks.unionByName(edges.df.select(F.lit(f).alias("feature"), F.col("boundary").alias("value"), F.lit(1).cast("bigint").alias("m"), F.lit(False).alias("here")))
    counts = cut_lineage(marks.groupBy("feature", "value").agg(F.sum("m").alias("m"), F.max("here").alias("here")))
    ranked = running_sums(counts, ["feature"], "value", ["m"])
    counts.unpersist()
    return ranked.where("here").select("feature", "value", (F.col("cum_m") - F.col("m")).cast("int").alias("bin"))


def boundary_arrays(bins: DataFrame) -> DataFrame:
    """``(feature, boundaries)`` of a bins table."""
    inner = F.when(F.col("hi") < float("inf"), F.col("hi"))
    return bins.groupBy("feature").agg(F.sort_array(F.collect_list(inner)).alias("boundaries"))


def apply_bins_long(cells: DataFrame, bins: DataFrame, sparse: bool = False) -> DataFrame:
    """The same on long rows ``(..., feature, value)``: an equi-join with the bins table.

    Features may be as few as one, so cells never meet in a task for each: up to ``BROADCAST_BINS`` bins go to the cells; more are
    copied ``SALTS`` times, so a feature's cells are dealt over tasks that Spark may split further.
    """
    arrays = boundary_arrays(bins)
    if bins.count() <= BROADCAST_BINS:
        placed = cells.join(F.broadcast(arrays), "feature")
    else:
        arrays = arrays.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        salt = F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int")
        placed = cells.withColumn("_salt", salt).join(arrays, ["feature", "_salt"]).select(*cells.columns, "boundaries")
    out = placed.withColumn("bin", _bucket_of("boundaries", "value")).drop("boundaries")
    return out.filter("bin > 0") if sparse else out


def bin_offsets(bins: DataFrame) -> DataFrame:
    """``(feature, n_bins, offset)``: the first global id of each feature. One row per feature."""
    sizes = bins.groupBy("feature").agg(F.count(F.lit(1)).alias("n_bins"))
    before = Window.partitionBy().orderBy("feature").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.withColumn("offset", F.coalesce(F.sum("n_bins").over(before), F.lit(0)))


def bin_features(binned: DataFrame, bins: DataFrame, key: str = "row_id") -> DataFrame:
    """Sorted global bin ids ``offset + bin`` of every row's (feature, bin) pairs."""
    ids = binned.join(bin_offsets(bins), "feature")
    return ids.groupBy(key).agg(F.sort_array(F.collect_list(F.col("offset") + F.col("bin"))).alias("ids"))


def relayout(df: DataFrame, kind: str, dense: str | None, sparse: list[str], widths: list[int]) -> DataFrame:
    """Rearrange one dense group and several sparse groups.

    ``mix`` keeps the groups; ``dense`` gives one wide array ``bins`` where absent is 0; ``sparse``
    gives one map ``bins`` whose features are numbered group after group (bin 0 left out).
    ``widths`` are the feature counts of the groups, the dense one first when there is one.
    """
    if kind == "mix":
        return df
    groups = ([dense] if dense else []) + list(sparse)
    offsets = [sum(widths[:i]) for i in range(len(widths))]
    if kind == "dense":
        arrays = []
        for i, name in enumerate(groups):
            if name == dense:
                arrays.append(name)
            elif 0 < widths[i] <= WIDE:
                arrays.append(f"array({', '.join(f'coalesce({name}[{k}], 0)' for k in range(widths[i]))})")
            else:
                arrays.append(f"transform(sequence(0, {widths[i] - 1}), i -> coalesce({name}[i], 0))")
        return df.withColumn("bins", F.expr(f"concat({', '.join(arrays)})")).drop(*groups)
    # One map is built of all entries: a map for each step costs more than the rest.
    entries = []
    for i, name in enumerate(groups):
        if name == dense:
            moved = f"transform({name}, (b, i) -> named_struct('k', i + {offsets[i]}, 'b', b))"
        else:
            moved = f"transform(map_entries({name}), e -> named_struct('k', e.key + {offsets[i]}, 'b', e.value))"
        entries.append(f"filter({moved}, e -> e.b > 0)")
    return df.withColumn("bins", F.expr(f"map_from_entries(concat({', '.join(entries)}))")).drop(*groups)


def revert_cuts(nodes: DataFrame, bins: DataFrame) -> DataFrame:
    """Add ``cut``, the original value behind each split's ``bin``: the upper edge of that bin."""
    edges = bins.select("feature", "bin", F.col("hi").alias("cut"))
    return nodes.drop("cut").join(edges, ["feature", "bin"], "left")
