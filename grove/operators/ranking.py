"""Running sums and exact ranks that never need one task to hold a whole group.

A window ordered over a group runs in one task. Groups here may be most of the table (all scores of
an AUC, all values of one feature), so large groups are first cut into order-preserving buckets with
fixed edges. Sums are running inside a bucket, and the bucket offsets, which are few, are added.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TARGET_ROWS = 1_000_000
MAX_EDGES = 1024
BROADCAST_CELLS = 2_000_000


def _with_bucket(df: DataFrame, keys: Sequence[str], order: str, target_rows: int) -> tuple[DataFrame, bool]:
    """Add ``_bucket``: equal values of ``order`` share a bucket, and buckets follow its order."""
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    largest = sizes.agg(F.max("_rows")).first()[0] or 0
    if largest <= target_rows:
        return df.withColumn("_bucket", F.lit(0)), False
    parts = min(MAX_EDGES, -(-largest // target_rows) * 2)
    probabilities = [i / parts for i in range(1, parts)]
    edges = (
        df.groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("_rows"),
            F.percentile_approx(order, probabilities, 20 * parts).alias("_edges"),
        )
        .filter(F.col("_rows") > target_rows)
        .select(*keys, F.array_distinct("_edges").alias("_edges"))
    )
    # Edges are fixed here, once: two branches of a later plan must never see different ones.
    # There is at most one row per group above the target, so this is small next to the data.
    rows = edges.collect()
    fixed = df.sparkSession.createDataFrame(rows, edges.schema)
    if len(rows) * parts <= BROADCAST_CELLS:
        fixed = F.broadcast(fixed)
    joined = df.join(fixed, list(keys), "left") if keys else df.crossJoin(fixed)
    bucket = F.coalesce(F.expr(f"size(filter(_edges, e -> e < {order}))"), F.lit(0))
    return joined.withColumn("_bucket", bucket).drop("_edges"), True


def running_sums(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    values: Sequence[str],
    target_rows: int = TARGET_ROWS,
) -> DataFrame:
    """Add ``cum_<v>`` (inclusive), ``tot_<v>`` and ``next_<order>`` for every row of ``df``.

    ``order`` must be unique inside a group, so aggregate per distinct value before the call.
    """
    keys = list(keys)
    bucketed, split = _with_bucket(df, keys, order, target_rows)
    inside = Window.partitionBy(*keys, "_bucket").orderBy(order)
    to_here = inside.rowsBetween(Window.unboundedPreceding, 0)
    if not split:
        whole = Window.partitionBy(*keys, "_bucket")
        added = [F.sum(v).over(to_here).alias(f"cum_{v}") for v in values]
        added += [F.sum(v).over(whole).alias(f"tot_{v}") for v in values]
        return bucketed.select("*", *added, F.lead(order).over(inside).alias(f"next_{order}")).drop("_bucket")
    per_bucket = bucketed.groupBy(*keys, "_bucket").agg(
        F.min(order).alias("_low"), *[F.sum(v).alias(f"_s_{v}") for v in values]
    )
    across = Window.partitionBy(*keys).orderBy("_bucket")
    before = across.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy(*keys)
    offsets = per_bucket.select(
        *keys,
        "_bucket",
        F.lead("_low").over(across).alias("_next_low"),
        *[F.coalesce(F.sum(f"_s_{v}").over(before), F.lit(0)).alias(f"_o_{v}") for v in values],
        *[F.sum(f"_s_{v}").over(every).alias(f"tot_{v}") for v in values],
    )
    local = bucketed.select(
        "*",
        *[F.sum(v).over(to_here).alias(f"_c_{v}") for v in values],
        F.lead(order).over(inside).alias("_next"),
    )
    joined = local.join(offsets, [*keys, "_bucket"])
    return joined.select(
        *df.columns,
        *[(F.col(f"_c_{v}") + F.col(f"_o_{v}")).alias(f"cum_{v}") for v in values],
        *[F.col(f"tot_{v}") for v in values],
        F.coalesce("_next", "_next_low").alias(f"next_{order}"),
    )


def tile(
    df: DataFrame,
    parts: int,
    order: str | Column,
    key: str,
    strata: Sequence[str] = (),
    target_rows: int = TARGET_ROWS,
) -> DataFrame:
    """Add ``fold`` 1..parts like ``ntile(parts) over (partition by strata order by order, key)``.

    Only the ``parts - 1`` boundary rows of each stratum are looked up, so the table itself is not
    sorted or shuffled: the assignment is a comparison with a few fixed values.
    """
    strata = list(strata)
    order = F.col(order) if isinstance(order, str) else order
    slim = df.select(*strata, order.alias("_o"), F.col(key).alias("_k"))
    bucketed, _ = _with_bucket(slim, strata, "_o", target_rows)
    counts = bucketed.groupBy(*strata, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    every = Window.partitionBy(*strata)
    before = every.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        *strata,
        "_bucket",
        "_n",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"),
        F.sum("_n").over(every).alias("_total"),
    )
    # Rank (1-based) at which each part after the first begins.
    wanted = (
        starts.select("*", F.explode(F.sequence(F.lit(1), F.lit(parts - 1))).alias("_part"))
        if parts > 1
        else starts.select("*", F.lit(0).alias("_part")).limit(0)
    )
    wanted = wanted.withColumn(
        "_rank", F.expr(f"_part * (_total div {parts}) + least(_part, _total % {parts}) + 1")
    ).filter("_rank > _offset AND _rank <= _offset + _n")
    in_bucket = Window.partitionBy(*strata, "_bucket").orderBy("_o", "_k")
    needed = bucketed.join(F.broadcast(wanted.select(*strata, "_bucket").distinct()), [*strata, "_bucket"], "left_semi")
    ranked = needed.withColumn("_pos", F.row_number().over(in_bucket))
    found = ranked.join(F.broadcast(wanted), [*strata, "_bucket"]).filter("_pos = _rank - _offset")
    bounds = found.groupBy(*strata).agg(F.sort_array(F.collect_list(F.struct("_o", "_k"))).alias("_bounds"))
    rows = bounds.collect()  # parts - 1 boundary keys per stratum
    if not rows:
        return df.withColumn("fold", F.lit(1))
    fixed = F.broadcast(df.sparkSession.createDataFrame(rows, bounds.schema))
    here = F.struct(order.alias("_o"), F.col(key).alias("_k"))
    base = df.withColumn("_here", here)
    joined = base.join(fixed, strata, "left") if strata else base.crossJoin(fixed)
    fold = F.expr("1 + coalesce(size(filter(_bounds, b -> b <= _here)), 0)")
    return joined.withColumn("fold", fold).drop("_bounds", "_here")
