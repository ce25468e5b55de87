"""Binning, histograms, splits, routing and leaf statistics."""

from __future__ import annotations

from types import SimpleNamespace

import numpy as np
from pyspark.sql import Window
from pyspark.sql import functions as F

from grove.forest import Forest, Node, Tree
from grove.operators import binning as B
from grove.operators import correct, histogram, route, splits
from grove.plans.binned import BinnedParams, BinnedTrainer
from grove.plans.leafwise import LeafwiseParams, LeafwiseTrainer
from grove.plans.rows import TrainingRows, frontier_sql
from grove.queries import ORACLES, register
from grove.queries.inputs import (
    BINS_SQL, CELLS_SQL, PRICE, ROWS_SQL, TOKENS_SQL, ALL_TOKENS_SQL, document_features, document_table, lineitem, price_table, read, scratch, unlabelled_table,
)


def _big(df, *names):
    return df.withColumns({n: F.col(n).cast("bigint") for n in names})


def _round(df, digits, *names):
    return df.withColumns({n: F.round(n, digits) for n in names})


# ---------------------------------------------------------------- binning


@register(
    "b_value_summary",
    CELLS_SQL.replace("CAST(1 AS DOUBLE) AS w", "l_quantity / 100 AS w")
    .join(["WITH ", """, f AS (SELECT greatest(1, count(*) / sum(w)) AS f FROM rows_)
 SELECT CAST(feature AS BIGINT) AS feature, value, round(sum(w) * max(f.f), 5) AS w, round(sum(w * y) * max(f.f), 3) AS wy, count(*) AS n
 FROM cells, f GROUP BY feature, value"""]),
)
def b_value_summary(spark, sf):
    df = B.value_summary(price_table(spark, sf).withColumn("weight", F.expr("features[0] / 100")))
    return _round(_round(_big(df, "feature"), 5, "w"), 3, "wy")


_CUT = """, s AS (SELECT feature, value, sum(w) AS w, sum(w * y) AS wy FROM cells GROUP BY feature, value),
 k AS (SELECT *, sum(w) OVER (PARTITION BY feature ORDER BY value) AS cw, sum(wy) OVER (PARTITION BY feature ORDER BY value) AS cy,
 sum(w) OVER (PARTITION BY feature) AS tw, sum(wy) OVER (PARTITION BY feature) AS ty, lead(value) OVER (PARTITION BY feature ORDER BY value) AS nxt FROM s),
 g AS (SELECT feature, 0.5 * (value + nxt) AS cut, cw AS left_w, tw - cw AS right_w,
 cy * cy / (cw + 2) + (ty - cy) * (ty - cy) / (tw - cw + 2) - ty * ty / (tw + 4) AS gain FROM k WHERE nxt IS NOT NULL AND cw >= 5 AND tw - cw >= 5),
 best AS (SELECT * FROM g WHERE gain > 0 QUALIFY row_number() OVER (PARTITION BY feature ORDER BY gain DESC, cut) = 1)"""


@register(
    "b_best_cut",
    "WITH " + CELLS_SQL + _CUT + """ SELECT CAST(feature AS BIGINT) AS feature, round(gain, 3) AS gain, round(cut, 6) AS cut,
 round(left_w, 3) AS left_w, round(right_w, 3) AS right_w FROM best""",
)
def b_best_cut(spark, sf):
    df = B.best_cut(B.value_summary(price_table(spark, sf)))
    return _round(_round(_big(df, "feature"), 3, "gain", "left_w", "right_w"), 6, "cut")


@register(
    "b_fit_two_bins",
    "WITH " + CELLS_SQL + _CUT + """, b AS (SELECT feature, CAST(0 AS BIGINT) AS bin, CAST('-inf' AS DOUBLE) AS lo, cut AS hi FROM best
 UNION ALL SELECT feature, 1, cut, CAST('inf' AS DOUBLE) FROM best)
 SELECT CAST(b.feature AS BIGINT) AS feature, bin, count(*) AS n, round(sum(y), 6) AS label_sum FROM cells JOIN b ON cells.feature = b.feature
 AND value > lo AND value <= hi GROUP BY b.feature, bin""",
)
def b_fit_two_bins(spark, sf):
    table = price_table(spark, sf)
    binned = B.apply_bins(table, B.fit_bins(table, max_bins=2))
    cells = binned.select("label", F.posexplode("bins").alias("feature", "bin"))
    df = cells.groupBy("feature", "bin").agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("label_sum"))
    return _round(_big(df, "feature", "bin"), 6, "label_sum")


@register("b_fit_bins")
def b_fit_bins(spark, sf):
    """Greedy bins of a feature with many values: the whole price column, 64 bins."""
    rows = lineitem(spark, sf).selectExpr("array(l_extendedprice, l_quantity) AS features", "l_discount * 100 AS label", "1D AS weight")
    return B.fit_bins(rows, max_bins=64).to_df(spark)


@register(
    "b_select_features",
    "WITH " + ALL_TOKENS_SQL + " SELECT CAST(feature AS BIGINT) AS feature, count(*) AS occurrences FROM counts GROUP BY feature HAVING count(*) >= 5",
)
def b_select_features(spark, sf):
    return _big(B.select_features(unlabelled_table(spark, sf)), "feature")


_SPARSE_SUMMARY = """, kept AS (SELECT feature, sum(w) AS fw, sum(w * y) AS fwy, count(*) AS fn FROM docs GROUP BY feature HAVING count(*) >= 5),
 tot AS (SELECT sum(w) AS tw, sum(w * y) AS twy, count(*) AS tn FROM (SELECT DISTINCT doc_id, w, y FROM docs)),
 summ AS (SELECT feature, value, sum(w) AS w, sum(w * y) AS wy, count(*) AS n FROM docs SEMI JOIN kept USING (feature) GROUP BY feature, value
 UNION ALL SELECT feature, CAST(-3.4028234663852886e38 AS DOUBLE), tw - fw, twy - fwy, tn - fn FROM kept, tot WHERE tw > fw + 1e-5)"""


@register(
    "b_sparse_summary",
    "WITH " + TOKENS_SQL + _SPARSE_SUMMARY + " SELECT CAST(feature AS BIGINT) AS feature, value, round(w, 6) AS w, round(wy, 6) AS wy, CAST(n AS BIGINT) AS n FROM summ",
)
def b_sparse_summary(spark, sf):
    return _round(_big(B.sparse_value_summary(document_table(spark, sf, keep=True)), "feature", "n"), 6, "w", "wy")


@register(
    "b_fit_sparse_top",
    "WITH " + TOKENS_SQL + _SPARSE_SUMMARY + ", cells AS (SELECT feature, value, w, wy / w AS y FROM summ)" + _CUT
    + """ SELECT CAST(feature AS BIGINT) AS feature, round(gain, 6) AS gain, CASE WHEN cut < -1e30 THEN -1 ELSE round(cut, 6) END AS cut
 FROM best ORDER BY round(gain, 9) DESC, feature LIMIT 50""",
)
def b_fit_sparse_top(spark, sf):
    cut = B.best_cut(B.sparse_value_summary(document_table(spark, sf, keep=True))).withColumn("gain", F.round("gain", 9))
    top = B.top_features(cut, 50)
    shown = F.when(F.col("cut") < -1e30, F.lit(-1.0)).otherwise(F.round("cut", 6))
    return _big(top.select("feature", F.round("gain", 6).alias("gain"), shown.alias("cut")), "feature")


@register("b_fit_sparse_bins")
def b_fit_sparse_bins(spark, sf):
    return B.fit_sparse_bins(document_table(spark, sf, keep=True), max_features=1000).to_df(spark)


_BIN_COUNTS = "WITH " + BINS_SQL + " SELECT CAST(feature AS BIGINT) AS feature, CAST(bin AS BIGINT) AS bin, count(*) AS n, round(sum(y), 6) AS label_sum FROM binned GROUP BY feature, bin"


def _bin_counts(binned):
    cells = binned.select("label", F.posexplode("bins").alias("feature", "bin"))
    df = cells.groupBy("feature", "bin").agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("label_sum"))
    return _round(_big(df, "feature", "bin"), 6, "label_sum")


@register("b_apply_bins", _BIN_COUNTS)
def b_apply_bins(spark, sf):
    table = price_table(spark, sf)
    return _bin_counts(B.apply_bins(table, B.fit_fine_bins(table)))


@register("b_save_load", _BIN_COUNTS)
def b_save_load(spark, sf):
    table = price_table(spark, sf)
    path = scratch(spark)
    B.fit_fine_bins(table).save(spark, path)
    return _bin_counts(B.apply_bins(table, B.BinSet.load(spark, path)))


@register("b_apply_bins_long", _BIN_COUNTS)
def b_apply_bins_long(spark, sf):
    table = price_table(spark, sf)
    cells = table.select("label", F.posexplode("features").alias("feature", "value"))
    placed = B.apply_bins_long(cells, B.fit_fine_bins(table).to_df(spark))
    df = placed.groupBy("feature", "bin").agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("label_sum"))
    return _round(_big(df, "feature", "bin"), 6, "label_sum")


_DOC_BINS = TOKENS_SQL + """, kept AS (SELECT feature FROM docs GROUP BY feature HAVING count(*) >= 5),
 v AS (SELECT feature, value, dense_rank() OVER (PARTITION BY feature ORDER BY value) AS bin FROM (SELECT DISTINCT feature, value FROM docs SEMI JOIN kept USING (feature))),
 dbins AS (SELECT docs.*, v.bin FROM docs JOIN v USING (feature, value))"""


@register(
    "b_apply_sparse",
    "WITH " + _DOC_BINS + " SELECT CAST(feature AS BIGINT) AS feature, CAST(bin AS BIGINT) AS bin, count(*) AS n, round(sum(y), 6) AS label_sum FROM dbins GROUP BY feature, bin",
)
def b_apply_sparse(spark, sf):
    table = document_table(spark, sf, keep=True)
    binned = B.apply_bins(table, B.fit_fine_bins(table, max_bins=100_000, min_occurrences=5))
    cells = binned.select("label", F.explode("bins").alias("feature", "bin"))
    df = cells.groupBy("feature", "bin").agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("label_sum"))
    return _round(_big(df, "feature", "bin"), 6, "label_sum")


@register(
    "b_relayout",
    "WITH " + BINS_SQL + """, r AS (SELECT feature, bin, count(*) AS n FROM binned GROUP BY feature, bin)
 SELECT 'dense' AS layout, CAST(feature AS BIGINT) AS feature, CAST(bin AS BIGINT) AS bin, n FROM r
 UNION ALL SELECT 'sparse', CAST(feature AS BIGINT), CAST(bin AS BIGINT), n FROM r WHERE bin > 0""",
)
def b_relayout(spark, sf):
    table = price_table(spark, sf)
    bins = B.apply_bins(table, B.fit_fine_bins(table)).select(
        F.slice("bins", 1, 1).alias("a"), F.map_from_arrays(F.array(F.lit(0), F.lit(1)), F.slice("bins", 2, 2)).alias("b")
    )
    dense = B.relayout(bins, "dense", "a", ["b"], [1, 2]).select(F.lit("dense").alias("layout"), F.posexplode("bins").alias("feature", "bin"))
    sparse = B.relayout(bins, "sparse", "a", ["b"], [1, 2]).select(F.lit("sparse").alias("layout"), F.explode("bins").alias("feature", "bin"))
    both = dense.unionByName(sparse).groupBy("layout", "feature", "bin").agg(F.count(F.lit(1)).alias("n"))
    return _big(both, "feature", "bin")


@register(
    "b_bin_features",
    """WITH vals AS (SELECT 0 AS feature, o_orderstatus AS v, dense_rank() OVER (ORDER BY o_orderstatus) - 1 AS bin FROM (SELECT DISTINCT o_orderstatus FROM orders)
 UNION ALL SELECT 1, o_orderpriority, dense_rank() OVER (ORDER BY o_orderpriority) - 1 FROM (SELECT DISTINCT o_orderpriority FROM orders)),
 off AS (SELECT count(*) AS o FROM vals WHERE feature = 0)
 SELECT o_orderkey AS row_id, CAST(a.bin AS VARCHAR) || ',' || CAST(b.bin + o AS VARCHAR) AS ids FROM orders, off, vals a, vals b
 WHERE a.feature = 0 AND a.v = o_orderstatus AND b.feature = 1 AND b.v = o_orderpriority""",
)
def b_bin_features(spark, sf):
    orders = read(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    long = orders.select(
        F.col("o_orderkey").alias("row_id"),
        F.explode(F.array(F.struct(F.lit(0).alias("feature"), F.col("o_orderstatus").alias("v")), F.struct(F.lit(1).alias("feature"), F.col("o_orderpriority").alias("v")))).alias("c"),
    ).select("row_id", "c.*")
    values = long.select("feature", "v").distinct()
    bins = values.withColumn("bin", F.dense_rank().over(Window.partitionBy("feature").orderBy("v")) - 1)  # a dozen values
    ids = B.bin_features(long.join(F.broadcast(bins), ["feature", "v"]), bins)
    return ids.select("row_id", F.array_join(F.transform("ids", lambda i: i.cast("string")), ",").alias("ids"))


@register("b_bin_then_train")
def b_bin_then_train(spark, sf):
    """Bins stored first, the binned table written, then trained on: the same forest as in one go."""
    from grove.plans.binned import BinnedParams
    from grove.plans.fit import train_on_bins
    from grove.plans.rows import binned_rows

    table = price_table(spark, sf)
    path = scratch(spark)
    bins = B.fit_fine_bins(table)
    count = table.count()
    binned_rows(table, bins, count).write.parquet(path)
    params = BinnedParams(n_estimators=1, max_depth=2, l2=10.0)
    fitted = train_on_bins(spark.read.parquet(path), bins, params, count, 3)
    return fitted.forest.nodes_df(spark)


# ---------------------------------------------------------------- histograms and splits

_NODES = "WITH " + BINS_SQL + """, hist AS (SELECT ln % 2 AS node, feature, bin, sum(y - 40) AS g, count(*) AS h, count(*) AS n FROM binned GROUP BY ln % 2, feature, bin)"""
_CAND = _NODES + """, k AS (SELECT *, sum(g) OVER w AS gl, CAST(sum(h) OVER w AS DOUBLE) AS hl, sum(n) OVER w AS nl, sum(g) OVER p AS gt, CAST(sum(h) OVER p AS DOUBLE) AS ht, sum(n) OVER p AS nt FROM hist
 WINDOW w AS (PARTITION BY node, feature ORDER BY bin), p AS (PARTITION BY node, feature)),
 cand AS (SELECT node, feature, bin, gl, hl, nl, gt - gl AS gr, ht - hl AS hr, nt - nl AS nr, gt, ht, nt FROM k WHERE nl < nt)"""


def _rows(spark, sf):
    table = price_table(spark, sf).withColumn("ln", F.lit(0))
    li = lineitem(spark, sf).select(F.array("l_quantity", "l_discount", "l_tax").alias("features"), F.expr(PRICE).alias("label"), F.lit(1.0).alias("weight"), "l_linenumber")
    binned = B.apply_bins(li, B.fit_fine_bins(table))
    return binned.select(
        F.expr("l_linenumber % 2").alias("node"), "bins", F.expr("label - 40").alias("g"), F.lit(1.0).alias("h"), F.lit(1).cast("bigint").alias("n"), "label"
    )


_HIST_OUT = " SELECT CAST(node AS BIGINT) AS node, CAST(feature AS BIGINT) AS feature, CAST(bin AS BIGINT) AS bin, round(g, 6) AS g, round(CAST(h AS DOUBLE), 6) AS h, CAST(n AS BIGINT) AS n FROM hist"


def _hist_out(df):
    return _round(_big(df, "node", "feature", "bin", "n"), 6, "g", "h")


@register("h_dense", _NODES + _HIST_OUT)
def h_dense(spark, sf):
    return _hist_out(histogram.node_histogram(_rows(spark, sf)))


@register(
    "h_wide",
    """WITH c AS (SELECT label % 2 AS node, label AS y, unnest(embedding) AS v, unnest(range(64)) AS feature FROM embeddings)
 SELECT CAST(node AS BIGINT) AS node, CAST(feature AS BIGINT) AS feature, CAST(least(3, greatest(0, floor(v * 10 + 2))) AS BIGINT) AS bin,
 round(CAST(sum(y - 4) AS DOUBLE), 6) AS g, round(CAST(count(*) AS DOUBLE), 6) AS h, count(*) AS n FROM c GROUP BY 1, 2, 3""",
)
def h_wide(spark, sf):
    """64 features: per-task Arrow sums, then one small shuffle."""
    rows = read(spark, sf, "embeddings").selectExpr(
        "label % 2 AS node",
        "transform(embedding, v -> int(least(3, greatest(0, floor(double(v) * 10 + 2))))) AS bins",
        "double(label - 4) AS g", "1D AS h", "1L AS n",
    )
    return _hist_out(histogram.node_histogram(rows, 2, [4] * 64))


@register(
    "h_sparse",
    "WITH " + _DOC_BINS + """, nodes AS (SELECT DISTINCT doc_id, doc_id % 2 AS node, y FROM docs), tot AS (SELECT node, sum(y) AS g, count(*) AS n FROM nodes GROUP BY node),
 pres AS (SELECT doc_id % 2 AS node, feature, bin, sum(y) AS g, count(*) AS n FROM dbins GROUP BY doc_id % 2, feature, bin),
 hist AS (SELECT node, feature, bin, g, n AS h, n FROM pres UNION ALL SELECT t.node, p.feature, 0, max(t.g) - sum(p.g), max(t.n) - sum(p.n), max(t.n) - sum(p.n)
 FROM pres p JOIN tot t ON p.node = t.node GROUP BY t.node, p.feature HAVING max(t.n) > sum(p.n))""" + _HIST_OUT,
)
def h_sparse(spark, sf):
    table = document_table(spark, sf, keep=True)
    binned = B.apply_bins(table, B.fit_fine_bins(table, max_bins=100_000, min_occurrences=5))
    rows = binned.selectExpr("int(row_id % 2) AS node", "bins", "label AS g", "1D AS h", "1L AS n")
    return _hist_out(histogram.node_histogram_sparse(rows))


@register(
    "h_node_totals",
    "WITH " + ROWS_SQL + " SELECT CAST(ln % 2 AS BIGINT) AS node, round(sum(y - 40), 6) AS g, round(CAST(count(*) AS DOUBLE), 6) AS h, count(*) AS n FROM rows_ GROUP BY ln % 2",
)
def h_node_totals(spark, sf):
    return _round(_big(histogram.node_totals(_rows(spark, sf)), "node", "n"), 6, "g", "h")


@register(
    "h_candidates",
    _CAND + """ SELECT CAST(node AS BIGINT) AS node, CAST(feature AS BIGINT) AS feature, CAST(bin AS BIGINT) AS bin, round(gl, 6) AS g_left, round(gr, 6) AS g_right,
 CAST(nl AS BIGINT) AS n_left, CAST(nr AS BIGINT) AS n_right FROM cand WHERE nl >= 100 AND nr >= 100""",
)
def h_candidates(spark, sf):
    cand = splits.split_candidates(histogram.node_histogram(_rows(spark, sf)), min_rows=100)
    return _round(_big(cand, "node", "feature", "bin", "n_left", "n_right"), 6, "g_left", "g_right").select(
        "node", "feature", "bin", "g_left", "g_right", "n_left", "n_right"
    )


def _scaled(spark, sf, **options):
    hist = histogram.node_histogram(_rows(spark, sf))
    facts = spark.createDataFrame([(0, 1, 0.5), (1, 2, -0.25)], "node int, depth int, weight double")
    return splits.split_gain(splits.split_candidates(hist, **options.pop("limits", {})), node_facts=facts, **options)


def _gain_out(df):
    df = _round(_round(_big(df, "node", "feature", "bin"), 3, "gain"), 6, "left_weight", "right_weight")
    return df.select("node", "feature", "bin", "gain", "left_weight", "right_weight")


# Node 0 has depth 1 and weight 0.5, node 1 depth 2 and weight -0.25; lambda times n is 30, gamma 1.5.
_FACTS = _CAND + """, f AS (SELECT *, CASE node WHEN 0 THEN 0.5 ELSE -0.25 END::DOUBLE AS p, 30 * power(1.5, node + 1)::DOUBLE AS pl, 45 * power(1.5, node + 1)::DOUBLE AS cl FROM cand)"""
_GAIN_OUT = """ SELECT CAST(node AS BIGINT) AS node, CAST(feature AS BIGINT) AS feature, CAST(bin AS BIGINT) AS bin, round(gain, 3) AS gain, round(wl, 6) AS left_weight, round(wr, 6) AS right_weight FROM r"""
_L2 = _FACTS + """, x AS (SELECT *, (gl - cl * p) / (hl + cl) AS ql, (gr - cl * p) / (hr + cl) AS qr FROM f),
 r AS (SELECT node, feature, bin, nl, nr, ql * ql * (hl + cl) + qr * qr * (hr + cl) + (pl - 2 * cl) * p * p AS gain, ql + p AS wl, qr + p AS wr FROM x)"""


@register("h_gain_l2", _L2 + _GAIN_OUT)
def h_gain_l2(spark, sf):
    return _gain_out(_scaled(spark, sf, kind="l2", nlam=30.0, gamma=1.5))


@register(
    "h_gain_internal",
    _FACTS + ", r AS (SELECT node, feature, bin, gl * gl / (hl + cl) + gr * gr / (hr + cl) AS gain, gl / (hl + cl) AS wl, gr / (hr + cl) AS wr FROM f)" + _GAIN_OUT,
)
def h_gain_internal(spark, sf):
    return _gain_out(_scaled(spark, sf, kind="internal", nlam=30.0, gamma=1.5))


_SOFT = "CASE WHEN {x} > {t} THEN {x} - {t} WHEN {x} < -{t} THEN {x} + {t} ELSE 0 END"


@register(
    "h_gain_l1l2",
    _FACTS
    + ", y AS (SELECT *, gl + hl * p AS tl, gr + hr * p AS tr, 20 * power(1.5, node + 1)::DOUBLE AS ps, 30 * power(1.5, node + 1)::DOUBLE AS cs FROM f),"
    + f" x AS (SELECT *, ({_SOFT.format(x='tl', t='cs')}) / (hl + cl) AS wl, ({_SOFT.format(x='tr', t='cs')}) / (hr + cl) AS wr FROM y),"
    + """ r AS (SELECT node, feature, bin, p * p * (hl + pl) - 2 * p * tl + 2 * ps * abs(p) + wl * wl * (hl + cl) + p * p * (hr + pl) - 2 * p * tr + 2 * ps * abs(p) + wr * wr * (hr + cl) AS gain, wl, wr FROM x)"""
    + _GAIN_OUT,
)
def h_gain_l1l2(spark, sf):
    return _gain_out(_scaled(spark, sf, kind="l1l2", nlam=30.0, nsig=20.0, gamma=1.5))


@register(
    "h_gain_minpen",
    _FACTS
    + """, x AS (SELECT *, (gl - 30 * 0.1) / (hl + 30 * 0.6) AS a, (gr - 30 * 0.1) / (hr + 30 * 0.6) AS b FROM f),
 c AS (SELECT *, 0.01 + 0.1 * (a + b) + 0.6 * (a * a + b * b) / 2 - 0.2 * a * b AS ch FROM x),
 r AS (SELECT node, feature, bin, 2 * a * gl - a * a * hl + 2 * b * gr - b * b * hr - 60 * ch AS gain, a + p AS wl, b + p AS wr FROM c)"""
    + _GAIN_OUT,
)
def h_gain_minpen(spark, sf):
    hist = histogram.node_histogram(_rows(spark, sf))
    names = "node int, depth int, weight double, d_r double, dd_r double, offset double, lin double, quad double, cross double"
    facts = spark.createDataFrame([(0, 1, 0.5, 0.1, 0.6, 0.01, 0.1, 0.6, -0.2), (1, 2, -0.25, 0.1, 0.6, 0.01, 0.1, 0.6, -0.2)], names)
    return _gain_out(splits.split_gain(splits.split_candidates(hist), "minpen", nlam=30.0, node_facts=facts))


_BINNED = (
    _FACTS
    + ", t AS (SELECT *, p * hl + gl AS yl, p * hr + gr AS yr, p * ht + gt AS yt, hl + 10 + 1e-10 AS vl, hr + 10 + 1e-10 AS vr, ht + 10 + 1e-10 AS vt FROM f WHERE hl >= 5 * ht / (nt + 1e-10) AND hr >= 5 * ht / (nt + 1e-10)),"
    + f" x AS (SELECT *, {_SOFT.format(x='(yl / vl)', t='(2 / vl)')} AS wl, {_SOFT.format(x='(yr / vr)', t='(2 / vr)')} AS wr, {_SOFT.format(x='(yt / vt)', t='(2 / vt)')} AS wt FROM t),"
    + """ r AS (SELECT node, feature, bin, nl, nr, (0.5 * vt * wt * wt - wt * yt + 2 * abs(wt)) - (0.5 * vl * wl * wl - wl * yl + 2 * abs(wl)) - (0.5 * vr * wr * wr - wr * yr + 2 * abs(wr)) AS gain, wl, wr FROM x)"""
)


@register("h_gain_binned", _BINNED + _GAIN_OUT)
def h_gain_binned(spark, sf):
    return _gain_out(_scaled(spark, sf, kind="binned", l1=2.0, l2=10.0, limits={"min_sample": 5.0}))


_BEST = ", b AS (SELECT * FROM r WHERE gain > {tie} QUALIFY row_number() OVER (PARTITION BY node ORDER BY gain DESC, feature, bin) = 1)"


@register("h_best_l2", _L2 + _BEST.format(tie=0) + _GAIN_OUT.replace("FROM r", "FROM b"))
def h_best_l2(spark, sf):
    return _gain_out(splits.best_splits(_scaled(spark, sf, kind="l2", nlam=30.0, gamma=1.5)))


@register("h_best_binned", _BINNED + _BEST.format(tie="1e-6") + _GAIN_OUT.replace("FROM r", "FROM b"))
def h_best_binned(spark, sf):
    scored = _scaled(spark, sf, kind="binned", l1=2.0, l2=10.0, limits={"min_sample": 5.0})
    return _gain_out(splits.best_splits(scored, splits.BINNED_TIE))


@register("h_sibling", _NODES + " SELECT CAST(feature AS BIGINT) AS feature, CAST(bin AS BIGINT) AS bin, round(g, 6) AS g, round(CAST(h AS DOUBLE), 6) AS h, CAST(n AS BIGINT) AS n FROM hist WHERE node = 1")
def h_sibling(spark, sf):
    hist = histogram.node_histogram(_rows(spark, sf))
    parent = hist.groupBy("feature", "bin").agg(F.sum("g").alias("g"), F.sum("h").alias("h"), F.sum("n").alias("n"))
    other = histogram.sibling_histogram(parent, hist.filter("node = 0"))
    return _round(_big(other, "feature", "bin", "n"), 6, "g", "h")


@register(
    "h_sample_features",
    "WITH " + ALL_TOKENS_SQL + """, f AS (SELECT DISTINCT feature FROM counts),
 o AS (SELECT feature, row_number() OVER (ORDER BY CAST('0x' || substr(md5(CAST(feature AS VARCHAR) || '-5'), 1, 15) AS BIGINT), feature) AS r FROM f)
 SELECT CAST(feature AS BIGINT) AS feature FROM o WHERE r <= greatest(1, floor((SELECT count(*) FROM f) * 0.1))""",
)
def h_sample_features(spark, sf):
    return _big(splits.sample_features(document_features(spark, sf), 0.1, seed=5), "feature")


# ---------------------------------------------------------------- routing and leaf statistics

# Two fixed splits: feature 0 at bin 23, and below its left child feature 1 at bin 4.
_ROUTED = "WITH " + BINS_SQL + """, pv AS (SELECT q, d, t, y, w, (SELECT count(*) FROM vals v WHERE v.feature = 0 AND v.value < q) AS b0,
 (SELECT count(*) FROM vals v WHERE v.feature = 1 AND v.value < d) AS b1, (SELECT count(*) FROM vals v WHERE v.feature = 2 AND v.value < t) AS b2 FROM rows_),
 routed AS (SELECT *, CASE WHEN b0 <= 23 THEN CASE WHEN b1 <= 4 THEN 3 ELSE 4 END ELSE 2 END AS node FROM pv)"""


def _routed(spark, sf):
    table = price_table(spark, sf)
    rows = B.apply_bins(table, B.fit_fine_bins(table)).withColumns({"node": F.lit(0), "score": F.lit(0.0)})
    schema = "node int, feature int, bin int, left int, right int"
    first = route.route(rows, spark.createDataFrame([(0, 0, 23, 1, 2)], schema))
    return route.route(first, spark.createDataFrame([(1, 1, 4, 3, 4)], schema))


@register("r_route", _ROUTED + " SELECT CAST(node AS BIGINT) AS node, count(*) AS n, round(sum(y), 6) AS label_sum FROM routed GROUP BY node")
def r_route(spark, sf):
    df = _routed(spark, sf).groupBy("node").agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("label_sum"))
    return _round(_big(df, "node"), 6, "label_sum")


@register(
    "r_update_scores",
    _ROUTED + """ SELECT CAST(node AS BIGINT) AS node, round(CAST(sum(CASE node WHEN 3 THEN -0.5 WHEN 4 THEN 0.25 ELSE 0.75 END) AS DOUBLE), 3) AS score_sum FROM routed GROUP BY node""",
)
def r_update_scores(spark, sf):
    changes = spark.createDataFrame([(3, -0.5), (4, 0.25), (2, 0.75)], "node int, delta double")
    df = route.update_scores(_routed(spark, sf), changes).groupBy("node").agg(F.sum("score").alias("score_sum"))
    return _round(_big(df, "node"), 3, "score_sum")


@register(
    "b_revert_cuts",
    "WITH " + BINS_SQL + """ SELECT CAST(feature AS BIGINT) AS feature, CAST(bin AS BIGINT) AS bin, round(0.5 * (value + nxt), 6) AS cut FROM vals WHERE nxt IS NOT NULL""",
)
def b_revert_cuts(spark, sf):
    bins = B.fit_fine_bins(price_table(spark, sf)).to_df(spark)
    nodes = bins.filter("hi < double('Infinity')").select("feature", "bin", F.lit(0.0).alias("cut"))
    return _round(_big(B.revert_cuts(nodes, bins), "feature", "bin"), 6, "cut").select("feature", "bin", "cut")


# Leaves of two trees: tree 0 as routed above, tree 1 splits feature 2 at bin 3.
_LEAVES = _ROUTED + """, lv AS (SELECT y, w, node, CASE WHEN b2 <= 3 THEN 1 ELSE 2 END AS other FROM routed)"""
_STATS = _LEAVES + """, st AS (SELECT 0 AS tree, node AS leaf, sum(y - 40) AS g, count(*) AS h, count(*) AS n FROM lv GROUP BY node
 UNION ALL SELECT 1, other, sum(y - 40), count(*), count(*) FROM lv GROUP BY other)"""


def _leaves(spark, sf):
    return _routed(spark, sf).select(
        "label", "weight", F.array(F.col("node"), F.expr("IF(bins[2] <= 3, 1, 2)")).alias("leaves"), F.expr("label - 40").alias("g"), F.lit(1.0).alias("h"), F.lit(1).cast("bigint").alias("n")
    )


@register(
    "w_leaf_stats",
    _STATS + " SELECT CAST(tree AS BIGINT) AS tree, CAST(leaf AS BIGINT) AS leaf, round(g, 6) AS g, round(CAST(h AS DOUBLE), 6) AS h, CAST(n AS BIGINT) AS n FROM st",
)
def w_leaf_stats(spark, sf):
    return _round(_big(correct.leaf_stats(_leaves(spark, sf)), "tree", "leaf", "n"), 6, "g", "h")


def _weighted_stats(spark, sf):
    return correct.leaf_stats(_leaves(spark, sf)).withColumns({"weight": F.expr("leaf / 8D"), "depth": F.expr("IF(leaf > 2, 2, 1)")})


@register(
    "w_newton_step",
    _STATS + """, z AS (SELECT *, leaf / 8 AS wt, 50 * power(1.2, CASE WHEN leaf > 2 THEN 2 ELSE 1 END) AS nl FROM st)
 SELECT CAST(tree AS BIGINT) AS tree, CAST(leaf AS BIGINT) AS leaf, round(0.5 * (g - nl * wt) / (h + nl), 6) AS delta, round(wt + 0.5 * (g - nl * wt) / (h + nl), 6) AS new_weight FROM z""",
)
def w_newton_step(spark, sf):
    df = correct.newton_step(_weighted_stats(spark, sf), 50.0, 1.2)
    return _round(_big(df, "tree", "leaf"), 6, "delta", "new_weight").select("tree", "leaf", "delta", "new_weight")


@register(
    "w_newton_step_l1",
    _STATS + """, z AS (SELECT *, leaf / 8 AS wt, 50 * power(1.2, CASE WHEN leaf > 2 THEN 2 ELSE 1 END) AS nl, 300 * power(1.2, CASE WHEN leaf > 2 THEN 2 ELSE 1 END) AS ns FROM st),
 a AS (SELECT *, 0.5 * (g - nl * wt) / (h + nl) AS d0, 0.5 * ns / (h + nl) AS pull FROM z),
 b AS (SELECT *, CASE WHEN wt + d0 > 0 THEN d0 - pull ELSE d0 + pull END AS d1 FROM a),
 c AS (SELECT *, greatest(-1, least(1, CASE WHEN (wt + d0) * (wt + d1) <= 0 THEN -wt ELSE d1 END)) AS delta FROM b)
 SELECT CAST(tree AS BIGINT) AS tree, CAST(leaf AS BIGINT) AS leaf, round(delta, 6) AS delta, round(wt + delta, 6) AS new_weight FROM c""",
)
def w_newton_step_l1(spark, sf):
    df = correct.newton_step(_weighted_stats(spark, sf), 50.0, 1.2, nsig=300.0, max_delta=1.0)
    return _round(_big(df, "tree", "leaf"), 6, "delta", "new_weight").select("tree", "leaf", "delta", "new_weight")


@register(
    "w_soft_step",
    _STATS + f""", z AS (SELECT *, leaf / 8 AS wt, h + 1000 + 1e-10 AS v, (leaf / 8 * h + g) AS t FROM st), x AS (SELECT *, {_SOFT.format(x='(t / v)', t='(5 / v)')} AS nw FROM z)
 SELECT CAST(tree AS BIGINT) AS tree, CAST(leaf AS BIGINT) AS leaf, round(nw, 6) AS new_weight, round(nw - wt, 6) AS delta FROM x""",
)
def w_soft_step(spark, sf):
    df = correct.soft_step(_weighted_stats(spark, sf), 5.0, 1000.0)
    return _round(_big(df, "tree", "leaf"), 6, "delta", "new_weight").select("tree", "leaf", "new_weight", "delta")


@register(
    "w_gram",
    _LEAVES + """, u AS (SELECT y, w, node AS a, other + 10 AS b FROM lv)
 SELECT CAST(a AS BIGINT) AS a, CAST(b AS BIGINT) AS b, round(sum(w), 6) AS shared, CAST(NULL AS DOUBLE) AS wy FROM u GROUP BY a, b
 UNION ALL SELECT a, a, round(sum(w), 6), round(sum(w * y), 6) FROM u GROUP BY a
 UNION ALL SELECT b, b, round(sum(w), 6), round(sum(w * y), 6) FROM u GROUP BY b""",
)
def w_gram(spark, sf):
    ids = _leaves(spark, sf).withColumn("leaves", F.expr("array(leaves[0], leaves[1] + 10)"))
    return _round(_big(correct.gram_long(ids), "a", "b"), 6, "shared", "wy")


# ---------------------------------------------------------------- the same by the trainers' own code


def _fixed_trees() -> list[Tree]:
    """The two trees of the SQL above; a leaf weighs an eighth of its number."""
    one, two = Tree([Node(n=1)]), Tree([Node(n=1)])
    one.split(0, 0, 23, 1.0, {"n": 1}, {"n": 1})
    one.split(1, 1, 4, 1.0, {"n": 1}, {"n": 1})
    two.split(0, 2, 3, 1.0, {"n": 1}, {"n": 1})
    for tree in (one, two):
        for i in tree.leaves():
            tree.nodes[i].weight = i / 8
    return [one, two]


def _trainer_rows(spark, sf, score: float = 0.0) -> TrainingRows:
    table = price_table(spark, sf)
    bins = B.fit_fine_bins(table)
    rows = B.apply_bins(table, bins).select("label", "weight", F.lit(1).cast("bigint").alias("n"), "bins", F.lit(score).alias("score"))
    return TrainingRows(rows, bins, "LS", "leafwise")


@register("r_route_trees", ORACLES["r_route"])
def r_route_trees(spark, sf):
    """Rows in the slots that the growing tree gives them."""
    rows, tree = _trainer_rows(spark, sf), _fixed_trees()[0]
    slot = frontier_sql(tree, rows.access, {i: i for i in tree.leaves()}, {})
    df = rows.scored(f"{slot} AS node").groupBy("node").agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("label_sum"))
    return _round(_big(df, "node"), 6, "label_sum")


@register("r_update_scores_trees", ORACLES["r_update_scores"])
def r_update_scores_trees(spark, sf):
    """Scores with a pending tree, and stored anew by ``rescore``."""
    rows, tree = _trainer_rows(spark, sf), _fixed_trees()[0]
    for i, w in ((3, -0.5), (4, 0.25), (2, 0.75)):
        tree.nodes[i].weight = w
    slot = frontier_sql(tree, rows.access, {i: i for i in tree.leaves()}, {})
    rows.pending = [tree]
    pending = rows.scored(f"{slot} AS node").select("node", "_s")
    rows.rescore(0.0, [tree], 0)
    stored = rows.scored(f"{slot} AS node").select("node", "_s")
    both = pending.unionByName(stored).groupBy("node").agg((F.sum("_s") / 2).alias("score_sum"))
    return _round(_big(both, "node"), 3, "score_sum")


def _trainer_sums(spark, sf):
    """``(tree number, tree, leaves, g, h)`` of both trees at score 40."""
    rows = _trainer_rows(spark, sf, 40.0)
    return [(t, tree, tree.leaves(), *rows.group_sums(tree, tree.leaves())) for t, tree in enumerate(_fixed_trees())]


@register("w_leaf_stats_trees", ORACLES["w_leaf_stats"])
def w_leaf_stats_trees(spark, sf):
    found = [(t, i, float(g), float(h), int(round(h))) for t, _, leaves, gs, hs in _trainer_sums(spark, sf) for i, g, h in zip(leaves, gs, hs)]
    return _round(spark.createDataFrame(found, "tree bigint, leaf bigint, g double, h double, n bigint"), 6, "g", "h")


def _stepped(spark, found):
    df = spark.createDataFrame(found, "tree bigint, leaf bigint, delta double, new_weight double")
    return _round(df, 6, "delta", "new_weight")


def _newton(spark, sf, loss: str, nsig: float):
    trainer = SimpleNamespace(p=LeafwiseParams(learning_rate=0.5, reg_depth=1.2, loss=loss), trees=_fixed_trees())
    found = []
    for t, tree, leaves, g, h in _trainer_sums(spark, sf):
        w = np.array([tree.nodes[i].weight for i in leaves])
        new = LeafwiseTrainer._steps(trainer, t, leaves, g, h, w, 50.0, nsig)
        found += [(t, i, float(b - a), float(b)) for i, a, b in zip(leaves, w, new)]
    return _stepped(spark, found)


@register("w_newton_step_trees", ORACLES["w_newton_step"])
def w_newton_step_trees(spark, sf):
    return _newton(spark, sf, "LS", 0.0)


@register("w_newton_step_l1_trees", ORACLES["w_newton_step_l1"])
def w_newton_step_l1_trees(spark, sf):
    """Steps of the exponential losses are limited to 1."""
    return _newton(spark, sf, "Log", 300.0)


@register("w_soft_step_trees", ORACLES["w_soft_step"])
def w_soft_step_trees(spark, sf):
    trainer, found = SimpleNamespace(p=BinnedParams(l1=5.0, l2=1000.0)), []
    for t, tree, leaves, g, h in _trainer_sums(spark, sf):
        delta = BinnedTrainer._update(trainer, tree, leaves, g, h)
        found += [(t, i, float(d), float(tree.nodes[i].weight)) for i, d in zip(leaves, delta)]
    return _stepped(spark, found)


@register("w_gram_tasks", ORACLES["w_gram"])
def w_gram_tasks(spark, sf):
    """The Gram matrix as the corrections build it, from sums of each task."""
    rows, trees = _trainer_rows(spark, sf), _fixed_trees()
    columns = [(t, i) for t, tree in enumerate(trees) for i in tree.leaves()]
    shared, target = correct.gram_update(rows.moments(), trees, rows.access, columns, list(range(len(columns))))
    number = [10 * t + i for t, i in columns]
    found = [
        (number[a], number[b], float(shared[a, b]), float(target[a]) if a == b else None)
        for a in range(len(columns)) for b in range(a, len(columns)) if shared[a, b]
    ]
    return _round(spark.createDataFrame(found, "a bigint, b bigint, shared double, wy double"), 6, "shared", "wy")


@register("b_revert_cuts_forest", ORACLES["b_revert_cuts"])
def b_revert_cuts_forest(spark, sf):
    """Cuts as a finished forest gets them."""
    bins = B.fit_fine_bins(price_table(spark, sf))
    trees = []
    for feature, edges in bins.boundaries.items():
        for bin_ in range(len(edges)):
            trees.append(Tree([Node(n=1)]))
            trees[-1].split(0, feature, bin_, 1.0, {"n": 1}, {"n": 1})
    nodes = Forest(trees).set_cuts(bins).trees
    found = [(t.nodes[0].feature, t.nodes[0].bin, float(t.nodes[0].cut)) for t in nodes]
    return _round(spark.createDataFrame(found, "feature bigint, bin bigint, cut double"), 6, "cut")
