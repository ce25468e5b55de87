"""Growing, scoring, explaining and validating forests."""

from __future__ import annotations

from pyspark.sql import functions as F

from grove.forest import Forest, Node, Tree, load_forests, save_forests
from grove.operators import binning as B
from grove.operators import explain, metrics
from grove.operators.folds import folds, holdout
from grove.operators.penalty import node_penalty
from grove.operators.prepare import training_table
from grove.operators.score import leaf_features, leaf_long, leaf_members, multi_proba, predict_class, score_array, transform_many
from grove.plans.binned import BinnedParams
from grove.plans.fit import fit_classifier, fit_forest
from grove.plans.leafwise import LeafwiseParams
from grove.plans.validate import cross_validate, evaluate_path, sweep
from grove.queries import forest_sql as S
from grove.queries import register
from grove.functions.losses import loss_value
from grove.queries.inputs import FEATURES, PRICE, RETURNED, ROWS_SQL, document_table, lineitem, price_table, read, scratch

CENTRED = "l_extendedprice / 1000 - 53"
L1, L2, RATE = 1.0, 10.0, 0.5

_W = "WITH " + ROWS_SQL + ", "
_BOOSTED = _W + S.boosted("y - 53", L1, L2, RATE) + ", " + S.leaves(RATE)


def _big(df, *names):
    return df.withColumns({n: F.col(n).cast("bigint") for n in names})


def _round(df, digits, *names):
    return df.withColumns({n: F.round(n, digits) for n in names})


def _two_levels(table, trees=2, **options):
    """Trees of two levels that split every node, on bins of single values."""
    config = {"n_estimators": trees, "max_depth": 2, "l1": L1, "l2": L2, "tree_gain_ratio": 1e-9, **options}
    return fit_forest(table, BinnedParams(**config), bins=B.fit_fine_bins(table))


def boosted_forest(spark, sf):
    table = price_table(spark, sf, CENTRED)
    return table, _two_levels(table, opt_algorithm="greedy", learning_rate=RATE).forest


# ---------------------------------------------------------------- growing


def minimum_slice(spark, sf):
    """One tree of three levels on lineitem, scored; metrics per return flag."""
    df = lineitem(spark, sf)
    table = training_table(df, FEATURES, CENTRED)
    fitted = fit_forest(
        table, BinnedParams(n_estimators=1, max_depth=3, l1=L1, l2=L2, tree_gain_ratio=1e-9), bins=B.fit_fine_bins(table)
    )
    scored = fitted.forest.transform(
        df.select("l_returnflag", F.expr(CENTRED).alias("label"), F.array(*FEATURES).alias("features"))
    )
    out = metrics.evaluate(scored, "LS", by=["l_returnflag"], engine="binned")
    return _round(out, 6, "accuracy", "rmse", "mean_loss").select("l_returnflag", "n", "accuracy", "rmse", "mean_loss")


register(
    "t_minimum_slice",
    _W
    + "base AS (SELECT q, d, t, y - 53 AS y, rf FROM rows_), "
    + S.domain("base")
    + ", "
    + S.tree_ctes(0, "base", "y", L1, L2, levels=3)
    + """ SELECT rf AS l_returnflag, count(*) AS n, round(avg(CASE WHEN (wt > 0) = (y > 0) THEN 1.0 ELSE 0.0 END), 6) AS accuracy,
 round(sqrt(avg((wt - y) * (wt - y))), 6) AS rmse, round(avg((wt - y) * (wt - y)), 6) AS mean_loss FROM t0_rows GROUP BY rf""",
)(minimum_slice)


@register(
    "t_tree",
    _W + "base AS (SELECT q, d, t, y - 53 AS y FROM rows_), " + S.domain("base") + ", " + S.tree_ctes(0, "base", "y", L1, L2)
    + " SELECT rule, round(max(wt), 6) AS weight, count(*) AS n FROM t0_rows GROUP BY rule",
)
def t_tree(spark, sf):
    table = price_table(spark, sf, CENTRED)
    nodes = _two_levels(table, trees=1, opt_algorithm="greedy", learning_rate=1.0).forest.nodes_df(spark)
    leaves = nodes.filter("left < 0").select("tree", F.col("node").alias("leaf"), "n")
    return _round(explain.rules(nodes).join(leaves, ["tree", "leaf"]), 6, "weight").select("rule", "weight", "n")


@register(
    "t_boost",
    _BOOSTED + " SELECT round(avg((y - w0 - 0.5 * wt) * (y - w0 - 0.5 * wt)), 6) AS mean_loss, count(*) AS n FROM t1_rows",
)
def t_boost(spark, sf):
    table, forest = boosted_forest(spark, sf)
    return _round(metrics.evaluate(forest.transform(table), "LS", engine="binned"), 6, "mean_loss").select("mean_loss", "n")


@register(
    "t_forest_binned",
    _W + S.boosted("y - 53", L1, L2, 1.0)
    + f""", a AS (SELECT rule0, sum(y - wt) AS s, count(*) + {L2} + 1e-10 AS v FROM t1_rows GROUP BY rule0),
 a2 AS (SELECT rule0, {S.soft('(s / v)', f'({L1} / v)')} AS x0 FROM a),
 b AS (SELECT rule, sum(y - x0) AS s, count(*) + {L2} + 1e-10 AS v FROM t1_rows JOIN a2 USING (rule0) GROUP BY rule),
 b2 AS (SELECT rule, {S.soft('(s / v)', f'({L1} / v)')} AS x1 FROM b)
 SELECT CAST(0 AS BIGINT) AS tree, rule0 AS rule, round(x0, 6) AS weight FROM a2 UNION ALL SELECT 1, rule, round(x1, 6) FROM b2""",
)
def t_forest_binned(spark, sf):
    """Two trees with the correction of both after the second."""
    nodes = _two_levels(price_table(spark, sf, CENTRED)).forest.nodes_df(spark)
    return _round(_big(explain.rules(nodes), "tree"), 6, "weight").select("tree", "rule", "weight")


@register("t_forest_binned_logistic")
def t_forest_binned_logistic(spark, sf):
    table = price_table(spark, sf, RETURNED)
    params = BinnedParams(n_estimators=2, max_depth=3, loss="LOGISTIC", l1=0.0, l2=10.0, max_bins=64)
    return metrics.evaluate(fit_forest(table, params).forest.transform(table), "LOGISTIC", engine="binned")


@register("t_forest_binned_modls")
def t_forest_binned_modls(spark, sf):
    table = price_table(spark, sf, RETURNED)
    params = BinnedParams(n_estimators=2, max_depth=3, loss="MODLS", l1=0.0, l2=10.0, max_bins=64)
    return metrics.evaluate(fit_forest(table, params).forest.transform(table), "MODLS", engine="binned")


@register("t_forest_sparse")
def t_forest_sparse(spark, sf):
    """The binned engine on token counts of all labelled documents."""
    table = document_table(spark, sf, keep=True)
    params = BinnedParams(n_estimators=2, max_depth=2, loss="LOGISTIC", l1=0.0, l2=5.0, tree_gain_ratio=0.1)
    return metrics.evaluate(fit_forest(table, params).forest.transform(table), "LOGISTIC", engine="binned")


def _leafwise(**options):
    return LeafwiseParams(**{"max_leaf": 12, "opt_interval": 6, "test_interval": 6, "min_samples_leaf": 20, **options})


def _explained(fitted, table, loss="LS"):
    return evaluate_path(table, fitted.path, loss)


# Two leaves: the best root split under lambda 0.2, then ten damped sweeps towards the optimum under 0.05.
@register(
    "t_leafwise_first_tree",
    _W + "base AS (SELECT q, d, t, y - (SELECT avg(y) FROM rows_) AS y FROM rows_), " + S.domain("base") + f""",
 h AS (SELECT f.feature, {S.VALUE.format(f='f.feature')} AS value, sum(y) AS g, CAST(count(*) AS DOUBLE) AS n FROM base, (VALUES (0), (1), (2)) f(feature) GROUP BY 1, 2),
 k AS (SELECT feature, value, sum(g) OVER w AS gl, sum(n) OVER w AS nl, sum(g) OVER p AS gt, sum(n) OVER p AS nt FROM h
 WINDOW w AS (PARTITION BY feature ORDER BY value), p AS (PARTITION BY feature)),
 b AS (SELECT *, gl * gl / (nl + 0.3 * nt) + (gt - gl) * (gt - gl) / (nt - nl + 0.3 * nt) AS gain FROM k WHERE nl >= 20 AND nt - nl >= 20
 QUALIFY row_number() OVER (ORDER BY gain DESC, feature, value) = 1),
 s AS (SELECT '<=' AS side, gl AS g, nl AS n FROM b UNION ALL SELECT '>', gt - gl, nt - nl FROM b)
 SELECT CAST(feature AS VARCHAR) || side || CAST(round(0.5 * (value + (SELECT min(v.value) FROM domain v WHERE v.feature = b.feature AND v.value > b.value)), 5) AS VARCHAR) AS rule,
 CAST(s.n AS BIGINT) AS n, round(s.g / (s.n + 0.075 * nt) + power(0.5, 10) * (s.g / (s.n + 0.3 * nt) - s.g / (s.n + 0.075 * nt)), 8) AS weight,
 round((SELECT avg(y) FROM rows_), 6) AS constant FROM b, s""",
)
def t_leafwise_first_tree(spark, sf):
    forest = fit_forest(price_table(spark, sf), _leafwise(max_leaf=2, l2=0.05, sl2=0.2, reg_depth=1.5)).forest
    nodes = forest.nodes_df(spark)
    leaves = nodes.filter("left < 0").select("tree", F.col("node").alias("leaf"), "n")
    named = explain.rules(nodes).join(leaves, ["tree", "leaf"]).withColumn("constant", F.lit(round(forest.constant, 6)))
    return _round(named, 8, "weight").select("rule", "n", "weight", "constant")


@register("t_forest_leafwise")
def t_forest_leafwise(spark, sf):
    table = price_table(spark, sf)
    return _explained(fit_forest(table, _leafwise()), table)


@register("t_forest_leafwise_weighted")
def t_forest_leafwise_weighted(spark, sf):
    table = price_table(spark, sf, weight="l_quantity")
    return _explained(fit_forest(table, _leafwise(l1=0.001)), table)


@register("t_forest_leafwise_log")
def t_forest_leafwise_log(spark, sf):
    table = price_table(spark, sf, RETURNED)
    return _explained(fit_forest(table, _leafwise(loss="Log", normalize=False, n_iter=2, max_leaf=8)), table, "Log")


@register("t_forest_leafwise_opt")
def t_forest_leafwise_opt(spark, sf):
    table = price_table(spark, sf)
    return _explained(fit_forest(table, _leafwise(algorithm="opt", reg_depth=1.2)), table)


@register("t_forest_leafwise_sib")
def t_forest_leafwise_sib(spark, sf):
    table = price_table(spark, sf)
    return _explained(fit_forest(table, _leafwise(algorithm="sib")), table)


@register("t_forest_leafwise_internal")
def t_forest_leafwise_internal(spark, sf):
    table = price_table(spark, sf)
    return _explained(fit_forest(table, _leafwise(internal_nodes=True)), table)


@register("t_warm_start")
def t_warm_start(spark, sf):
    table = price_table(spark, sf)
    first = fit_forest(table, _leafwise(max_leaf=8)).forest
    return _explained(fit_forest(table, _leafwise(max_leaf=14), init_model=first), table)


@register("t_path")
def t_path(spark, sf):
    """Train on most rows, predict the rest with every model of the path."""
    table = training_table(read(spark, sf, "orders"), ["o_custkey"], "o_totalprice / 1000", key="o_orderkey")
    split = holdout(table, 0.25, "row_id")
    fitted = fit_forest(split.filter("NOT is_test").select("features", "label", "weight"), _leafwise())
    return transform_many(split.filter("is_test"), fitted.path, ["row_id"])


@register("t_ovr")
def t_ovr(spark, sf):
    df = lineitem(spark, sf).select(F.array(*FEATURES).alias("features"), F.lit(1.0).alias("weight"), "l_returnflag")
    params = BinnedParams(n_estimators=1, max_depth=2, loss="LOGISTIC", l1=0.0, l2=5.0)
    fitted = fit_classifier(df, "l_returnflag", params)
    scored = df.withColumn("p", multi_proba(score_array(df, fitted.forests))).withColumn("prediction", predict_class(F.col("p"), fitted.classes))
    return metrics.class_accuracy(scored, label="l_returnflag")


@register("w_fit_log")
def w_fit_log(spark, sf):
    return fit_forest(price_table(spark, sf), _leafwise()).log_df(spark)


# ---------------------------------------------------------------- scoring with a fixed forest


def fixed_forest() -> Forest:
    """Two small trees on quantity, discount and tax with exact weights."""

    def tree(*rows):
        return Tree([Node(parent=p, depth=d, feature=f, cut=c, left=l, right=r, weight=w, gain=g) for p, d, f, c, l, r, w, g in rows])

    first = tree((-1, 0, 0, 24.5, 1, 2, 0, 9.0), (0, 1, 1, 0.045, 3, 4, 0, 3.0), (0, 1, -1, 0, -1, -1, 0.75, 0), (1, 2, -1, 0, -1, -1, -0.5, 0), (1, 2, -1, 0, -1, -1, 0.25, 0))
    second = tree((-1, 0, 2, 0.035, 1, 2, 0, 4.0), (0, 1, -1, 0, -1, -1, -0.125, 0), (0, 1, -1, 0, -1, -1, 0.375, 0))
    return Forest([first, second], 0.5, 3, model_id="fixed")


_FIXED = """WITH f AS (SELECT l_linenumber AS ln, l_quantity AS w, l_extendedprice / 1000 AS y, CASE WHEN l_quantity <= 24.5 THEN CASE WHEN l_discount <= 0.045 THEN 3 ELSE 4 END ELSE 2 END AS a,
 CASE WHEN l_tax <= 0.035 THEN 1 ELSE 2 END AS b FROM lineitem),
 s AS (SELECT *, 0.5 + CASE a WHEN 3 THEN -0.5 WHEN 4 THEN 0.25 ELSE 0.75 END AS s1, CASE b WHEN 1 THEN -0.125 ELSE 0.375 END AS s2 FROM f)"""


def _fixed_rows(spark, sf):
    return lineitem(spark, sf).select(
        F.col("l_linenumber").cast("bigint").alias("ln"), F.array(*FEATURES).alias("features"), F.col("l_quantity").alias("weight"), (F.col("l_extendedprice") / 1000).alias("label")
    )


@register("d_predict", _FIXED + " SELECT CAST(ln AS BIGINT) AS ln, CAST(s1 + s2 AS DOUBLE) AS score, count(*) AS n FROM s GROUP BY ln, s1 + s2")
def d_predict(spark, sf):
    return fixed_forest().transform(_fixed_rows(spark, sf)).groupBy("ln", "score").agg(F.count(F.lit(1)).alias("n"))


@register("d_predict_first_trees", _FIXED + " SELECT CAST(ln AS BIGINT) AS ln, CAST(s1 AS DOUBLE) AS score, count(*) AS n FROM s GROUP BY ln, s1")
def d_predict_first_trees(spark, sf):
    scored = fixed_forest().transform(_fixed_rows(spark, sf), ntrees=1)
    return scored.groupBy("ln", "score").agg(F.count(F.lit(1)).alias("n"))


@register(
    "d_predict_many",
    _FIXED + """ SELECT 'fixed' AS model_id, CAST(ln AS BIGINT) AS ln, CAST(sum(s1 + s2) AS DOUBLE) AS total FROM s GROUP BY ln
 UNION ALL SELECT 'shifted', CAST(ln AS BIGINT), CAST(sum(s1 + s2 + 1) AS DOUBLE) FROM s GROUP BY ln""",
)
def d_predict_many(spark, sf):
    shifted = fixed_forest()
    shifted.model_id, shifted.constant = "shifted", 1.5
    long = transform_many(_fixed_rows(spark, sf), [fixed_forest(), shifted], ["ln"])
    return long.groupBy("model_id", "ln").agg(F.sum("score").alias("total"))


@register("s_save_load_model", _FIXED + " SELECT CAST(ln AS BIGINT) AS ln, CAST(sum(s1 + s2) AS DOUBLE) AS total FROM s GROUP BY ln")
def s_save_load_model(spark, sf):
    path = scratch(spark)
    save_forests(spark, [fixed_forest()], path)
    scored = load_forests(spark, path, "fixed")[0].transform(_fixed_rows(spark, sf))
    return scored.groupBy("ln").agg(F.sum("score").alias("total"))


@register(
    "l_leaf_index",
    _FIXED + """ SELECT CAST(0 AS BIGINT) AS tree, CAST(a AS BIGINT) AS node, CAST(a AS BIGINT) AS leaf_id, count(*) AS n, round(sum(y), 6) AS label_sum FROM s GROUP BY a
 UNION ALL SELECT 1, b, 5 + b, count(*), round(sum(y), 6) FROM s GROUP BY b""",
)
def l_leaf_index(spark, sf):
    forest = fixed_forest()
    long = leaf_long(forest.leaf_index(_fixed_rows(spark, sf)), forest, ["label"])
    df = long.groupBy("tree", "node", "leaf_id").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("label"), 6).alias("label_sum"))
    return _big(df, "tree", "node", "leaf_id")


@register(
    "l_leaf_features",
    _FIXED + """ SELECT CAST(k AS BIGINT) AS leaf_feature, CAST(count(*) * 2 AS DOUBLE) AS total FROM (SELECT a - 2 AS k FROM s UNION ALL SELECT b + 2 FROM s) GROUP BY k""",
)
def l_leaf_features(spark, sf):
    df = leaf_features(_fixed_rows(spark, sf), fixed_forest(), value=2.0)
    cells = df.select(F.explode("leaf_features").alias("leaf_feature", "value"))
    return _big(cells.groupBy("leaf_feature").agg(F.sum("value").alias("total")), "leaf_feature")


@register(
    "l_leaf_members",
    _FIXED + " SELECT CAST(0 AS BIGINT) AS tree, CAST(a AS BIGINT) AS node, count(*) AS n FROM s GROUP BY a UNION ALL SELECT 1, b, count(*) FROM s GROUP BY b",
)
def l_leaf_members(spark, sf):
    return _big(leaf_members(fixed_forest().leaf_index(_fixed_rows(spark, sf))), "tree", "node")


@register(
    "e_evaluate_path",
    _FIXED + """ SELECT CAST(1 AS BIGINT) AS seq, CAST(2 AS BIGINT) AS trees, CAST(5 AS BIGINT) AS leaves, count(*) AS n, round(sqrt(avg((s1 + s2 - y) * (s1 + s2 - y))), 6) AS rmse FROM s
 UNION ALL SELECT 2, 1, 3, count(*), round(sqrt(avg((s1 - y) * (s1 - y))), 6) FROM s""",
)
def e_evaluate_path(spark, sf):
    shorter = fixed_forest()
    shorter.trees, shorter.seq = shorter.trees[:1], 2
    df = evaluate_path(_fixed_rows(spark, sf), [fixed_forest(), shorter])
    return _round(_big(df, "seq", "trees", "leaves"), 6, "rmse").select("seq", "trees", "leaves", "n", "rmse")


@register("d_predict_stream", _FIXED + " SELECT CAST(s1 + s2 AS DOUBLE) AS score, CAST(a AS BIGINT) AS leaf, count(*) AS n FROM s GROUP BY s1 + s2, a")
def d_predict_stream(spark, sf):
    """The whole table as a stream: read, scored, written exactly once, then counted."""
    from grove.streaming.score import score_stream, write_scores_stream

    schema = lineitem(spark, sf).schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "lineitem.parquet").parquet(sf)
    rows = stream.select(F.array(*FEATURES).alias("features"))
    path = scratch(spark)
    query = write_scores_stream(score_stream(rows, fixed_forest(), leaves=True), f"{path}/out", f"{path}/state")
    query.processAllAvailable()
    query.stop()
    out = spark.read.parquet(f"{path}/out")
    return out.groupBy("score", F.col("leaves")[0].cast("bigint").alias("leaf")).agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------- explaining a forest learned from the data


@register(
    "x_importance",
    _BOOSTED + " SELECT CAST(feature AS BIGINT) AS feature, round(sum(gain) / (SELECT sum(gain) FROM split), 6) AS importance FROM split GROUP BY feature",
)
def x_importance(spark, sf):
    df = explain.feature_importance(boosted_forest(spark, sf)[1].nodes_df(spark))
    return _round(_big(df, "feature"), 6, "importance").select("feature", "importance")


@register(
    "x_path_importance",
    _BOOSTED + " SELECT CAST(feature AS BIGINT) AS feature, count(*) AS uses, round(sum(abs(w)), 6) AS abs_weight FROM step GROUP BY feature",
)
def x_path_importance(spark, sf):
    df = explain.path_importance(boosted_forest(spark, sf)[1].nodes_df(spark))
    return _round(_big(df, "feature"), 6, "abs_weight").select("feature", "uses", "abs_weight")


@register(
    "x_ranked_rules",
    _BOOSTED + " SELECT CAST(tree AS BIGINT) AS tree, rule, round(w, 6) AS weight, CAST(sign(w) AS BIGINT) AS sign FROM leaf WHERE w <> 0",
)
def x_ranked_rules(spark, sf):
    df = explain.ranked_rules(boosted_forest(spark, sf)[1].nodes_df(spark))
    return _round(_big(df, "tree", "sign"), 6, "weight").select("tree", "rule", "weight", "sign")


@register(
    "x_cooccurrence",
    _BOOSTED + """ SELECT CAST(least(f0, f1) AS BIGINT) AS feature_a, CAST(greatest(f0, f1) AS BIGINT) AS feature_b, count(*) AS n FROM leaf WHERE f0 >= 0 AND f1 >= 0 GROUP BY 1, 2""",
)
def x_cooccurrence(spark, sf):
    df = explain.feature_cooccurrence(boosted_forest(spark, sf)[1].nodes_df(spark))
    return _big(df, "feature_a", "feature_b").select("feature_a", "feature_b", "n")


@register("x_first_use", _BOOSTED + " SELECT CAST(feature AS BIGINT) AS feature, CAST(min(tree) AS BIGINT) AS first_tree FROM split GROUP BY feature")
def x_first_use(spark, sf):
    return _big(explain.first_use(boosted_forest(spark, sf)[1].nodes_df(spark)), "feature", "first_tree").select("feature", "first_tree")


@register(
    "x_distinct_rules",
    _BOOSTED + " SELECT rule, count(*) AS leaves, CAST(max(CASE WHEN w <> 0 THEN 1 ELSE 0 END) AS BIGINT) AS weighted FROM leaf GROUP BY rule",
)
def x_distinct_rules(spark, sf):
    return _big(explain.distinct_rules(boosted_forest(spark, sf)[1].nodes_df(spark)), "weighted").select("rule", "leaves", "weighted")


@register(
    "x_leaf_profile",
    _BOOSTED + " SELECT CAST(tree AS BIGINT) AS tree, rule, n AS rows, round(ys / n, 6) AS mean_label, round(w, 6) AS leaf_weight FROM leaf",
)
def x_leaf_profile(spark, sf):
    table, forest = boosted_forest(spark, sf)
    df = explain.leaf_profile(forest.leaf_index(table), forest.nodes_df(spark))
    return _round(_big(df, "tree"), 6, "mean_label", "leaf_weight").select("tree", "rule", "rows", "mean_label", "leaf_weight")


@register(
    "x_forest_stats",
    _BOOSTED + """ SELECT CAST(2 AS BIGINT) AS trees, CAST(sum(c) AS BIGINT) AS leaves, CAST(max(c) AS BIGINT) AS max_leaves, CAST(avg(c) AS DOUBLE) AS avg_leaves
 FROM (SELECT tree, count(*) AS c FROM leaf GROUP BY tree)""",
)
def x_forest_stats(spark, sf):
    df = explain.forest_stats(boosted_forest(spark, sf)[1].nodes_df(spark))
    return _big(df, "max_leaves").select("trees", "leaves", "max_leaves", "avg_leaves")


# In a full tree of two levels a leaf's implied weight moves by 1/2, its parent's by 1/4 and the root's by 1/4.
@register(
    "w_penalty_sib",
    _BOOSTED + """, pos AS (SELECT 0 AS tree, node0 AS node, max(w0) AS w FROM t1_rows GROUP BY node0 UNION ALL SELECT 1, node, 0.5 * max(wt) FROM t1_rows GROUP BY node),
 l AS (SELECT tree, node, w, sum(w) OVER (PARTITION BY tree, (node - 1) // 2) AS sib, sum(w) OVER (PARTITION BY tree) AS total FROM pos)
 SELECT CAST(tree AS BIGINT) AS tree, round(w, 6) AS weight,
 round(2 * 0.5 * (0.5 * (w - (sib - w))) + 2 * 0.25 * (0.25 * (sib - (total - sib))) + 0.25 * 0.25 * total, 6) AS d_r,
 CAST(2 * 0.25 + 2 * 0.0625 + 0.0625 AS DOUBLE) AS dd_r FROM l""",
)
def w_penalty_sib(spark, sf):
    nodes = boosted_forest(spark, sf)[1].nodes_df(spark)
    terms = node_penalty(nodes, "sib").join(nodes.select("tree", "node", "weight"), ["tree", "node"])
    return _round(_big(terms, "tree"), 6, "weight", "d_r").select("tree", "weight", "d_r", "dd_r")


@register("w_penalty_opt")
def w_penalty_opt(spark, sf):
    return node_penalty(boosted_forest(spark, sf)[1].nodes_df(spark), "opt", 1.2)


# ---------------------------------------------------------------- validation


@register("c_cross_validate")
def c_cross_validate(spark, sf):
    table = training_table(read(spark, sf, "orders"), ["o_custkey"], "o_totalprice / 1000", key="o_orderkey")
    return cross_validate(folds(table, 2, "row_id"), _leafwise(max_leaf=6, opt_interval=3, test_interval=3))


@register("c_sweep")
def c_sweep(spark, sf):
    table = price_table(spark, sf)
    return sweep(table, table, _leafwise(max_leaf=6), {"l2": [0.1, 1.0]})


@register(
    "t_limits",
    """SELECT * FROM (VALUES ('max_depth', CAST(4 AS BIGINT), CAST(1 AS BIGINT), CAST(2 AS BIGINT)), ('max_leaf_tree', 4, 1, 2),
 ('passive_root', 1, NULL, 8)) v(limited, trees, depth, most_leaves)""",
)
def t_limits(spark, sf):
    """Eight leaves under each limit: stumps by depth or by leaves of a tree, or one tree as long as a leaf can be split."""
    table = price_table(spark, sf)
    found = []
    for name, value in (("max_depth", 1), ("max_leaf_tree", 2), ("passive_root", True)):
        trees = fit_forest(table, _leafwise(max_leaf=8, **{name: value})).forest.trees
        depth = max(t.max_depth() for t in trees) if name != "passive_root" else None
        found.append((name, len(trees), depth, max(len(t.leaves()) for t in trees)))
    return spark.createDataFrame(found, "limited string, trees bigint, depth bigint, most_leaves bigint")


@register("t_losses", "SELECT loss, true AS lower FROM (VALUES ('Logit'), ('LogRe'), ('LogRe2'), ('Abs'), ('Expo'), ('Log')) v(loss)")
def t_losses(spark, sf):
    """Training under every other loss lowers it from where it starts."""
    found = []
    for loss in ("Logit", "LogRe", "LogRe2", "Abs", "Expo", "Log"):
        table = price_table(spark, sf, RETURNED if loss not in ("Abs", "LogRe2") else PRICE)
        if loss == "LogRe":
            table = table.withColumn("label", F.greatest(F.col("label"), F.lit(0.0)))
        params = _leafwise(max_leaf=4, opt_interval=4, test_interval=4, loss=loss, normalize=loss in ("Abs", "LogRe2"), n_iter=2)
        forest = fit_forest(table, params).forest
        scored = forest.transform(table)
        before, after = scored.select(F.avg(loss_value(loss, repr(forest.constant) + "D", "label")), F.avg(loss_value(loss, "score", "label"))).first()
        found.append((loss, after < before))
    return spark.createDataFrame(found, "loss string, lower boolean")
