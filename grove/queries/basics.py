"""Preparation, losses, metrics, folds."""

from __future__ import annotations

from pyspark.sql import functions as F

from grove.functions.losses import BINNED_TRAINABLE, LEAFWISE_TRAINABLE, LEAFWISE_VALUE_ONLY, derivatives, loss_value
from grove.operators import folds as fold_ops
from grove.operators import metrics, prepare
from grove.operators.score import binary_flag, binary_proba, multi_proba, predict_class
from grove.queries import register
from grove.queries.inputs import keyed_orders, lineitem, price_table, read

# ---------------------------------------------------------------- preparation


@register(
    "p_clean",
    """SELECT CAST(l_linenumber AS BIGINT) AS ln, count(*) AS n, min(x) AS lo, max(x) AS hi FROM (
 SELECT l_linenumber, CASE WHEN v IS NULL OR isnan(v) THEN CAST(-3.4028234663852886e38 AS DOUBLE)
 ELSE greatest(CAST(-3.4028234663852886e38 AS DOUBLE), least(CAST(3.4028234663852886e38 AS DOUBLE), v)) END AS x FROM (
 SELECT l_linenumber, CASE l_linenumber WHEN 1 THEN CAST('nan' AS DOUBLE) WHEN 2 THEN CAST('inf' AS DOUBLE)
 WHEN 3 THEN CAST('-inf' AS DOUBLE) WHEN 4 THEN NULL ELSE l_tax END AS v FROM lineitem)) GROUP BY l_linenumber""",
)
def p_clean(spark, sf):
    broken = F.expr(
        "CASE l_linenumber WHEN 1 THEN double('NaN') WHEN 2 THEN double('Infinity') WHEN 3 THEN double('-Infinity') "
        "WHEN 4 THEN NULL ELSE l_tax END"
    )
    df = prepare.clean(lineitem(spark, sf).select("l_linenumber", broken.alias("x")), ["x"])
    return df.groupBy(F.col("l_linenumber").cast("bigint").alias("ln")).agg(
        F.count(F.lit(1)).alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi")
    )


@register(
    "p_validate",
    """SELECT count(*) AS rows, count(*) FILTER (WHERE l_extendedprice IS NULL) AS bad_labels,
 count(*) FILTER (WHERE NOT coalesce(l_quantity, 0) > 0) AS bad_weights, min(l_extendedprice / 1000) AS min_label,
 max(l_extendedprice / 1000) AS max_label, CAST(3 AS BIGINT) AS min_features, CAST(3 AS BIGINT) AS max_features FROM lineitem""",
)
def p_validate(spark, sf):
    facts = prepare.profile(price_table(spark, sf, weight="l_quantity"))
    return facts.withColumns({c: F.col(c).cast("bigint") for c in ("min_features", "max_features")})


@register(
    "p_encode_label",
    """SELECT l_linestatus AS label, CAST(dense_rank() OVER (ORDER BY l_linestatus) - 1 AS BIGINT) AS class_index,
 CASE WHEN dense_rank() OVER (ORDER BY l_linestatus) = 1 THEN CAST(1 AS DOUBLE) ELSE CAST(-1 AS DOUBLE) END AS binary_label, n
 FROM (SELECT l_linestatus, count(*) AS n FROM lineitem GROUP BY l_linestatus)""",
)
def p_encode_label(spark, sf):
    df = prepare.encode_label(lineitem(spark, sf).select(F.col("l_linestatus").alias("label")), "label")
    return df.groupBy("label", F.col("class_index").cast("bigint").alias("class_index"), F.col("binary").alias("binary_label")).agg(
        F.count(F.lit(1)).alias("n")
    )


@register(
    "p_ovr_labels",
    """WITH c AS (SELECT l_returnflag AS name, CAST(row_number() OVER (ORDER BY l_returnflag) - 1 AS BIGINT) AS class_id
 FROM (SELECT DISTINCT l_returnflag FROM lineitem))
 SELECT class_id, count(*) FILTER (WHERE l_returnflag = name) AS positives, count(*) FILTER (WHERE l_returnflag <> name) AS negatives
 FROM lineitem, c GROUP BY class_id""",
)
def p_ovr_labels(spark, sf):
    df = prepare.ovr_labels(lineitem(spark, sf).select("l_returnflag"), "l_returnflag")
    return df.select(F.posexplode("ovr").alias("class_id", "y")).groupBy(F.col("class_id").cast("bigint").alias("class_id")).agg(
        F.count_if(F.col("y") > 0).alias("positives"), F.count_if(F.col("y") < 0).alias("negatives")
    )


@register(
    "p_center_target",
    """SELECT o_orderkey, round(o_totalprice / 1000 - (SELECT avg(o_totalprice / 1000) FROM orders), 6) AS label FROM orders""",
)
def p_center_target(spark, sf):
    centred, _ = prepare.center_target(keyed_orders(spark, sf))
    return centred.select("o_orderkey", F.round("label", 6).alias("label"))


@register(
    "p_density_profile",
    """WITH c AS (SELECT f.feature, CASE f.feature WHEN 0 THEN l_quantity WHEN 1 THEN l_discount ELSE l_tax END AS v
 FROM lineitem, (VALUES (0), (1), (2)) f(feature)),
 p AS (SELECT feature, count(*) AS n, count(*) FILTER (WHERE v <> 0) AS present FROM c GROUP BY feature)
 SELECT CAST(feature AS BIGINT) AS feature, present, round(present / n, 8) AS share,
 CASE WHEN (SELECT sum(present) / sum(n) FROM p) < 0.4 THEN 'sparse' ELSE 'dense' END AS by_table,
 CASE WHEN present / n >= 0.5 THEN 'dense' ELSE 'sparse' END AS by_feature FROM p""",
)
def p_density_profile(spark, sf):
    df = prepare.density_profile(price_table(spark, sf))
    return df.withColumn("feature", F.col("feature").cast("bigint")).withColumn("share", F.round("share", 8))


@register(
    "g_init_constant",
    """SELECT round(avg(y), 8) AS ls, round(ln((1 + avg(y)) / (1 - avg(y))), 8) AS log, round(ln((1 + avg(y)) / (1 - avg(y))) / 2, 8) AS logit,
 round(sum(y * w) / sum(w), 8) AS weighted FROM (SELECT CASE WHEN l_returnflag = 'R' THEN 1.0 ELSE -1.0 END::DOUBLE AS y, l_quantity AS w FROM lineitem)""",
)
def g_init_constant(spark, sf):
    df = lineitem(spark, sf).select(F.expr("IF(l_returnflag = 'R', 1.0D, -1.0D)").alias("label"), F.col("l_quantity").alias("w"))
    parts = [prepare.init_constant(df, n).select(F.round("constant", 8).alias(c)) for n, c in (("LS", "ls"), ("Log", "log"), ("Logit", "logit"))]
    parts.append(prepare.init_constant(df, "LS", weight="w").select(F.round("constant", 8).alias("weighted")))
    out = parts[0]
    for part in parts[1:]:
        out = out.crossJoin(part)  # single rows
    return out


# ---------------------------------------------------------------- losses

_SCORED = """WITH s AS (SELECT l_linenumber AS ln, CASE WHEN l_returnflag = 'R' THEN CAST(1 AS DOUBLE) ELSE CAST(-1 AS DOUBLE) END AS y,
 l_discount * 40 - 2 AS p FROM lineitem), z AS (SELECT *, y * p AS m, y - p AS r, 1 / (1 + exp(-p)) AS q, 1 / (1 + exp(y - p)) AS q2 FROM s)"""


def _scored(spark, sf):
    return lineitem(spark, sf).select(
        F.col("l_linenumber").cast("bigint").alias("ln"),
        F.expr("IF(l_returnflag = 'R', 1.0D, -1.0D)").alias("y"),
        F.expr("l_discount * 40 - 2").alias("p"),
    )


@register(
    "g_loss_leafwise",
    _SCORED
    + """ SELECT CAST(ln AS BIGINT) AS ln, round(sum(r * r / 2), 6) AS LS, round(sum(exp(-m)), 6) AS Expo, round(sum(ln(1 + exp(-m))), 6) AS Log,
 round(sum(ln(1 + exp(-2 * m))), 6) AS Logit, round(sum(-u * ln(q) - (1 - u) * ln(1 - q)), 6) AS LogRe,
 round(sum(2 * ln(1 + exp(p - y)) - (p - y) - 2 * ln(2)), 6) AS LogRe2, round(sum(abs(r)), 6) AS Abs,
 round(sum(CASE WHEN m <= 1 THEN r * r / 2 ELSE 0 END), 6) AS ModLS,
 round(sum(CASE WHEN m <= -1 THEN -2 * m WHEN m < 1 THEN r * r / 2 ELSE 0 END), 6) AS ModHuber
 FROM (SELECT *, (y + 1) / 2 AS u FROM z) GROUP BY ln""",
)
def g_loss_leafwise(spark, sf):
    df = _scored(spark, sf).withColumn("u", F.expr("(y + 1) / 2"))
    names = LEAFWISE_TRAINABLE + LEAFWISE_VALUE_ONLY
    return df.groupBy("ln").agg(
        *[F.round(F.sum(loss_value(n, "p", "u" if n == "LogRe" else "y")), 6).alias(n) for n in names]
    )


@register(
    "g_loss_binned",
    _SCORED
    + """ SELECT CAST(ln AS BIGINT) AS ln, round(sum(r * r), 6) AS LS, round(sum(CASE WHEN m < 1 THEN (m - 1) * (m - 1) ELSE 0 END), 6) AS MODLS,
 round(sum(ln(1 + exp(-m))), 6) AS LOGISTIC FROM z GROUP BY ln""",
)
def g_loss_binned(spark, sf):
    return _scored(spark, sf).groupBy("ln").agg(
        *[F.round(F.sum(loss_value(n, "p", "y", "binned")), 6).alias(n) for n in BINNED_TRAINABLE]
    )


@register(
    "g_derivatives_leafwise",
    _SCORED
    + """ SELECT CAST(ln AS BIGINT) AS ln, round(sum(r), 6) AS LS_g, round(sum(CAST(1 AS DOUBLE)), 6) AS LS_h,
 round(sum(y * exp(-m)), 6) AS Expo_g, round(sum(exp(-m)), 6) AS Expo_h,
 round(sum(y * exp(-m) / (1 + exp(-m))), 6) AS Log_g, round(sum(exp(-m) / (1 + exp(-m)) / (1 + exp(-m))), 6) AS Log_h,
 round(sum(2 * y * exp(-2 * m) / (1 + exp(-2 * m))), 6) AS Logit_g, round(sum(4 * exp(-2 * m) / (1 + exp(-2 * m)) / (1 + exp(-2 * m))), 6) AS Logit_h,
 round(sum((y + 1) / 2 - q), 6) AS LogRe_g, round(sum(q * (1 - q)), 6) AS LogRe_h,
 round(sum(1 - 2 * q2), 6) AS LogRe2_g, round(sum(2 * q2 * (1 - q2)), 6) AS LogRe2_h,
 round(sum(CASE WHEN y > p THEN CAST(1 AS DOUBLE) ELSE -1 END), 6) AS Abs_g, round(sum(CAST(0 AS DOUBLE)), 6) AS Abs_h FROM z GROUP BY ln""",
)
def g_derivatives_leafwise(spark, sf):
    df = _scored(spark, sf).withColumn("u", F.expr("(y + 1) / 2"))
    columns = []
    for n in LEAFWISE_TRAINABLE:
        g, h = derivatives(n, "p", "u" if n == "LogRe" else "y")
        columns += [F.round(F.sum(g), 6).alias(f"{n}_g"), F.round(F.sum(h), 6).alias(f"{n}_h")]
    return df.groupBy("ln").agg(*columns)


@register(
    "g_derivatives_binned",
    _SCORED
    + """ SELECT CAST(ln AS BIGINT) AS ln, round(sum(r), 6) AS LS_g, round(sum(CAST(1 AS DOUBLE)), 6) AS LS_h,
 round(sum(CASE WHEN m > 1 THEN 0 ELSE r END), 6) AS MODLS_g,
 round(sum(CASE WHEN m > 1 THEN greatest(CAST(0.1 AS DOUBLE), 1 - 5 * (m - 1)) ELSE 1 END), 6) AS MODLS_h,
 round(sum(CASE WHEN y > 0 THEN 1 ELSE 0 END - q), 6) AS LOGISTIC_g, round(sum(q * (1 - q)), 6) AS LOGISTIC_h FROM z GROUP BY ln""",
)
def g_derivatives_binned(spark, sf):
    columns = []
    for n in BINNED_TRAINABLE:
        g, h = derivatives(n, "p", "y", "binned")
        columns += [F.round(F.sum(g), 6).alias(f"{n}_g"), F.round(F.sum(h), 6).alias(f"{n}_h")]
    return _scored(spark, sf).groupBy("ln").agg(*columns)


@register(
    "g_expo_shifted",
    _SCORED
    + """, a AS (SELECT greatest(-500, least(500, avg(m))) AS shift FROM z)
 SELECT CAST(ln AS BIGINT) AS ln, round(sum(y * exp(-(m - shift))), 6) AS g, round(sum(exp(-(m - shift))), 6) AS h, round(max(exp(shift)), 8) AS lambda_scale
 FROM z, a GROUP BY ln""",
)
def g_expo_shifted(spark, sf):
    df = _scored(spark, sf)
    shift = max(-500.0, min(500.0, df.agg(F.avg(F.col("p") * F.col("y"))).first()[0]))
    g, h = derivatives("Expo", "p", "y", shift=shift)
    return df.groupBy("ln").agg(
        F.round(F.sum(g), 6).alias("g"), F.round(F.sum(h), 6).alias("h"), F.round(F.exp(F.lit(shift)), 8).alias("lambda_scale")
    )


# ---------------------------------------------------------------- probabilities and classes

_SCORES = """WITH s AS (SELECT event_id, value / 100 - 1 AS a, CAST(event_id % 7 AS DOUBLE) / 4 - 1 AS b, CAST(user_id % 5 AS DOUBLE) / 2 - 1 AS c FROM events)"""


def _events(spark, sf):
    return read(spark, sf, "events").selectExpr(
        "event_id", "value / 100 - 1 AS a", "double(event_id % 7) / 4 - 1 AS b", "double(user_id % 5) / 2 - 1 AS c"
    )


@register("d_proba_binary", _SCORES + " SELECT event_id, round(1 / (1 + exp(-a)), 8) AS p_first, round(1 - 1 / (1 + exp(-a)), 8) AS p_second FROM s")
def d_proba_binary(spark, sf):
    p = binary_proba(F.col("a"))
    return _events(spark, sf).select("event_id", F.round(p[0], 8).alias("p_first"), F.round(p[1], 8).alias("p_second"))


@register(
    "d_proba_sigmoid",
    _SCORES
    + """, q AS (SELECT event_id, 1 / (1 + exp(-a)) AS x, 1 / (1 + exp(-b)) AS y, 1 / (1 + exp(-c)) AS z FROM s)
 SELECT event_id, round(x / (x + y + z), 8) AS p0, round(y / (x + y + z), 8) AS p1, round(z / (x + y + z), 8) AS p2 FROM q""",
)
def d_proba_sigmoid(spark, sf):
    return _probabilities(spark, sf, "sigmoid")


@register(
    "d_proba_softmax",
    _SCORES
    + """, q AS (SELECT event_id, exp(a) AS x, exp(b) AS y, exp(c) AS z FROM s)
 SELECT event_id, round(x / (x + y + z), 8) AS p0, round(y / (x + y + z), 8) AS p1, round(z / (x + y + z), 8) AS p2 FROM q""",
)
def d_proba_softmax(spark, sf):
    return _probabilities(spark, sf, "softmax")


def _probabilities(spark, sf, calc):
    df = _events(spark, sf).withColumn("p", multi_proba(F.array("a", "b", "c"), calc))
    return df.select("event_id", *[F.round(F.col("p")[i], 8).alias(f"p{i}") for i in range(3)])


@register(
    "d_class",
    _SCORES
    + """ SELECT event_id, CASE WHEN a >= b AND a >= c THEN 'first' WHEN b >= c THEN 'second' ELSE 'third' END AS prediction, a > 0 AS flag FROM s""",
)
def d_class(spark, sf):
    p = multi_proba(F.array("a", "b", "c"), "softmax")
    return _events(spark, sf).select(
        "event_id", predict_class(p, ["first", "second", "third"]).alias("prediction"), binary_flag(F.col("a")).alias("flag")
    )


# ---------------------------------------------------------------- metrics

_LABELED = """WITH e AS (SELECT l_linestatus AS grp, CASE WHEN l_returnflag = 'R' THEN CAST(1 AS DOUBLE) ELSE CAST(-1 AS DOUBLE) END AS y,
 l_discount * 20 - 1 + CASE WHEN l_returnflag = 'R' THEN 0.25 ELSE 0 END AS s, l_quantity AS w FROM lineitem)"""


def _labeled(spark, sf):
    return lineitem(spark, sf).selectExpr(
        "l_linestatus AS grp",
        "IF(l_returnflag = 'R', 1.0D, -1.0D) AS label",
        "l_discount * 20 - 1 + IF(l_returnflag = 'R', 0.25D, 0D) AS score",
        "l_quantity AS w",
    )


def _rounded(df, *names, digits=6):
    return df.withColumns({n: F.round(n, digits) for n in names})


@register(
    "e_evaluate",
    _LABELED
    + """ SELECT grp, count(*) AS n, round(avg(CASE WHEN (s > 0) = (y > 0) THEN 1.0 ELSE 0.0 END), 6) AS accuracy,
 round(sqrt(avg((s - y) * (s - y))), 6) AS rmse, round(sum((s - y) * (s - y)), 4) AS squared_error, round(avg(ln(1 + exp(-s * y))), 6) AS mean_loss
 FROM e GROUP BY grp""",
)
def e_evaluate(spark, sf):
    df = metrics.evaluate(_labeled(spark, sf), "Log", by=["grp"])
    return _rounded(_rounded(df, "accuracy", "rmse", "mean_loss"), "squared_error", digits=4)


@register(
    "e_evaluate_weighted",
    _LABELED
    + """ SELECT count(*) AS n, round(sum(CASE WHEN (s > 0) = (y > 0) THEN w ELSE 0 END) / sum(w), 6) AS accuracy,
 round(sqrt(sum(w * (s - y) * (s - y)) / sum(w)), 6) AS rmse, round(sum(w * (s - y) * (s - y)), 2) AS squared_error,
 round(sum(w * (s - y) * (s - y) / 2) / sum(w), 6) AS mean_loss FROM e""",
)
def e_evaluate_weighted(spark, sf):
    df = metrics.evaluate(_labeled(spark, sf), "LS", weight="w")
    return _rounded(_rounded(df, "accuracy", "rmse", "mean_loss"), "squared_error", digits=2)


_CONFUSION = """, c AS (SELECT grp, count(*) FILTER (WHERE s > 0 AND y > 0) AS tp, count(*) FILTER (WHERE s > 0 AND NOT y > 0) AS fp,
 count(*) FILTER (WHERE NOT s > 0 AND NOT y > 0) AS tn, count(*) FILTER (WHERE NOT s > 0 AND y > 0) AS fn FROM e GROUP BY grp)"""


@register(
    "e_confusion",
    _LABELED
    + _CONFUSION
    + """, r AS (SELECT *, CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp) END AS p, CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn) END AS r FROM c)
 SELECT grp, tp, fp, tn, fn, round(p, 6) AS precision, round(r, 6) AS recall, round(CASE WHEN p + r = 0 THEN 0 ELSE 2 * p * r / (p + r) END, 6) AS f1 FROM r""",
)
def e_confusion(spark, sf):
    return _rounded(metrics.confusion(_labeled(spark, sf), ["grp"]), "precision", "recall", "f1")


@register(
    "e_confusion_guarded",
    _LABELED
    + _CONFUSION
    + """, r AS (SELECT *, tp / (tp + fp + 1e-10) AS p, tp / (tp + fn + 1e-10) AS r FROM c)
 SELECT grp, tp, fp, tn, fn, round(p, 6) AS precision, round(r, 6) AS recall, round(2 * p * r / (p + r + 1e-10), 6) AS f1 FROM r""",
)
def e_confusion_guarded(spark, sf):
    return _rounded(metrics.confusion(_labeled(spark, sf), ["grp"], guarded=True), "precision", "recall", "f1")


_RANKED = """, g AS (SELECT round(s, 6) AS s, count(*) FILTER (WHERE y > 0) AS pos, count(*) FILTER (WHERE NOT y > 0) AS neg FROM e GROUP BY 1),
 k AS (SELECT s, pos, neg, sum(pos) OVER (ORDER BY s DESC) AS hits, sum(pos + neg) OVER (ORDER BY s DESC) AS called, sum(pos) OVER () AS tp, sum(neg) OVER () AS tn FROM g)"""


@register(
    "e_best_threshold",
    _LABELED
    + _RANKED
    + """, m AS (SELECT s, CASE WHEN hits = 0 THEN 0 ELSE 2 * hits / (called + tp) END AS f1, (tp + tn - called - tp + 2 * hits) / (tp + tn) AS acc FROM k)
 SELECT round((SELECT max(f1) FROM m), 6) AS best_f1, (SELECT s FROM m ORDER BY f1 DESC, s DESC LIMIT 1) AS f1_threshold,
 round((SELECT max(acc) FROM m), 6) AS best_accuracy, (SELECT s FROM m ORDER BY acc DESC, s DESC LIMIT 1) AS accuracy_threshold""",
)
def e_best_threshold(spark, sf):
    df = metrics.best_threshold(_labeled(spark, sf).withColumn("score", F.round("score", 6)))
    return _rounded(df, "best_f1", "best_accuracy")


@register(
    "e_auc",
    _LABELED
    + _RANKED
    + """ SELECT CAST(max(tp) AS BIGINT) AS positives, CAST(max(tn) AS BIGINT) AS negatives,
 round(sum(neg * (hits - pos + pos / 2)) / ((max(tp) + 1e-10) * (max(tn) + 1e-10)), 6) AS auc FROM k""",
)
def e_auc(spark, sf):
    return _rounded(metrics.auc(_labeled(spark, sf).withColumn("score", F.round("score", 6))), "auc")


@register(
    "e_r2",
    """WITH e AS (SELECT l_linestatus AS grp, l_extendedprice / 1000 AS y, l_quantity * 1.4 + 1 AS s, l_tax + 1 AS w FROM lineitem),
 m AS (SELECT grp AS g, sum(w * y) / sum(w) AS my, avg(y) AS ay FROM e GROUP BY grp)
 SELECT grp, round(1 - sum((y - s) * (y - s)) / sum((y - ay) * (y - ay)), 6) AS r2,
 round(1 - sum(w * (y - s) * (y - s)) / sum(w * (y - my) * (y - my)), 6) AS weighted_r2 FROM e JOIN m ON grp = g GROUP BY grp""",
)
def e_r2(spark, sf):
    df = lineitem(spark, sf).selectExpr("l_linestatus AS grp", "l_extendedprice / 1000 AS label", "l_quantity * 1.4 + 1 AS score", "l_tax + 1 AS w")
    plain, weighted = metrics.r2(df, ["grp"]), metrics.r2(df, ["grp"], weight="w")
    return _rounded(plain.join(weighted.withColumnRenamed("r2", "weighted_r2"), "grp"), "r2", "weighted_r2")


@register(
    "e_class_accuracy",
    """WITH e AS (SELECT l_returnflag AS y, CASE WHEN l_linestatus = 'F' THEN 'R' ELSE 'N' END AS p, l_quantity AS w FROM lineitem)
 SELECT round(avg(CASE WHEN y = p THEN 1.0 ELSE 0.0 END), 6) AS accuracy, round(sum(CASE WHEN y = p THEN w ELSE 0 END) / sum(w), 6) AS weighted FROM e""",
)
def e_class_accuracy(spark, sf):
    df = lineitem(spark, sf).selectExpr("l_returnflag AS label", "IF(l_linestatus = 'F', 'R', 'N') AS prediction", "l_quantity AS w")
    plain = metrics.class_accuracy(df)
    weighted = metrics.class_accuracy(df, weight="w").withColumnRenamed("accuracy", "weighted")
    return _rounded(plain.crossJoin(weighted), "accuracy", "weighted")  # single rows


@register(
    "e_label_distribution",
    """SELECT o_orderpriority AS label, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 8) AS ratio FROM orders GROUP BY o_orderpriority""",
)
def e_label_distribution(spark, sf):
    df = metrics.label_distribution(read(spark, sf, "orders").select(F.col("o_orderpriority").alias("label")), "label")
    return _rounded(df, "ratio", digits=8)


# ---------------------------------------------------------------- folds


@register("c_folds", "SELECT event_id, CAST(ntile(7) OVER (ORDER BY event_id) AS BIGINT) AS fold FROM events")
def c_folds(spark, sf):
    df = fold_ops.folds(read(spark, sf, "events").select("event_id"), 7, "event_id")
    return df.withColumn("fold", F.col("fold").cast("bigint"))


@register(
    "c_folds_shuffled",
    """WITH f AS (SELECT event_id, ntile(5) OVER (ORDER BY CAST('0x' || substr(md5(CAST(event_id AS VARCHAR) || '-11'), 1, 15) AS BIGINT), event_id) AS fold FROM events)
 SELECT CAST(fold AS BIGINT) AS fold, count(*) AS n, min(event_id) AS lo, max(event_id) AS hi FROM f GROUP BY fold""",
)
def c_folds_shuffled(spark, sf):
    df = fold_ops.folds(read(spark, sf, "events").select("event_id"), 5, "event_id", shuffle=True, seed=11)
    facts = df.groupBy("fold").agg(F.count(F.lit(1)).alias("n"), F.min("event_id").alias("lo"), F.max("event_id").alias("hi"))
    return facts.withColumn("fold", F.col("fold").cast("bigint"))


@register(
    "c_folds_by_class",
    "SELECT o_orderkey, o_orderpriority AS stratum, CAST(ntile(4) OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) AS BIGINT) AS fold FROM orders",
)
def c_folds_by_class(spark, sf):
    df = fold_ops.stratified_folds(read(spark, sf, "orders").select("o_orderkey", "o_orderpriority"), 4, "o_orderpriority", "o_orderkey")
    return df.select("o_orderkey", "stratum", F.col("fold").cast("bigint").alias("fold"))


@register(
    "c_folds_by_range",
    """WITH b AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders),
 s AS (SELECT o_orderkey, CAST(least(4, floor((o_totalprice - lo) * 4 / (hi - lo)) + 1) AS BIGINT) AS stratum FROM orders, b)
 SELECT o_orderkey, stratum, CAST(ntile(4) OVER (PARTITION BY stratum ORDER BY o_orderkey) AS BIGINT) AS fold FROM s""",
)
def c_folds_by_range(spark, sf):
    df = fold_ops.stratified_folds(read(spark, sf, "orders").select("o_orderkey", "o_totalprice"), 4, "o_totalprice", "o_orderkey", numeric=True)
    return df.select("o_orderkey", F.col("stratum").cast("bigint").alias("stratum"), F.col("fold").cast("bigint").alias("fold"))


@register(
    "c_holdout",
    """WITH h AS (SELECT o_orderkey, CAST('0x' || substr(md5(CAST(o_orderkey AS VARCHAR) || '-3'), 1, 15) AS BIGINT) / CAST(1152921504606846976 AS DOUBLE) < 0.2 AS is_test FROM orders)
 SELECT is_test, count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS key_sum FROM h GROUP BY is_test""",
)
def c_holdout(spark, sf):
    df = fold_ops.holdout(read(spark, sf, "orders").select("o_orderkey"), 0.2, "o_orderkey", seed=3)
    return df.groupBy("is_test").agg(F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("key_sum"))
