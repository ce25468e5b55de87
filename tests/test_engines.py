"""Both engines against plain row-by-row versions on small fixtures, and their invariants."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from grove.forest import load_forests, save_forests
from grove.operators import binning as B
from grove.operators import explain
from grove.plans import fit as fit_module
from grove.plans import rows as rows_module
from grove.plans.binned import BinnedParams
from grove.plans.fit import fit_classifier, fit_forest
from grove.plans.leafwise import LeafwiseParams, adjusted_test_interval
from tests import brute


def fixture(spark, n=160, classes=False, weighted=False, seed=3, levels=9):
    rng = np.random.default_rng(seed)
    x = rng.integers(0, levels, (n, 4)).astype(float)
    y = 2 * np.sin(x[:, 0]) + (x[:, 1] > 4) * x[:, 2] * 0.5 + rng.normal(0, 0.3, n)
    if classes:
        y = np.where(y > np.median(y), 1.0, -1.0)
    w = rng.integers(1, 4, n) / 2 if weighted else np.ones(n)
    rows = [(i, [float(v) for v in x[i]], float(y[i]), float(w[i])) for i in range(n)]
    table = spark.createDataFrame(rows, "row_id bigint, features array<double>, label double, weight double").repartition(3)
    return table, x, y, w


def scores(forest, table):
    got = forest.transform(table).select("row_id", "score").toPandas().sort_values("row_id")
    return got["score"].to_numpy()


LEAFWISE = {
    "ls": dict(),
    "ls_weighted": dict(weighted=True),
    "ls_depth": dict(reg_depth=1.3, sl2=0.02),
    "two_trees_searched": dict(n_tree_search=2),
    "internal": dict(internal_nodes=True),
    "opt": dict(algorithm="opt", reg_depth=1.2),
    "sib": dict(algorithm="sib"),
    "log": dict(loss="Log", normalize=False, n_iter=2),
    "expo": dict(loss="Expo", normalize=False, n_iter=2, max_leaf=9),
}


@pytest.mark.parametrize("case", sorted(LEAFWISE))
def test_leafwise_equals_brute_force(spark, case):
    options = dict(LEAFWISE[case])
    weighted = options.pop("weighted", False)
    config = {"max_leaf": 14, "opt_interval": 5, "min_samples_leaf": 8, "l2": 0.05, **options}
    params = LeafwiseParams(**config)
    table, x, y, w = fixture(spark, classes=params.loss != "LS", weighted=weighted)
    fitted = fit_forest(table, params)
    want, trees = brute.leafwise(x, y, w, params)
    assert [len(t.nodes) for t in fitted.forest.trees] == [len(t) for t in trees]
    tolerance = 1e-4 if params.algorithm != "l2" else 1e-9  # the plain version differentiates numerically
    np.testing.assert_allclose(scores(fitted.forest, table), want, atol=tolerance)


BINNED = {
    "corrective": dict(),
    "greedy": dict(opt_algorithm="greedy", learning_rate=0.3),
    "weighted": dict(weighted=True, tree_gain_ratio=0.4),
    "few_leaves": dict(max_leaf=4, tree_gain_ratio=0.01),
    "logistic": dict(loss="LOGISTIC", l1=0.1),
    "modls": dict(loss="MODLS", l1=0.1),
    "many_trees": dict(n_estimators=24, max_depth=1),
}


@pytest.mark.parametrize("case", sorted(BINNED))
def test_binned_equals_brute_force(spark, case):
    options = dict(BINNED[case])
    weighted = options.pop("weighted", False)
    params = BinnedParams(**{"n_estimators": 3, "max_depth": 3, "l1": 0.2, "l2": 1.0, "min_samples_leaf": 4, "tree_gain_ratio": 0.2, **options})
    table, x, y, w = fixture(spark, classes=params.loss != "LS", weighted=weighted)
    fitted = fit_forest(table, params, bins=B.fit_fine_bins(table))
    want, _ = brute.binned(x, y, w, params)
    np.testing.assert_allclose(scores(fitted.forest, table), want, atol=1e-8)


@pytest.mark.parametrize("params", [
    LeafwiseParams(max_leaf=9, opt_interval=4, min_samples_leaf=8, l2=0.05),
    LeafwiseParams(max_leaf=9, opt_interval=4, min_samples_leaf=8, l2=0.05, algorithm="sib"),
    BinnedParams(n_estimators=2, max_depth=3, l1=0.2, l2=1.0, tree_gain_ratio=0.2),
])
def test_search_as_a_job_gives_the_same_forest(spark, params, monkeypatch):
    table, *_ = fixture(spark)
    bins = B.fit_fine_bins(table)
    small = fit_forest(table, params, bins=bins).forest
    monkeypatch.setattr(rows_module, "DRIVER_CELLS", 0)
    large = fit_forest(table, params, bins=bins).forest
    np.testing.assert_allclose(scores(large, table), scores(small, table), atol=1e-9)


def test_partitions_and_collapsing_do_not_matter(spark, monkeypatch):
    table, *_ = fixture(spark, n=200, levels=2)
    params = LeafwiseParams(max_leaf=8, opt_interval=4, min_samples_leaf=5, l2=0.05)
    merged = fit_forest(table, params)
    monkeypatch.setattr(fit_module, "maybe_collapse", lambda rows, loss, n: rows)
    plain = fit_forest(table.repartition(7), params)
    np.testing.assert_allclose(scores(merged.forest, table), scores(plain.forest, table), atol=1e-9)
    assert merged.log[-1]["loss"] == pytest.approx(plain.log[-1]["loss"])


def test_corrections_by_jobs_equal_those_by_gram(spark, monkeypatch):
    table, *_ = fixture(spark)
    params = LeafwiseParams(max_leaf=8, opt_interval=4, min_samples_leaf=8, l2=0.05, n_iter=2)
    by_gram = fit_forest(table, params)
    monkeypatch.setattr("grove.plans.leafwise.MAX_GRAM", 0)
    by_jobs = fit_forest(table, params)
    np.testing.assert_allclose(scores(by_gram.forest, table), scores(by_jobs.forest, table), atol=1e-8)


@pytest.mark.parametrize("engine", ["leafwise", "binned"])
def test_sparse_table_gives_the_dense_forest(spark, engine):
    table, *_ = fixture(spark)
    shifted = table.withColumn("features", F.transform("features", lambda v: v - 3 if engine == "leafwise" else v))
    entries = F.filter(F.transform("features", lambda v, i: F.struct(i, v)), lambda e: e["v"] != 0)
    entries = F.expr("filter(transform(features, (v, i) -> struct(i, v)), e -> e.v != 0)")
    sparse = shifted.withColumn("features", F.map_from_entries(entries))
    if engine == "leafwise":
        params = LeafwiseParams(max_leaf=8, opt_interval=4, min_samples_leaf=8, l2=0.05)
        dense_fit, sparse_fit = fit_forest(shifted, params), fit_forest(sparse, params)
    else:
        params = BinnedParams(n_estimators=2, max_depth=2, l1=0.2, l2=1.0, min_child_weight=1.0, tree_gain_ratio=0.2)
        dense_fit, sparse_fit = fit_forest(shifted, params), fit_forest(sparse, params)
    np.testing.assert_allclose(scores(sparse_fit.forest, sparse), scores(dense_fit.forest, shifted), atol=1e-9)


def test_loss_never_rises_within_a_correction(spark):
    table, *_ = fixture(spark)
    log = fit_forest(table, LeafwiseParams(max_leaf=10, opt_interval=5, min_samples_leaf=8, l2=0.0)).log
    for a, b in zip(log, log[1:]):
        if a["step"] == b["step"]:
            assert b["loss"] <= a["loss"] + 1e-12


def test_path_warm_start_save_and_load(spark, tmp_path):
    table, *_ = fixture(spark)
    params = dict(opt_interval=4, test_interval=4, min_samples_leaf=8, l2=0.05)
    fitted = fit_forest(table, LeafwiseParams(max_leaf=10, **params))
    assert [f.seq for f in fitted.path] == list(range(1, len(fitted.path) + 1))
    assert fitted.path[0].n_leaves < fitted.path[-1].n_leaves
    save_forests(spark, fitted.path, str(tmp_path))
    loaded = load_forests(spark, str(tmp_path))
    assert len(loaded) == len(fitted.path)
    np.testing.assert_array_equal(scores(loaded[-1], table), scores(fitted.forest, table))
    more = fit_forest(table, LeafwiseParams(max_leaf=14, **params), init_model=loaded[0])
    assert more.forest.n_leaves >= 14
    with pytest.raises(ValueError):
        fit_forest(table, LeafwiseParams(max_leaf=4, **params), init_model=fitted.forest)


def test_large_forests_score_like_small_ones(spark, monkeypatch):
    table, *_ = fixture(spark)
    forest = fit_forest(table, LeafwiseParams(max_leaf=10, opt_interval=5, min_samples_leaf=8)).forest
    small, leaves = scores(forest, table), forest.leaf_index(table).orderBy("row_id").select("leaves").collect()
    monkeypatch.setattr("grove.functions.trees.CASE_NODES", 0)
    np.testing.assert_allclose(scores(forest, table), small, atol=1e-12)
    assert forest.leaf_index(table).orderBy("row_id").select("leaves").collect() == leaves


def test_importance_sums_to_one_and_weights_of_one_change_nothing(spark):
    table, *_ = fixture(spark)
    params = LeafwiseParams(max_leaf=8, opt_interval=4, min_samples_leaf=8)
    forest = fit_forest(table, params).forest
    total = explain.feature_importance(forest.nodes_df(spark)).agg(F.sum("importance")).first()[0]
    assert total == pytest.approx(1.0)
    assert explain.forest_stats(forest.nodes_df(spark)).first()["leaves"] == forest.n_leaves


def test_one_vs_rest_learns_classes(spark):
    from grove.operators.score import multi_proba, predict_class, score_array

    rng = np.random.default_rng(0)
    rows = []
    for i in range(240):
        k = i % 3
        rows.append((i, [float(rng.normal(k * 2.5, 0.6)), float(rng.normal(-k, 0.8))], "abc"[k], 1.0))
    table = spark.createDataFrame(rows, "row_id bigint, features array<double>, name string, weight double")
    fitted = fit_classifier(table, "name", LeafwiseParams(max_leaf=8, opt_interval=8, loss="Log", normalize=False, min_samples_leaf=5, n_iter=2))
    p = multi_proba(score_array(table, fitted.forests))
    out = table.select("name", p.alias("p"), predict_class(p, fitted.classes).alias("guess")).toPandas()
    assert (out["name"] == out["guess"]).mean() > 0.9
    assert np.allclose([sum(v) for v in out["p"]], 1.0)


@pytest.mark.parametrize("bad", [
    dict(max_leaf=0), dict(loss="Huber"), dict(reg_depth=0.5), dict(l2=-1.0), dict(min_samples_leaf=0.7), dict(learning_rate=0.0),
    dict(algorithm="other"), dict(n_iter=0), dict(opt_interval=0),
])
def test_bad_leafwise_parameters_raise(bad):
    with pytest.raises(ValueError):
        LeafwiseParams(**bad).check()


@pytest.mark.parametrize("bad", [dict(n_estimators=0), dict(tree_gain_ratio=0.0), dict(loss="Log"), dict(l1=-1.0), dict(opt_algorithm="x"), dict(max_depth=-1)])
def test_bad_binned_parameters_raise(bad):
    with pytest.raises(ValueError):
        BinnedParams(**bad).check()


def test_interval_adjustment():
    assert adjusted_test_interval(100, 100) == 100
    assert adjusted_test_interval(250, 100) == 300
    assert adjusted_test_interval(30, 100) == 50
