"""Cases that once failed: odd cells, losses at large scores, tables without anything to cut, bins by default."""

import math

import pytest
from pyspark.sql import functions as F

from grove.forest import Forest, Node, Tree
from grove.functions import trees as tree_functions
from grove.functions.losses import loss_value
from grove.plans.binned import BinnedParams, BinnedTrainer, replay
from grove.plans.fit import find_bins, fit_classifier, fit_forest
from grove.plans.leafwise import LeafwiseParams, adjusted_test_interval

NAN, INF = float("nan"), float("inf")


def dense(spark, rows):
    return spark.createDataFrame([(x, float(y), 1.0) for x, y in rows], "features array<double>, label double, weight double")


def sparse(spark, rows):
    return spark.createDataFrame([(x, float(y), 1.0) for x, y in rows], "features map<int,double>, label double, weight double")


@pytest.mark.parametrize("params", [LeafwiseParams(max_leaf=4, min_samples_leaf=1), BinnedParams(n_estimators=2, min_samples_leaf=1, l2=1.0)])
def test_nothing_to_cut_gives_the_constant(spark, params):
    for table in (sparse(spark, [({}, 1), ({}, 3)]), sparse(spark, [({0: 1.0}, 1), ({0: 1.0}, 3)])):
        forest = fit_forest(table, params).forest
        got = {r[0] for r in forest.transform(table).select(forest.transform(table).columns[-1]).collect()}
        assert len(got) == 1 and not any(math.isnan(x) for x in got)


@pytest.mark.parametrize("params", [LeafwiseParams(max_leaf=6, min_samples_leaf=1), BinnedParams(n_estimators=2, min_samples_leaf=1, l2=1.0, l1=0.0)])
def test_odd_cells_can_be_trained_on(spark, params):
    rows = [([NAN, 1.0], 1), ([None, 2.0], 1), ([INF, 3.0], 2), ([-INF, 4.0], 1), ([5.0, 5.0], 3), ([6.0, NAN], 4)] * 3
    table = dense(spark, rows)
    forest = fit_forest(table, params).forest
    assert all(not math.isnan(r[-1]) for r in forest.transform(table).collect())
    names = table.withColumn("name", F.when(F.col("label") > 1, "a").otherwise("b"))
    loss = "Log" if isinstance(params, LeafwiseParams) else "LOGISTIC"
    params.loss = loss
    assert len(fit_classifier(names, "name", params).fits) == 1


def test_logre_stays_finite(spark):
    df = spark.sql("SELECT * FROM VALUES (40D, 1D), (800D, 0D), (-40D, 1D), (0.5D, 0.25D) t(s, y)")
    got = [r[0] for r in df.select(loss_value("LogRe", "s", "y")).collect()]
    assert all(x is not None and math.isfinite(x) for x in got) and got[0] < 1e-10 and abs(got[2] - 40) < 1e-6
    q = 1 / (1 + math.exp(-0.5))
    assert abs(got[3] + 0.25 * math.log(q) + 0.75 * math.log(1 - q)) < 1e-12


@pytest.mark.parametrize("missing", ["lowest", "zero"])
@pytest.mark.parametrize("kind", ["dense", "map"])
def test_both_ways_of_scoring_agree(spark, monkeypatch, missing, kind):
    """Below and above the size at which a forest is no longer one expression."""
    cells = [None, NAN, -1.0, 0.0, 2.0]
    if kind == "dense":
        df = spark.createDataFrame([([a, b],) for a in cells for b in cells], "features array<double>")
    else:
        maps = [{0: a, 1: b} for a in cells for b in cells] + [{}, {0: 1.0}, {1: None}]
        df = spark.createDataFrame([(m,) for m in maps], "features map<int,double>")
    trees = []
    for feature, cut in ((0, -0.5), (1, 0.5), (0, -5.0)):
        tree = Tree([Node(n=1)])
        tree.split(0, feature, 0, 1.0, {"weight": 2.0, "n": 1}, {"weight": 3.0 + feature, "n": 1})
        tree.nodes[0].cut = cut
        trees.append(tree)
    forest = Forest(trees, 1.0, 2, missing)
    short = [r[-1] for r in forest.transform(df).collect()]
    monkeypatch.setattr(tree_functions, "CASE_NODES", 0)
    assert [r[-1] for r in forest.transform(df).collect()] == short


def test_bins_are_those_asked_for(spark):
    many = sparse(spark, [({0: float(i)}, i % 7) for i in range(600)])
    assert len(find_bins(many, BinnedParams(max_bins=300, min_child_weight=0.5)).boundaries[0]) > 200
    wide = dense(spark, [([float(i)], i % 5) for i in range(700)])
    assert len(find_bins(wide, LeafwiseParams()).boundaries[0]) == 699
    assert len(find_bins(wide, LeafwiseParams(max_bins=50)).boundaries[0]) <= 49


@pytest.mark.parametrize("test, opt, want", [(250, 100, 300), (249, 100, 200), (30, 100, 50), (100, 100, 100), (1, 7, 1), (3, 7, 7)])
def test_intervals(test, opt, want):
    assert adjusted_test_interval(test, opt) == want


def test_replay_picks_by_gain_and_stops():
    gain = lambda g: {"gain": g}
    scored = {"": gain(9.0), "0": gain(2.0), "1": gain(5.0), "10": None, "11": gain(1.0), "00": None, "01": None}
    p = BinnedParams(max_depth=3, max_leaf=50, tree_gain_ratio=0.1)
    assert replay({}, p) == ([], [""]) and replay({"": None}, p) == ([], [])
    assert replay(scored, p) == (["", "1", "0", "11"], [])
    assert replay(scored, BinnedParams(max_depth=3, max_leaf=3, tree_gain_ratio=0.1)) == (["", "1"], [])
    assert replay(scored, BinnedParams(max_depth=3, tree_gain_ratio=0.5)) == (["", "1"], [])


def events(spark, n=200):
    rows = [([float(i * 37 % 50), float(i * 11 % 23), float(i * i % 31)], (i * 37 % 50) / 10 + (i * 11 % 23 > 9) + (i % 5) / 7) for i in range(n)]
    return dense(spark, rows)


LEAFWISE = dict(max_leaf=8, min_samples_leaf=5, opt_interval=4, test_interval=8, l2=0.1, reg_depth=1.5)
BINNED = dict(n_estimators=3, min_samples_leaf=5, max_leaf=4, l2=5.0)


@pytest.mark.parametrize("kind, how", [(LeafwiseParams, LEAFWISE), (BinnedParams, BINNED)])
def test_quadratic_correction_is_exact_under_squares(spark, kind, how):
    table = events(spark)
    a, b = (fit_forest(table, kind(**how, correction=c)).forest for c in ("exact", "quadratic"))
    assert len(a.trees) == len(b.trees)
    for s, t in zip(a.trees, b.trees):
        assert [(n.feature, n.bin) for n in s.nodes] == [(n.feature, n.bin) for n in t.nodes]
        assert all(abs(m.weight - n.weight) < 1e-9 for m, n in zip(s.nodes, t.nodes))


def test_quadratic_correction_of_other_losses(spark):
    table = events(spark).withColumn("label", F.when(F.col("label") > 3, 1.0).otherwise(-1.0))
    for kind, how in ((LeafwiseParams, LEAFWISE | {"loss": "Log"}), (BinnedParams, BINNED | {"loss": "LOGISTIC"})):
        losses = []
        for c in ("exact", "quadratic"):
            scored = fit_forest(table, kind(**how, correction=c)).forest.transform(table)
            losses.append(scored.select(F.avg(F.log1p(F.exp(-F.col("label") * F.col(scored.columns[-1]))))).first()[0])
        assert abs(losses[0] - losses[1]) < 0.01 * losses[0]


def test_jobs_of_a_quadratic_correction_do_not_grow(spark, monkeypatch):
    table = events(spark).withColumn("label", F.when(F.col("label") > 3, 1.0).otherwise(-1.0))
    jobs, plain = [], BinnedTrainer.correct

    def counted(self):
        spark.sparkContext.setJobGroup(f"correct {len(jobs)}", "")
        plain(self)
        jobs.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"correct {len(jobs)}")))
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)

    monkeypatch.setattr(BinnedTrainer, "correct", counted)
    fit_forest(table, BinnedParams(**BINNED | {"n_estimators": 4, "loss": "LOGISTIC"}, correction="quadratic"))
    assert len(jobs) == 4 and jobs[1] == jobs[3] > 0


def test_options_of_the_leafwise_engine(spark):
    table = events(spark)
    loss = lambda f: f.transform(table).select(F.avg(F.pow(F.col("label") - F.col("score"), 2))).first()[0]
    plain = fit_forest(table, LeafwiseParams(**LEAFWISE))
    once = fit_forest(table, LeafwiseParams(**LEAFWISE, exit_delta=1e9))
    assert max(r["sweep"] for r in once.log) == 1 < max(r["sweep"] for r in plain.log)
    free = fit_forest(table, LeafwiseParams(**LEAFWISE, normalize=False, intercept=True))
    assert free.forest.constant != 0 and loss(free.forest) < 2 * loss(plain.forest)
    few, again = (fit_forest(table, LeafwiseParams(**LEAFWISE, feature_ratio=0.34)).forest for _ in range(2))
    shape = lambda f: [[(n.feature, n.bin) for n in t.nodes] for t in f.trees]
    assert shape(few) == shape(again) != shape(plain.forest)


def test_models_on_the_way(spark):
    path = fit_forest(events(spark), BinnedParams(**BINNED | {"n_estimators": 5}, save_frequency=2)).path
    assert [len(f.trees) for f in path] == [2, 4, 5]


def test_quadratic_correction_in_blocks_of_rows(spark, monkeypatch):
    """Blocks of three Gram rows a job give the same forest as one block."""
    table = events(spark).withColumn("label", F.when(F.col("label") > 3, 1.0).otherwise(-1.0))
    params = BinnedParams(**BINNED | {"n_estimators": 4, "loss": "LOGISTIC"}, correction="quadratic")
    whole = fit_forest(table, params).forest
    monkeypatch.setattr("grove.operators.correct.GRAM_BLOCK", 3)
    parts = fit_forest(table, params).forest
    for s, t in zip(whole.trees, parts.trees):
        assert [(n.feature, n.bin) for n in s.nodes] == [(n.feature, n.bin) for n in t.nodes]
        assert all(abs(m.weight - n.weight) < 1e-9 for m, n in zip(s.nodes, t.nodes))


def test_squares_beyond_the_kept_gram_stay_exact_with_one_pass(spark, monkeypatch):
    """LS past MAX_GRAM leaves: the correction of the trees in turn, one pass, equals the kept matrix's."""
    table = events(spark)
    params = BinnedParams(**BINNED | {"n_estimators": 4})
    kept = fit_forest(table, params).forest
    monkeypatch.setattr("grove.plans.binned.MAX_GRAM", 0)
    jobs, plain = [], BinnedTrainer.correct

    def counted(self):
        spark.sparkContext.setJobGroup(f"past {len(jobs)}", "")
        plain(self)
        jobs.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"past {len(jobs)}")))
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)

    monkeypatch.setattr(BinnedTrainer, "correct", counted)
    past = fit_forest(table, params).forest
    for s, t in zip(kept.trees, past.trees):
        assert all(abs(m.weight - n.weight) < 1e-9 for m, n in zip(s.nodes, t.nodes))
    assert len(set(jobs[1:])) == 1  # the same jobs for every tree


def test_binned_correction_never_refuses_many_leaves(spark, monkeypatch):
    """The binned quadratic mode builds only the trees in turn: a leaf bound far below the forest's size is no refusal."""
    monkeypatch.setattr("grove.operators.correct.QUADRATIC_LEAVES", 2)
    table = events(spark).withColumn("label", F.when(F.col("label") > 3, 1.0).otherwise(-1.0))
    fitted = fit_forest(table, BinnedParams(**BINNED | {"n_estimators": 3, "loss": "LOGISTIC"}, correction="quadratic"))
    assert len(fitted.forest.trees) == 3


def test_classes_train_together_as_alone(spark):
    """One pass for three classes gives each class the forest it gets alone, with fewer jobs than one class after another."""
    rows = [([float(i * 37 % 50), float(i * 11 % 23), float(i * i % 31)], ("a", "b", "c")[(i * 37 % 50 > 20) + (i * 11 % 23 > 15)]) for i in range(240)]
    table = spark.createDataFrame(rows, "features array<double>, name string").withColumn("weight", F.lit(1.0))
    for loss in ("LOGISTIC", "LS"):
        params = BinnedParams(n_estimators=3, min_samples_leaf=5, max_leaf=4, l2=5.0, loss=loss)
        jobs = {}
        for together in (True, False):
            spark.sparkContext.setJobGroup(f"classes {together}", "")
            got = fit_classifier(table, "name", params, together=together)
            jobs[together] = len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"classes {together}"))
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
            if together:
                one = got
        assert one.classes == got.classes == ["a", "b", "c"]
        for f, g in zip(one.forests, got.forests):
            assert (f.class_id, f.class_label) == (g.class_id, g.class_label) and len(f.trees) == len(g.trees) == 3
            for s, t in zip(f.trees, g.trees):
                assert [(n.feature, n.cut, n.left) for n in s.nodes] == [(n.feature, n.cut, n.left) for n in t.nodes]
                assert all(abs(m.weight - n.weight) < 1e-9 for m, n in zip(s.nodes, t.nodes))
        assert jobs[True] < jobs[False]
