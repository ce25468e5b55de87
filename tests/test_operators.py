"""Edge cases and scale paths of the operators."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from grove.operators import binning as B
from grove.operators import folds, metrics, prepare
from grove.sources import tables, text


def table_of(spark, values, labels=None, weights=None):
    rows = [([float(v)] if v is not None else [None], float(y), float(w)) for v, y, w in zip(values, labels or values, weights or [1] * len(values))]
    return spark.createDataFrame(rows, "features array<double>, label double, weight double")


def brute_bins(x, y, max_bins, least, l2):
    x, y = np.asarray(x, float), np.asarray(y, float)
    groups = [np.ones(len(x), bool)]
    cuts = []

    def best(mask):
        found = (0.0, None)
        v = np.unique(x[mask])
        for a, b in zip(v[:-1], v[1:]):
            le, gt = mask & (x <= a), mask & (x > a)
            if le.sum() < least or gt.sum() < least:
                continue
            gain = y[le].sum() ** 2 / (le.sum() + l2) + y[gt].sum() ** 2 / (gt.sum() + l2) - y[mask].sum() ** 2 / (mask.sum() + 2 * l2)
            if gain > found[0]:
                found = (gain, (a + b) / 2)
        return found

    while len(cuts) + 1 < max_bins:
        options = [(best(m), i) for i, m in enumerate(groups)]
        (gain, cut), i = max(options, key=lambda o: o[0][0])
        if gain <= 0:
            break
        cuts.append(cut)
        m = groups.pop(i)
        groups += [m & (x <= cut), m & (x > cut)]
    return sorted(cuts)


def test_bins_equal_brute_force_on_every_path(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(0, 1, 150).round(2)
    y = np.sin(3 * x) + rng.normal(0, 0.2, 150)
    t = table_of(spark, x, list(y))
    want = brute_bins(x, y, 7, 5, 2.0)
    np.testing.assert_allclose(B.fit_bins(t, 7).boundaries[0], want)
    np.testing.assert_allclose(B.fit_bins(t, 7, local_values=10, target_rows=20).boundaries[0], want)


def test_bins_of_degenerate_features(spark):
    assert len(B.fit_bins(table_of(spark, [3] * 20)).boundaries[0]) == 0
    assert len(B.fit_bins(table_of(spark, [3])).boundaries[0]) == 0
    assert len(B.fit_bins(table_of(spark, range(30), [5] * 30), min_bucket_weight=40).boundaries[0]) == 0


def test_large_bin_sets_apply_like_small_ones(spark, monkeypatch):
    t = table_of(spark, list(range(50)) + [-1e300, 1e300])
    bins = B.fit_fine_bins(t)
    case = [r[0] for r in B.apply_bins(t, bins).select("bins").collect()]
    monkeypatch.setattr(B, "CASE_BOUNDARIES", 0)
    assert [r[0] for r in B.apply_bins(t, bins).select("bins").collect()] == case


def test_validation(spark):
    good = table_of(spark, [1, 2, 3], [1, -1, 1])
    assert prepare.validate(good, classification=True, n_features=1)["rows"] == 3
    for bad, options in [
        (table_of(spark, [1, 2], [1, 1]), dict(classification=True)),
        (table_of(spark, [1, 2], [1, -1], [1, 0]), {}),
        (table_of(spark, [1, 2], [1, float("nan")]), {}),
        (good.limit(0), {}),
        (good, dict(n_features=2)),
    ]:
        with pytest.raises(ValueError):
            prepare.validate(bad, **options)


def test_clean_values(spark):
    t = spark.createDataFrame([(float("nan"),), (float("inf"),), (float("-inf"),), (None,), (2.0,)], "x double")
    got = sorted(r[0] for r in prepare.clean(t, ["x"]).collect())
    assert got == [prepare.VALUE_MIN] * 3 + [2.0, prepare.VALUE_MAX]


def test_curves_are_the_same_with_many_buckets(spark):
    rng = np.random.default_rng(5)
    s, y = rng.integers(0, 60, 500) / 4.0, rng.choice([-1, 1], 500)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(s, y)], "score double, label double")
    pos, neg = s[y > 0], s[y < 0]
    want = np.mean([(p > q) + 0.5 * (p == q) for p in pos for q in neg])
    for target in (10, 10**6):
        assert metrics.auc(df, target_rows=target).first()["auc"] == pytest.approx(want, abs=1e-9)
    a, b = (metrics.best_threshold(df, target_rows=t).first() for t in (7, 10**6))
    assert a == b


@pytest.mark.parametrize("target", [40, 10**6])
def test_folds_equal_ntile(spark, target):
    df = spark.range(1003).withColumn("grp", F.expr("IF(id % 3 = 0, 'hot', string(id % 50))"))
    for made, window in [
        (folds.folds(df, 7, "id", target_rows=target), "ORDER BY id"),
        (folds.stratified_folds(df, 4, "grp", "id", target_rows=target), "PARTITION BY grp ORDER BY id"),
    ]:
        k = 7 if "PARTITION" not in window else 4
        assert made.filter(f"fold <> {k} + 1").count() == 1003
        assert made.selectExpr(f"fold - ntile({k}) OVER ({window}) AS d").filter("d <> 0").count() == 0


def test_text_errors(spark, tmp_path):
    def write(name, *lines):
        path = tmp_path / name
        path.write_text("\n".join(lines) + "\n")
        return str(path)

    with pytest.raises(ValueError):
        text.read_dense(spark, write("ragged", "1 2", "1 2 3"))
    with pytest.raises(ValueError):
        text.read_sparse(spark, write("twice", "sparse 4", "1:2 1:3"))
    with pytest.raises(ValueError):
        text.read_sparse(spark, write("outside", "sparse 4", "4:1"))
    with pytest.raises(ValueError):
        text.read_sparse(spark, write("headless", "1:1 2:2"))
    rows, width = text.read_sparse(spark, write("good", "sparse 4", "0 3:2.5", "", "1:-1"))
    assert width == 4
    assert [r["features"] for r in rows.orderBy("row_id").collect()] == [{0: 1.0, 3: 2.5}, {}, {1: -1.0}]
    mixed = text.read_labeled(spark, write("mixed", "1 2.5 3 1:2|5:6 0:1", "-1 nan 4 2:2 7:0|7:9"), "y.x")
    first, second = mixed.orderBy("row_id").collect()
    assert (first["label"], first["features"], first["groups"]) == (1.0, [2.5, 3.0], [{1: 2.0, 5: 6.0}, {0: 1.0}])
    assert second["features"][0] == prepare.VALUE_MIN and second["groups"][1] == {7: 0.0}


def test_files_of_different_length_do_not_align(spark):
    x = spark.createDataFrame([(0, [1.0]), (1, [2.0])], "row_id bigint, features array<double>")
    y = spark.createDataFrame([(0, 1.0)], "row_id bigint, v double")
    with pytest.raises(Exception, match="differ in length"):
        tables.align(x, y).collect()


def test_forest_rejects_another_width(spark):
    from grove.queries.models import fixed_forest

    df = spark.createDataFrame([([1.0, 2.0],)], "features array<double>")
    with pytest.raises(Exception, match="3 features"):
        fixed_forest().transform(df).collect()


def test_missing_values_go_left(spark):
    from grove.queries.models import fixed_forest

    df = spark.createDataFrame([([None, float("nan"), 0.0],), ([-1e30, 0.0, 0.0],)], "features array<double>")
    a, b = fixed_forest().transform(df).select("score").collect()
    assert a == b
    sparse = spark.createDataFrame([({2: 0.0},)], "features map<int,double>")
    assert fixed_forest().transform(sparse).first()["score"] == a["score"]


def test_streaming_scores(spark, tmp_path):
    from grove.queries.models import fixed_forest
    from grove.streaming.score import score_stream, write_scores_stream

    rows = spark.createDataFrame([([30.0, 0.1, 0.1],)] * 5, "features array<double>")
    rows.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    query = write_scores_stream(score_stream(stream, fixed_forest()), str(tmp_path / "out"), str(tmp_path / "state"))
    query.processAllAvailable()
    query.stop()
    assert [r["score"] for r in spark.read.parquet(str(tmp_path / "out")).collect()] == [1.625] * 5
    with pytest.raises(ValueError):
        score_stream(rows, fixed_forest())


def test_estimators(spark):
    from pyspark.ml.linalg import Vectors

    from grove.plans.estimator import ForestClassifier, ForestRegressor

    rng = np.random.default_rng(2)
    x = rng.uniform(0, 1, (120, 2)).round(2)
    rows = [(Vectors.dense(v), float(v[0] * 3), "yes" if v[1] > 0.5 else "no") for v in x]
    df = spark.createDataFrame(rows, ["features", "y", "name"])
    options = {"max_leaf": 6, "opt_interval": 6, "min_samples_leaf": 5}
    out = ForestRegressor(labelCol="y", options=options).fit(df).transform(df)
    error = out.agg(F.avg(F.expr("(prediction - y) * (prediction - y)"))).first()[0]
    assert error < 0.3
    model = ForestClassifier(labelCol="name", options={**options, "n_iter": 2}).fit(df)
    scored = model.transform(df)
    assert scored.filter("prediction = name").count() > 105
    assert scored.filter("abs(probability[0] + probability[1] - 1) > 1e-9").count() == 0


def test_fine_bins_in_ordered_buckets(spark, monkeypatch):
    """Midpoints of every distinct value, also when each feature is cut into many ordered buckets; counted before collecting."""
    values = [v * 0.5 for v in range(-40, 41)] + [3.0, 3.0, 1e300]
    t = table_of(spark, values, list(range(len(values))))
    whole = B.fit_fine_bins(t)
    parts = B.fit_fine_bins(t, target_rows=4)
    distinct = sorted(set(values))
    want = [(a + b) / 2 for a, b in zip(distinct, distinct[1:])]
    assert whole.boundaries[0].tolist() == parts.boundaries[0].tolist() == want
    assert len(B.fit_fine_bins(table_of(spark, [7.0] * 5)).boundaries[0]) == 0
    monkeypatch.setattr(B, "MAX_BOUNDARIES", 10)
    with pytest.raises(ValueError, match="boundaries"):
        B.fit_fine_bins(t)
