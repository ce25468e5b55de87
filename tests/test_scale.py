"""Work per task follows the data, not the number of shuffle partitions: tables of a few rows with small bounds."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from grove.operators import binning as B
from grove.operators import splits
from grove.operators.folds import drawn, folds
from grove.plans import leafwise
from grove.plans import rows as rows_of_run
from grove.plans.binned import BinnedParams
from grove.plans.fit import fit_forest
from grove.plans.leafwise import LeafwiseParams
from grove.plans.validate import cross_validate
from grove.queries import inputs
from grove.sources import text


@pytest.fixture(scope="module")
def documents(spark, tmp_path_factory):
    """60 documents of 1 to 20 words, one without text, and their labels but for every third."""
    path = str(tmp_path_factory.mktemp("documents"))
    docs = spark.range(60).selectExpr("id AS doc_id", "IF(id = 7, NULL, array_join(transform(sequence(0, id % 20), i -> concat('w', (id * i) % 31)), ' ')) AS text")
    docs.write.parquet(f"{path}/documents.parquet")
    docs.where("doc_id % 3 > 0").selectExpr("doc_id", "doc_id % 2 AS quality").write.parquet(f"{path}/labels.parquet")
    return path


@pytest.mark.parametrize("labelled", [False, True])
def test_tasks_that_count_tokens_follow_the_text(spark, documents, monkeypatch, labelled):
    plain = sorted(map(tuple, inputs.document_cells(spark, documents, labelled).collect()))
    monkeypatch.setattr(inputs, "TASK_TEXT", 100)
    cells = inputs.document_cells(spark, documents, labelled)
    assert sorted(map(tuple, cells.collect())) == plain and len(plain) > 200
    assert cells.rdd.getNumPartitions() >= 10  # the session has 4 shuffle partitions
    assert inputs.document_table(spark, documents).rdd.getNumPartitions() >= 10
    features = {r[0] for r in inputs.document_cells(spark, documents, labelled=False).select("feature").collect()}
    found = [r[0] for r in inputs.document_features(spark, documents).collect()]
    assert sorted(found) == sorted(features)


@pytest.mark.parametrize("fmt", ["header", "y.sparse"])
def test_ranges_of_lines_follow_their_bytes(spark, documents, monkeypatch, fmt):
    monkeypatch.setattr(text, "RANGE_BYTES", 200)
    table = inputs.document_table(spark, documents)
    path = inputs.scratch(spark)
    text.write_table(table, path, fmt, n_features=1 << 28)
    assert spark.read.text(path).select(F.input_file_name()).distinct().count() >= 5
    back = text.read_sparse(spark, path)[0] if fmt == "header" else text.read_labeled(spark, path, fmt)
    want = [r["features"] for r in table.orderBy("row_id").collect()]
    assert [r["features"] for r in back.orderBy("row_id").collect()] == want


@pytest.mark.parametrize("bits", [1, 3, 16])
@pytest.mark.parametrize("ratio", [0.0, 0.1, 0.5, 1.0])
def test_share_of_features_without_a_whole_sort(spark, monkeypatch, bits, ratio):
    monkeypatch.setattr(splits, "SLOT_BITS", bits)
    features = spark.range(200).selectExpr("int(id * 37) AS feature")
    want = features.orderBy(drawn("feature", 5), "feature").limit(max(1, int(200 * ratio)))
    assert sorted(splits.sample_features(features, ratio, 5).collect()) == sorted(want.collect())
    assert splits.sample_features(features.limit(0), ratio, 5).count() == 0


@pytest.mark.parametrize("limit", [0, 1000])
def test_cells_of_one_feature_spread_over_tasks(spark, monkeypatch, limit):
    """Few features: cells stay where they are, or meet copies of the bins; never one task for each feature."""
    monkeypatch.setattr(B, "BROADCAST_BINS", limit)
    bins = B.BinSet({0: np.array([1.5, 3.5]), 1: np.array([0.0])}).to_df(spark)
    cells = spark.range(400, numPartitions=4).selectExpr("id", "int(id % 2) AS feature", "double(id % 7 - 1) AS value")
    placed = B.apply_bins_long(cells, bins)
    want = sorted((r["id"], r["feature"], r["value"], int(np.searchsorted([[1.5, 3.5], [0.0]][r["feature"]], r["value"]))) for r in cells.collect())
    assert sorted((r["id"], r["feature"], r["value"], r["bin"]) for r in placed.collect()) == want
    assert set(placed.columns) == {"id", "feature", "value", "bin"}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert placed.select("id", F.spark_partition_id().alias("p")).groupBy("p").count().count() > 2
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_rounds_of_cuts_do_not_shuffle_the_values(spark, monkeypatch):
    """Greedy bins of two features by rounds equal those cut in one task, and a round's search has no window."""
    rng = np.random.default_rng(3)
    rows = [([float(x), float(z)], float(y), 1.0) for x, z, y in zip(rng.normal(size=400).round(2), rng.integers(0, 90, 400), rng.normal(size=400))]
    table = spark.createDataFrame(rows, "features array<double>, label double, weight double")
    seen, plain = [], B._best_in_buckets
    monkeypatch.setattr(B, "_best_in_buckets", lambda *a: seen.append(plain(*a)) or seen[-1])
    by_rounds = B.fit_bins(table, 9, local_values=10, target_rows=50)
    local = B.fit_bins(table, 9)
    for f in (0, 1):
        np.testing.assert_allclose(by_rounds.boundaries[f], local.boundaries[f])
        assert abs(by_rounds.gains[f] - local.gains[f]) < 1e-9 * local.gains[f]
    assert seen and all("Window" not in x._jdf.queryExecution().executedPlan().toString() for x in seen)


def test_relayout_builds_one_map(spark):
    df = spark.sql("SELECT array(0, 2, 1) AS a, map(0, 3, 4, 0) AS b, map(1, 5) AS c")
    sparse = B.relayout(df, "sparse", "a", ["b", "c"], [3, 70, 2])
    assert sparse.first()["bins"] == {1: 2, 2: 1, 3: 3, 74: 5}
    assert B.relayout(df, "dense", "a", ["b", "c"], [3, 70, 2]).first()["bins"] == [0, 2, 1, 3] + [0] * 70 + [5]
    plan = sparse._jdf.queryExecution().analyzed().toString()
    assert plan.count("map_from_entries") == 1 and "map_concat" not in plan


def test_bins_of_cells_stay_out_of_the_generated_loop(spark):
    """Many cuts in one generated method are never compiled by the JVM, so they are looked up in a function of their own."""
    edges = {0: np.arange(60) + 0.5, 2: np.array([0.5])}
    df = spark.range(70).selectExpr("array(double(id), 1D, IF(id = 3, NULL, double(id))) AS features")
    column = B.dense_bins(B.BinSet(edges))
    got = df.select("features", column.alias("bins")).collect()
    want = [[min(i, 60), 0, 1 if i > 0 else 0] for i in range(70)]  # a null is no less than any cut
    assert [r["bins"] for r in got] == want
    plan = df.select(F.posexplode(column))._jdf.queryExecution().optimizedPlan().toString()
    assert "lambdafunction" in plan and "lambdafunction" not in df.select(B.dense_bins(B.BinSet({0: edges[2]})))._jdf.queryExecution().optimizedPlan().toString()


def test_partitions_of_maps_follow_their_cells(spark, monkeypatch):
    monkeypatch.setattr(rows_of_run, "BATCH_CELLS", 50)
    table = spark.range(100).selectExpr("map_from_entries(transform(sequence(0, 19), i -> struct(int(i), double(id % (i + 2))))) AS features", "double(id) AS label", "1D AS weight")
    bins = B.fit_sparse_bins(table)
    got = rows_of_run.binned_rows(table, bins, 100)
    assert got.rdd.getNumPartitions() == 40
    assert sorted(map(str, got.select("label", "bins").collect())) == sorted(map(str, B.apply_bins(table, bins).select("label", "bins").collect()))


def many_values(spark):
    """Four hundred rows: a feature of some 300 values, one of 9, one of some 250."""
    rng = np.random.default_rng(11)
    x, z, v = rng.integers(0, 700, 400), rng.integers(0, 9, 400), rng.normal(size=400).round(2)
    rows = [([float(a), float(b), float(c)], float(a % 50 + 3 * b + 20 * c), float(1 + i % 3), i) for i, (a, b, c) in enumerate(zip(x, z, v))]
    return spark.createDataFrame(rows, "features array<double>, label double, weight double, row_id int")


def few_on_the_driver(monkeypatch):
    """Features of more than 40 boundaries stay in tables; windows run over 30 bins."""
    monkeypatch.setattr(B, "KEPT_BOUNDARIES", 40, raising=False)
    monkeypatch.setattr(rows_of_run, "DRIVER_BINS", 41, raising=False)
    for module in (splits, leafwise):
        monkeypatch.setattr(module, "RANGE_BINS", 30, raising=False)


def test_cross_validation_leaves_the_bins_of_many_values_off_the_driver(spark, monkeypatch):
    """The same metrics as with all boundaries and histograms on the driver, which gets few rows at a time."""
    table = folds(many_values(spark), 2, "row_id")
    params = LeafwiseParams(max_leaf=4, opt_interval=2, test_interval=2, min_samples_leaf=20)
    want = cross_validate(table, params).orderBy("seq").collect()
    few_on_the_driver(monkeypatch)
    got, kind = [], type(table)
    for name in ("collect", "toPandas", "toArrow"):
        plain = getattr(kind, name)
        monkeypatch.setattr(kind, name, lambda self, plain=plain: got.append(plain(self)) or got[-1])
    found = cross_validate(table, params).orderBy("seq").collect()
    assert max(map(len, got)) <= 100
    assert len(found) == len(want) == 2
    for a, b in zip(found, want):
        np.testing.assert_allclose(list(a), list(b), rtol=1e-9)


@pytest.mark.parametrize("params", [
    LeafwiseParams(max_leaf=4, min_samples_leaf=5), BinnedParams(n_estimators=1, max_leaf=3, min_samples_leaf=5, l2=1.0),
])
def test_forests_of_bins_in_tables(spark, monkeypatch, params):
    """Boundaries in tables give the forest that arrays give, and one trained on from it."""
    table = many_values(spark).drop("row_id")
    longer = {"max_leaf": 6} if isinstance(params, LeafwiseParams) else {"n_estimators": 2}

    def run():
        bins = B.fit_fine_bins(table)
        first = fit_forest(table, params, bins=bins).forest
        second = fit_forest(table, type(params)(**vars(params) | longer), bins=bins, init_model=first).forest
        return bins, [(n.feature, n.cut, n.n, round(n.weight, 8)) for f in (first, second) for t in f.trees for n in t.nodes]

    plain, want = run()
    few_on_the_driver(monkeypatch)
    bins, found = run()
    assert [isinstance(bins.boundaries[f], B.KeptBoundaries) for f in range(3)] == [True, False, True] and len(want) > 10
    assert found == want
    for f in range(3):
        assert len(bins.boundaries[f]) == len(plain.boundaries[f]) and np.asarray(bins.boundaries[f]).tolist() == plain.boundaries[f].tolist()
    assert sorted(bins.to_df(spark).drop("gain").collect()) == sorted(plain.to_df(spark).drop("gain").collect())


def test_bins_in_tables_place_any_value(spark, monkeypatch):
    """Values that were not there when bins were made, nulls, repeated rows and neighbours whose middle is one of them."""
    near = [1.0]
    for _ in range(6):
        near.append(float(np.nextafter(near[-1], 2)))
    table = spark.createDataFrame([([x, x], 1.0, 1.0) for x in [*near, *map(float, range(-40, 40)), 0.0, -0.0, 7.0, 7.0]], "features array<double>, label double, weight double")
    other = spark.createDataFrame([([x, x],) for x in [-1e300, 1e300, 0.25, 0.5, 0.75, None, -0.0, 3.0, 3.0, *near]], "features array<double>")
    plain = B.fit_fine_bins(table)
    want = [sorted(map(str, B.apply_bins(t, plain).collect())) for t in (table, other)]
    monkeypatch.setattr(B, "KEPT_BOUNDARIES", 10)
    kept = B.fit_fine_bins(table, target_rows=20)
    assert len(kept.kept) == 2
    assert [sorted(map(str, B.apply_bins(t, kept).collect())) for t in (table, other)] == want
    places = range(len(kept.boundaries[1]))
    assert kept.cut_values((1, i) for i in places) == {(1, i): float(plain.boundaries[1][i]) for i in places}


@pytest.mark.parametrize("rows", [0, 4])
def test_cuts_by_ranges_of_bins(spark, monkeypatch, rows):
    """Running sums of ranges of bins equal those of one window over a node's feature."""
    hist = spark.range(120).selectExpr("int(id % 2) AS node", "int(id % 3) AS feature", "int(id) AS bin", "double(id % 7) - 3 AS g", "double(id % 5) + 1 AS h", "1 + id % 4 AS n")
    want = sorted(splits.split_candidates(hist, rows, 0.1).collect())
    monkeypatch.setattr(splits, "RANGE_BINS", 7)
    found = splits.split_candidates(hist, rows, 0.1, n_bins=120)
    assert sorted(found.collect()) == want and len(want) > 50 and set(found.columns) == {c for c in splits.split_candidates(hist).columns}
