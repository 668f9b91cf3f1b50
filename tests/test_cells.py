"""Training on weighted cells equals training on rows; SHAP tables, ranks and inversions equal the plain ways."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabforge.operators import boost, explain, profile, select
from tabforge.operators import cells as C

FEATS = ["a", "b", "c"]


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(3)
    a, b, c = rng.integers(0, 40, 4000), rng.normal(size=4000).round(2), rng.integers(0, 5, 4000)
    y = ((a * (c + 1) > 60) ^ (rng.random(4000) < 0.1)).astype(int)
    out = spark.createDataFrame([(float(p), float(q), float(r), int(s)) for p, q, r, s in zip(a, b, c, y)], "a double, b double, c double, label int")
    return boost.fold_table(out, FEATS, "label", 2)


@pytest.fixture
def collapsed(monkeypatch):
    def use():
        monkeypatch.setattr(C, "MIN_ROWS", 0)
        monkeypatch.setattr(C, "pays", lambda cells, n: True)
    return use


def _accuracy(label, score):
    return F.avg(((score > 0.5).cast("int") == label.cast("int")).cast("double"))


@pytest.mark.parametrize("opts", [{}, {"class_weight": True}, {"early_stopping": None, "metric": _accuracy}])
def test_cross_validation_on_cells_equals_rows(rows, collapsed, monkeypatch, opts):
    params = {"max_depth": 3, "learning_rate": 0.3, "seed": 5, "colsample_bytree": 0.7, "gamma": 0.5, "min_child_weight": 3}
    run = lambda: [tuple(r) for r in boost.cross_validate(rows, FEATS, "label", params, **{"k": 2, "rounds": 4, "early_stopping": 2, "folds": "fold", **opts})[1].orderBy("round").collect()]
    want = run()
    seen, train = [], boost.train_cells
    monkeypatch.setattr(boost, "train_cells", lambda c, *a: seen.append(c["cells"]) or train(c, *a))
    collapsed()
    assert np.allclose(run(), want, atol=1e-9)
    assert len(seen) == 2 and max(seen) < 4000          # fewer cells than rows were trained on


def test_drawn_rows_of_cells(spark, rows, collapsed):
    collapsed()
    found = C.FoldCells(rows, FEATS, "label").of(0, 32)
    assert found["table"].agg(F.sum("__n")).first()[0] == rows.count()
    half = boost.with_drawn(found["table"], 0.5, 1).agg(F.sum("__k"), F.every(F.col("__k") <= F.col("__n"))).first()
    assert abs(half[0] - 2000) < 200 and half[1]
    again = boost.with_drawn(found["table"], None, 1).agg(F.sum("__k")).first()[0]
    assert abs(again - 4000) < 300
    model = boost.train_cells(found, 3, {"n_estimators": 4, "learning_rate": 0.3, "max_depth": 3, "subsample": 0.6, "seed": 1}, False)
    f1 = [r["f1"] for r in boost.staged_f1(spark, model, found["table"], C.code_names(3), "__label", "__n").orderBy("round").collect()]
    assert len(f1) == 4 and f1[-1] > 0.8


def test_selectors_on_cells(rows, collapsed):
    d = rows.drop("fold")
    run = lambda: ([tuple(r) for r in select.select_boosted(d, "label", 2, FEATS, rounds=5).orderBy("position").collect()],
                   [tuple(r) for r in select.select_extra(d, "label", 2, FEATS, num_trees=3).orderBy("position").collect()])
    forest = lambda: {r["feature"] for r in select.select_forest(d, "label", 2, FEATS, num_trees=12).where("selected").collect()}
    want, chosen = run(), forest()
    collapsed()
    boosted, extra = run()
    assert boosted == want[0] and forest() == chosen
    assert np.allclose([r[2] for r in extra], [r[2] for r in want[1]], atol=1e-9)


def test_sampled_shap_by_table(spark, rows, monkeypatch):
    model = boost.train_boosted(rows, FEATS, "label", {"n_estimators": 4, "max_depth": 3, "seed": 1})
    few = rows.withColumn("id", F.monotonically_increasing_id()).limit(300)
    run = lambda: sorted(map(tuple, explain.sampled_shap(spark, model, few, FEATS, ["id"], samples=3).collect()))
    fast = run()
    assert explain.margin_table(boost.forest_arrays(spark, model)["trees"], 3) is not None
    monkeypatch.setattr(explain, "MARGIN_CELLS", 0)
    assert run() == fast


def test_spearman_moves_no_row_for_columns_with_few_values(spark):
    d = spark.range(2000).select((F.col("id") % 7).cast("double").alias("x"), F.when(F.col("id") % 5 > 0, F.col("id") % 3).cast("double").alias("y"))
    ranked = profile.rank_columns(d, ["x", "y"])
    plan = ranked._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "Exchange hashpartitioning" not in plan
    want = d.toPandas().rank()
    got = ranked.toPandas()
    for c in ("x", "y"):
        assert np.allclose(np.sort(got[c].dropna()), np.sort(want[c].dropna())) and got[c].isna().sum() == want[c].isna().sum()


@pytest.mark.parametrize("kx,ky", [(50, 7), (900, 9), (3, 900), (900, 900), (1, 5)])
def test_discordant_pairs(kx, ky, monkeypatch):
    rng = np.random.default_rng(kx + ky)
    x, y = np.unique(np.stack([rng.integers(0, kx, 900), rng.integers(0, ky, 900)], 1), axis=0).T.astype(float)
    w = rng.integers(1, 9, len(x)).astype(float)
    want = float(((x[:, None] < x) & (y[:, None] > y)).astype(float).dot(w).dot(w))
    assert profile.discordant(x, y, w) == want
    monkeypatch.setattr(profile, "_FEW", 1)
    assert profile.discordant(x, y, w) == want


@pytest.mark.parametrize("gain,share", [(0.0, 0.0), (0.002, 0.01)])
def test_grown_tree_equals_sparks(spark, gain, share):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import RandomForestRegressor

    from tabforge.operators import grow
    rng = np.random.default_rng(8)
    X = np.unique(np.stack([2 * rng.integers(0, 20, 1500), rng.integers(0, 9, 1500), rng.integers(0, 4, 1500)], 1), axis=0)
    y, w = np.where(X[:, 0] * (X[:, 2] + 1) > 40, 1.0, -1.0) + rng.normal(size=len(X)).round(2), rng.integers(1, 9, len(X)).astype(float)
    tree = grow.grow(X, y, w, w, max_depth=6, min_gain=gain, min_share=share, take=3, rng=rng)
    data = spark.createDataFrame([(*map(float, x), float(t), float(n)) for x, t, n in zip(X, y, w)], "a double, b double, c double, y double, w double")
    data = VectorAssembler(inputCols=["a", "b", "c"], outputCol="f").transform(data).coalesce(1)
    m = RandomForestRegressor(featuresCol="f", labelCol="y", weightCol="w", numTrees=1, bootstrap=False, subsamplingRate=1.0, maxDepth=6, maxBins=64,
                              minInfoGain=gain, minWeightFractionPerNode=share, featureSubsetStrategy="all", seed=1).fit(data)
    want = [r["prediction"] for r in m.transform(data).select("prediction").collect()]
    assert np.allclose(grow.walk(X, tree), want, atol=1e-9)
    assert m.trees[0].numNodes == len(tree["value"]) and tree["cover"][0] == w.sum()
    few, grow_few = grow.HISTOGRAM, lambda: grow.grow(X, y, w, w, max_depth=6, min_gain=gain, min_share=share, take=3, rng=rng)
    try:
        grow.HISTOGRAM = 50                                # nodes in groups
        assert all(np.array_equal(v, tree[k]) for k, v in grow_few().items())
    finally:
        grow.HISTOGRAM = few


def test_drawn_trials_need_no_job_for_each_level(spark, rows, collapsed, monkeypatch):
    """Trees of drawn rows are fitted by one job, equal for equal seeds, and score like those of Spark's jobs by level."""
    from tabforge.operators import grow
    collapsed()
    found = C.FoldCells(rows, FEATS, "label").of(0, 32)
    params = {"n_estimators": 6, "learning_rate": 0.3, "max_depth": 7, "subsample": 0.8, "gamma": 0.5, "min_child_weight": 2, "seed": 4}

    def f1(validate):
        model = boost.train_cells(found, 3, params, validate)
        return model, [r["f1"] for r in boost.staged_f1(spark, model, found["table"].where("__held"), C.code_names(3), "__label", "__n").orderBy("round").collect()]
    spark.sparkContext.setJobGroup("few", "few")
    first = f1(True)
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("few"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert isinstance(first[0], grow.CellTrees) and jobs < 20
    assert f1(True)[1] == first[1]
    whole = f1(False)[1]
    monkeypatch.setattr(grow, "TASK_BYTES", 0)
    slow = f1(False)
    assert not isinstance(slow[0], grow.CellTrees) and len(slow[1]) == len(whole) == 6
    assert np.allclose(slow[1], whole, atol=0.05)


def test_best_trial_refitted_on_cells(spark, rows, collapsed, monkeypatch):
    """The model that is refitted to cells reads values, not codes, and scores like the one of the rows."""
    from tabforge.operators import explain, metrics
    d = rows.drop("fold")
    best = {"params": {"max_depth": 6, "subsample": 0.7, "gamma": 0.5, "colsample_bytree": 0.8, "seed": 3}, "n_estimators": 5}
    auc = lambda m: metrics.roc_auc(boost.score(m, d, FEATS, ["label"])).first()[0]
    want = auc(boost.fit_best(d, FEATS, "label", best, class_weight=True))
    collapsed()
    monkeypatch.setattr(boost, "train_boosted", None)
    model = boost.fit_best(d, FEATS, "label", best, class_weight=True)
    assert model.getNumTrees == 5 and list(model.treeWeights) == [1.0] + [0.05] * 4
    assert abs(auc(model) - want) < 0.02
    root = explain.tree_nodes(spark, model).where("node = 0").agg(F.min("count"), F.max("count"), F.min("gain")).first()
    assert 2600 < root[0] <= root[1] < 3000 and root[2] > 0
    held = C.FoldCells(rows, FEATS, "label").of(0, 32)
    trees = boost.train_cells(held, 3, {"n_estimators": 5, "max_depth": 6, "subsample": 0.7, "seed": 3}, True)
    of_rows, of_cells = [sorted(tuple(r) for r in boost.staged_confusion(spark, m, t, f, y, n).collect()) for m, t, f, y, n in (
        (trees.model(held["cuts"]), rows, FEATS, "label", None), (trees, held["table"], C.code_names(3), "__label", "__n"))]
    assert of_rows == of_cells


def test_experiment_scores_its_rows_once(spark, tmp_path, monkeypatch):
    from tabforge.plans import experiment
    rng = np.random.default_rng(5)
    made = spark.createDataFrame([(float(a), float(b), int((a > 5) ^ (b < 2)), i) for i, (a, b) in enumerate(zip(rng.integers(0, 11, 300), rng.normal(size=300)))],
                                 "a double, b double, label int, id int")
    read, evaluate = [], experiment.metrics.evaluate
    monkeypatch.setattr(experiment.metrics, "evaluate", lambda d, *a: read.append(d._jdf.queryExecution().optimizedPlan().toString()) or evaluate(d, *a))
    out = experiment.run_experiment(spark, made, {"label": "label", "features": ["a", "b"], "split_key": "id", "n_trials": 1,
                                                  "cv": {"k": 2, "rounds": 2, "early_stopping": 2}}).collect()
    assert len(out) == 2 and len(read) == 2
    assert not any(x in p for p in read for x in ("Aggregate", "UDF"))           # neither cleaned nor scored again
