"""Early stopping, tree blocks, parameter mapping, dealt folds, concurrent and resumable trials."""

import pytest
from pyspark.sql import functions as F

from tabforge.operators import boost, explain, folds, search, spaces
from tabforge.plans import views as V

SF = "/root/testdata/sf0.001"
FEATS = V.FEATURES


@pytest.fixture(scope="module")
def sig(spark):
    return V.sig(spark, SF).withColumn("rid", F.monotonically_increasing_id()).cache()


def test_training_ends_when_held_out_rows_get_worse(spark, sig):
    """Rows that peak early end the training; the trees before that are the full run's first."""
    held = F.col("rid") % 3 == 0
    params = {"n_estimators": 40, "max_depth": 6, "learning_rate": 0.5, "seed": 1}
    short = boost.train_boosted(sig, FEATS, "label", params, validation=held)
    full = boost.train_boosted(sig.where(~held), FEATS, "label", params)
    assert full.getNumTrees == 40 and short.getNumTrees < 40
    a = boost.staged_f1(spark, short, sig.where(held), FEATS, "label").orderBy("round").collect()
    b = boost.staged_f1(spark, full, sig.where(held), FEATS, "label").orderBy("round").collect()
    assert [r["f1"] for r in a] == pytest.approx([r["f1"] for r in b[:len(a)]], abs=0.02)


def test_cross_validation_stops_each_fold(spark, sig):
    params = {"max_depth": 6, "learning_rate": 0.5, "seed": 1}
    s, curve = boost.cross_validate(sig, FEATS, "label", params, k=3, rounds=30, early_stopping=10)
    assert all(n < 30 for n in s["fold_rounds"]) and curve.count() == max(s["fold_rounds"])
    assert 1 <= s["n_estimators"] <= max(s["fold_rounds"]) and s["loss"] == pytest.approx(1 - s["test_mean"])
    s, curve = boost.cross_validate(sig, FEATS, "label", params, k=2, rounds=5, early_stopping=None, class_weight=True)
    assert s["fold_rounds"] == [5, 5] and curve.count() == 5


def test_a_stopped_fold_keeps_its_last_score():
    rows = boost.mean_curve([[0.5, 0.7], [0.4, 0.6, 0.8, 0.7]])
    assert [round(m, 6) for m, _ in rows] == [0.45, 0.65, 0.75, 0.7]
    assert boost.early_stop_cut([m for m, _ in rows], 2) == 2


def test_tree_blocks_change_nothing(spark, sig, monkeypatch):
    m = boost.train_boosted(sig, FEATS, "label", {"n_estimators": 5, "max_depth": 4, "seed": 1})
    part = sig.where("rid % 7 = 0")
    def results():
        return [sorted(map(tuple, x.collect())) for x in (
            boost.staged_confusion(spark, m, part, FEATS, "label"), boost.staged_scores(spark, m, part, FEATS, ["rid"], [1, 4]),
            explain.tree_shap(spark, m, part, FEATS, ["rid"]), explain.sampled_shap(spark, m, part, FEATS, ["rid"], samples=2))]
    whole = results()
    monkeypatch.setattr(boost, "TREE_BLOCK", 40)
    assert len(list(boost.forest_blocks(spark, m))) >= 3
    for a, b in zip(whole, results()):
        assert len(a) == len(b)
        for x, y in zip(a, b):
            assert x == pytest.approx(y, abs=1e-9)


def test_gain_is_bounded_by_rows_and_trees_split(spark, sig):
    """The reference's bounds on a summed gain leave trees with splits; nearly every drawn trial trains something."""
    n = sig.count()
    assert boost.spark_params({"gamma": 0.5}, n)[0]["minInfoGain"] == pytest.approx(0.5 / n)
    with pytest.raises(ValueError, match="number of rows"):
        boost.spark_params({"gamma": 0.5})
    trained = 0
    drawn = search.candidates(spark, spaces.space("xgb", "random_search"), 6, 3).collect()
    for c in drawn:
        p = {**search.parse_params(dict(c["params"])), "n_estimators": 2}
        nodes = explain.tree_nodes(spark, boost.train_boosted(sig, FEATS, "label", p))
        trained += nodes.where("left >= 0").count() > 0
    assert trained == len(drawn)


@pytest.mark.parametrize("params", [{"max_depth": 31}, {"max_depth": 0}, {"subsample": 0}, {"subsample": 1.5}, {"colsample_bytree": -1},
                                    {"max_bin": 1}, {"min_data_in_leaf": 0}])
def test_values_out_of_range_are_refused(params):
    with pytest.raises(ValueError, match="outside"):
        boost.spark_params(params, 100)


def test_dealt_folds(spark, sig):
    rows = sig.select("label", "rid").union(spark.createDataFrame([(None, 1), (None, 2)], "label int, rid long")).repartition(7)
    out = folds.deal_folds(rows, "label", 4)
    assert sorted(r["rid"] for r in out.collect()) == sorted(r["rid"] for r in rows.collect())
    by = {}
    for r in out.groupBy("label", "fold").count().collect():
        by.setdefault(r["label"], []).append(r["count"])
    assert all(max(c) - min(c) <= 1 for c in by.values()) and set(by) == {0, 1, None}
    # rows are neither sorted nor shuffled: the only exchange below the broadcast deals the offsets
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    top = plan.split("Window")[0]
    assert "Sort" not in top and "Repartition" not in top
    assert folds.deal_folds(rows.where("false"), "label", 4).count() == 0


def test_trial_written_twice_is_stored_once(spark, tmp_path):
    path = str(tmp_path / "trials")
    row = {"trial_id": 1, "optim_type": "random", "iteration": 0, "params": {"a": "1"}, "u": {}, "loss": 0.5, "variance": 0.0,
           "estimators": 3, "train_time": 1.0}
    search.append_trial(spark, path, row)
    search.append_trial(spark, path, {**row, "loss": 0.25})
    search.append_trials(spark, path, [{**row, "optim_type": "adaptive"}, {**row, "trial_id": 2}])
    want = [("adaptive", 1, 0.5), ("random", 1, 0.25), ("random", 2, 0.5)]
    assert sorted((r["optim_type"], r["trial_id"], r["loss"]) for r in search.read_trials(spark, path).collect()) == want
    search.compact_trials(spark, path)
    assert len(list((tmp_path / "trials").iterdir())) == 1
    search.append_trial(spark, path, {**row, "trial_id": 3})
    search.append_trial(spark, path, {**row, "trial_id": 2})          # also stored in the compacted file
    assert sorted((r["optim_type"], r["trial_id"]) for r in search.read_trials(spark, path).collect()) == [
        ("adaptive", 1), ("random", 1), ("random", 2), ("random", 3)]


def test_searches_resume_and_run_concurrently(spark, sig, tmp_path, monkeypatch):
    asked = []

    def cross_validate(df, features, label, params, **kw):
        asked.append(params["x"])
        if len(asked) == 3 and not resumed:
            raise RuntimeError("lost")
        return {"loss": float(params["x"]), "variance": 0.0, "n_estimators": 1, "train_time": 0.0}, None
    monkeypatch.setattr(boost, "cross_validate", cross_validate)
    space, path, resumed = {"x": search.uniform(0, 1)}, str(tmp_path / "t"), False
    with pytest.raises(RuntimeError, match="lost"):
        search.search(sig, FEATS, "label", space, "random", 6, path=path, parallel=1)
    stored = search.read_trials(spark, path).count()
    resumed = True
    out = search.search(sig, FEATS, "label", space, "random", 6, path=path, parallel=3)
    assert stored == 2 and len(asked) == 3 + 4 and out.count() == 6
    out = search.search(sig, FEATS, "label", space, "adaptive", 9, path=path, parallel=2, n_candidates=200).where("optim_type = 'adaptive'")
    assert sorted(r["trial_id"] for r in out.collect()) == list(range(9))


def test_experiment_from_train_and_test_files(spark, sig, tmp_path):
    from tabforge.plans.experiment import run_experiment
    rows = sig.select(*FEATS, "label")
    rows.where("rid % 3 > 0").write.parquet(str(tmp_path / "train"))
    rows.where("rid % 3 = 0").write.parquet(str(tmp_path / "test"))
    out = run_experiment(spark, None, {"train": str(tmp_path / "train"), "test": str(tmp_path / "test"), "label": "label", "features": FEATS,
                                       "algorithm": "xgb", "optimization": "random_search", "n_trials": 2,
                                       "cv": {"k": 2, "rounds": 2, "early_stopping": 2}}).collect()
    assert {r["mode"] for r in out} == {"train", "test"} and len(out) == 2
