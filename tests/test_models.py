"""Model invariants on the sig view (sf0.001): node-table margins equal Spark's
raw prediction, SHAP sums to the margin, staged last round equals transform,
folds balanced, probabilities in [0, 1]."""

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tabforge.operators import boost, explain, folds, metrics
from tabforge.plans import views as V

SF = "/root/testdata/sf0.001"
FEATS = V.FEATURES


@pytest.fixture(scope="module")
def fitted(spark):
    d = V.sig(spark, SF)
    train = d.where(F.col("l_orderkey") % 10 < 7)
    test = d.where(F.col("l_orderkey") % 10 >= 7) \
        .withColumn("rid", F.monotonically_increasing_id()).cache()   # keys not unique here
    m = boost.train_boosted(train, FEATS, "label", {"n_estimators": 6, "max_depth": 3, "seed": 1})
    return m, test


def test_margins_and_shap(spark, fitted):
    m, test = fitted
    sh = explain.tree_shap(spark, m, test, FEATS, ["rid"])
    raw = m.transform(boost.assemble(test, FEATS, None, None, keep=["rid"] + FEATS)).select(
        "rid", vector_to_array("rawPrediction")[1].alias("raw"))
    j = sh.join(raw, "rid")
    r = j.select(F.max(F.abs(F.col("margin") - F.col("raw"))).alias("a"),
                 F.max(F.abs(sum(F.col(f"phi_{f}") for f in FEATS) + F.col("expected_value")
                             - F.col("margin"))).alias("b")).first()
    assert r["a"] < 1e-9 and r["b"] < 1e-9


def test_staged_last_round_equals_transform(spark, fitted):
    m, test = fitted
    last = boost.staged_f1(spark, m, test, FEATS, "label").orderBy(F.col("round").desc()).first()
    f1 = metrics.f1_at_half(boost.score(m, test, FEATS, ["label"])).first()[0]
    assert last["f1"] == pytest.approx(f1)
    p = boost.score(m, test, FEATS, ["label"]).agg(F.min("score"), F.max("score")).first()
    assert 0.0 <= p[0] <= p[1] <= 1.0


def test_folds_balanced(spark):
    d = V.clf(spark, SF)
    f = folds.assign_folds(d, "y", 5, [F.col(c).asc() for c in V.KEYS])
    counts = f.groupBy("y", "fold").count().collect()
    by_class = {}
    for r in counts:
        by_class.setdefault(r["y"], []).append(r["count"])
    for cs in by_class.values():
        assert max(cs) - min(cs) <= 1


def test_not_trained_error():
    with pytest.raises(Exception, match="Please train the models"):
        boost.BoostedClassifier(FEATS, "label").test(None)


def test_importance_weight_counts_splits(spark, fitted):
    m, _ = fitted
    nodes = explain.tree_nodes(spark, m)
    imp = explain.importance(nodes, FEATS, "weight")
    n_splits = nodes.where(F.col("left") >= 0).count()
    assert sum(r["weight"] for r in imp.collect()) == n_splits


def test_vectorised_shap_equals_recursive(spark, fitted):
    import numpy as np
    m, test = fitted
    forest = boost.forest_arrays(spark, m)
    X = np.array([[r[f] for f in FEATS] for r in test.select(*FEATS).limit(200).collect()], float)
    tables = [explain.leaf_tables(t) for t in forest["trees"]]
    fast = explain.shap_batch(X, forest["trees"], tables, len(FEATS))
    slow = np.zeros_like(fast)
    for t in forest["trees"]:
        for r in range(len(X)):
            explain.tree_shap_row(X[r], t, slow[r], t["weight"])
    assert np.abs(fast - slow).max() < 1e-12


def test_sig_model_quality(spark):
    """FIXTURES: held-out AUC about 0.854 for 10 rounds, depth 4 on the sig view."""
    sf = "/root/testdata/sf0.01"
    d = V.sig(spark, sf)
    train, test = d.where(F.col("l_orderkey") % 10 < 7), d.where(F.col("l_orderkey") % 10 >= 7)
    m = boost.train_boosted(train, FEATS, "label", {"n_estimators": 10, "max_depth": 4, "seed": 1})
    auc = metrics.roc_auc(boost.score(m, test, FEATS, ["label"])).first()[0]
    assert auc > 0.8


def test_model_queries_run_the_whole_budget(monkeypatch):
    """Searches take the reference's space and its test budget, cross-validation the xgb budget, sampled SHAP the library's draws."""
    import pytest
    from tabforge.operators import boost, explain, search, spaces
    from tabforge.plans import experiment, q_model
    from tabforge.plans import views as V

    class Seen(Exception):
        pass

    def stop(*args, **kw):
        raise Seen(args, kw)

    class Table:
        def select(self, *cols):
            return self

    monkeypatch.setattr(q_model, "_train_test", lambda spark, sf_dir: (None, None))
    monkeypatch.setattr(q_model, "_model", lambda spark, sf_dir: None)
    monkeypatch.setattr(V, "sig", lambda spark, sf_dir: Table())
    for module, name in ((search, "search"), (boost, "cross_validate"), (explain, "sampled_shap"), (experiment, "run_experiment")):
        monkeypatch.setattr(module, name, stop)

    def asked(query):
        with pytest.raises(Seen) as e:
            query(None, "")
        return e.value.args

    budget = spaces.TEST_BUDGET
    cv = {k: budget[k] for k in ("k", "rounds", "early_stopping")}
    for query, optim in ((q_model.q_search_random, "random"), (q_model.q_search_adaptive, "hyperopt"), (q_model.q_fit_best, "random")):
        args, kw = asked(query)
        assert kw["n_trials"] == budget["n_trials"] and kw["cv"] == cv and args[3] is spaces.SPACES["xgb", optim]
    conf = asked(q_model.q_run_experiment)[0][2]
    assert conf["n_trials"] == budget["n_trials"] and conf["cv"] == cv and "space" not in conf
    budget = spaces.BUDGETS["xgb"]
    for query in (q_model.q_cross_validate, q_model.q_cv_custom_metric):
        kw = asked(query)[1]
        assert (kw["k"], kw["rounds"]) == (budget["k"], budget["rounds"])
    args, kw = asked(q_model.q_sampled_shap)
    assert len(args) == 5 and not kw
