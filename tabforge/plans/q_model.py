"""Registered queries: training, CV, search, evaluation of models, explanations
(L4-L11, H1-H8, X1-X6, E13, the end-to-end experiment).

Model queries train on the ``sig`` view (rows with l_orderkey % 10 < 7) and
score the rest; model outputs have no SQL form and are checked by rows here and
by invariants in ``tests/``.  The trials-table operators (best trial, resume,
summary) run on a decision-threshold search over the ``scored`` view, which
has an exact SQL twin.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tabforge.operators import boost, explain, metrics, search, spaces
from tabforge.plans import views as V
from tabforge.plans.registry import register

_F = V.FEATURES
CV_OPTS = {k: spaces.BUDGETS["xgb"][k] for k in ("k", "rounds", "early_stopping")}
BUDGET = spaces.TEST_BUDGET          # of the searches; the README gives the time of the larger one
SEARCH_CV = {k: BUDGET[k] for k in ("k", "rounds", "early_stopping")}
BASE_PARAMS = {"n_estimators": 10, "max_depth": 4, "learning_rate": 0.3, "seed": 42}


def _train_test(spark, sf_dir):
    d = V.sig(spark, sf_dir)
    return d.where(F.col("l_orderkey") % 10 < 7), d.where(F.col("l_orderkey") % 10 >= 7)


def _model(spark, sf_dir, params=None):
    """Trained anew for each query, so a query's time holds its training."""
    train, _ = _train_test(spark, sf_dir)
    return boost.train_boosted(train, _F, "label", params or BASE_PARAMS)


@register("boost_train")
def q_boost_train(spark, sf_dir):
    _, test = _train_test(spark, sf_dir)
    return boost.score(_model(spark, sf_dir), test, _F, V.KEYS + ["label"])


@register("score")
def q_score(spark, sf_dir):
    train, test = _train_test(spark, sf_dir)
    m = _model(spark, sf_dir)
    return (boost.score(m, train, _F, V.KEYS + ["label"]).withColumn("mode", F.lit("train"))
            .unionByName(boost.score(m, test, _F, V.KEYS + ["label"])
                         .withColumn("mode", F.lit("test"))))


@register("boost_class_weight")
def q_boost_class_weight(spark, sf_dir):
    """L3 + L4: class 1 weighted by n0/n1 during training."""
    train, test = _train_test(spark, sf_dir)
    m = boost.train_boosted(train, _F, "label", BASE_PARAMS, class_weight=True)
    return boost.score(m, test, _F, V.KEYS + ["label"])


@register("staged_f1")
def q_staged_f1(spark, sf_dir):
    _, test = _train_test(spark, sf_dir)
    return boost.staged_f1(spark, _model(spark, sf_dir), test, _F, "label")


@register("cross_validate")
def q_cross_validate(spark, sf_dir):
    train, _ = _train_test(spark, sf_dir)
    _, curve = boost.cross_validate(train, _F, "label", BASE_PARAMS, **CV_OPTS)
    return curve


@register("cv_custom_metric")
def q_cv_custom_metric(spark, sf_dir):
    """A user metric (here: accuracy at 0.5) evaluated per round in CV."""
    train, _ = _train_test(spark, sf_dir)

    def accuracy(label, score):
        return F.avg(((score > 0.5).cast("int") == label.cast("int")).cast("double"))
    _, curve = boost.cross_validate(train, _F, "label", BASE_PARAMS, **{**CV_OPTS, "early_stopping": None},
                                    metric=accuracy)
    return curve


@register("tree_nodes")
def q_tree_nodes(spark, sf_dir):
    return explain.tree_nodes(spark, _model(spark, sf_dir))


for _kind in ("weight", "gain", "cover", "total_gain", "total_cover"):
    def _imp(spark, sf_dir, kind=_kind):
        return explain.importance(explain.tree_nodes(spark, _model(spark, sf_dir)), _F, kind)
    register(f"importance_{_kind}")(_imp)


@register("importance_top")
def q_importance_top(spark, sf_dir):
    return explain.top_importance(explain.tree_nodes(spark, _model(spark, sf_dir)), _F, 10)


@register("tree_shap")
def q_tree_shap(spark, sf_dir):
    _, test = _train_test(spark, sf_dir)
    return explain.tree_shap(spark, _model(spark, sf_dir), test, _F, V.KEYS + ["label"])


@register("sampled_shap")
def q_sampled_shap(spark, sf_dir):
    _, test = _train_test(spark, sf_dir)
    return explain.sampled_shap(spark, _model(spark, sf_dir), test, _F, V.KEYS)


@register("shap_summary")
def q_shap_summary(spark, sf_dir):
    _, test = _train_test(spark, sf_dir)
    contrib = explain.tree_shap(spark, _model(spark, sf_dir), test, _F, V.KEYS)
    return explain.shap_summary(contrib, _F)


# ------------------------------------------------------------------ search
@register("search_random")
def q_search_random(spark, sf_dir):
    train, _ = _train_test(spark, sf_dir)
    t = search.search(train, _F, "label", spaces.space("xgb", "random_search"), "random", n_trials=BUDGET["n_trials"],
                      seed=BUDGET["seed"], cv=SEARCH_CV)
    return t.drop("train_time")


@register("search_adaptive")
def q_search_adaptive(spark, sf_dir):
    train, _ = _train_test(spark, sf_dir)
    t = search.search(train, _F, "label", spaces.space("xgb", "hyperopt"), "adaptive", n_trials=BUDGET["n_trials"],
                      seed=BUDGET["seed"], cv=SEARCH_CV)
    return t.drop("train_time")


@register("fit_best")
def q_fit_best(spark, sf_dir):
    """H6 + L9: best of a random search, refit at learning rate 0.05, test scores."""
    train, test = _train_test(spark, sf_dir)
    t = search.search(train, _F, "label", spaces.space("xgb", "random_search"), "random", n_trials=BUDGET["n_trials"],
                      seed=BUDGET["seed"], cv=SEARCH_CV)
    b = search.best_trial(t).first().asDict(recursive=True)
    best = {"params": search.parse_params(b["params"]), "n_estimators": b["estimators"]}
    m = boost.fit_best(train, _F, "label", best)
    return boost.score(m, test, _F, V.KEYS + ["label"])


# fixed values: decision thresholds tried by the two threshold searches
GRID = [round(0.05 * i, 2) for i in range(1, 20)]
RANDOM = [round((i * 0.6180339887498949) % 1.0, 6) for i in range(1, 20)]


def _threshold_sql(name: str, values: list[float], first_id: int) -> str:
    rows = ", ".join(f"({first_id + i}, {i}, {v!r})" for i, v in enumerate(values))
    return f"""SELECT CAST(th.trial_id AS BIGINT) AS trial_id, '{name}' AS optim_type, CAST(th.iteration AS INTEGER) AS iteration,
       CAST(th.threshold AS DOUBLE) AS threshold,
       1 - COALESCE(2e0 * SUM(CASE WHEN label = 1 AND score > th.threshold THEN 1 ELSE 0 END)
           / NULLIF(2 * SUM(CASE WHEN label = 1 AND score > th.threshold THEN 1 ELSE 0 END)
                    + SUM(CASE WHEN label = 0 AND score > th.threshold THEN 1 ELSE 0 END)
                    + SUM(CASE WHEN label = 1 AND score <= th.threshold THEN 1 ELSE 0 END), 0), 0) AS loss
FROM scored, (VALUES {rows}) th(trial_id, iteration, threshold)
GROUP BY th.trial_id, th.iteration, th.threshold"""


_TRIALS_SQL = V.with_ctes(V.SCORED_SQL, f"trials AS ({_threshold_sql('grid', GRID, 0)} "
                          f"UNION ALL {_threshold_sql('random', RANDOM, 100)})")


@register("trials_log", V.with_ctes(V.SCORED_SQL) + f"SELECT trial_id, optim_type, iteration, loss FROM ({_threshold_sql('grid', GRID, 0)})")
def q_trials_log(spark, sf_dir):
    """H5: trials stored in the trials table, the first ones twice, compacted and read back."""
    path = search.trials_path(spark, "log")
    trials = search.threshold_trials(V.scored(spark, sf_dir), GRID, "grid").collect()            # a row for each threshold
    rows = [{"trial_id": r["trial_id"], "optim_type": r["optim_type"], "iteration": r["iteration"],
             "params": {"threshold": repr(r["threshold"])}, "u": {}, "loss": r["loss"],
             "variance": 0.0, "estimators": 0, "train_time": 0.0} for r in trials]
    search.append_trials(spark, path, rows)
    search.append_trials(spark, path, rows[:3])
    search.compact_trials(spark, path)
    return search.read_trials(spark, path).select("trial_id", "optim_type", "iteration", "loss")


def _threshold_trials(spark, sf_dir):
    s = V.scored(spark, sf_dir)
    return (search.threshold_trials(s, GRID, "grid", 0)
            .unionByName(search.threshold_trials(s, RANDOM, "random", 100)))


@register("best_trial", _TRIALS_SQL + """
SELECT trial_id, optim_type, iteration, threshold AS threshold, loss AS loss
FROM trials ORDER BY loss, iteration, trial_id LIMIT 1""")
def q_best_trial(spark, sf_dir):
    return search.best_trial(_threshold_trials(spark, sf_dir))


@register("summarize_runs", _TRIALS_SQL + """
SELECT optim_type, (arg_min(threshold, (loss, iteration, trial_id))) AS best_params,
       MIN(loss) AS best_loss, CAST(COUNT(*) AS BIGINT) AS n_trials
FROM trials GROUP BY optim_type""")
def q_summarize_runs(spark, sf_dir):
    return search.summarize_runs(_threshold_trials(spark, sf_dir), params_col="threshold")


@register("resume_trials", V.with_ctes(V.SCORED_SQL) + _threshold_sql("grid", GRID, 0))
def q_resume_trials(spark, sf_dir):
    """H7: trials 0-9 are stored; the resumed run evaluates only the pending ones."""
    s = V.scored(spark, sf_dir)
    path = search.trials_path(spark, "resume")
    search.threshold_trials(s, GRID[:10], "grid", 0).write.mode("overwrite").parquet(path)
    done = spark.read.parquet(path)
    cands = spark.range(len(GRID)).select(
        F.col("id").alias("trial_id"), F.round(F.lit(0.05) * (F.col("id") + 1), 2).alias("threshold"))
    todo = search.pending(cands, done).orderBy("trial_id").collect()   # <= candidate count
    if todo:
        first = todo[0]["trial_id"]
        new = search.threshold_trials(s, [r["threshold"] for r in todo], "grid", first) \
            .withColumn("iteration", F.col("trial_id").cast("int"))
        new.write.mode("append").parquet(path)
    return spark.read.parquet(path)


# ------------------------------------------------------------------ comparison, experiment
PROFILES = {
    "lgb": {"n_estimators": 10, "num_leaves": 16, "learning_rate": 0.3, "feature_fraction": 0.8,
            "seed": 992},
    "xgb": {"n_estimators": 10, "max_depth": 4, "eta": 0.3, "subsample": 0.9, "seed": 42},
}


@register("compare_models")
def q_compare_models(spark, sf_dir):
    """E12 + E13: each profile evaluated on train and test, pivoted to one row each."""
    train, test = _train_test(spark, sf_dir)
    res = []
    for algo, p in PROFILES.items():
        m = boost.train_boosted(train, _F, "label", p)
        for mode, part in (("train", train), ("test", test)):
            res.append(metrics.evaluate(boost.score(m, part, _F, ["label"]), algo, mode))
    return metrics.compare(res)


@register("run_experiment")
def q_run_experiment(spark, sf_dir):
    """S3 -> T7 -> L2 -> H3 -> L9 -> L8 -> E12 -> E13 on the sig view."""
    from tabforge.plans.experiment import run_experiment
    conf = {"split_key": "l_orderkey", "label": "label", "features": _F, "labels": [0, 1], "algorithm": "xgb",
            "optimization": "random_search", "n_trials": BUDGET["n_trials"], "cv": SEARCH_CV}
    return run_experiment(spark, V.sig(spark, sf_dir).select(*_F, "label", "l_orderkey"), conf)



@register("doc_quality_eval")
def q_doc_quality_eval(spark, sf_dir):
    """Text primitives on documents joined to labels -> boosted model for the
    (imbalanced) quality target -> held-out evaluation table."""
    from tabforge.operators import synth
    d = V.doc(spark, sf_dir).select("doc_id", "text", "n_chars", "quality")
    fm = synth.synthesize(d, ["num_characters", "num_words"], 1, ["text"],
                          passthrough=["doc_id", "n_chars", "quality"], keep_base=False)
    feats = ["NUM_CHARACTERS(text)", "NUM_WORDS(text)", "n_chars"]
    train = fm.where(F.col("doc_id") % 10 < 7)
    test = fm.where(F.col("doc_id") % 10 >= 7)
    m = boost.train_boosted(train, feats, "quality", {"n_estimators": 10, "max_depth": 3,
                                                       "seed": 7}, class_weight=True)
    scored = boost.score(m, test, feats, ["quality"]).withColumnRenamed("quality", "label")
    return metrics.evaluate(scored, "gbt_text", "test")
