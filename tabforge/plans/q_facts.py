"""Registered queries: what SQL can state of trained and iterative results.

Models, explanations and components have no SQL form, but facts about them do: counts and
means that the data fix, identities that must hold in every row, and the
features that carry the label of the ``sig`` view.  Every query runs its operator whole.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tabforge.operators import boost, explain, profile
from tabforge.operators import select as S
from tabforge.plans import views as V
from tabforge.plans.q_model import BASE_PARAMS, _model, _train_test
from tabforge.plans.registry import register

_F = V.FEATURES
_K = ", ".join(V.KEYS)
_TRAIN = "l_orderkey % 10 < 7"
_TEST = "l_orderkey % 10 >= 7"
_TREES = BASE_PARAMS["n_estimators"]


def _strongest(rows: str, k: int = 2) -> str:
    """SQL: (feature, position, top) where top marks the ``k`` features that correlate most with the label."""
    parts = " UNION ALL ".join(f"SELECT '{f}' AS feature, {i} AS position, ABS(CORR({f}, label)) AS c FROM sig WHERE {rows}" for i, f in enumerate(_F))
    return f"SELECT feature, CAST(position AS INTEGER) AS position, ROW_NUMBER() OVER (ORDER BY c DESC, position) <= {k} AS top FROM ({parts})"


def _top(df, value: str, k: int = 2):
    """The Spark side of ``_strongest``: a handful of features, ranked by ``value``."""
    from pyspark.sql import Window
    return df.withColumn("top", F.row_number().over(Window.orderBy(F.desc(value), "feature")) <= k)


@register("tree_facts", V.with_ctes(V.SIG_SQL) + f"""
SELECT CAST(t.tree AS INTEGER) AS tree, n AS n_rows, TRUE AS covers_add_up, CASE WHEN t.tree = 0 THEN 1e0 ELSE {BASE_PARAMS['learning_rate']!r} END AS weight,
       CASE WHEN t.tree = 0 THEN mean END AS first_mean, CASE WHEN t.tree = 0 THEN spread END AS first_spread
FROM (SELECT COUNT(*) AS n, AVG(2e0 * label - 1) AS mean, VAR_POP(2e0 * label - 1) AS spread FROM sig WHERE {_TRAIN}), range({_TREES}) t(tree)""")
def q_tree_facts(spark, sf_dir):
    """Rows, weight and cover sums of each tree; mean and variance of the label (as +-1) at the first root."""
    nodes = explain.tree_nodes(spark, _model(spark, sf_dir))
    below = nodes.select("tree", F.col("node").alias("child"), F.col("count").alias("rows"))
    sums = (nodes.where("left >= 0").select("tree", "node", "count", F.explode(F.array("left", "right")).alias("child"))
            .join(below, ["tree", "child"]).groupBy("tree", "node", "count").agg(F.sum("rows").alias("rows"))
            .groupBy("tree").agg(F.every(F.col("rows") == F.col("count")).alias("covers_add_up")))
    root = nodes.where("node = 0").join(sums, "tree", "left")
    first = F.col("tree") == 0
    return root.select("tree", F.col("count").cast("bigint").alias("n_rows"), F.coalesce("covers_add_up", F.lit(True)).alias("covers_add_up"), "weight",
                       F.when(first, F.col("prediction")).alias("first_mean"), F.when(first, F.col("impurity")).alias("first_spread"))


@register("class_weight_facts", V.with_ctes(V.SIG_SQL) + f"""
SELECT n AS n_rows, ROUND(ABS(n1 * (n0 * 1e0 / n1) - n0) / (2e0 * n0), 9) AS first_mean
FROM (SELECT COUNT(*) AS n, SUM(CASE WHEN label = 0 THEN 1 ELSE 0 END) AS n0, SUM(label) AS n1 FROM sig WHERE {_TRAIN})""")
def q_class_weight_facts(spark, sf_dir):
    """L3: with class 1 weighted by n0 / n1, the first root's weighted mean label is balanced."""
    train, _ = _train_test(spark, sf_dir)
    nodes = explain.tree_nodes(spark, boost.train_boosted(train, _F, "label", BASE_PARAMS, class_weight=True))
    return (nodes.where("tree = 0 AND node = 0")
            .select(F.col("count").cast("bigint").alias("n_rows"), F.round(F.abs("prediction"), 9).alias("first_mean")))


@register("importance_facts", V.with_ctes(V.SIG_SQL) + f"""
SELECT feature, position, top, TRUE AS totals_agree FROM ({_strongest(_TRAIN)})""")
def q_importance_facts(spark, sf_dir):
    """The features of the largest total gain, and totals that are split counts times means."""
    nodes = explain.tree_nodes(spark, _model(spark, sf_dir))
    kinds = [explain.importance(nodes, _F, k).drop("position") for k in ("weight", "gain", "cover", "total_cover")]
    out = explain.importance(nodes, _F, "total_gain")
    for k in kinds:
        out = out.join(k, "feature")

    def agrees(total, mean):                         # means and totals are rounded to two places
        return F.abs(F.col(total) - F.col("weight") * F.col(mean)) <= 0.005 * (F.col("weight") + 1) + 1e-6
    return _top(out, "total_gain").select("feature", "position", "top",
                                          (agrees("total_gain", "gain") & agrees("total_cover", "cover")).alias("totals_agree"))


@register("shap_additive", V.with_ctes(V.SIG_SQL) + f"""
SELECT {_K}, label, TRUE AS adds_up, TRUE AS gives_score FROM sig WHERE {_TEST}""")
def q_shap_additive(spark, sf_dir):
    """In every row the contributions and the expected value add up to the margin, which gives the score."""
    _, test = _train_test(spark, sf_dir)
    m = _model(spark, sf_dir)
    contrib = explain.tree_shap(spark, m, test, _F, [*V.KEYS, "label", *_F])
    phis = [f"phi_{f}" for f in _F]
    out = boost.score(m, contrib, _F, [*V.KEYS, "label", *phis, "expected_value", "margin"])
    total = sum((F.col(p) for p in phis), F.col("expected_value"))
    return out.select(*V.KEYS, "label", (F.abs(total - F.col("margin")) < 1e-9).alias("adds_up"),
                      (F.abs(1 / (1 + F.exp(-2 * F.col("margin"))) - F.col("score")) < 1e-9).alias("gives_score"))


@register("shap_facts", V.with_ctes(V.SIG_SQL) + f"""
SELECT m.method, feature, position, top FROM ({_strongest(_TEST)}), (VALUES ('sampled'), ('tree')) m(method)""")
def q_shap_facts(spark, sf_dir):
    """The features of the largest mean contributions, by exact and by sampled values."""
    _, test = _train_test(spark, sf_dir)
    m = _model(spark, sf_dir)
    places = F.create_map(*[F.lit(x) for i, f in enumerate(_F) for x in (f, i)])
    out = None
    for method, contrib in (("tree", explain.tree_shap(spark, m, test, _F, V.KEYS)), ("sampled", explain.sampled_shap(spark, m, test, _F, V.KEYS))):
        t = _top(explain.shap_summary(contrib, _F), "mean_abs_shap").select(
            F.lit(method).alias("method"), "feature", places[F.col("feature")].alias("position"), "top")
        out = t if out is None else out.unionByName(t)
    return out


@register("staged_facts", V.with_ctes(V.SIG_SQL) + f"""
SELECT CAST(r.r + 1 AS INTEGER) AS round, n AS n_rows, p AS n_positive, TRUE AS last_is_score
FROM (SELECT COUNT(*) AS n, CAST(SUM(label) AS BIGINT) AS p FROM sig WHERE {_TEST}), range({_TREES}) r(r)""")
def q_staged_facts(spark, sf_dir):
    """Every round's confusion holds all rows; the last round's is that of the final scores."""
    _, test = _train_test(spark, sf_dir)
    m = _model(spark, sf_dir)
    c = boost.staged_confusion(spark, m, test, _F, "label")
    hit, yes = F.col("score") > 0.5, F.col("label") == 1
    final = boost.score(m, test, _F, ["label"]).agg(F.count_if(hit & yes).alias("a"), F.count_if(hit & ~yes).alias("b")).first()
    same = (F.col("tp") == final["a"]) & (F.col("fp") == final["b"])
    return c.select("round", (F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")).alias("n_rows"),
                                F.expr("tp + fn").alias("n_positive"), (same | (F.col("round") < _TREES)).alias("last_is_score"))


@register("select_by_models", V.with_ctes(V.SIG_SQL) + f"""
SELECT m.method, feature, position, top AS selected FROM ({_strongest('TRUE')}), (VALUES ('forest'), ('logistic')) m(method)""")
def q_select_by_models(spark, sf_dir):
    """the two features that a logistic model and a forest select."""
    d = V.sig(spark, sf_dir)
    out = None
    for name, fn in (("logistic", S.select_logistic), ("forest", S.select_forest)):
        t = fn(d, "label", 2, _F).select(F.lit(name).alias("method"), "feature", "position", "selected")
        out = t if out is None else out.unionByName(t)
    return out


_E = V.EMB_FEATURES


@register("pca_facts", V.with_ctes(V.EMB_SQL) + "SELECT " + " + ".join(f"VAR_SAMP({e})" for e in _E) + f""" AS total_variance,
       CAST({len(_E)} AS BIGINT) AS n_components, TRUE AS shares_match, TRUE AS in_order, TRUE AS uncorrelated FROM emb""")
def q_pca_facts(spark, sf_dir):
    """V7, V8: all projections together keep the variance, each has its stated share of it, and no two correlate."""
    d = V.emb(spark, sf_dir)
    names = [f"pc{i + 1}" for i in range(len(_E))]
    proj = profile.pca_project(d, _E, "label", len(_E))
    var = proj.agg(*[F.var_samp(n).alias(n) for n in names]).select(F.posexplode(F.array(*names)).alias("i", "v"))
    joined = profile.pca(d, _E).join(var, F.col("component") == F.col("i") + 1)
    total = var.agg(F.sum("v")).first()[0]
    steps = F.transform(F.sort_array(F.collect_list(F.struct("component", "v"))), lambda x: x["v"])
    corr = profile.correlation(proj, names, "pearson").where("feature_1 <> feature_2").agg(F.every(F.abs("r") < 1e-6)).first()[0]
    return joined.agg(
        F.sum("v").alias("total_variance"), F.count("*").alias("n_components"),
        F.every(F.abs(F.col("explained_pct") / 100 * total - F.col("v")) <= 1e-9 * total).alias("shares_match"),
        F.forall(F.zip_with(F.slice(steps, 1, len(_E) - 1), F.slice(steps, 2, len(_E)), lambda a, b: a >= b - 1e-12), lambda x: x).alias("in_order"),
        F.lit(corr).alias("uncorrelated"))
