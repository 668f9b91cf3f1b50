"""Registered queries: evaluation (E1-E12) on the ``scored`` view."""

from __future__ import annotations

from tabforge.operators import metrics as M
from tabforge.plans import views as V
from tabforge.plans.registry import register

_CURVE = "WITH " + V.SCORED_SQL + """,
g AS (SELECT score, SUM(label) AS pos, COUNT(*) - SUM(label) AS neg FROM scored GROUP BY score),
c AS (SELECT score, pos, neg, SUM(pos) OVER (ORDER BY score DESC) AS tps,
             SUM(neg) OVER (ORDER BY score DESC) AS fps FROM g),
t AS (SELECT SUM(pos) AS P, SUM(neg) AS Q, MAX(score) AS mx FROM g),
cells AS (
  SELECT SUM(CASE WHEN label = 0 AND score <= 0.5 THEN 1 ELSE 0 END) AS tn,
         SUM(CASE WHEN label = 0 AND score > 0.5 THEN 1 ELSE 0 END) AS fp,
         SUM(CASE WHEN label = 1 AND score <= 0.5 THEN 1 ELSE 0 END) AS fn,
         SUM(CASE WHEN label = 1 AND score > 0.5 THEN 1 ELSE 0 END) AS tp FROM scored),
m AS (
  SELECT COALESCE(tp * 1e0 / NULLIF(tp + fp, 0), 0) AS p1, COALESCE(tp * 1e0 / NULLIF(tp + fn, 0), 0) AS r1,
         COALESCE(tn * 1e0 / NULLIF(tn + fn, 0), 0) AS p0, COALESCE(tn * 1e0 / NULLIF(tn + fp, 0), 0) AS r0,
         tp + fn AS s1, tn + fp AS s0, (tp + tn) * 1e0 / (tp + tn + fp + fn) AS acc FROM cells),
m2 AS (
  SELECT *, COALESCE(2 * p1 * r1 / NULLIF(p1 + r1, 0), 0) AS f1,
         COALESCE(2 * p0 * r0 / NULLIF(p0 + r0, 0), 0) AS f0, s0 + s1 AS n FROM m),
rep AS (
  SELECT '0' AS label, p0 AS precision, r0 AS recall, f0 AS f1_score, s0 AS support FROM m2
  UNION ALL SELECT '1', p1, r1, f1, s1 FROM m2
  UNION ALL SELECT 'accuracy', NULL, NULL, acc, n FROM m2
  UNION ALL SELECT 'macro avg', (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, n FROM m2
  UNION ALL SELECT 'weighted avg', (p0 * s0 + p1 * s1) / n, (r0 * s0 + r1 * s1) / n,
                   (f0 * s0 + f1 * s1) / n, n FROM m2),
ranks AS (
  SELECT label, RANK() OVER (ORDER BY score) + (COUNT(*) OVER (PARTITION BY score) - 1) / 2e0 AS r
  FROM scored),
auc AS (
  SELECT (SUM(CASE WHEN label = 1 THEN r ELSE 0 END) - P * (P + 1) / 2e0) / (P * Q) AS roc_auc
  FROM ranks, t GROUP BY P, Q),
pr AS (
  SELECT score, tps * 1e0 / (tps + fps) AS prec, tps * 1e0 / P AS rec FROM c, t WHERE tps - pos < P
  UNION ALL SELECT 1e308, 1e0, 0e0),
prauc AS (
  SELECT SUM(a) AS pr_auc FROM (
    SELECT (rec - LAG(rec) OVER (ORDER BY score DESC)) * (prec + LAG(prec) OVER (ORDER BY score DESC))
           / 2 AS a FROM pr))
"""

_CONF = """SELECT a.actual, a.predicted, CAST(COALESCE(b.n, 0) AS BIGINT) AS n
FROM (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) a(actual, predicted)
LEFT JOIN (SELECT label AS actual, CASE WHEN score > 0.5 THEN 1 ELSE 0 END AS predicted,
                  COUNT(*) AS n FROM scored GROUP BY 1, 2) b
  ON a.actual = b.actual AND a.predicted = b.predicted"""

_ROC = """SELECT score AS threshold, (fps * 1e0 / Q) AS fpr,
       (tps * 1e0 / P) AS tpr FROM c, t
UNION ALL SELECT (mx + 1), 0e0, 0e0 FROM t"""


def _scored(spark, sf_dir):
    return V.scored(spark, sf_dir)


@register("classify", "WITH " + V.SCORED_SQL + """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, label, score AS score,
       CASE WHEN score > 0.5 THEN 1 ELSE 0 END AS pred FROM scored""")
def q_classify(spark, sf_dir):
    return M.classify(_scored(spark, sf_dir), 0.5)


@register("confusion", _CURVE + _CONF)
def q_confusion(spark, sf_dir):
    return M.confusion(_scored(spark, sf_dir))


@register("class_report", _CURVE + """
SELECT label, precision AS precision, recall AS recall,
       f1_score AS f1_score, CAST(support AS BIGINT) AS support FROM rep""")
def q_class_report(spark, sf_dir):
    return M.class_report(_scored(spark, sf_dir))


@register("roc_curve", _CURVE + _ROC)
def q_roc_curve(spark, sf_dir):
    return M.roc_curve(_scored(spark, sf_dir))


@register("roc_curve_dropped", _CURVE + """,
d AS (SELECT score, pos, neg, tps, fps, ROW_NUMBER() OVER (ORDER BY score DESC) AS i,
             COUNT(*) OVER () AS nn, LEAD(pos) OVER (ORDER BY score DESC) AS npos,
             LEAD(neg) OVER (ORDER BY score DESC) AS nneg FROM c)
SELECT score AS threshold, (fps * 1e0 / Q) AS fpr, (tps * 1e0 / P) AS tpr
FROM d, t WHERE i = 1 OR i = nn OR npos <> pos OR nneg <> neg
UNION ALL SELECT (mx + 1), 0e0, 0e0 FROM t""")
def q_roc_curve_dropped(spark, sf_dir):
    return M.roc_curve(_scored(spark, sf_dir), drop_intermediate=True)


@register("roc_auc", _CURVE + "SELECT roc_auc AS roc_auc FROM auc")
def q_roc_auc(spark, sf_dir):
    return M.roc_auc(_scored(spark, sf_dir))


@register("pr_curve", _CURVE + """
SELECT score AS threshold, (tps * 1e0 / (tps + fps)) AS precision,
       (tps * 1e0 / P) AS recall FROM c, t WHERE tps - pos < P
UNION ALL SELECT NULL, 1e0, 0e0""")
def q_pr_curve(spark, sf_dir):
    return M.pr_curve(_scored(spark, sf_dir))


@register("pr_auc", _CURVE + "SELECT pr_auc AS pr_auc FROM prauc")
def q_pr_auc(spark, sf_dir):
    return M.pr_auc(_scored(spark, sf_dir))


@register("fpr_fnr", _CURVE + """
SELECT score AS threshold, (fps * 1e0 / Q) AS fpr,
       (1 - tps * 1e0 / P) AS fnr FROM c, t
UNION ALL SELECT (mx + 1), 0e0, 1e0 FROM t""")
def q_fpr_fnr(spark, sf_dir):
    return M.fpr_fnr(_scored(spark, sf_dir))


@register("no_skill", "WITH " + V.SCORED_SQL + " SELECT AVG(label * 1e0) AS no_skill FROM scored")
def q_no_skill(spark, sf_dir):
    return M.no_skill(_scored(spark, sf_dir))


@register("log_loss", "WITH " + V.SCORED_SQL + """
SELECT (AVG(-(label * LN(LEAST(GREATEST(score, 1e-15), 1 - 1e-15))
                 + (1 - label) * LN(1 - LEAST(GREATEST(score, 1e-15), 1 - 1e-15))))) AS log_loss
FROM scored""")
def q_log_loss(spark, sf_dir):
    return M.log_loss(_scored(spark, sf_dir))


@register("f1_at_half", _CURVE + """
SELECT (COALESCE(2e0 * tp / NULLIF(2 * tp + fp + fn, 0), 0)) AS f1 FROM cells""")
def q_f1_at_half(spark, sf_dir):
    return M.f1_at_half(_scored(spark, sf_dir))


@register("evaluate", _CURVE + """,
conf AS (""" + _CONF + """),
ev AS (
  SELECT 'confusion_' || CAST(actual AS VARCHAR) || '_' || CAST(predicted AS VARCHAR) AS metric,
         n * 1e0 AS value FROM conf
  UNION ALL SELECT 'precision_' || label, precision FROM rep WHERE precision IS NOT NULL
  UNION ALL SELECT 'recall_' || label, recall FROM rep WHERE recall IS NOT NULL
  UNION ALL SELECT 'f1_' || label, f1_score FROM rep
  UNION ALL SELECT 'support_' || label, support * 1e0 FROM rep
  UNION ALL SELECT 'roc_auc', roc_auc FROM auc
  UNION ALL SELECT 'pr_auc', pr_auc FROM prauc
  UNION ALL SELECT 'log_loss', AVG(-(label * LN(LEAST(GREATEST(score, 1e-15), 1 - 1e-15))
                 + (1 - label) * LN(1 - LEAST(GREATEST(score, 1e-15), 1 - 1e-15)))) FROM scored)
SELECT 'price' AS algo, 'test' AS mode, metric, value AS value FROM ev""")
def q_evaluate(spark, sf_dir):
    return M.evaluate(_scored(spark, sf_dir), algo="price", mode="test")


@register("fpr_fnr_dropped", _CURVE + """,
d AS (SELECT score, pos, neg, tps, fps, ROW_NUMBER() OVER (ORDER BY score DESC) AS i,
             COUNT(*) OVER () AS nn, LEAD(pos) OVER (ORDER BY score DESC) AS npos,
             LEAD(neg) OVER (ORDER BY score DESC) AS nneg FROM c)
SELECT score AS threshold, (fps * 1e0 / Q) AS fpr, (1 - tps * 1e0 / P) AS fnr
FROM d, t WHERE i = 1 OR i = nn OR npos <> pos OR nneg <> neg
UNION ALL SELECT (mx + 1), 0e0, 1e0 FROM t""")
def q_fpr_fnr_dropped(spark, sf_dir):
    """E8 on the ROC points the common library keeps by default (collinear points dropped)."""
    return M.fpr_fnr(_scored(spark, sf_dir), drop_intermediate=True)
