"""Evaluation of binary scores (E1-E13).  Input: a frame with ``label`` (0/1) and ``score``.

Every curve starts from one row per distinct score (map-side combined
aggregate), then a running sum over the score order (``functions.prefix``,
distributed above a size limit).  A curve point's predecessor is fully known
from its own row (cumulative counts minus its own counts), so areas need no
``lag`` over a global window.

Fixed conventions: a score is class 1 when ``score > threshold`` (strict);
ROC starts at (0, 0) with threshold max+1; PR starts at the highest threshold
with full recall and ends at (recall 0, precision 1); 0/0 in a report is 0;
log loss clips p to [1e-15, 1-1e-15]; F1 uses p rounded half to even.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabforge.functions.prefix import running_sum
from tabforge.session import written

EPS = 1e-15


def _lab(label: str) -> Column:
    return F.col(label).cast("long")


def classify(df: DataFrame, threshold: float = 0.5, score: str = "score",
             out: str = "pred") -> DataFrame:
    """1 when score > threshold else 0."""
    return df.withColumn(out, F.when(F.col(score) > F.lit(threshold), 1).otherwise(0))


def _cells(df: DataFrame, label: str, pred: Column) -> DataFrame:
    y = _lab(label)
    return df.agg(
        F.sum(F.when((y == 0) & (pred == 0), 1).otherwise(0)).cast("long").alias("tn"),
        F.sum(F.when((y == 0) & (pred == 1), 1).otherwise(0)).cast("long").alias("fp"),
        F.sum(F.when((y == 1) & (pred == 0), 1).otherwise(0)).cast("long").alias("fn"),
        F.sum(F.when((y == 1) & (pred == 1), 1).otherwise(0)).cast("long").alias("tp"))


def _pred(score: str, threshold: float) -> Column:
    return F.when(F.col(score) > F.lit(threshold), 1).otherwise(0)


def confusion(df: DataFrame, threshold: float = 0.5, label: str = "label",
              score: str = "score") -> DataFrame:
    """(actual, predicted, n) for all four cells, absent cells 0; one pass."""
    return _confusion_from(_cells(df, label, _pred(score, threshold)))


def _confusion_from(c: DataFrame) -> DataFrame:
    return c.selectExpr("stack(4, 0, 0, tn, 0, 1, fp, 1, 0, fn, 1, 1, tp) "
                        "AS (actual, predicted, n)").select(
        F.col("actual").cast("int"), F.col("predicted").cast("int"),
        F.coalesce(F.col("n"), F.lit(0)).cast("long").alias("n"))


def _div(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def class_report(df: DataFrame, threshold: float = 0.5, label: str = "label",
                 score: str = "score") -> DataFrame:
    """Precision, recall, f1_score, support per class, accuracy, macro and weighted avg."""
    return _report_from(_cells(df, label, _pred(score, threshold)))


def _report_from(c: DataFrame) -> DataFrame:
    c = c.na.fill(0)
    tn, fp, fn, tp = (F.col(x) for x in ("tn", "fp", "fn", "tp"))
    p1, r1 = _div(tp, tp + fp), _div(tp, tp + fn)
    p0, r0 = _div(tn, tn + fn), _div(tn, tn + fp)
    s = c.select(p1.alias("p1"), r1.alias("r1"), p0.alias("p0"), r0.alias("r0"),
                 (tp + fn).alias("s1"), (tn + fp).alias("s0"),
                 _div(tp + tn, tp + tn + fp + fn).alias("acc"))
    s = s.withColumn("f1", _div(2 * F.col("p1") * F.col("r1"), F.col("p1") + F.col("r1"))) \
         .withColumn("f0", _div(2 * F.col("p0") * F.col("r0"), F.col("p0") + F.col("r0"))) \
         .withColumn("n", F.col("s0") + F.col("s1"))

    def w(a, b):
        return _div(F.col(a) * F.col("s0") + F.col(b) * F.col("s1"), F.col("n"))

    rows = [
        s.select(F.lit("0").alias("label"), F.col("p0").alias("precision"),
                 F.col("r0").alias("recall"), F.col("f0").alias("f1_score"),
                 F.col("s0").alias("support")),
        s.select(F.lit("1"), "p1", "r1", "f1", "s1"),
        s.select(F.lit("accuracy"), F.lit(None).cast("double"), F.lit(None).cast("double"),
                 "acc", "n"),
        s.select(F.lit("macro avg"), (F.col("p0") + F.col("p1")) / 2,
                 (F.col("r0") + F.col("r1")) / 2, (F.col("f0") + F.col("f1")) / 2, "n"),
        s.select(F.lit("weighted avg"), w("p0", "p1"), w("r0", "r1"), w("f0", "f1"), "n"),
    ]
    out = rows[0]
    for r in rows[1:]:
        out = out.union(r)
    return out.withColumn("support", F.col("support").cast("long"))


# ---------------------------------------------------------------- curves

def score_counts(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """One row per distinct score: (score, pos, neg)."""
    y = _lab(label)
    return (df.groupBy(F.col(score).cast("double").alias("score"))
            .agg(F.sum(y).alias("pos"), F.sum(1 - y).alias("neg")))


def _curve(df: DataFrame, label: str, score: str):
    g = written(score_counts(df, label, score), "curve")
    t = g.agg(F.sum("pos").alias("P"), F.sum("neg").alias("Q"), F.max("score").alias("mx"),
              F.count(F.lit(1)).alias("d")).first()
    cum = running_sum(g, [F.col("score").desc()], ["pos", "neg"])
    cum = cum.withColumnRenamed("cum_pos", "tps").withColumnRenamed("cum_neg", "fps")
    return cum, t


def roc_curve(df: DataFrame, label: str = "label", score: str = "score",
              drop_intermediate: bool = False) -> DataFrame:
    """(threshold, fpr, tpr), one point per distinct score plus (0, 0, max+1).

    ``drop_intermediate=True`` removes points collinear with both neighbours
    (second difference of fps and tps both zero), as the common library default.
    """
    cum, t = _curve(df, label, score)
    P, Q = float(t["P"] or 0), float(t["Q"] or 0)
    pts = cum.select(F.col("score").alias("threshold"),
                     F.try_divide(F.col("fps").cast("double"), F.lit(Q)).alias("fpr"),
                     F.try_divide(F.col("tps").cast("double"), F.lit(P)).alias("tpr"),
                     "pos", "neg", "tps", "fps")
    if drop_intermediate and t["d"] > 2:
        pts = _drop_collinear(pts, t["d"])
    if t["mx"] is None:                       # no rows, no points
        return pts.select("threshold", "fpr", "tpr")
    lead = df.sparkSession.range(1).select(
        F.lit(float(t["mx"]) + 1.0).alias("threshold"), F.lit(0.0).alias("fpr"),
        F.lit(0.0).alias("tpr"))
    return lead.unionByName(pts.select("threshold", "fpr", "tpr"))


def _drop_collinear(pts: DataFrame, d: int) -> DataFrame:
    """Keep first, last, and points whose next step differs from the previous step.

    Step into point i is (pos_i, neg_i); step out of it is point i+1's counts.
    Point index = running count of points; the next point is found with an
    equi-join on index (distributed), not a global ``lead``.
    """
    idx = running_sum(pts.withColumn("one", F.lit(1)), [F.col("threshold").desc()], ["one"]) \
        .withColumnRenamed("cum_one", "i")
    nxt = idx.select((F.col("i") - 1).alias("i"), F.col("pos").alias("npos"),
                     F.col("neg").alias("nneg"))
    j = idx.join(nxt, "i", "left")
    keep = ((F.col("i") == 1) | (F.col("i") == d) | (F.col("npos") != F.col("pos"))
            | (F.col("nneg") != F.col("neg")))
    return j.where(keep).drop("i", "one", "npos", "nneg")


def roc_auc(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """E5: area under the ROC curve (trapezoid = Mann-Whitney with tie halves)."""
    return _roc_auc_from(*_curve(df, label, score))


def _roc_auc_from(cum: DataFrame, t) -> DataFrame:
    P, Q = float(t["P"] or 0), float(t["Q"] or 0)
    # negatives at this score x (positives above it + half the positives at it)
    part = F.col("neg") * (F.col("tps") - F.col("pos") + F.col("pos") / 2.0)
    return cum.agg(F.try_divide(F.sum(part), F.lit(P * Q)).alias("roc_auc"))


def pr_curve(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """(threshold, precision, recall); the end point has a NULL threshold."""
    cum, t = _curve(df, label, score)
    P = float(t["P"] or 0)
    pts = _pr_points(cum, P)
    end = df.sparkSession.range(1).select(F.lit(None).cast("double").alias("threshold"),
                                          F.lit(1.0).alias("precision"),
                                          F.lit(0.0).alias("recall"))
    return pts.select("threshold", "precision", "recall").unionByName(end)


def _pr_points(cum: DataFrame, P: float) -> DataFrame:
    # keep thresholds from the max down to the highest one reaching full recall:
    # that is every point whose predecessor has not reached full recall yet
    prev_tps = F.col("tps") - F.col("pos")
    prev_fps = F.col("fps") - F.col("neg")
    return cum.where(prev_tps < F.lit(P)).select(
        F.col("score").alias("threshold"),
        (F.col("tps") / (F.col("tps") + F.col("fps"))).cast("double").alias("precision"),
        F.try_divide(F.col("tps").cast("double"), F.lit(P)).alias("recall"),
        F.when(prev_tps + prev_fps > 0, prev_tps / (prev_tps + prev_fps))
        .otherwise(F.lit(1.0)).cast("double").alias("prev_precision"),
        F.try_divide(prev_tps.cast("double"), F.lit(P)).alias("prev_recall"))


def pr_auc(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Trapezoid area under the PR curve over recall."""
    return _pr_auc_from(*_curve(df, label, score))


def _pr_auc_from(cum: DataFrame, t) -> DataFrame:
    pts = _pr_points(cum, float(t["P"] or 0))
    area = (F.col("recall") - F.col("prev_recall")) * (F.col("precision")
                                                       + F.col("prev_precision")) / 2.0
    return pts.agg(F.sum(area).alias("pr_auc"))


def fpr_fnr(df: DataFrame, label: str = "label", score: str = "score",
            drop_intermediate: bool = False) -> DataFrame:
    """(threshold, fpr, fnr) along the ROC thresholds."""
    return roc_curve(df, label, score, drop_intermediate).select(
        "threshold", "fpr", (F.lit(1.0) - F.col("tpr")).alias("fnr"))


def no_skill(df: DataFrame, label: str = "label") -> DataFrame:
    """Share of positives (the flat line of a PR plot)."""
    return df.agg(F.avg(_lab(label).cast("double")).alias("no_skill"))


def log_loss_expr(label: str = "label", score: str = "score") -> Column:
    p = F.least(F.greatest(F.col(score).cast("double"), F.lit(EPS)), F.lit(1 - EPS))
    y = _lab(label).cast("double")
    return F.avg(-(y * F.log(p) + (1 - y) * F.log(1 - p)))


def log_loss(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Mean negative log-likelihood."""
    return df.agg(log_loss_expr(label, score).alias("log_loss"))


def f1_expr(label: str = "label", score: str = "score") -> Column:
    """Aggregate F1 with p rounded half to even (0.5 -> class 0)."""
    pred = F.when(F.col(score) > 0.5, 1).otherwise(0)
    y = _lab(label)
    tp = F.sum(F.when((y == 1) & (pred == 1), 1).otherwise(0))
    fp = F.sum(F.when((y == 0) & (pred == 1), 1).otherwise(0))
    fn = F.sum(F.when((y == 1) & (pred == 0), 1).otherwise(0))
    return F.coalesce(F.try_divide((2 * tp).cast("double"), (2 * tp + fp + fn).cast("double")),
                      F.lit(0.0))


def f1_at_half(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """E11 / L11 default metric."""
    return df.agg(f1_expr(label, score).alias("f1"))


def evaluate(df: DataFrame, algo: str = "model", mode: str = "test", threshold: float = 0.5,
             label: str = "label", score: str = "score") -> DataFrame:
    """(algo, mode, metric, value): confusion cells, report, ROC AUC, PR AUC, log loss."""
    df = df.select(F.col(label).alias("label"), F.col(score).alias("score"))
    cells = _cells(df, "label", _pred("score", threshold))             # one row
    conf = _confusion_from(cells).select(
        F.concat(F.lit("confusion_"), F.col("actual").cast("string"), F.lit("_"),
                 F.col("predicted").cast("string")).alias("metric"),
        F.col("n").cast("double").alias("value"))
    rep = _report_from(cells)
    rep_long = rep.selectExpr(
        "stack(4, concat('precision_', label), precision, concat('recall_', label), recall, "
        "concat('f1_', label), f1_score, concat('support_', label), CAST(support AS DOUBLE)) "
        "AS (metric, value)").where(F.col("value").isNotNull())
    cum, t = _curve(df, "label", "score")                                # one curve for both
    auc = _roc_auc_from(cum, t).select(F.lit("roc_auc").alias("metric"),
                                       F.col("roc_auc").alias("value"))
    pra = _pr_auc_from(cum, t).select(F.lit("pr_auc").alias("metric"),
                                      F.col("pr_auc").alias("value"))
    loss = log_loss(df, "label", "score").select(F.lit("log_loss").alias("metric"), F.col("log_loss").alias("value"))
    out = conf.unionByName(rep_long).unionByName(auc).unionByName(pra).unionByName(loss)
    return out.select(F.lit(algo).alias("algo"), F.lit(mode).alias("mode"), "metric", "value")


COMPARED = ("roc_auc", "pr_auc", "f1_1", "f1_0", "precision_1", "recall_1", "log_loss")


def compare(results: list[DataFrame], metrics: list[str] | tuple = COMPARED) -> DataFrame:
    """One row per (algo, mode [, optim]) with one column per metric of ``metrics``."""
    out = results[0]
    for r in results[1:]:
        out = out.unionByName(r, allowMissingColumns=True)
    keys = [c for c in ("algo", "optim", "mode") if c in out.columns]
    metrics = list(metrics)
    return out.where(F.col("metric").isin(metrics)).groupBy(*keys).pivot(
        "metric", metrics).agg(F.first("value"))
