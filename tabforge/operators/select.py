"""Feature selection (F1-F9).  Each scorer returns (feature, position, score, selected).

Exact scorers (Pearson, chi-square) are one or two aggregations over the
data; model scorers fit one Spark ML model each on an assembled vector.  Every
result table has one row per feature, so ranking them with a window is a
bounded, schema-sized job.
"""

from __future__ import annotations

import math

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabforge.functions.numeric import col, safe_corr
from tabforge.operators.cells import PART_CELLS
from tabforge.operators.scale import fit_scale, scale_expr

VOTE_COLUMNS = ["Pearson", "Chi-2", "Logistics", "Random Forest", "LightGBM", "Extra_trees"]


def _table(df: DataFrame, features: list[str], scores: list[Column]) -> DataFrame:
    stack = ", ".join(f"'{f.replace(chr(39), chr(39) * 2)}', {i}, `s{i}`"
                      for i, f in enumerate(features))
    return df.agg(*[s.alias(f"s{i}") for i, s in enumerate(scores)]).selectExpr(
        f"stack({len(features)}, {stack}) AS (feature, position, score)")


def top_k(scores: DataFrame, k: int, later_wins_ties: bool = True) -> DataFrame:
    """Selected = among the k highest scores (NULL last)."""
    pos = F.col("position").desc() if later_wins_ties else F.col("position").asc()
    w = Window.orderBy(F.col("score").desc_nulls_last(), pos)
    return scores.withColumn("selected", F.row_number().over(w) <= k)


def above_mean(scores: DataFrame, k: int) -> DataFrame:
    """selected = score >= mean(score) and among the k highest (ties: earlier first)."""
    w = Window.orderBy(F.col("score").desc_nulls_last(), F.col("position").asc())
    return (scores.withColumn("__m", F.avg("score").over(Window.partitionBy()))
            .withColumn("selected", (F.row_number().over(w) <= k) & (F.col("score") >= F.col("__m")))
            .drop("__m"))


def _check_k(k) -> None:
    if not isinstance(k, int):
        raise TypeError(f"the number of features is {k!r}, not a whole number")


def select_pearson(df: DataFrame, label: str, k: int, features: list[str]) -> DataFrame:
    """|r(x, y)|, NaN/NULL -> 0, top k (the later column wins ties)."""
    _check_k(k)
    y = col(label).cast("double")
    scores = _table(df, features, [F.coalesce(F.abs(safe_corr(col(f).cast("double"), y)),
                                              F.lit(0.0)) for f in features])
    return top_k(scores, k)


def minmax_frame(df: DataFrame, features: list[str]) -> DataFrame:
    """Features min-max scaled to (0, 1) with fitted literals (one aggregation)."""
    p = fit_scale(df, features, "minmax", (0, 1))
    return df.select(*[scale_expr(col(c), "minmax", p["stats"][c], (0, 1)).alias(c)
                       if c in features else col(c) for c in df.columns])


def select_chi2(df: DataFrame, label: str, k: int, features: list[str]) -> DataFrame:
    """chi-square of class-wise sums of min-max scaled features.

    O_cj = sum of x_j in class c, E_cj = n_c / n * sum of x_j; score = sum_c (O-E)^2/E.
    A feature summing to 0 scores NULL and ranks last.
    """
    _check_k(k)
    x = minmax_frame(df.select(*[col(f) for f in features], col(label)), features)
    per = x.groupBy(col(label).alias("__c")).agg(
        F.count(F.lit(1)).alias("__nc"), *[F.sum(col(f)).alias(f"o{i}") for i, f in enumerate(features)])
    stack = ", ".join(f"'{f.replace(chr(39), chr(39) * 2)}', {i}, `o{i}`" for i, f in enumerate(features))
    long = per.selectExpr("__c", "__nc", f"stack({len(features)}, {stack}) AS (feature, position, obs)")
    wf = Window.partitionBy("feature")
    t = long.withColumn("__tot", F.sum("obs").over(wf)) \
            .withColumn("__n", F.sum("__nc").over(wf))
    t = t.withColumn("__exp", F.col("__nc") / F.col("__n") * F.col("__tot"))
    term = F.try_divide(F.pow(F.col("obs") - F.col("__exp"), 2), F.col("__exp"))
    scores = t.groupBy("feature", "position").agg(
        F.when(F.max("__tot") > 0, F.sum(term)).alias("score"))
    return top_k(scores, k, later_wins_ties=True)


def _vector(df: DataFrame, features: list[str], label: str, scaled: bool) -> DataFrame:
    from pyspark.ml.feature import VectorAssembler
    src = df.select(*[col(f).cast("double").alias(f) for f in features],
                    col(label).cast("double").alias("__label"))
    if scaled:
        src = minmax_frame(src, features)
    from tabforge.functions.partitioning import spread
    return spread(VectorAssembler(inputCols=features, outputCol="__features").transform(src)
                  .select("__features", "__label")).persist(StorageLevel.MEMORY_AND_DISK)


def _cells(df: DataFrame, features: list[str], label: str) -> dict | None:
    """The rows of ``df`` as weighted cells of binned features, or None where the rows serve as well (``operators.cells``)."""
    from tabforge.operators import cells as C
    n = df.count()
    if n < C.MIN_ROWS:
        return None
    cuts = C.cut_points(df, features, C.BINS, n)
    table = C.cells(df, features, cuts, [col(label).cast("double").alias("__label")])
    size = table.count()
    return {"table": table, "cells": size, "rows": n, "cuts": cuts, "ratio": 1.0} if C.pays(size, n) else None


def _importance_table(spark, features: list[str], values: list[float]) -> DataFrame:
    return spark.createDataFrame([(f, i, float(v)) for i, (f, v) in enumerate(zip(features, values))],
                                 "feature STRING, position INT, score DOUBLE")


def select_logistic(df: DataFrame, label: str, k: int, features: list[str]) -> DataFrame:
    """L2 logistic regression on scaled X (regParam = 1/n, i.e. C = 1); |coef|."""
    from pyspark.ml.classification import LogisticRegression
    _check_k(k)
    v = _vector(df, features, label, scaled=True)
    n = v.count()
    m = LogisticRegression(featuresCol="__features", labelCol="__label", regParam=1.0 / n,
                           elasticNetParam=0.0, standardization=False, maxIter=100).fit(v)
    v.unpersist()
    return above_mean(_importance_table(df.sparkSession, features,
                                        [abs(c) for c in m.coefficients.toArray()]), k)


def select_forest(df: DataFrame, label: str, k: int, features: list[str],
                  num_trees: int = 100, seed: int = 1) -> DataFrame:
    """random-forest impurity importance on raw X.

    Where rows collapse to fewer cells, a tree's bootstrap sample is a Poisson draw from
    each cell's rows, and trees are independent fits, eight at a time.
    """
    from pyspark.ml.classification import RandomForestClassifier
    _check_k(k)
    found = _cells(df, features, label)
    if found:
        return above_mean(_importance_table(df.sparkSession, features, _forest_on_cells(found, len(features), num_trees, seed)), k)
    v = _vector(df, features, label, scaled=False)
    m = RandomForestClassifier(featuresCol="__features", labelCol="__label",
                               numTrees=num_trees, seed=seed).fit(v)
    v.unpersist()
    return above_mean(_importance_table(df.sparkSession, features,
                                        m.featureImportances.toArray()), k)


def _forest_on_cells(c: dict, d: int, num_trees: int, seed: int, parallel: int = 8):
    """Mean impurity importance of ``num_trees`` bootstrapped trees."""
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler

    from tabforge.operators import cells as C
    from tabforge.operators.boost import in_threads, with_drawn
    table = C.dealt(c["table"], c["cells"]).persist(StorageLevel.MEMORY_AND_DISK)
    codes = VectorAssembler(inputCols=C.code_names(d), outputCol="__features")

    def one(t):
        rows = codes.transform(with_drawn(table, None, seed * 1_000_003 + t)).select("__features", "__label", F.col("__k").alias("__weight")).persist()
        try:
            return RandomForestClassifier(featuresCol="__features", labelCol="__label", weightCol="__weight", numTrees=1, bootstrap=False,
                                          featureSubsetStrategy="sqrt" if num_trees > 1 else "all", maxBins=C.all_bins(c["cuts"], c["cells"]),
                                          seed=seed * 1_000_003 + t).fit(rows).featureImportances.toArray()
        finally:
            rows.unpersist()
    try:
        return sum(in_threads([lambda t=t: one(t) for t in range(num_trees)], parallel)) / num_trees
    finally:
        table.unpersist()


def select_boosted(df: DataFrame, label: str, k: int, features: list[str],
                   rounds: int = 500, seed: int = 1) -> DataFrame:
    """boosted trees (lr .05, depth 5, 20 % features per node, 40 rows per leaf, a gain of
    .01 at least, summed over the rows); split-count importance read from the node table."""
    from pyspark.ml.classification import GBTClassifier

    from tabforge.operators.boost import train_cells
    from tabforge.operators.explain import importance, tree_nodes
    _check_k(k)
    found = _cells(df, features, label)
    if found:                                          # split counts are those of the rows
        found["table"] = found["table"].withColumn("__held", F.lit(False))
        m = train_cells(found, len(features), {"n_estimators": rounds, "learning_rate": 0.05, "max_depth": 5, "colsample_bynode": 0.2,
                                               "gamma": 0.01, "min_data_in_leaf": 40, "seed": seed}, False)
        imp = importance(tree_nodes(df.sparkSession, m), features, "weight")
        return above_mean(imp.select("feature", "position", F.col("weight").alias("score")), k)
    v = _vector(df, features, label, scaled=False)
    m = GBTClassifier(featuresCol="__features", labelCol="__label", maxIter=rounds,
                      stepSize=0.05, maxDepth=5, featureSubsetStrategy="0.2",
                      minInfoGain=0.01 / max(1, v.count()), minInstancesPerNode=40, seed=seed).fit(v)
    v.unpersist()
    imp = importance(tree_nodes(df.sparkSession, m), features, "weight")
    return above_mean(imp.select("feature", "position", F.col("weight").alias("score")), k)


#: Random cut points of a feature in a tree of ``select_extra``.
EXTRA_CUTS = 16


def random_cuts(grid: list[float], n: int, seed: int) -> list[float]:
    """``n`` cut points at random quantile levels, between the values of an ascending ``grid`` of quantiles."""
    import numpy as np
    at = np.random.default_rng(seed).uniform(0, len(grid) - 1, n)
    return sorted({float(x) for x in np.interp(at, np.arange(len(grid)), grid)})


def _boxes(data: DataFrame, grids: list[list[float]], seed: int):
    """(cut points of each feature, ``data`` with the bucket of each value): the cuts of one tree."""
    from pyspark.ml.feature import Bucketizer
    inf, d = float("inf"), len(grids)
    cuts = [random_cuts(g, EXTRA_CUTS, seed * d + i) for i, g in enumerate(grids)]
    cut = Bucketizer(splitsArray=[[-inf, *c, inf] for c in cuts], inputCols=[f"__v{i}" for i in range(d)],
                     outputCols=[f"__b{i}" for i in range(d)], handleInvalid="keep")
    return cuts, cut.transform(data)


def extra_tree(data: DataFrame, features: list[str], grids: list[list[float]], depth: int, seed: int, collapse: bool = False):
    """One extremely randomised tree: all rows, its own random cut points, a random feature subset at each node.

    ``collapse``: rows of equal buckets and label are counted first, in one pass, and the tree is
    fitted to the counts; without it, each level of the tree is a pass over the rows.  Returns
    (cut points of each feature, model).
    """
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler
    cuts, boxed = _boxes(data, grids, seed)
    names = [f"__b{i}" for i in range(len(features))]
    forest = RandomForestClassifier(featuresCol="__features", labelCol="__label", numTrees=1, bootstrap=False, maxDepth=depth,
                                    featureSubsetStrategy="sqrt", maxBins=EXTRA_CUTS + 2, seed=seed)
    codes = VectorAssembler(inputCols=names, outputCol="__features")
    if not collapse:
        return cuts, forest.fit(codes.transform(boxed).select("__features", "__label"))
    counted = boxed.groupBy(*names, "__label").agg(F.count(F.lit(1)).cast("double").alias("__weight")).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        n = counted.count()
        forest = forest.setWeightCol("__weight").setMaxBins(max(EXTRA_CUTS + 2, math.isqrt(n) + 1))       # all of them are looked at
        rows = codes.transform(counted).select("__features", "__label", "__weight")
        return cuts, forest.fit(rows.coalesce(max(1, -(-n // PART_CELLS))))
    finally:
        counted.unpersist()


def select_extra(df: DataFrame, label: str, k: int, features: list[str],
                 num_trees: int = 100, seed: int = 1, depth: int = 5, parallel: int = 8) -> DataFrame:
    """extremely randomised trees: mean impurity importance of trees that each choose among cut points of their own.

    A tree sees all rows through cut points at ``EXTRA_CUTS`` random quantile levels of
    each feature and tries a random subset of features at each node.  Trees are
    independent fits, ``parallel`` at a time; equal seeds give equal scores.  Large tables are
    counted by bucket for each tree (``extra_tree``).
    """
    from tabforge.operators import cells as C
    from tabforge.functions.partitioning import spread
    from tabforge.operators.boost import in_threads
    _check_k(k)
    names = [f"__v{i}" for i in range(len(features))]
    data = spread(df.select(*[col(f).cast("double").alias(n) for f, n in zip(features, names)],
                            col(label).cast("double").alias("__label"))).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        grids = data.approxQuantile(names, [i / 100 for i in range(101)], 0.001)
        n = data.count()
        collapse = n >= C.MIN_ROWS and C.pays(_boxes(data, grids, seed * 1_000_003)[1].select(
            *[f"__b{i}" for i in range(len(features))], "__label").distinct().count(), n)
        fits = in_threads([lambda t=t: extra_tree(data, features, grids, depth, seed * 1_000_003 + t, collapse)[1].featureImportances.toArray()
                           for t in range(num_trees)], parallel)
    finally:
        data.unpersist()
    return above_mean(_importance_table(df.sparkSession, features, sum(fits) / num_trees), k)


SELECTORS = {"Pearson": select_pearson, "Chi-2": select_chi2, "Logistics": select_logistic,
             "Random Forest": select_forest, "LightGBM": select_boosted,
             "Extra_trees": select_extra}


def vote(df: DataFrame, label: str, k: int, features: list[str],
         methods: list[str] | None = None, **opts) -> DataFrame:
    """one row per feature, a boolean per method, Total; sorted by Total desc,
    Feature desc; rank from 1; first k rows.  The methods run side by side."""
    from tabforge.operators.boost import in_threads
    _check_k(k)
    methods = methods or VOTE_COLUMNS

    def one(name):
        return SELECTORS[name](df, label, k, features, **opts.get(name, {})).select(
            F.col("feature").alias("Feature"), F.col("selected").alias(name))
    tables = in_threads([lambda name=name: one(name) for name in methods], 3)
    table = tables[0]
    for t in tables[1:]:
        table = table.join(t, "Feature")
    total = sum((F.col(f"`{m}`").cast("int") for m in methods), F.lit(0))
    table = table.withColumn("Total", total)
    w = Window.orderBy(F.col("Total").desc(), F.col("Feature").desc())
    return (table.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
            .select("rank", "Feature", *[F.col(f"`{m}`") for m in methods], "Total"))


def select_features(df: DataFrame, label: str, k: int, features: list[str] | None = None,
                    methods: list[str] | None = None, path: str | None = None, **opts) -> DataFrame:
    """F8: keep the voted features (original order) and the label; optionally write CSV."""
    from tabforge.operators.clean import keep_columns
    features = features or [c for c in df.columns if c != label]
    chosen = [r["Feature"] for r in vote(df, label, k, features, methods, **opts).collect()]
    out = keep_columns(df, chosen, label)
    if path:
        from tabforge.sources.io import write_table
        write_table(out, path, "csv")
    return out
