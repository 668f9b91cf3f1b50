"""Boosted trees: training, scoring, per-round scores, cross-validation.

Training is Spark ML's ``GBTClassifier`` (logistic loss, distributed).  The
reference's three engines become parameter *profiles* mapped onto it; knobs
with no Spark counterpart are accepted and recorded in the trial, no more.

Early stopping is Spark ML's own: held-out rows are marked by a validation
column and training ends at the first round that does not lower their log loss
(a patience of one round; the model keeps the rounds up to the best).

Per-round scores (CV curves) come from the model's own node table, in blocks of
trees of at most ``TREE_BLOCK`` nodes: a block is broadcast, each task walks its rows
through its trees with numpy and emits only its confusion counts per round; where
several blocks are needed, the rows' margins are written between them.  margin =
sum of tree weight x leaf value; P(1) = 1 / (1 + exp(-2 margin)), Spark's own link.
"""

from __future__ import annotations

import math
import time
from collections.abc import Iterator

from pyspark import InheritableThread
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabforge.functions.numeric import col
from tabforge.functions.partitioning import spread
from tabforge.operators.explain import dropped, tree_nodes

NOT_TRAINED = "Please train the models using train_models method before testing"

# reference parameter names -> GBTClassifier parameters (fixed mapping)
_ROUNDS = ("n_estimators", "num_boost_round", "iterations", "num_iterations")
_RATE = ("learning_rate", "eta")
_DEPTH = ("max_depth", "depth")
_LEAVES = ("num_leaves", "max_leaves")
_MIN_ROWS = ("min_data_in_leaf", "min_child_samples")
_MIN_GAIN = ("min_gain_to_split", "gamma", "min_split_gain")
_COLS = ("feature_fraction", "colsample_bytree", "colsample_bylevel", "colsample_bynode", "rsm")
_SUBSAMPLE = ("subsample", "bagging_fraction")
_BINS = ("border_count", "max_bin")
_SEED = ("seed", "random_state", "random_seed")


def _first(params: dict, names: tuple):
    for n in names:
        if n in params and params[n] is not None:
            return params[n]
    return None


def _within(name: str, lo: float, hi: float, open_low: bool = False):
    """A conversion that refuses what Spark cannot take, instead of changing it."""
    def conv(v):
        f = float(v)
        if not (lo < f if open_low else lo <= f) or f > hi:
            raise ValueError(f"{name} {v} is outside of what the trainer takes ({lo} to {hi})")
        return f
    return conv


def needs_rows(params: dict | None) -> bool:
    """Whether a parameter is a bound on a sum over rows, which Spark takes for each row."""
    return any((params or {}).get(n) is not None for n in (*_MIN_GAIN, "min_child_weight"))


def spark_params(params: dict | None, n_rows: int | None = None) -> tuple[dict, dict]:
    """(GBTClassifier keyword arguments, recorded-only parameters).

    A minimum gain bounds a gain summed over all rows; Spark's ``minInfoGain`` bounds it
    for each row, so it is divided by ``n_rows`` (as is ``min_child_weight``).  Values
    outside of Spark's range are refused.
    """
    params = dict(params or {})
    if needs_rows(params) and not n_rows:
        raise ValueError("minimum gain and child weight need the number of rows")
    out: dict = {}
    used: set = set()

    def take(names, key, conv):
        v = _first(params, names)
        if v is not None:
            out[key] = conv(v)
            used.update(n for n in names if n in params)

    take(_ROUNDS, "maxIter", int)
    take(_RATE, "stepSize", float)
    take(_DEPTH, "maxDepth", lambda v: int(_within("depth", 1, 30)(v)))
    if "maxDepth" not in out:
        take(_LEAVES, "maxDepth", lambda v: int(_within("depth of that many leaves", 1, 30)(math.ceil(math.log2(max(int(v), 2))))))
    take(_MIN_ROWS, "minInstancesPerNode", lambda v: int(_within("rows of a leaf", 1, 2 ** 31 - 1)(v)))
    take(_MIN_GAIN, "minInfoGain", lambda v: _within("minimum gain", 0, math.inf)(v) / n_rows)
    take(_COLS, "featureSubsetStrategy", lambda v: str(_within("share of features", 0, 1, open_low=True)(v)))
    take(_SUBSAMPLE, "subsamplingRate", _within("share of rows", 0, 1, open_low=True))
    take(_BINS, "maxBins", lambda v: int(_within("bins", 2, 2 ** 31 - 1)(v)))
    take(_SEED, "seed", int)
    if "min_child_weight" in params:
        share = float(params["min_child_weight"]) / n_rows
        if share >= 0.5:
            raise ValueError(f"min_child_weight {params['min_child_weight']} is half of the {n_rows} rows or more: no split is possible")
        out["minWeightFractionPerNode"] = share
        used.add("min_child_weight")
    recorded = {k: v for k, v in params.items() if k not in used}
    return out, recorded


def assemble(df: DataFrame, features: list[str], label: str | None = None,
             weight: str | None = None, keep: list[str] | None = None) -> DataFrame:
    from pyspark.ml.feature import VectorAssembler
    keep = list(keep or [])
    cols = [col(f).cast("double").alias(f) for f in features]
    extra = ([col(label).cast("double").alias("__label")] if label else []) + \
            ([col(weight).cast("double").alias("__weight")] if weight else [])
    src = df.select(*[col(k) for k in keep if k not in features], *cols, *extra)
    return VectorAssembler(inputCols=features, outputCol="__features").transform(src)


def train_boosted(df: DataFrame, features: list[str], label: str, params: dict | None = None,
                  class_weight: bool = False, weight: str | None = None, validation: Column | None = None,
                  n_rows: int | None = None):
    """L4: fit GBTClassifier on (features, label[, weight]); returns the Spark model.

    L5: with ``validation`` (a boolean expression on ``df``), training uses the other rows
    and ends at the first round that does not lower the log loss on the marked ones; the
    model holds the rounds up to the best.  ``n_rows``: training rows, if known.
    """
    from pyspark.ml.classification import GBTClassifier

    from tabforge.operators.folds import class_weight_value, with_class_weight
    learn = df if validation is None else df.where(~validation)
    if class_weight and weight is None:
        df = with_class_weight(df, label, "__w", class_weight_value(learn, label))
        weight = "__w"
    keep = []
    if validation is not None:
        df = df.withColumn("__held", validation)
        keep = ["__held"]
    # training reads its input once per round: spread an under-partitioned input once
    data = spread(assemble(df, features, label, weight, keep))
    kwargs, _ = spark_params(params, (n_rows or learn.count()) if needs_rows(params) else None)
    clf = GBTClassifier(featuresCol="__features", labelCol="__label", **kwargs)
    if weight:
        clf = clf.setWeightCol("__weight")
    if validation is not None:
        clf = clf.setValidationIndicatorCol("__held")
        clf = clf.copy({clf.validationTol: 0.0})
    return clf.fit(data)


def score(model, df: DataFrame, features: list[str], keep: list[str] | None = None,
          out: str = "score") -> DataFrame:
    """P(class 1) beside the kept columns."""
    from pyspark.ml.functions import vector_to_array
    keep = list(keep if keep is not None else [c for c in df.columns if c not in features])
    data = assemble(df, features, None, None, keep=keep + features)
    pred = model.transform(data)
    return pred.select(*[col(k) for k in keep],
                       vector_to_array(F.col("probability"))[1].alias(out))


def on_cells(params: dict | None, class_weight: bool) -> bool:
    """Whether weights say all that the parameters ask of rows: a least number of rows in a leaf is none, if classes weigh differently."""
    return not class_weight or _first(dict(params or {}), _MIN_ROWS) is None


def rows_drawn(params: dict | None) -> bool:
    """Whether each tree sees a draw of the rows."""
    share = _first(dict(params or {}), _SUBSAMPLE)
    return share is not None and float(share) < 1.0


def train_cells(c: dict, d: int, params: dict, validate: bool):
    """A model of the codes of ``d`` features, fitted to the cells ``c`` (``cells.FoldCells``) as ``train_boosted`` fits the rows.

    ``validate``: the held cells end the training.  A share of rows drawn for each tree is
    a binomial draw from each cell's rows: in one task where the cells fit into it
    (``grow.boosted``), by Spark's trees otherwise (``_boost_drawn``).
    """
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import VectorAssembler

    from tabforge.operators import cells as C
    from tabforge.operators import grow
    kwargs, _ = spark_params(params, c["rows"])
    kwargs["maxBins"] = C.all_bins(c["cuts"], c["cells"])
    least = kwargs.pop("minInstancesPerNode", 1)
    if least > 1:                                     # rows are weights here
        kwargs["minWeightFractionPerNode"] = max(kwargs.get("minWeightFractionPerNode", 0.0), min((least - 0.5) / c["rows"], 0.499999))
    table = c["table"] if validate else c["table"].where("NOT __held")
    table = table.withColumn("__class", F.when(F.col("__label") == 1, F.lit(float(c["ratio"]))).otherwise(F.lit(1.0)))
    if kwargs.get("subsamplingRate", 1.0) < 1.0 and grow.fits(c["cells"], d):
        rate = kwargs["subsamplingRate"]
        return grow.boosted(table, d, kwargs.get("maxIter", 20), kwargs.get("stepSize", 0.1), rate, kwargs.get("seed", 0), validate,
                            max_depth=kwargs.get("maxDepth", 5), min_gain=kwargs.get("minInfoGain", 0.0), min_share=_share_drawn(kwargs, rate),
                            subset=kwargs.get("featureSubsetStrategy", "all"))
    table = C.dealt(table, c["cells"])
    if kwargs.get("subsamplingRate", 1.0) < 1.0:
        return _boost_drawn(table, d, kwargs, validate)
    data = VectorAssembler(inputCols=C.code_names(d), outputCol="__features").transform(table.withColumn("__weight", F.col("__n") * F.col("__class")))
    clf = GBTClassifier(featuresCol="__features", labelCol="__label", weightCol="__weight", **kwargs)
    if validate:
        clf = clf.setValidationIndicatorCol("__held")
        clf = clf.copy({clf.validationTol: 0.0})
    return clf.fit(data.select("__features", "__label", "__weight", "__held"))


def drawn(counts: str, rate: float | None, seed: int, out: str):
    """Adds to each cell how many of its rows are drawn: a share ``rate`` without replacement, or with it (None)."""
    def run(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext
        rng = np.random.default_rng([seed % 2 ** 63, TaskContext.get().partitionId()])
        for b in batches:
            n = b.column(b.schema.get_field_index(counts)).to_numpy(zero_copy_only=False)
            k = rng.poisson(n) if rate is None else rng.binomial(n, rate)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(k.astype(float))], [*b.schema.names, out])
    return run


def with_drawn(table: DataFrame, rate: float | None, seed: int, counts: str = "__n", out: str = "__k") -> DataFrame:
    """``table`` with the rows drawn of each cell; cells without any are left out."""
    schema = T.StructType([*table.schema.fields, T.StructField(out, T.DoubleType())])
    return table.mapInArrow(drawn(counts, rate, seed, out), schema).where(F.col(out) > 0)


def _share_drawn(kwargs: dict, rate: float) -> float:
    """Least weight of a leaf as a share of the rows drawn: it is given as one of all rows."""
    return min(kwargs.get("minWeightFractionPerNode", 0.0) / rate, 0.499999)


def _boost_drawn(table: DataFrame, d: int, kwargs: dict, validate: bool):
    """Gradient boosting of log loss by trees that each see a draw of the rows.

    The rounds of Spark's ``GBTClassifier`` (weight 1 of the first tree, the learning rate of the others,
    targets 4y / (1 + exp(2y margin)) with y = -1 or 1, a stop when the held log loss
    rises), with trees of Spark's ``RandomForestRegressor``: its classifier draws rows only.
    """
    from pyspark.ml.classification import GBTClassificationModel
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import RandomForestRegressor

    from tabforge.operators import cells as C
    from tabforge.session import written
    kwargs = dict(kwargs)
    rate, rounds, step, seed = kwargs.pop("subsamplingRate"), kwargs.pop("maxIter", 20), kwargs.pop("stepSize", 0.1), kwargs.pop("seed", 0)
    kwargs["minWeightFractionPerNode"] = _share_drawn(kwargs, rate)
    kwargs.setdefault("featureSubsetStrategy", "all")
    codes = VectorAssembler(inputCols=C.code_names(d), outputCol="__features")
    y, margin = 2.0 * F.col("__label") - 1.0, F.col("__margin")
    plain = [*table.columns, "__margin"]
    state = written(table.withColumn("__margin", F.lit(0.0)), "margins").persist()
    trees, weights, best, kept = [], [], math.inf, 0
    for m in range(rounds):
        target = y if m == 0 else 4.0 * y / (1.0 + F.exp(2.0 * y * margin))
        sample = codes.transform(with_drawn(state.where("NOT __held"), rate, seed + m)).select(
            "__features", target.alias("__target"), (F.col("__k") * F.col("__class")).alias("__weight")).persist()
        fit = RandomForestRegressor(featuresCol="__features", labelCol="__target", weightCol="__weight", numTrees=1, bootstrap=False,
                                    subsamplingRate=1.0, seed=seed + m, **kwargs).fit(sample)
        sample.unpersist()
        trees.append(fit.trees[0])
        weights.append(1.0 if m == 0 else step)
        moved = fit.transform(codes.transform(state)).withColumn("__margin", margin + weights[-1] * F.col("prediction")).select(*plain)
        moved = (written(moved, "margins") if m % 10 == 9 else moved).persist()       # plans stay short
        state.unpersist()
        state = moved
        if not validate:
            kept = m + 1
            continue
        rows = F.col("__n") * F.col("__class")
        now = state.where("__held").agg(F.sum(rows * 2.0 * F.log1p(F.exp(-2.0 * y * margin))) / F.sum(rows)).first()[0]
        if now is not None and now > best:
            break
        if now is None or now < best:
            best, kept = best if now is None else now, m + 1
    state.unpersist()
    sc = table.sparkSession.sparkContext
    of_trees = sc._gateway.new_array(sc._jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, kept)
    of_weights = sc._gateway.new_array(sc._jvm.double, kept)
    for i in range(kept):
        of_trees[i], of_weights[i] = trees[i]._java_obj, weights[i]
    return GBTClassificationModel(sc._jvm.org.apache.spark.ml.classification.GBTClassificationModel("GBTClassifier_cells", of_trees, of_weights))


# ---------------------------------------------------------------- node table -> numpy

#: Nodes of the trees that are broadcast at once (one tree at least): about 60 bytes each.
TREE_BLOCK = 500_000


def _tree_arrays(rs: list) -> dict:
    """One tree's node rows as numpy arrays indexed by node id."""
    import numpy as np
    size = max(r["node"] for r in rs) + 1
    feat, left, right = np.zeros(size, np.int64), -np.ones(size, np.int64), -np.ones(size, np.int64)
    thr, pred, cover = np.zeros(size), np.zeros(size), np.zeros(size)
    for r in rs:
        i = r["node"]
        feat[i] = r["feature"] if r["feature"] is not None and r["left"] >= 0 else 0
        thr[i] = r["threshold"] if r["threshold"] is not None else 0.0
        left[i], right[i] = r["left"], r["right"]
        pred[i] = r["prediction"]
        cover[i] = r["count"] if r["count"] is not None else 0
    return {"feature": feat, "threshold": thr, "left": left, "right": right,
            "value": pred, "cover": cover, "weight": float(rs[0]["weight"] or 1.0)}


def forest_blocks(spark, model, limit: int | None = None) -> Iterator[list[dict]]:
    """The model's trees in order, in lists of at most ``limit`` nodes (``TREE_BLOCK``), one tree at least.

    Only one block is on the driver at a time.
    """
    from tabforge.operators.grow import CellTrees
    limit = limit or TREE_BLOCK
    if isinstance(model, CellTrees):
        yield from model.blocks(limit)
        return
    with dropped(spark) as path:
        nodes = tree_nodes(spark, model, path)
        sizes = {r["tree"]: r["n"] for r in nodes.groupBy("tree").agg(F.count("*").alias("n")).collect()}   # a row for each tree
        held: list[int] = []
        for t in [*sorted(sizes), None]:
            if held and (t is None or sum(sizes[x] for x in held) + sizes[t] > limit):
                rows: dict[int, list] = {x: [] for x in held}
                for r in (nodes.where(F.col("tree").between(held[0], held[-1]))
                          .select("tree", "node", "feature", "threshold", "left", "right", "prediction", "count", "weight").collect()):
                    rows[r["tree"]].append(r)
                yield [_tree_arrays(rows[x]) for x in held]
                held = []
            if t is not None:
                held.append(t)


def forest_arrays(spark, model) -> dict:
    """All trees at once, for a model that is known to be small."""
    return {"trees": [t for block in forest_blocks(spark, model) for t in block]}


def tree_predict(X, tree) -> "np.ndarray":
    """Leaf value of every row of X for one tree (value <= threshold goes left)."""
    import numpy as np
    n = X.shape[0]
    idx = np.zeros(n, dtype=np.int64)
    rows = np.arange(n)
    left, right = tree["left"], tree["right"]
    while True:
        internal = left[idx] >= 0
        if not internal.any():
            break
        go_left = X[rows, tree["feature"][idx]] <= tree["threshold"][idx]
        idx = np.where(internal, np.where(go_left, left[idx], right[idx]), idx)
    return tree["value"][idx]


def staged_confusion(spark, model, df: DataFrame, features: list[str], label: str, count: str | None = None) -> DataFrame:
    """(round, tp, fp, fn, tn) after each boosting round (class 1 when P > 0.5); ``count``: the rows that a row stands for."""
    from tabforge.session import written
    xcols = [f"__x{i}" for i in range(len(features))]
    src = spread(df.select(col(label).cast("double").alias("__y"), (col(count).cast("long") if count else F.lit(1).cast("long")).alias("__n"),
                           *[col(f).cast("double").alias(f"__x{i}") for i, f in enumerate(features)]))
    src = src.withColumn("__margin", F.lit(0.0))
    counts, done = [], 0
    blocks = list_ahead(forest_blocks(spark, model))
    for trees, last in blocks:
        bc = spark.sparkContext.broadcast(trees)
        out = src.select(F.lit(None).cast("int").alias("round"), *[F.lit(None).cast("long").alias(c) for c in ("tp", "fp", "fn", "tn")],
                         "*").mapInPandas(_confusion_of(bc, xcols, done, last), "round INT, tp LONG, fp LONG, fn LONG, tn LONG, __y DOUBLE, __n LONG, "
                                          + ", ".join(f"{c} DOUBLE" for c in xcols) + ", __margin DOUBLE")
        if not last:
            out = written(out, "margins")
            src = out.where("round IS NULL").select("__y", "__n", *xcols, "__margin")
        counts.append(out.where("round IS NOT NULL").select("round", "tp", "fp", "fn", "tn"))
        done += len(trees)
    every = counts[0]
    for c in counts[1:]:
        every = every.unionByName(c)
    return every.groupBy("round").agg(*[F.sum(c).alias(c) for c in ("tp", "fp", "fn", "tn")])


def list_ahead(items: Iterator) -> Iterator[tuple]:
    """(item, whether it is the last)."""
    items = iter(items)
    held = next(items)
    for x in items:
        yield held, False
        held = x
    yield held, True


def _confusion_of(bc, xcols: list[str], done: int, last: bool):
    """Counts of a block's rounds for a task and, but for the last block, its rows with their margins."""
    def run(batches):
        import numpy as np
        import pandas as pd
        trees = bc.value
        acc = np.zeros((len(trees), 4), dtype=np.int64)
        for pdf in batches:
            if pdf.empty:
                continue
            X = pdf[xcols].to_numpy(dtype=float)
            y, n = pdf["__y"].to_numpy() == 1, pdf["__n"].to_numpy()
            margin = pdf["__margin"].to_numpy(dtype=float).copy()
            for r, t in enumerate(trees):
                margin += t["weight"] * tree_predict(X, t)
                p = margin > 0                     # P > 0.5  <=>  margin > 0
                acc[r] += [int(n[p & y].sum()), int(n[p & ~y].sum()), int(n[~p & y].sum()), int(n[~p & ~y].sum())]
            if not last:
                yield pdf.assign(__margin=margin)
        out = {"round": np.arange(done + 1, done + 1 + len(trees), dtype=np.int32),
               "tp": acc[:, 0], "fp": acc[:, 1], "fn": acc[:, 2], "tn": acc[:, 3]}
        yield pd.DataFrame({**out, "__n": np.zeros(len(trees), np.int64), **{c: np.full(len(trees), np.nan) for c in ("__y", *xcols, "__margin")}})
    return run


def staged_f1(spark, model, df: DataFrame, features: list[str], label: str, count: str | None = None) -> DataFrame:
    """(round, f1) on ``df`` after each round; F1 = 2TP / (2TP + FP + FN), 0 if empty."""
    c = staged_confusion(spark, model, df, features, label, count)
    return c.select("round", F.coalesce(F.try_divide(2.0 * F.col("tp"),
                                                     (2 * F.col("tp") + F.col("fp") + F.col("fn"))
                                                     .cast("double")), F.lit(0.0)).alias("f1"))


def staged_scores(spark, model, df: DataFrame, features: list[str], keep: list[str],
                  rounds: list[int] | None = None) -> DataFrame:
    """Per-row P(1) after the given rounds: (keep..., round, score) - for custom metrics."""
    from tabforge.session import written
    xcols = [f"__x{i}" for i in range(len(features))]
    src = spread(df.select(*[col(k) for k in keep],
                           *[col(f).cast("double").alias(f"__x{i}") for i, f in enumerate(features)]))
    src = src.withColumn("__margin", F.lit(0.0))
    kept = [f for f in src.schema.fields if f.name in keep]
    tail = [T.StructField("round", T.IntegerType()), T.StructField("score", T.DoubleType())]
    want = set(rounds) if rounds else None
    parts, done = [], 0
    for trees, last in list_ahead(forest_blocks(spark, model)):
        out = src.mapInPandas(_scores_of(spark.sparkContext.broadcast(trees), xcols, keep, want, done, last), T.StructType(
            kept + [T.StructField(c, T.DoubleType()) for c in (*xcols, "__margin")] + tail))
        if not last:
            out = written(out, "margins")
            src = out.where("round IS NULL").select(*[col(k) for k in keep], *xcols, "__margin")
        parts.append(out.where("round IS NOT NULL").select(*[col(k) for k in keep], "round", "score"))
        done += len(trees)
    every = parts[0]
    for x in parts[1:]:
        every = every.unionByName(x)
    return every


def _scores_of(bc, xcols: list[str], keep: list[str], want: set | None, done: int, last: bool):
    def run(batches):
        import numpy as np
        trees = bc.value
        for pdf in batches:
            if pdf.empty:
                continue
            X = pdf[xcols].to_numpy(dtype=float)
            margin = pdf["__margin"].to_numpy(dtype=float).copy()
            blank = pdf[[*keep, *xcols]].copy()
            for r, t in enumerate(trees, start=done + 1):
                margin += t["weight"] * tree_predict(X, t)
                if want is None or r in want:
                    yield blank.assign(__margin=np.nan, round=np.int32(r), score=1.0 / (1.0 + np.exp(-2.0 * margin)))
            if not last:
                yield blank.assign(__margin=margin, round=None, score=np.nan)
    return run


def early_stop_cut(curve: list[float], patience: int | None) -> int:
    """Index of the best round, scanning until ``patience`` rounds bring no improvement."""
    best, arg = -math.inf, 0
    for i, v in enumerate(curve):
        if v > best:
            best, arg = v, i
        elif patience and i - arg >= patience:
            break
    return arg


def fold_table(df: DataFrame, features: list[str], label: str, k: int = 5, order: list | None = None) -> DataFrame:
    """Features, label and stratified ``fold``, written once (in ``order``, if one is given)."""
    from tabforge.operators.folds import assign_folds, deal_folds
    from tabforge.session import written
    rows = df.select(*[col(f) for f in features], col(label))
    if order:
        return written(assign_folds(rows, label, k, order), "folds")
    return deal_folds(spread(rows), label, k)


def in_threads(jobs: list, parallel: int) -> list:
    """Results of ``jobs`` (functions), at most ``parallel`` at a time, each in a thread and scheduler pool of its own.

    Pools take effect where the session runs with ``spark.scheduler.mode=FAIR``.
    """
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession() or SparkSession.builder.getOrCreate()
    out, errors, todo = [None] * len(jobs), [], list(enumerate(jobs))[::-1]

    def work(pool: str):
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", pool)
        while todo and not errors:
            try:
                i, job = todo.pop()
            except IndexError:
                return
            try:
                out[i] = job()
            except Exception as e:  # noqa: BLE001 - raised again below
                errors.append(e)
    threads = [InheritableThread(work, args=(f"trial-{t}",), session=spark) for t in range(max(1, min(parallel, len(jobs))))]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    if errors:
        raise errors[0]
    return out


def cross_validate(df: DataFrame, features: list[str], label: str, params: dict | None = None,
                   k: int = 5, rounds: int = 100, early_stopping: int | None = 10,
                   order: list | None = None, metric=None, class_weight: bool = False,
                   parallel: int = 4, folds: str | None = None, cells=None) -> tuple[dict, DataFrame]:
    """Stratified k-fold CV; per-round mean and sd of the test metric over folds.

    Summary: best round by mean test F1 (within the early-stopping window),
    loss = 1 - best, n_estimators = best round, variance = min(sd)^2, seconds, and
    fold_rounds (trees that each fold fitted).  With ``early_stopping``, a fold's
    training ends at the first round that does not lower the log loss on the fold
    (``train_boosted``); its last score stands for later rounds.  Without it, all
    rounds are trained.  ``metric``: optional ``fn(label_col, score_col) -> aggregate
    Column``, evaluated per round on per-row staged scores (costlier than the built-in
    F1 counts).  ``folds``: a column of ``df`` that holds the fold already (0 to k - 1),
    so that a search deals its rows out once.  ``class_weight``: class 1 weighs n0/n1.
    Folds run in ``parallel`` threads.  Where rows collapse to fewer cells of binned
    features (``operators.cells``), training and scores take the cells, whose weights are rows;
    ``cells``: a ``FoldCells`` of ``df`` that several calls share.
    """
    from tabforge.operators import cells as C
    spark = df.sparkSession
    t0 = time.time()
    p = dict(params or {})
    for n in _ROUNDS:
        p.pop(n, None)
    p["n_estimators"] = rounds
    data = df.withColumn("fold", col(folds)) if folds else fold_table(df, features, label, k, order)
    whole = None
    if on_cells(p, class_weight):
        whole = cells or C.FoldCells(data, features, label, class_weight)
    bins = _first(p, _BINS)

    def one(f):
        found = whole.of(f, C.BINS if bins is None else int(bins), rows_drawn(p)) if whole else None
        if found:
            codes = C.code_names(len(features))
            m = train_cells(found, len(features), p, bool(early_stopping))
            test = found["table"].where("__held")
            if metric is None:
                per = staged_f1(spark, m, test, codes, "__label", "__n").withColumnRenamed("f1", "value")
            else:                                  # a metric is any aggregate of rows: each cell's rows again
                s = staged_scores(spark, m, test.withColumn("__lab", F.col("__label").cast(data.schema[label].dataType)), codes, ["__lab", "__n"])
                s = s.select("round", "__lab", "score", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__n"))))
                per = s.groupBy("round").agg(metric(F.col("__lab"), F.col("score")).alias("value"))
            return [r["value"] for r in per.orderBy("round").collect()]       # a number for each round
        held = F.col("fold") == f
        test = data.where(held)
        if early_stopping:
            m = train_boosted(data, features, label, p, class_weight=class_weight, validation=held)
        else:
            m = train_boosted(data.where(~held), features, label, p, class_weight=class_weight)
        if metric is None:
            per = staged_f1(spark, m, test, features, label).withColumnRenamed("f1", "value")
        else:
            s = staged_scores(spark, m, test.withColumn("__lab", col(label)), features, ["__lab"])
            per = s.groupBy("round").agg(metric(F.col("__lab"), F.col("score")).alias("value"))
        return [r["value"] for r in per.orderBy("round").collect()]           # a number for each round

    curves = in_threads([lambda f=f: one(f) for f in range(k)], parallel)
    rows = mean_curve(curves)
    cut = early_stop_cut([mean for mean, _ in rows], early_stopping)
    kept = rows[:cut + 1] if early_stopping else rows
    summary = {"loss": 1.0 - rows[cut][0], "n_estimators": cut + 1,
               "variance": min(sd for _, sd in kept) ** 2,
               "test_mean": rows[cut][0], "test_std": rows[cut][1],
               "train_time": time.time() - t0, "fold_rounds": [len(c) for c in curves]}
    out = spark.createDataFrame([(i, mean, sd) for i, (mean, sd) in enumerate(rows, 1)],
                                "round INT, test_mean DOUBLE, test_std DOUBLE")
    return summary, out


def mean_curve(curves: list[list[float]]) -> list[tuple[float, float]]:
    """(mean, sd) over folds for each round; a fold that stopped keeps its last value."""
    out = []
    for r in range(max(map(len, curves))):
        v = [c[min(r, len(c) - 1)] for c in curves if c and c[min(r, len(c) - 1)] is not None]
        mean = sum(v) / len(v) if v else 0.0
        out.append((mean, math.sqrt(sum((x - mean) ** 2 for x in v) / len(v)) if v else 0.0))
    return out


def fit_best(df: DataFrame, features: list[str], label: str, best: dict,
             final_rate: float = 0.05, class_weight: bool = False):
    """Refit with the best trial's parameters and rounds, learning rate 0.05.

    Trees of drawn rows are fitted to cells, where the table is large and its cells fit into a task
    (``cells.FoldCells``).
    """
    from tabforge.operators import cells as C
    from tabforge.operators import grow
    p = dict(best.get("params") or {})
    for n in _RATE + _ROUNDS:
        p.pop(n, None)
    p["learning_rate"] = final_rate
    p["n_estimators"] = int(best["n_estimators"])
    if rows_drawn(p) and on_cells(p, class_weight):
        bins = _first(p, _BINS)
        data = df.select(*[col(f) for f in features], col(label), F.lit(0).alias("fold"))
        found = C.FoldCells(data, features, label, class_weight).of(-1, C.BINS if bins is None else int(bins), True)      # none is held out
        if found and grow.fits(found["cells"], len(features)):
            return train_cells(found, len(features), p, False).model(found["cuts"])
    return train_boosted(df, features, label, p, class_weight=class_weight)


class BoostedClassifier:
    """Train-then-test wrapper with the reference's guard."""

    def __init__(self, features: list[str], label: str, params: dict | None = None):
        self.features, self.label, self.params = features, label, params
        self.model = None

    def train(self, df: DataFrame):
        self.model = train_boosted(df, self.features, self.label, self.params)
        return self

    def test(self, df: DataFrame, keep: list[str] | None = None) -> DataFrame:
        if self.model is None:
            raise Exception(NOT_TRAINED)
        return score(self.model, df, self.features, keep)
