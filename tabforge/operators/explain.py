"""Tree explanations.

X1 reads a fitted tree ensemble's own node table: the model is written to the
shared checkpoint folder and its ``data`` parquet read back with Spark, so
importance is a plain ``groupBy(featureIndex)``.  SHAP (X4) runs path-dependent
TreeSHAP per row in ``mapInPandas`` with the node table
broadcast a block of trees at a time; rows are partitioned by Spark, never gathered.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabforge.functions.partitioning import spread
from tabforge.session import scratch_path

@contextmanager
def dropped(spark: SparkSession):
    """A scratch path that is deleted at the end."""
    path = scratch_path(spark, "model")
    try:
        yield path
    finally:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def tree_nodes(spark: SparkSession, model, path: str | None = None) -> DataFrame:
    """(tree, node, feature, threshold, gain, count, prediction, left, right, weight)."""
    path = path or scratch_path(spark, "model")
    model.write().overwrite().save(path)
    data = spark.read.parquet(f"{path}/data")
    nodes = data.select(
        F.col("treeID").alias("tree"), F.col("nodeData.id").alias("node"),
        F.col("nodeData.prediction").alias("prediction"),
        F.col("nodeData.impurity").alias("impurity"),
        F.col("nodeData.gain").alias("gain"),
        F.col("nodeData.rawCount").alias("count"),
        F.col("nodeData.leftChild").alias("left"),
        F.col("nodeData.rightChild").alias("right"),
        F.col("nodeData.split.featureIndex").alias("feature"),
        F.try_element_at(F.col("nodeData.split.leftCategoriesOrThreshold"), F.lit(1))
        .alias("threshold"))
    weights = _tree_weights(spark, path, model)
    return nodes.join(F.broadcast(weights), "tree", "left")


def _tree_weights(spark: SparkSession, path: str, model) -> DataFrame:
    w = list(getattr(model, "treeWeights", None) or [])
    if not w:
        w = [1.0]
    return spark.createDataFrame([(i, float(x)) for i, x in enumerate(w)],
                                 "tree INT, weight DOUBLE")


def importance(nodes: DataFrame, features: list[str], kind: str = "weight") -> DataFrame:
    """Per feature: weight (split count), gain (mean), cover (mean count),
    total_gain, total_cover; rounded to 2 places.  Features never split on get 0."""
    kinds = {"weight": F.count(F.lit(1)), "gain": F.avg("gain"), "cover": F.avg("count"),
             "total_gain": F.sum("gain"), "total_cover": F.sum("count")}
    if kind not in kinds:
        raise ValueError(f"unknown importance {kind!r}; known: {', '.join(kinds)}")
    splits = nodes.where(F.col("left") >= 0).groupBy("feature").agg(
        kinds[kind].cast("double").alias("value"))
    names = nodes.sparkSession.createDataFrame(list(enumerate(features)),
                                               "feature INT, name STRING")
    return (names.join(F.broadcast(splits), "feature", "left")
            .select(F.col("name").alias("feature"), F.col("feature").alias("position"),
                    F.round(F.coalesce(F.col("value"), F.lit(0.0)), 2).alias(kind)))


def top_importance(nodes: DataFrame, features: list[str], k: int = 10,
                   kind: str = "weight") -> DataFrame:
    """The k most important features (ties: earlier position first)."""
    return importance(nodes, features, kind).orderBy(F.col(kind).desc(),
                                                     F.col("position").asc()).limit(k)


# ---------------------------------------------------------------- SHAP

def _extend(m: list, pz: float, po: float, pi: int) -> list:
    m = [list(e) for e in m]                      # entries: [feature, zero, one, weight]
    depth = len(m)
    m.append([pi, pz, po, 1.0 if depth == 0 else 0.0])
    for i in range(depth - 1, -1, -1):
        m[i + 1][3] += po * m[i][3] * (i + 1) / (depth + 1)
        m[i][3] = pz * m[i][3] * (depth - i) / (depth + 1)
    return m


def _unwind(m: list, i: int) -> list:
    depth = len(m)
    n = m[depth - 1][3]
    out = [list(e) for e in m[:depth - 1]]
    zi, oi = m[i][1], m[i][2]
    for j in range(depth - 2, -1, -1):
        if oi != 0:
            t = out[j][3]
            out[j][3] = n * depth / ((j + 1) * oi)
            n = t - out[j][3] * zi * (depth - (j + 1)) / depth
        else:
            out[j][3] = out[j][3] * depth / (zi * (depth - (j + 1)))
    for j in range(i, depth - 1):
        out[j][0], out[j][1], out[j][2] = m[j + 1][0], m[j + 1][1], m[j + 1][2]
    return out


def tree_shap_row(x, tree: dict, phi, scale: float = 1.0) -> None:
    """Path-dependent TreeSHAP of one row for one tree (published algorithm),
    adding scale * contribution to ``phi``.  Covers are training row counts."""
    left, right = tree["left"], tree["right"]
    feat, thr, cover, value = tree["feature"], tree["threshold"], tree["cover"], tree["value"]

    def recurse(j, m, pz, po, pi):
        m = _extend(m, pz, po, pi)
        if left[j] < 0:
            for i in range(1, len(m)):
                w = sum(e[3] for e in _unwind(m, i))
                phi[m[i][0]] += scale * w * (m[i][2] - m[i][1]) * value[j]
            return
        d = feat[j]
        hot, cold = (left[j], right[j]) if x[d] <= thr[j] else (right[j], left[j])
        iz = io = 1.0
        k = next((i for i in range(1, len(m)) if m[i][0] == d), None)
        if k is not None:
            iz, io = m[k][1], m[k][2]
            m = _unwind(m, k)
        rj = cover[j] if cover[j] > 0 else 1.0
        recurse(hot, m, iz * cover[hot] / rj, io, d)
        recurse(cold, m, iz * cover[cold] / rj, 0.0, d)

    recurse(0, [], 1.0, 1.0, -1)


def leaf_tables(tree: dict) -> list[dict]:
    """Per leaf: its unique path features, the conditions a row must meet to
    follow the path, and the TreeSHAP contributions for every pattern of met
    conditions (2^k x k, k = unique features on the path; built once per model).

    A repeated feature merges into one path element (zero fractions multiply,
    one-indicators AND), as in the recursive algorithm.
    """
    import numpy as np
    left, right = tree["left"], tree["right"]
    feat, thr, cover, value = tree["feature"], tree["threshold"], tree["cover"], tree["value"]
    out = []

    def walk(j, path):
        if left[j] < 0:
            order: list[int] = []
            z: dict[int, float] = {}
            conds: dict[int, list] = {}
            for parent, child, go_left in path:
                d = int(feat[parent])
                if d in z:
                    order.remove(d)
                else:
                    z[d] = 1.0
                    conds[d] = []
                order.append(d)
                rj = cover[parent] if cover[parent] > 0 else 1.0
                z[d] *= cover[child] / rj
                conds[d].append((float(thr[parent]), go_left))
            k = len(order)
            table = np.zeros((1 << k, max(k, 1)))
            for mask in range(1 << k):
                ones = [(mask >> i) & 1 for i in range(k)]
                m = _extend([], 1.0, 1.0, -1)
                for i, d in enumerate(order):
                    m = _extend(m, z[d], float(ones[i]), d)
                for i in range(k):
                    w = sum(e[3] for e in _unwind(m, i + 1))
                    table[mask, i] = w * (ones[i] - z[order[i]]) * value[j]
            out.append({"features": order, "conds": [conds[d] for d in order], "table": table})
            return
        walk(left[j], path + [(j, left[j], True)])
        walk(right[j], path + [(j, right[j], False)])

    walk(0, [])
    return out


def shap_batch(X, trees: list[dict], tables: list[list[dict]], n_features: int):
    """Contributions of every row of X (n x d) on the margin scale, vectorised."""
    import numpy as np
    phi = np.zeros((X.shape[0], n_features))
    for t, leaves in zip(trees, tables):
        wt = t["weight"]
        for leaf in leaves:
            mask = np.zeros(X.shape[0], dtype=np.int64)
            for i, (d, conds) in enumerate(zip(leaf["features"], leaf["conds"])):
                ok = np.ones(X.shape[0], dtype=bool)
                for th, go_left in conds:
                    ok &= (X[:, d] <= th) if go_left else (X[:, d] > th)
                mask |= ok.astype(np.int64) << i
            contrib = leaf["table"][mask]
            for i, d in enumerate(leaf["features"]):
                phi[:, d] += wt * contrib[:, i]
    return phi


def expected_value(tree: dict) -> float:
    """Cover-weighted mean leaf value."""
    import numpy as np
    leaves = tree["left"] < 0
    c = tree["cover"][leaves]
    if c.sum() <= 0:
        return float(np.mean(tree["value"][leaves]))
    return float(np.sum(tree["value"][leaves] * c) / c.sum())


def tree_shap(spark, model, df: DataFrame, features: list[str], keep: list[str]) -> DataFrame:
    """Per row: keep columns, ``phi_<feature>``, ``expected_value``, ``margin``.

    sum(phi) + expected_value = margin (Spark's raw score).  Trees come in blocks of at
    most ``boost.TREE_BLOCK`` nodes; a block's leaf tables are built once and broadcast
    with it, and the contributions of several blocks are carried in written rows.
    """
    from pyspark.sql import types as T

    from tabforge.functions.numeric import col
    from tabforge.operators.boost import forest_blocks, list_ahead
    from tabforge.session import written
    xcols = [f"__x{i}" for i in range(len(features))]
    phis = [f"phi_{f}" for f in features]
    src = spread(df.select(*[col(k) for k in keep],
                           *[col(f).cast("double").alias(f"__x{i}") for i, f in enumerate(features)]))
    kept = [f for f in src.schema.fields if f.name in keep]
    schema = T.StructType(kept + [T.StructField(c, T.DoubleType()) for c in (*xcols, *phis, "margin")])
    base, out = 0.0, src.select("*", *[F.lit(0.0).alias(c) for c in (*phis, "margin")])
    for trees, last in list_ahead(forest_blocks(spark, model)):
        base += sum(t["weight"] * expected_value(t) for t in trees)
        bc = spark.sparkContext.broadcast((trees, [leaf_tables(t) for t in trees]))
        out = out.mapInPandas(_shap_of(bc, xcols, phis), schema)
        if not last:
            out = written(out, "shap")
    return out.select(*[col(k) for k in keep], *[col(c) for c in phis], F.lit(base).alias("expected_value"), "margin")


def _shap_of(bc, xcols: list[str], phis: list[str]):
    """Adds a block's contributions and margin to each row's."""
    def run(batches):
        from tabforge.operators.boost import tree_predict
        trees, tables = bc.value
        for pdf in batches:
            if pdf.empty:
                continue
            X = pdf[xcols].to_numpy(dtype=float)
            pdf["margin"] += sum(t["weight"] * tree_predict(X, t) for t in trees)
            pdf[phis] += shap_batch(X, trees, tables, len(xcols))
            yield pdf
    return run


def _mix(x):
    """A 64-bit mixer of unsigned numpy integers."""
    import numpy as np
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _row_hash(X, seed: int):
    """A hash of each row's values."""
    import numpy as np
    out = np.full(len(X), np.uint64(seed + 1))
    for column in np.ascontiguousarray(X.T + 0.0).view(np.uint64):
        out = _mix(out * np.uint64(31) + column)
    return out


def sampled_shap(spark, model, df: DataFrame, features: list[str], keep: list[str],
                 background: int = 100, samples: int = 20, seed: int = 0) -> DataFrame:
    """Model-agnostic permutation-sampling SHAP on the margin scale.

    The background set is ``background`` rows picked by a seeded hash order
    (bounded, broadcast); each row's estimate averages ``samples`` random
    (permutation, background row) pairs, evaluated in numpy inside its task.  The draws
    hang on the row's values alone and margins add up over trees, so trees can come
    in blocks as for ``tree_shap``.  A block with few thresholds is looked up in its
    ``margin_table``; the values are the same.
    """
    import numpy as np
    from pyspark.sql import types as T

    from tabforge.functions.numeric import col
    from tabforge.operators.boost import forest_blocks, list_ahead
    from tabforge.session import written
    bg_rows = (df.select(*[col(f).cast("double").alias(f) for f in features])
               .withColumn("__h", F.xxhash64(*[col(f) for f in features], F.lit(seed)))
               .orderBy("__h").limit(background).drop("__h").collect())
    bg = np.array([[r[f] for f in features] for r in bg_rows], dtype=float)
    xcols = [f"__x{i}" for i in range(len(features))]
    phis = [f"phi_{f}" for f in features]
    src = spread(df.select(*[col(k) for k in keep],
                           *[col(f).cast("double").alias(f"__x{i}") for i, f in enumerate(features)]))
    kept = [f for f in src.schema.fields if f.name in keep]
    schema = T.StructType(kept + [T.StructField(c, T.DoubleType()) for c in (*xcols, *phis)])
    out = src.select("*", *[F.lit(0.0).alias(c) for c in phis])
    for trees, last in list_ahead(forest_blocks(spark, model)):
        out = out.mapInPandas(_sampled_of(spark.sparkContext.broadcast((trees, bg, margin_table(trees, len(features)))), xcols, phis, samples, seed), schema)
        if not last:
            out = written(out, "sampled")
    return out.select(*[col(k) for k in keep], *[col(c) for c in phis])


#: Margins of a table over the cells between a block's thresholds, at most; a block with more cells walks its trees.
MARGIN_CELLS = 1 << 20


def margin_table(trees: list[dict], d: int, limit: int | None = None):
    """(thresholds and stride of each feature, margin of each cell), or None beyond ``limit`` cells.

    Trees split at thresholds only, so the margin is the same between two neighbouring thresholds
    of each feature; a cell's margin is summed over the trees in their order, as for a row.
    """
    import numpy as np
    from tabforge.operators.boost import tree_predict
    cuts = [np.unique(np.concatenate([t["threshold"][(t["left"] >= 0) & (t["feature"] == i)] for t in trees])) for i in range(d)]
    sizes = [len(c) + 1 for c in cuts]
    if np.prod([float(s) for s in sizes]) > (limit or MARGIN_CELLS):
        return None
    strides = np.concatenate([np.cumprod(sizes[::-1])[::-1][1:], [1]]).astype(np.int64)
    at = np.indices(sizes).reshape(d, -1)
    # a value of each interval: its upper threshold (x <= threshold goes left), or beyond the last
    X = np.stack([np.append(c, np.inf)[a] for c, a in zip(cuts, at)], 1)
    margin = np.zeros(len(X))
    for t in trees:
        margin += t["weight"] * tree_predict(X, t)
    return cuts, strides, margin


def _sampled_of(bc, xcols: list[str], phis: list[str], samples: int, seed: int):
    def run(batches):
        import numpy as np

        from tabforge.operators.boost import tree_predict
        trees, B, table = bc.value
        d = len(xcols)

        def f(X):
            m = np.zeros(X.shape[0])
            for t in trees:
                m += t["weight"] * tree_predict(X, t)
            return m

        def places(X):
            """Each value's part of its row's place in the table."""
            cuts, strides, _ = table
            return np.stack([np.searchsorted(c, X[:, i]) * strides[i] for i, c in enumerate(cuts)], 1)

        from_b = places(B) if table else None
        for pdf in batches:
            if pdf.empty:
                continue
            X = pdf[xcols].to_numpy(dtype=float)
            n = len(pdf)
            rows = np.arange(n)
            own = _row_hash(X, seed)            # the draw hangs on the row's values, not on its task or batch
            phi = np.zeros((n, d))
            from_x = places(X) if table else None
            for k in range(samples):
                draw = _mix(own[:, None] + np.arange(1 + d, dtype=np.uint64) + np.uint64((k + 1) * 1009))
                perm = draw[:, 1:].argsort(axis=1)
                pick = (draw[:, 0] % np.uint64(len(B))).astype(np.int64)
                if table:                       # the same steps by places
                    cur = from_b[pick]
                    at = cur.sum(axis=1)
                    prev = table[2][at]
                    for j in perm.T:
                        at += from_x[rows, j] - cur[rows, j]
                        now = table[2][at]
                        phi[rows, j] += now - prev
                        prev = now
                    continue
                cur = B[pick].copy()
                prev = f(cur)
                for j in perm.T:                # add features one by one, each row in its own order
                    cur[rows, j] = X[rows, j]
                    now = f(cur)
                    phi[rows, j] += now - prev
                    prev = now
            pdf[phis] += phi / samples
            yield pdf
    return run


def shap_summary(contrib: DataFrame, features: list[str]) -> DataFrame:
    """Mean |contribution| per feature, largest first (the summary-plot order)."""
    stack = ", ".join(f"'{f}', `phi_{f}`" for f in features)
    long = contrib.selectExpr(f"stack({len(features)}, {stack}) AS (feature, phi)")
    return long.groupBy("feature").agg(F.avg(F.abs("phi")).alias("mean_abs_shap"))
