"""Profiling tables behind the reference's plots (V1-V9).

Histograms: one min/max aggregate, a broadcast of that small range table
(one row per column and class; size checked), one grouped count.
Correlations: one aggregate of all pairs (``try_divide`` form).  Spearman:
exact average ranks from value counts + running count, joined back per column
(broadcast when the column's distinct values are few, shuffle join otherwise).
PCA: Spark ML's distributed Gramian; only the d x d result reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabforge.functions.numeric import col
from tabforge.functions.partitioning import spread
from tabforge.functions.prefix import running_sum
from tabforge.session import scratch_path, written


def _long(df: DataFrame, cols: list[str], by: str | None = None, cast: str = "DOUBLE") -> DataFrame:
    stack = ", ".join(f"'{c.replace(chr(39), chr(39) * 2)}', CAST(`{c.replace('`', '``')}` AS {cast})"
                      for c in cols)
    ids = [f"`{by}`"] if by else []
    return df.selectExpr(*ids, f"stack({len(cols)}, {stack}) AS (column_name, value)") \
             .where(F.col("value").isNotNull())


def histogram(df: DataFrame, cols: list[str], bins: int = 20, by: str | None = None) -> DataFrame:
    """V1/V2: equal-width bins between the (per-class) min and max, density = n/(N*width).

    Output (column_name, [by], bin, lo, hi, n, density); empty bins included.
    A constant column uses the range [x-0.5, x+0.5].
    """
    if not isinstance(bins, int):
        raise TypeError(f"bins is {bins!r}, not a whole number")
    keys = ["column_name"] + ([by] if by else [])
    long = _long(df, cols, by)
    # written, so that its size in bytes is known and decides on a broadcast
    rng = written(long.groupBy(*keys).agg(F.min("value").alias("mn"), F.max("value").alias("mx"),
                                          F.count(F.lit(1)).alias("__tot"))
           .select(*keys, "__tot",
                   F.when(F.col("mx") == F.col("mn"), F.col("mn") - 0.5).otherwise(F.col("mn"))
                   .alias("lo0"),
                   F.when(F.col("mx") == F.col("mn"), F.col("mn") + 0.5).otherwise(F.col("mx"))
                   .alias("hi0")), "histogram")
    b = F.least(F.lit(bins - 1), F.floor((F.col("value") - F.col("lo0"))
                                         * (F.lit(float(bins)) / (F.col("hi0") - F.col("lo0")))))
    counts = (long.join(rng, keys)
              .groupBy(*keys, b.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n")))
    grid = rng.select(*keys, "__tot", "lo0", "hi0",
                      F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    width = (F.col("hi0") - F.col("lo0")) / F.lit(float(bins))
    return grid.join(counts, keys + ["bin"], "left").select(
        *keys, "bin", (F.col("lo0") + F.col("bin") * width).alias("lo"),
        (F.col("lo0") + (F.col("bin") + 1) * width).alias("hi"),
        F.coalesce(F.col("n"), F.lit(0)).cast("long").alias("n"),
        (F.coalesce(F.col("n"), F.lit(0)) / (F.col("__tot") * width)).alias("density"))


def category_counts(df: DataFrame, cols: list[str], by: str | None = None) -> DataFrame:
    """V3: (column_name, [by], value, n) for non-NULL values."""
    keys = ["column_name"] + ([by] if by else [])
    return (_long(df, cols, by, cast="STRING").groupBy(*keys, "value")
            .agg(F.count(F.lit(1)).alias("n")))


def correlation(df: DataFrame, cols: list[str], method: str = "pearson") -> DataFrame:
    """V4-V6: lower triangle (i >= j) of the pairwise-complete correlation matrix.

    Output (feature_1, feature_2, r) with feature_1 at position i, feature_2 at j.
    """
    if method not in ("pearson", "kendall", "spearman"):
        raise ValueError(f"unknown correlation {method!r}")
    if method == "spearman":
        # two passes read the ranks (profile, centred sums): rank once, keep them
        ranked = written(rank_columns(df.select(*[col(c) for c in cols]), cols), "ranks")
        return correlation(ranked, cols, "pearson")
    if method == "kendall":
        return kendall(df, cols)
    pairs = [(i, j) for i in range(len(cols)) for j in range(i + 1)]
    return _masked_pearson(df, cols, pairs)


def _masked_pearson(df: DataFrame, cols: list[str], pairs: list[tuple[int, int]]) -> DataFrame:
    """Pairwise-complete Pearson r from one pass of block products.

    With X centred on the column means and zero where NULL, and M the mask of
    present values, X'X, X'M, (X*X)'M and M'M hold every pair's sums over the rows
    where both are present.  Each task adds up its d x d products in numpy; their
    rows are summed by Spark, so the driver gets d x d numbers.  A constant or empty
    pair gives NULL.
    """
    import numpy as np
    import pyarrow as pa
    d = len(cols)
    mean_row = df.agg(*[F.avg(col(c).cast("double")).alias(f"m{i}") for i, c in enumerate(cols)]).first()
    means = np.array([0.0 if m is None else float(m) for m in mean_row])
    x = df.select(*[col(c).cast("double").alias(f"x{i}") for i, c in enumerate(cols)])

    def products(batches):
        sums = np.zeros((4, d, d))
        for b in batches:
            v = np.stack([c.to_numpy(zero_copy_only=False).astype(float) for c in b.columns], 1) - means
            m = (~np.isnan(v)).astype(float)
            v = np.nan_to_num(v)
            sums += np.stack([v.T @ v, v.T @ m, (v * v).T @ m, m.T @ m])
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.arange(4), d)), pa.array(np.tile(np.arange(d), 4)),
                                          pa.array(list(sums.reshape(4 * d, d)), pa.list_(pa.float64()))], ["part", "i", "row"])

    rows = (x.mapInArrow(products, "part bigint, i bigint, row array<double>").select("part", "i", F.posexplode("row").alias("j", "v"))
            .groupBy("part", "i", "j").agg(F.sum("v").alias("v")).collect())
    t = np.zeros((4, d, d))
    for r in rows:
        t[r["part"], r["i"], r["j"]] = r["v"]
    n = np.maximum(t[3], 1)
    cov = t[0] - t[1] * t[1].T / n
    var = t[2] - t[1] * t[1] / n                      # of column i over the rows where j is present too
    scale = np.maximum(t[2], 1e-300)
    out = []
    for i, j in pairs:
        flat = var[i, j] <= 1e-12 * scale[i, j] or var[j, i] <= 1e-12 * scale[j, i]
        out.append((cols[i], cols[j], None if flat or t[3, i, j] < 1 else float(cov[i, j] / np.sqrt(var[i, j] * var[j, i]))))
    return df.sparkSession.createDataFrame(out, "feature_1 STRING, feature_2 STRING, r DOUBLE")


def _replace_by(df: DataFrame, cols: list[str], ranks: DataFrame) -> DataFrame:
    """Each column's values replaced by their ``rank`` (column_name, value, rank); other columns stay.

    The ranks are written in a folder for each column, so that Catalyst knows each one's
    size: those of a column with few values, however often they repeat, are broadcast, and only
    columns with many values are joined by a shuffle of the rows.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "ranks")
    place = F.create_map(*[F.lit(x) for i, c in enumerate(cols) for x in (c, i)])[F.col("column_name")]
    ranks.select("value", "rank", place.alias("__column")).write.partitionBy("__column").parquet(path)
    table = spark.read.schema("value DOUBLE, rank DOUBLE, __column INT").parquet(path)
    out = df.select(*[col(c) for c in df.columns if c not in cols], *[col(c).cast("double").alias(f"__v{i}") for i, c in enumerate(cols)])
    for i in range(len(cols)):
        of = table.where(F.col("__column") == i).select(F.col("value").alias("__value"), F.col("rank").alias(f"__r{i}"))
        out = out.join(of, F.col(f"__v{i}") == F.col("__value"), "left").drop("__value", f"__v{i}")
    return out.select(*[F.col(f"__r{cols.index(c)}").alias(c) if c in cols else col(c) for c in df.columns])


#: Cells of a block of the inversion count, and blocks at most: with more cells than both allow, blocks grow.
KENDALL_BLOCK, KENDALL_BLOCKS = 1 << 20, 2048
_CHUNK = 64


def weighted_inversions(y, w) -> float:
    """Sum of w_i * w_j over i < j with y_i > y_j, by bottom-up merging of sorted blocks."""
    import numpy as np
    n = len(y)
    if n < 2:
        return 0.0
    y = np.unique(y, return_inverse=True)[1].astype(np.int64)
    top = int(y.max()) + 1
    blocks = -(-n // _CHUNK)
    # pad to whole chunks with weightless cells above all others
    y = np.concatenate([y, np.full(blocks * _CHUNK - n, top)])
    w = np.concatenate([np.asarray(w, float), np.zeros(blocks * _CHUNK - n)])
    later, total = np.triu(np.ones((_CHUNK, _CHUNK), bool), 1), 0.0
    for lo in range(0, blocks, 512):
        cy, cw = y.reshape(-1, _CHUNK)[lo:lo + 512], w.reshape(-1, _CHUNK)[lo:lo + 512]
        total += float(np.einsum("bi,bij,bj->", cw, ((cy[:, :, None] > cy[:, None, :]) & later).astype(float), cw, optimize=True))
    order = np.argsort(y.reshape(-1, _CHUNK), axis=1, kind="stable") + np.arange(blocks)[:, None] * _CHUNK
    place, size = order.ravel(), _CHUNK               # places sorted by y within blocks of ``size`` places
    while size < len(y):
        parent = place // (2 * size)
        order = np.argsort(parent * (top + 1) + y[place], kind="stable")     # left halves come first among equals
        place, parent = place[order], parent[order]
        right, pw = place // size % 2 == 1, w[place]
        left = np.cumsum(np.where(right, 0.0, pw))
        ends = np.searchsorted(parent, np.arange(parent[-1] + 1), side="right") - 1
        total += float((pw * (left[ends][parent] - left))[right].sum())
        size *= 2
    return total


#: Different values up to which inversions are counted bit by bit.
_FEW = 1 << 12


def discordant(x, y, w) -> float:
    """Sum of w_i * w_j over pairs with x_i < x_j and y_i > y_j.

    The coordinate with fewer values is counted along the other one: bit by bit where they
    are few (``_few_inversions``), by merging otherwise.
    """
    import numpy as np
    if len(y) < 2:
        return 0.0
    (ux, cx), (uy, cy) = (np.unique(v, return_inverse=True) for v in (x, y))
    if len(ux) < len(uy):
        (ux, cx), (uy, cy) = (uy, cy), (ux, cx)
    if len(uy) < 2:
        return 0.0
    order = np.lexsort((cy, cx))
    return _few_inversions(cy[order], w[order], len(uy)) if len(uy) <= _FEW else weighted_inversions(cy[order], w[order])


def _few_inversions(y, w, k: int) -> float:
    """Sum of w_i * w_j over i < j with y_i > y_j for codes below ``k``: at the highest bit where two codes differ, i has 1 and j has 0."""
    import numpy as np
    y, w, total = y.astype(np.uint16), np.asarray(w, float), 0.0
    for bit in range((k - 1).bit_length()):
        above = y >> np.uint16(bit + 1)
        order = np.argsort(above, kind="stable")                   # a radix sort of 16 bits
        one, sw = (y[order] >> np.uint16(bit)) & np.uint16(1) == 1, w[order]
        ones = np.cumsum(np.where(one, sw, 0.0))
        at = np.flatnonzero(np.concatenate([[True], above[order][1:] != above[order][:-1]]))
        before = np.repeat(np.concatenate([[0.0], ones])[at], np.diff(np.append(at, len(y))))
        total += float((sw * (ones - before))[~one].sum())
    return total


def _pair_groups(batches):
    """(pair, columns) of a task's rows; the pairs of a range are few and their cells bounded by its size."""
    import numpy as np
    import pyarrow as pa
    held = [b for b in batches if b.num_rows]
    if not held:
        return
    t = pa.Table.from_batches(held)
    pair = t["pair"].to_numpy()
    cols = {c: t[c].to_numpy() for c in t.column_names}
    for p in np.unique(pair):
        at = pair == p
        yield int(p), {c: v[at] for c, v in cols.items()}


def _ties(key, w):
    """Pairs tied in ``key`` (sorted) but for its first and last value, and those two's weights (may go on in other ranges)."""
    import numpy as np
    at = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    t = np.add.reduceat(w, at)
    edges = [(float(key[at[i]]), float(t[i])) for i in ({0, len(at) - 1})]
    return float((t[1:-1] * (t[1:-1] - 1) / 2).sum()), edges


_CELL = "pair INT, x DOUBLE, y DOUBLE, c DOUBLE, xb INT, kind STRING, value DOUBLE"


def _fact_rows(facts: list[tuple]):
    """(pair, x, y, c, xb, kind, value) rows of a task as one batch."""
    import pyarrow as pa
    types = [pa.int32(), pa.float64(), pa.float64(), pa.float64(), pa.int32(), pa.string(), pa.float64()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*facts), types)], [f.split()[0] for f in _CELL.split(", ")])


def _by_x(batches):
    """Cells with their range of (x, y), and what a range knows by itself."""
    import numpy as np
    import pyarrow as pa
    from pyspark import TaskContext
    xb = TaskContext.get().partitionId()
    for p, v in _pair_groups(batches):
        order = np.lexsort((v["y"], v["x"]))
        x, y, c = (v[k][order] for k in ("x", "y", "c"))
        n = len(x)
        yield pa.RecordBatch.from_arrays([pa.array(np.full(n, p, np.int32)), pa.array(x), pa.array(y), pa.array(c), pa.array(np.full(n, xb, np.int32)),
                                          pa.nulls(n, pa.string()), pa.nulls(n, pa.float64())], [f.split()[0] for f in _CELL.split(", ")])
        tied, edges = _ties(x, c)
        yield _fact_rows([(p, None, None, None, None, "n", float(c.sum())), (p, None, None, None, None, "n3", float((c * (c - 1) / 2).sum())),
                          (p, None, None, None, None, "nd", discordant(x, y, c)), (p, None, None, None, None, "n1", tied)]
                         + [(p, k, None, t, None, "x", None) for k, t in edges])


def _by_y(batches):
    """What a range of (y, x) knows: discordant cells of different x-ranges, ties in y, weights by x-range."""
    import numpy as np
    from pyspark import TaskContext
    yb = TaskContext.get().partitionId()
    for p, v in _pair_groups(batches):
        order = np.lexsort((v["y"], v["xb"]))
        xb, y, c = (v[k][order] for k in ("xb", "y", "c"))
        tied, edges = _ties(np.sort(y), c[np.argsort(y, kind="stable")])
        at = np.flatnonzero(np.concatenate([[True], xb[1:] != xb[:-1]]))
        nd = discordant(xb, y, c) if len(at) > 1 else 0.0
        yield _fact_rows([(p, None, None, None, None, "nd", nd), (p, None, None, None, None, "n2", tied)]
                         + [(p, None, k, t, None, "y", None) for k, t in edges]
                         + [(p, None, float(yb), t, int(b), "cross", None) for b, t in zip(xb[at], np.add.reduceat(c, at))])


def _crossed(table):
    """Discordant weights of one pair's (x-range, y-range) table, ranges differing in both."""
    import numpy as np
    import pyarrow as pa
    xb, yb, c = (table[k].to_numpy() for k in ("xb", "y", "c"))
    order = np.lexsort((yb, xb))
    return pa.table({"pair": pa.array(table["pair"].to_numpy()[:1], pa.int32()), "value": [weighted_inversions(yb[order], c[order])]})


def kendall(df: DataFrame, cols: list[str]) -> DataFrame:
    """V6: Kendall tau-b for every pair (i >= j), exact, without emitting pairs.

    tau_b = (n0 - n1 - n2 + n3 - 2 nd) / sqrt((n0 - n1)(n0 - n2)) over the rows
    where both values are present (n0 all pairs, n1/n2 pairs tied in x/y, n3
    tied in both).  nd, the discordant pairs, is a weighted inversion count over the
    distinct (x, y) cells: cells are range-partitioned by (x, y), where each range
    counts its own inversions by merging, then by (y, x), where each range counts those
    between different x-ranges; what differs in both ranges follows from the weights by
    x-range and y-range, one small table for each pair.  Cutting equal values into
    several ranges is harmless: the other coordinate then ascends.  A column with
    itself has 1 (NULL if constant) and needs no cells.
    """
    clean = df.select(*[F.when(~F.isnan(col(c).cast("double")), col(c).cast("double") + F.lit(0.0)).alias(f"v{i}") for i, c in enumerate(cols)])
    pairs = [(i, j) for i in range(len(cols)) for j in range(i)]
    varied = clean.agg(*[F.min(f"v{i}").alias(f"lo{i}") for i in range(len(cols))], *[F.max(f"v{i}").alias(f"hi{i}") for i in range(len(cols))]).first()
    out = [(c, c, 1.0 if varied[f"lo{i}"] is not None and varied[f"lo{i}"] < varied[f"hi{i}"] else None) for i, c in enumerate(cols)]
    schema = "feature_1 STRING, feature_2 STRING, r DOUBLE"
    if not pairs:
        return df.sparkSession.createDataFrame(out, schema)
    stack = ", ".join(f"{p}, v{i}, v{j}" for p, (i, j) in enumerate(pairs))
    cells = written(spread(clean).selectExpr(f"stack({len(pairs)}, {stack}) AS (pair, x, y)").where("x IS NOT NULL AND y IS NOT NULL")
                    .groupBy("pair", "x", "y").agg(F.count(F.lit(1)).cast("double").alias("c")), "cells")
    spark = df.sparkSession
    ranges = min(KENDALL_BLOCKS, max(-(-cells.count() // KENDALL_BLOCK), min(spark.sparkContext.defaultParallelism, 16)))
    placed = written(cells.repartitionByRange(ranges, "pair", "x", "y").mapInArrow(_by_x, _CELL), "cells-x")
    facts = written(placed.where("kind IS NULL").select("pair", "x", "y", "c", "xb").repartitionByRange(ranges, "pair", "y", "x")
                    .mapInArrow(_by_y, _CELL), "cells-y").unionByName(placed.where("kind IS NOT NULL"))
    half = F.col("c") * (F.col("c") - 1) / 2.0
    totals = (facts.where("kind IN ('n', 'n1', 'n2', 'n3', 'nd')").select("pair", "kind", "value")
              .unionByName(facts.where("kind = 'x'").groupBy("pair", "x").agg(F.sum("c").alias("c")).select("pair", F.lit("n1").alias("kind"), half.alias("value")))
              .unionByName(facts.where("kind = 'y'").groupBy("pair", "y").agg(F.sum("c").alias("c")).select("pair", F.lit("n2").alias("kind"), half.alias("value")))
              .unionByName(facts.where("kind = 'cross'").groupBy("pair", "xb", "y").agg(F.sum("c").alias("c")).groupBy("pair")
                           .applyInArrow(_crossed, "pair INT, value DOUBLE").withColumn("kind", F.lit("nd"))))
    found = {}
    for r in totals.groupBy("pair", "kind").agg(F.sum("value").alias("value")).collect():        # five numbers for each pair
        found.setdefault(r["pair"], {})[r["kind"]] = r["value"]
    for p, (i, j) in enumerate(pairs):
        t = {"n": 0.0, "n1": 0.0, "n2": 0.0, "n3": 0.0, "nd": 0.0, **found.get(p, {})}
        n0 = t["n"] * (t["n"] - 1) / 2
        under = (n0 - t["n1"]) * (n0 - t["n2"])
        out.append((cols[i], cols[j], (n0 - t["n1"] - t["n2"] + t["n3"] - 2 * t["nd"]) / under ** 0.5 if under > 0 else None))
    return spark.createDataFrame(out, schema)


def correlation_matrix(df: DataFrame, cols: list[str]) -> dict[tuple[str, str], float | None]:
    """Pearson matrix as a dict (d x d numbers on the driver, one job)."""
    out = {}
    for row in correlation(df, cols).collect():
        out[(row["feature_1"], row["feature_2"])] = row["r"]
        out[(row["feature_2"], row["feature_1"])] = row["r"]
    return out


def rank_columns(df: DataFrame, cols: list[str]) -> DataFrame:
    """Replace each column by its average rank among the column's non-NULL values."""
    counts = _long(df, cols).groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))
    cum = running_sum(counts, [F.col("value").asc()], ["n"], partition_by=["column_name"])
    ranks = cum.select("column_name", "value",
                       (F.col("cum_n") - F.col("n") + (F.col("n") + 1) / 2.0).alias("rank"))
    return _replace_by(df, cols, ranks)


def _assemble(df: DataFrame, cols: list[str], center: bool = True):
    from pyspark.ml.feature import VectorAssembler
    if center:
        means = df.agg(*[F.avg(col(c)).alias(c) for c in cols]).first()
        df = df.select(*[(col(c) - F.lit(means[c])).alias(c) if c in cols else col(c)
                         for c in df.columns])
    va = VectorAssembler(inputCols=cols, outputCol="__vec", handleInvalid="error")
    return va.transform(df)


def pca(df: DataFrame, cols: list[str]) -> DataFrame:
    """V7: (component, explained_pct, cumulative_pct) for all components."""
    from pyspark.ml.feature import PCA
    model = PCA(k=len(cols), inputCol="__vec", outputCol="__pc").fit(_assemble(df, cols))
    ev = [float(x) * 100.0 for x in model.explainedVariance.toArray()]
    rows = []
    acc = 0.0
    for i, v in enumerate(ev):
        acc += v
        rows.append((i + 1, v, acc))
    return df.sparkSession.createDataFrame(
        rows, "component INT, explained_pct DOUBLE, cumulative_pct DOUBLE")


def pca_project(df: DataFrame, cols: list[str], target: str | None = None,
                k: int = 2) -> DataFrame:
    """V8: centred data projected on the first k components (+ class).

    Sign fixed: each component's largest-magnitude loading is positive.
    """
    from pyspark.ml.feature import PCA
    from pyspark.ml.functions import vector_to_array
    data = _assemble(df, cols)
    model = PCA(k=k, inputCol="__vec", outputCol="__pc").fit(data)
    pc = model.pc.toArray()
    signs = [1.0 if pc[abs(pc[:, j]).argmax(), j] >= 0 else -1.0 for j in range(k)]
    proj = model.transform(data).withColumn("__a", vector_to_array(F.col("__pc")))
    keep = [col(target)] if target else []
    return proj.select(*keep, *[(F.col("__a")[j] * F.lit(signs[j])).alias(f"pc{j + 1}")
                                for j in range(k)])


def class_ratio(df: DataFrame, target: str) -> DataFrame:
    """V9: n0, n1 and the imbalance ratio n0/n1."""
    y = col(target).cast("long")
    return df.agg(F.sum(F.when(y == 0, 1).otherwise(0)).cast("long").alias("n0"),
                  F.sum(F.when(y == 1, 1).otherwise(0)).cast("long").alias("n1")) \
             .withColumn("ratio", F.try_divide(F.col("n0").cast("double"),
                                               F.col("n1").cast("double")))
