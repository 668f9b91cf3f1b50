"""Registered queries: sources, cleaning, missing values, encoding, scaling (S, C, M, T1-T4, T7)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabforge.operators import clean, missing, scale
from tabforge.plans import views as V
from tabforge.plans.pipeline import preprocess
from tabforge.plans.registry import register
from tabforge.sources import io

# cleaned dirty view: coerce -> label filter -> distinct
CL_SQL = "WITH " + V.DIRTY_SQL + """,
cl AS (
  SELECT DISTINCT target, TRY_CAST(feat1 AS DOUBLE) AS feat1, TRY_CAST(feat2 AS DOUBLE) AS feat2,
         TRY_CAST(feat3 AS DOUBLE) AS feat3, feat4
  FROM dirty WHERE target IN ('A', 'N', 'R'))"""

CO_SQL = "WITH " + V.DIRTY_SQL + """,
co AS (
  SELECT target, TRY_CAST(feat1 AS DOUBLE) AS feat1, TRY_CAST(feat2 AS DOUBLE) AS feat2,
         TRY_CAST(feat3 AS DOUBLE) AS feat3, feat4 FROM dirty)"""

MODE4 = ("(SELECT feat4 FROM cl WHERE feat4 IS NOT NULL GROUP BY feat4 "
         "ORDER BY COUNT(*) DESC, feat4 LIMIT 1)")

# after mean/mode fill (feat2 is dropped: 64.8 % missing > 50)
FILLED_SQL = CL_SQL + f""",
filled0 AS (
  SELECT target,
         COALESCE(feat1, (SELECT AVG(feat1) FROM cl)) AS feat1,
         COALESCE(feat3, (SELECT AVG(feat3) FROM cl)) AS feat3,
         COALESCE(feat4, {MODE4}) AS feat4
  FROM cl),
filled AS (
  SELECT target, feat1, feat3,
         CASE WHEN feat4 IN (SELECT feat4 FROM filled0 GROUP BY feat4
                             HAVING COUNT(*) <= {V.LUMP_THRESHOLD})
              THEN 'Other' ELSE feat4 END AS feat4
  FROM filled0)"""


def cleaned(spark, sf_dir):
    return clean.remove_invalid_duplicates(V.dirty(spark, sf_dir), V.DIRTY_NUMERIC, "target",
                                           V.DIRTY_LABELS)


def coerced(spark, sf_dir):
    return clean.coerce_numeric(V.dirty(spark, sf_dir), V.DIRTY_NUMERIC)


# ------------------------------------------------------------------ sources
@register("src_parquet", """SELECT * FROM lineitem""")
def q_src_parquet(spark, sf_dir):
    return io.read_table(spark, f"{sf_dir}/lineitem.parquet")


@register("sample_exact", """
SELECT * FROM lineitem
QUALIFY ROW_NUMBER() OVER (ORDER BY (l_orderkey * 7919 + l_linenumber * 104729 + l_partkey) % 1000003,
                           l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity,
                           l_extendedprice, l_discount, l_tax, l_shipdate)
        <= (SELECT ROUND(0.1 * COUNT(*)) FROM lineitem)""")
def q_sample_exact(spark, sf_dir):
    """S5 exact: 10 % of rows, chosen by a modular key (hash in production)."""
    li = V.table(spark, sf_dir, "lineitem")
    order = (F.col("l_orderkey") * 7919 + F.col("l_linenumber") * 104729 + F.col("l_partkey")) \
        % 1000003
    return io.sample_rows(li, 0.1, keys=["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                                         "l_quantity", "l_extendedprice", "l_discount",
                                         "l_tax", "l_shipdate"], order=order)


# ------------------------------------------------------------------ cleaning
@register("coerce_numeric", CO_SQL + "SELECT * FROM co")
def q_coerce(spark, sf_dir):
    return coerced(spark, sf_dir)


@register("filter_labels", "WITH " + V.DIRTY_SQL + " SELECT * FROM dirty WHERE target IN ('A', 'N', 'R')")
def q_filter_labels(spark, sf_dir):
    return clean.filter_labels(V.dirty(spark, sf_dir), "target", V.DIRTY_LABELS)


@register("drop_duplicates", "WITH " + V.DIRTY_DUP_SQL + """
SELECT DISTINCT target, TRY_CAST(feat1 AS DOUBLE) AS feat1, TRY_CAST(feat2 AS DOUBLE) AS feat2,
       TRY_CAST(feat3 AS DOUBLE) AS feat3, feat4 FROM dirty_dup""")
def q_drop_duplicates(spark, sf_dir):
    return clean.drop_duplicates(clean.coerce_numeric(V.dirty_dup(spark, sf_dir), V.DIRTY_NUMERIC))


@register("clean_invalid_dups", "WITH " + V.DIRTY_DUP_SQL + """
SELECT DISTINCT target, TRY_CAST(feat1 AS DOUBLE) AS feat1, TRY_CAST(feat2 AS DOUBLE) AS feat2,
       TRY_CAST(feat3 AS DOUBLE) AS feat3, feat4 FROM dirty_dup WHERE target IN ('A', 'N', 'R')""")
def q_clean_invalid_dups(spark, sf_dir):
    return clean.remove_invalid_duplicates(V.dirty_dup(spark, sf_dir), V.DIRTY_NUMERIC, "target",
                                           V.DIRTY_LABELS)


@register("split_label", CL_SQL + " SELECT feat1, feat2, feat3, feat4 FROM cl")
def q_split_label(spark, sf_dir):
    feats, _, _ = clean.split_label(cleaned(spark, sf_dir), "target")
    return feats


@register("select_columns", V.with_ctes(V.CLF_SQL) + "SELECT f2, f4, y FROM clf")
def q_select_columns(spark, sf_dir):
    return clean.keep_columns(V.clf(spark, sf_dir).drop(*V.KEYS), ["f4", "f2"], "y")


# ------------------------------------------------------------------ missing values
def _union_counts(src: str, cols: list[str], expr: str) -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{c}' AS column_name, {expr.format(c=c)} FROM {src}" for c in cols)


_ALL5 = ["target", "feat1", "feat2", "feat3", "feat4"]


@register("missing_counts", CO_SQL + _union_counts(
    "co", _ALL5, "CAST(COUNT(*) - COUNT({c}) AS BIGINT) AS n_missing"))
def q_missing_counts(spark, sf_dir):
    return missing.missing_counts(coerced(spark, sf_dir))


@register("missing_percent", CO_SQL + _union_counts(
    "co", _ALL5, "(100e0 * (COUNT(*) - COUNT({c})) / COUNT(*)) AS pct_missing"))
def q_missing_percent(spark, sf_dir):
    return missing.missing_percent(coerced(spark, sf_dir))


@register("drop_sparse_columns", CL_SQL + " SELECT target, feat1, feat3, feat4 FROM cl")
def q_drop_sparse(spark, sf_dir):
    return missing.drop_sparse_columns(cleaned(spark, sf_dir), 50)


@register("drop_missing_rows", CL_SQL + """
SELECT * FROM cl WHERE target IS NOT NULL AND feat1 IS NOT NULL AND feat2 IS NOT NULL
  AND feat3 IS NOT NULL AND feat4 IS NOT NULL""")
def q_drop_missing_rows(spark, sf_dir):
    return missing.drop_missing_rows(cleaned(spark, sf_dir))


@register("impute_mean", CL_SQL + """
SELECT target,
       (COALESCE(feat1, (SELECT AVG(feat1) FROM cl))) AS feat1,
       (COALESCE(feat2, (SELECT AVG(feat2) FROM cl))) AS feat2,
       (COALESCE(feat3, (SELECT AVG(feat3) FROM cl))) AS feat3, feat4 FROM cl""")
def q_impute_mean(spark, sf_dir):
    return missing.impute_mean(cleaned(spark, sf_dir), V.DIRTY_NUMERIC)


@register("impute_mode", CL_SQL + f"""
SELECT target, feat1, feat2, feat3, COALESCE(feat4, {MODE4}) AS feat4 FROM cl""")
def q_impute_mode(spark, sf_dir):
    return missing.impute_mode(cleaned(spark, sf_dir), V.DIRTY_CATEGORICAL)


@register("lump_rare", CL_SQL + f"""
SELECT target, feat1, feat2, feat3,
       CASE WHEN feat4 IN (SELECT feat4 FROM cl WHERE feat4 IS NOT NULL GROUP BY feat4
                           HAVING COUNT(*) <= {V.LUMP_THRESHOLD})
            THEN 'Other' ELSE feat4 END AS feat4 FROM cl""")
def q_lump_rare(spark, sf_dir):
    return missing.lump_rare(cleaned(spark, sf_dir), V.DIRTY_CATEGORICAL, V.LUMP_THRESHOLD)


@register("handle_missing", FILLED_SQL + " SELECT * FROM filled")
def q_handle_missing(spark, sf_dir):
    return missing.handle_missing(cleaned(spark, sf_dir), V.DIRTY_NUMERIC, V.DIRTY_CATEGORICAL,
                                  "fill", 50, V.LUMP_THRESHOLD)


@register("handle_missing_drop", CL_SQL + """
SELECT * FROM cl WHERE target IS NOT NULL AND feat1 IS NOT NULL AND feat2 IS NOT NULL
  AND feat3 IS NOT NULL AND feat4 IS NOT NULL""")
def q_handle_missing_drop(spark, sf_dir):
    return missing.handle_missing(cleaned(spark, sf_dir), V.DIRTY_NUMERIC, V.DIRTY_CATEGORICAL,
                                  "drop")


@register("encode_target", CL_SQL + """
SELECT CAST(DENSE_RANK() OVER (ORDER BY target) - 1 AS INTEGER) AS target,
       feat1, feat2, feat3, feat4 FROM cl""")
def q_encode_target(spark, sf_dir):
    return missing.encode_target(cleaned(spark, sf_dir), "target")


@register("missing_by_class", CL_SQL + "\nUNION ALL ".join(
    f"""SELECT target, '{c}' AS column_name, CAST(COUNT(*) - COUNT({c}) AS BIGINT) AS n_missing,
           CAST(COUNT({c}) AS BIGINT) AS n_present FROM cl GROUP BY target"""
    for c in ["feat1", "feat2", "feat3", "feat4"]))
def q_missing_by_class(spark, sf_dir):
    return missing.missing_by_class(cleaned(spark, sf_dir), "target")


# ------------------------------------------------------------------ scaling
def _clf_out(exprs: dict[str, str]) -> str:
    return (V.with_ctes(V.CLF_SQL) + "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, y, "
            + ", ".join(f"{e} AS {c}" for c, e in exprs.items()) + " FROM clf")


@register("scale_standard", _clf_out({
    f: f"({f} - AVG({f}) OVER ()) / STDDEV_POP({f}) OVER ()" for f in V.FEATURES}))
def q_scale_standard(spark, sf_dir):
    return scale.scale(V.clf(spark, sf_dir), V.FEATURES, "standardscaler")


@register("scale_minmax", _clf_out({
    f: f"({f} - MIN({f}) OVER ()) / (MAX({f}) OVER () - MIN({f}) OVER ()) * 2e0 - 1e0"
    for f in V.FEATURES}))
def q_scale_minmax(spark, sf_dir):
    return scale.scale(V.clf(spark, sf_dir), V.FEATURES, "minmax", (-1, 1))


@register("scale_robust", _clf_out({
    f: (f"({f} - QUANTILE_CONT({f}, 0.5) OVER ()) / "
        f"(QUANTILE_CONT({f}, 0.75) OVER () - QUANTILE_CONT({f}, 0.25) OVER ())")
    for f in V.FEATURES}))
def q_scale_robust(spark, sf_dir):
    return scale.scale(V.clf(spark, sf_dir), V.FEATURES, "robust")


@register("scale_train_test", V.with_ctes(V.CLF_SQL, """st AS (
  SELECT """ + ", ".join(f"AVG({f}) AS m_{f}, STDDEV_POP({f}) AS s_{f}" for f in V.FEATURES)
    + " FROM clf WHERE l_orderkey % 10 < 7)") + """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, y, """ + ", ".join(
    f"(({f} - m_{f}) / s_{f}) AS {f}" for f in V.FEATURES)
    + " FROM clf, st WHERE l_orderkey % 10 >= 7")
def q_scale_train_test(spark, sf_dir):
    d = V.clf(spark, sf_dir)
    params = scale.fit_scale(d.where(F.col("l_orderkey") % 10 < 7), V.FEATURES)
    return scale.apply_scale(d.where(F.col("l_orderkey") % 10 >= 7), params)


# ------------------------------------------------------------------ chain
CHAIN_SQL = FILLED_SQL + """,
enc AS (
  SELECT CAST(DENSE_RANK() OVER (ORDER BY target) - 1 AS INTEGER) AS target, feat1, feat3, feat4
  FROM filled),
chain AS (
  SELECT target,
         (feat1 - AVG(feat1) OVER ()) / STDDEV_POP(feat1) OVER () AS feat1,
         (feat3 - AVG(feat3) OVER ()) / STDDEV_POP(feat3) OVER () AS feat3,
         feat4
  FROM enc)"""


@register("preprocess_chain", CHAIN_SQL + " SELECT * FROM chain")
def q_preprocess_chain(spark, sf_dir):
    out, _ = preprocess(V.dirty(spark, sf_dir), numeric=V.DIRTY_NUMERIC,
                        categorical=V.DIRTY_CATEGORICAL, target="target", labels=V.DIRTY_LABELS,
                        category_threshold=V.LUMP_THRESHOLD, encode_target=True, transform=False)
    return out


@register("preprocess_summary", CHAIN_SQL + """
SELECT target, CAST(COUNT(*) AS BIGINT) AS n_rows, AVG(feat1) AS mean_feat1,
       AVG(feat3) AS mean_feat3,
       CAST(SUM(CASE WHEN feat4 = 'Other' THEN 1 ELSE 0 END) AS BIGINT) AS n_other
FROM chain GROUP BY target""")
def q_preprocess_summary(spark, sf_dir):
    """Flagship: dirty lineitem -> clean -> fill -> encode -> scale -> per-class means."""
    out, _ = preprocess(V.dirty(spark, sf_dir), numeric=V.DIRTY_NUMERIC,
                        categorical=V.DIRTY_CATEGORICAL, target="target", labels=V.DIRTY_LABELS,
                        category_threshold=V.LUMP_THRESHOLD, encode_target=True, transform=False)
    return out.groupBy("target").agg(
        F.count(F.lit(1)).alias("n_rows"), F.avg("feat1").alias("mean_feat1"),
        F.avg("feat3").alias("mean_feat3"),
        F.sum(F.when(F.col("feat4") == "Other", 1).otherwise(0)).cast("bigint").alias("n_other"))


# ------------------------------------------------------------------ power transforms
def _power_src(spark, sf_dir):
    return V.clf(spark, sf_dir).withColumn("g", F.col("f1") - 25)


_YJ_COLS = ["f1", "f3", "f4", "g"]
_BC_COLS = ["f1", "f2"]
_POWER_SRC_SQL = V.with_ctes(V.CLF_SQL, "src AS (SELECT *, f1 - 25 AS g FROM clf)")


def _yj_sql(x: str, lam: str) -> str:
    return (f"CASE WHEN {x} >= 0 THEN (CASE WHEN {lam} = 0 THEN LN({x} + 1) "
            f"ELSE (POW({x} + 1, {lam}) - 1) / {lam} END) "
            f"ELSE (CASE WHEN {lam} = 2 THEN -LN(1 - {x}) "
            f"ELSE -(POW(1 - {x}, 2 - {lam}) - 1) / (2 - {lam}) END) END")


def _bc_sql(x: str, lam: str) -> str:
    return f"CASE WHEN {lam} = 0 THEN LN({x}) ELSE (POW({x}, {lam}) - 1) / {lam} END"


def _fit_sql(cols: list[str], method: str) -> str:
    long = " UNION ALL ".join(f"SELECT '{c}' AS c, CAST({c} AS DOUBLE) AS x FROM src" for c in cols)
    s_expr = "SUM(SIGN(x) * LN(1 + ABS(x)))" if method == "yj" else "SUM(LN(x))"
    psi = _yj_sql("x", "l") if method == "yj" else _bc_sql("x", "l")
    return _POWER_SRC_SQL.rstrip("\n") + f""",
lam AS (SELECT (i - 40) / 10e0 AS l FROM range(81) t(i)),
lng AS ({long}),
s AS (SELECT c, COUNT(x) AS n, {s_expr} AS s FROM lng GROUP BY c),
v AS (SELECT c, l, VAR_POP({psi}) AS v FROM lng, lam GROUP BY c, l),
ll AS (SELECT v.c, l, -n / 2e0 * LN(v) + (l - 1) * s AS ll FROM v JOIN s ON v.c = s.c WHERE v > 0)
SELECT c AS column_name, arg_max(l, ll) AS lambda FROM ll GROUP BY c"""


def _lambdas_frame(spark, params):
    return spark.createDataFrame(sorted(params["lambdas"].items()),
                                 "column_name STRING, lambda DOUBLE")


@register("power_yj_fixed", _POWER_SRC_SQL + "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, "
          + ", ".join(f"{_yj_sql(c, '0.5e0')} AS {c}" for c in _YJ_COLS) + " FROM src")
def q_power_yj_fixed(spark, sf_dir):
    from tabforge.operators import power
    d = _power_src(spark, sf_dir).select(*V.KEYS, *_YJ_COLS)
    return power.apply_power(d, {"method": "yeo-johnson", "lambdas": {c: 0.5 for c in _YJ_COLS}})


@register("power_bc_fixed", _POWER_SRC_SQL + "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, "
          + ", ".join(f"{_bc_sql(c, '0.5e0')} AS {c}" for c in _BC_COLS) + " FROM src")
def q_power_bc_fixed(spark, sf_dir):
    from tabforge.operators import power
    d = _power_src(spark, sf_dir).select(*V.KEYS, *_BC_COLS)
    return power.apply_power(d, {"method": "box-cox", "lambdas": {c: 0.5 for c in _BC_COLS}})


@register("power_yj_fit", _fit_sql(_YJ_COLS, "yj"))
def q_power_yj_fit(spark, sf_dir):
    """Yeo-Johnson lambda = argmax of the likelihood on the fixed -4..4 / 0.1 grid."""
    from tabforge.operators import power
    p = power.fit_power(_power_src(spark, sf_dir), _YJ_COLS, "yeo-johnson", zoom_rounds=0,
                        max_moves=0)
    return _lambdas_frame(spark, p)


@register("power_bc_fit", _fit_sql(_BC_COLS, "bc"))
def q_power_bc_fit(spark, sf_dir):
    from tabforge.operators import power
    p = power.fit_power(_power_src(spark, sf_dir), _BC_COLS, "box-cox", zoom_rounds=0,
                        max_moves=0)
    return _lambdas_frame(spark, p)


@register("power_yj_refined")
def q_power_yj_refined(spark, sf_dir):
    """Default fit: grid then four tenfold zoom rounds (lambda to 1e-5)."""
    from tabforge.operators import power
    p = power.fit_power(_power_src(spark, sf_dir), _YJ_COLS, "yeo-johnson")
    return _lambdas_frame(spark, p)


@register("preprocess_full")
def q_preprocess_full(spark, sf_dir):
    """T7 with every step on: clean, fill, encode, scale, Yeo-Johnson."""
    out, _ = preprocess(V.dirty(spark, sf_dir), numeric=V.DIRTY_NUMERIC,
                        categorical=V.DIRTY_CATEGORICAL, target="target", labels=V.DIRTY_LABELS,
                        category_threshold=V.LUMP_THRESHOLD, encode_target=True, transform=True)
    return out


# ------------------------------------------------------------------ CSV source
def _lineitem_csv(spark, sf_dir, header: bool) -> str:
    """Write three lineitem columns as CSV below the shared checkpoint folder; return the path."""
    from tabforge.session import scratch_path
    path = scratch_path(spark, "lineitem-csv")
    io.read_table(spark, f"{sf_dir}/lineitem.parquet").select("l_orderkey", "l_extendedprice", "l_returnflag").write.option("header", header).csv(path)
    return path


@register("src_csv", "SELECT CAST(l_orderkey AS INTEGER) AS l_orderkey, l_extendedprice, l_returnflag FROM lineitem")
def q_src_csv(spark, sf_dir):
    """CSV round trip, header inferred from the first line."""
    path = _lineitem_csv(spark, sf_dir, header=True)
    return io.read_table(spark, path, "csv", header="infer")


@register("src_csv_noheader", 'SELECT CAST(l_orderkey AS INTEGER) AS "0", l_extendedprice AS "1", l_returnflag AS "2" FROM lineitem')
def q_src_csv_noheader(spark, sf_dir):
    """CSV without a header: columns named by position."""
    path = _lineitem_csv(spark, sf_dir, header=False)
    return io.read_table(spark, path, "csv", header=None)
