"""Registered queries: profiling (V), splits and folds (L1-L3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabforge.operators import folds, profile
from tabforge.plans import views as V
from tabforge.plans.registry import register

_F4 = V.FEATURES


def _long_sql(src: str, cols: list[str], extra: str = "") -> str:
    return " UNION ALL ".join(
        f"SELECT {extra}'{c}' AS column_name, CAST({c} AS DOUBLE) AS value FROM {src} "
        f"WHERE {c} IS NOT NULL" for c in cols)


def _hist_sql(by: str | None) -> str:
    k = f"{by}, " if by else ""
    using = "column_name" + (f", {by}" if by else "")
    return V.with_ctes(V.CLF_SQL, f"""lng AS ({_long_sql('clf', _F4, k)})""", f"""
rng AS (SELECT {k}column_name, COUNT(*) AS N,
               CASE WHEN MAX(value) = MIN(value) THEN MIN(value) - 0.5 ELSE MIN(value) END AS lo0,
               CASE WHEN MAX(value) = MIN(value) THEN MIN(value) + 0.5 ELSE MAX(value) END AS hi0
        FROM lng GROUP BY {using})""", f"""
cnt AS (SELECT {k}l.column_name,
               CAST(LEAST(19, FLOOR((value - lo0) * (20e0 / (hi0 - lo0)))) AS INTEGER) AS bin,
               COUNT(*) AS c
        FROM lng l JOIN rng r USING ({using}) GROUP BY ALL)""", f"""
grid AS (SELECT {k}column_name, N, lo0, hi0, CAST(UNNEST(RANGE(0, 20)) AS INTEGER) AS bin FROM rng)""") + f"""
SELECT {k}column_name, bin, (lo0 + bin * ((hi0 - lo0) / 20e0)) AS lo,
       (lo0 + (bin + 1) * ((hi0 - lo0) / 20e0)) AS hi,
       CAST(COALESCE(c, 0) AS BIGINT) AS n,
       (COALESCE(c, 0) / (N * ((hi0 - lo0) / 20e0))) AS density
FROM grid LEFT JOIN cnt USING ({using}, bin)"""


@register("histogram", _hist_sql(None))
def q_histogram(spark, sf_dir):
    return profile.histogram(V.clf(spark, sf_dir), _F4, 20)


@register("histogram_by_class", _hist_sql("y"))
def q_histogram_by_class(spark, sf_dir):
    return profile.histogram(V.clf(spark, sf_dir), _F4, 20, by="y")


@register("category_counts", "WITH " + V.DIRTY_SQL + """
SELECT 'target' AS column_name, target AS value, COUNT(*) AS n FROM dirty WHERE target IS NOT NULL GROUP BY 2
UNION ALL
SELECT 'feat4', feat4, COUNT(*) FROM dirty WHERE feat4 IS NOT NULL GROUP BY 2""")
def q_category_counts(spark, sf_dir):
    return profile.category_counts(V.dirty(spark, sf_dir), ["target", "feat4"])


@register("category_counts_by_class", "WITH " + V.DIRTY_SQL + """
SELECT target, 'feat4' AS column_name, feat4 AS value, COUNT(*) AS n
FROM dirty WHERE feat4 IS NOT NULL GROUP BY 1, 3""")
def q_category_counts_by_class(spark, sf_dir):
    return profile.category_counts(V.dirty(spark, sf_dir), ["feat4"], by="target")


def _corr_sql(src_ctes: str, src: str, cols: list[str]) -> str:
    parts = []
    for i, a in enumerate(cols):
        for b in cols[:i + 1]:
            parts.append(f"SELECT '{a}' AS feature_1, '{b}' AS feature_2, "
                         f"CORR({a}, {b}) AS r FROM {src}")
    return src_ctes + " UNION ALL ".join(parts)


@register("corr_pearson", _corr_sql(V.with_ctes(V.CLF_SQL), "clf", _F4))
def q_corr_pearson(spark, sf_dir):
    return profile.correlation(V.clf(spark, sf_dir), _F4, "pearson")


_RANKED = V.with_ctes(V.CLF_SQL, "rk AS (SELECT " + ", ".join(
    f"RANK() OVER (ORDER BY {c}) + (COUNT(*) OVER (PARTITION BY {c}) - 1) / 2e0 AS {c}"
    for c in _F4) + " FROM clf)")


@register("corr_spearman", _corr_sql(_RANKED, "rk", _F4))
def q_corr_spearman(spark, sf_dir):
    return profile.correlation(V.clf(spark, sf_dir), _F4, "spearman")


@register("pca_variance")
def q_pca_variance(spark, sf_dir):
    return profile.pca(V.emb(spark, sf_dir), V.EMB_FEATURES)


@register("pca_project")
def q_pca_project(spark, sf_dir):
    return profile.pca_project(V.emb(spark, sf_dir), V.EMB_FEATURES, "label")


@register("class_ratio", V.with_ctes(V.CLF_SQL) + """
SELECT CAST(SUM(CASE WHEN y = 0 THEN 1 ELSE 0 END) AS BIGINT) AS n0,
       CAST(SUM(CASE WHEN y = 1 THEN 1 ELSE 0 END) AS BIGINT) AS n1,
       (SUM(CASE WHEN y = 0 THEN 1 ELSE 0 END) * 1e0 / SUM(CASE WHEN y = 1 THEN 1 ELSE 0 END)) AS ratio
FROM clf""")
def q_class_ratio(spark, sf_dir):
    return profile.class_ratio(V.clf(spark, sf_dir), "y")


_ORDER_SQL = "(l_orderkey * 7919 + l_linenumber * 104729 + l_partkey) % 1000003"


def _order_col():
    return (F.col("l_orderkey") * 7919 + F.col("l_linenumber") * 104729 + F.col("l_partkey")) \
        % 1000003


_TIE = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "f1", "f2", "f3", "f4"]


@register("split_exact", V.with_ctes(V.CLF_SQL) + f"""
SELECT * FROM clf
QUALIFY ROW_NUMBER() OVER (ORDER BY {_ORDER_SQL}, {', '.join(_TIE)})
        <= (SELECT ROUND(0.3 * COUNT(*)) FROM clf)""")
def q_split_exact(spark, sf_dir):
    _, test = folds.split_exact(V.clf(spark, sf_dir), 0.3,
                                [_order_col().asc()] + [F.col(c).asc() for c in _TIE],
                                lead=_order_col())
    return test


@register("split_hash", V.with_ctes(V.CLF_SQL) + """
SELECT * FROM clf WHERE (l_orderkey * 31 + l_linenumber) % 10 >= 3""")
def q_split_hash(spark, sf_dir):
    train, _ = folds.split(V.clf(spark, sf_dir), 0.3,
                           bucket=((F.col("l_orderkey") * 31 + F.col("l_linenumber")) % 10) / 10.0)
    return train


@register("stratified_folds", V.with_ctes(V.CLF_SQL) + f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, y,
       CAST((ROW_NUMBER() OVER (PARTITION BY y ORDER BY {', '.join(_TIE)}) - 1) % 5 AS INTEGER) AS fold
FROM clf""")
def q_stratified_folds(spark, sf_dir):
    d = V.clf(spark, sf_dir)
    out = folds.assign_folds(d, "y", 5, [F.col(c).asc() for c in _TIE])
    return out.select(*V.KEYS, "y", "fold")


@register("class_weight", V.with_ctes(V.CLF_SQL) + """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, y,
       (CASE WHEN y = 1 THEN (SELECT SUM(CASE WHEN y = 0 THEN 1 ELSE 0 END) * 1e0
                                          / SUM(CASE WHEN y = 1 THEN 1 ELSE 0 END) FROM clf)
             ELSE 1e0 END) AS weight
FROM clf""")
def q_class_weight(spark, sf_dir):
    return folds.with_class_weight(V.clf(spark, sf_dir), "y").select(*V.KEYS, "y", "weight")


_KT = {"f1": "l_quantity", "f2": "l_extendedprice", "f3": "l_discount", "f4": "l_tax", "ln": "l_linenumber"}


def _kendall_pair(a: str, b: str) -> str:
    return f"""SELECT '{a}' AS feature_1, '{b}' AS feature_2, (
  WITH cl AS (SELECT {_KT[a]} AS x, {_KT[b]} AS y, COUNT(*) AS c FROM lineitem
              WHERE {_KT[a]} IS NOT NULL AND {_KT[b]} IS NOT NULL GROUP BY 1, 2),
  t AS (SELECT CAST(SUM(c) AS DOUBLE) AS n, CAST(SUM(c * (c - 1) / 2) AS DOUBLE) AS n3 FROM cl),
  tx AS (SELECT CAST(SUM(s * (s - 1) / 2) AS DOUBLE) AS n1 FROM (SELECT SUM(c) AS s FROM cl GROUP BY x)),
  ty AS (SELECT CAST(SUM(s * (s - 1) / 2) AS DOUBLE) AS n2 FROM (SELECT SUM(c) AS s FROM cl GROUP BY y)),
  d AS (SELECT CAST(COALESCE(SUM(p.c * q.c), 0) AS DOUBLE) AS nd FROM cl p JOIN cl q ON p.x < q.x AND p.y > q.y)
  SELECT ((n * (n - 1) / 2 - n1 - n2 + n3 - 2 * nd)
               / SQRT((n * (n - 1) / 2 - n1) * (n * (n - 1) / 2 - n2))) FROM t, tx, ty, d) AS r"""


_KCOLS = list(_KT)


@register("corr_kendall", " UNION ALL ".join(
    _kendall_pair(a, b) for i, a in enumerate(_KCOLS) for b in _KCOLS[:i + 1]))
def q_corr_kendall(spark, sf_dir):
    li = V.table(spark, sf_dir, "lineitem").select(*[F.col(v).alias(k) for k, v in _KT.items()])
    return profile.correlation(li, _KCOLS, "kendall")
