"""Registered queries: feature selection (F1-F9) on the ``sig`` view."""

from __future__ import annotations

from tabforge.operators import select as S
from tabforge.plans import views as V
from tabforge.plans.registry import register

_F = V.FEATURES


def _sig(spark, sf_dir):
    return V.sig(spark, sf_dir)


_PEARSON_CTE = V.with_ctes(V.SIG_SQL, "ps AS (" + " UNION ALL ".join(
    f"SELECT '{f}' AS feature, {i} AS position, COALESCE(ABS(CORR({f}, label)), 0) AS score FROM sig"
    for i, f in enumerate(_F)) + ")")

_CHI2_CTE = V.with_ctes(
    V.SIG_SQL,
    "mm AS (SELECT " + ", ".join(f"MIN({f}) AS a{i}, MAX({f}) AS b{i}" for i, f in enumerate(_F))
    + " FROM sig)",
    "x AS (SELECT label, " + ", ".join(f"({f} - a{i}) / (b{i} - a{i}) AS x{i}"
                                       for i, f in enumerate(_F)) + " FROM sig, mm)",
    "per AS (SELECT label, COUNT(*) AS nc, " + ", ".join(f"SUM(x{i}) AS o{i}" for i in range(len(_F)))
    + " FROM x GROUP BY label)",
    "lng AS (" + " UNION ALL ".join(f"SELECT label, nc, '{f}' AS feature, {i} AS position, o{i} AS obs FROM per"
                                    for i, f in enumerate(_F)) + ")",
    """t AS (SELECT *, SUM(obs) OVER (PARTITION BY feature) AS tot,
                SUM(nc) OVER (PARTITION BY feature) AS n FROM lng)""",
    """cs AS (SELECT feature, position,
                 CASE WHEN MAX(tot) > 0 THEN SUM(POW(obs - nc * 1e0 / n * tot, 2) / (nc * 1e0 / n * tot)) END
                 AS score FROM t GROUP BY feature, position)""")


def _ranked(src: str, k: int) -> str:
    return f"""SELECT feature, CAST(position AS INTEGER) AS position, score AS score,
       ROW_NUMBER() OVER (ORDER BY score DESC NULLS LAST, position DESC) <= {k} AS selected
FROM {src}"""


@register("select_pearson", _PEARSON_CTE + _ranked("ps", 2))
def q_select_pearson(spark, sf_dir):
    return S.select_pearson(_sig(spark, sf_dir), "label", 2, _F)


@register("select_chi2", _CHI2_CTE + _ranked("cs", 2))
def q_select_chi2(spark, sf_dir):
    return S.select_chi2(_sig(spark, sf_dir), "label", 2, _F)


@register("above_mean", _PEARSON_CTE + """
SELECT feature, CAST(position AS INTEGER) AS position, score AS score,
       score >= AVG(score) OVER () AND ROW_NUMBER() OVER (ORDER BY score DESC, position) <= 2 AS selected
FROM ps""")
def q_above_mean(spark, sf_dir):
    d = _sig(spark, sf_dir)
    scores = S.select_pearson(d, "label", 2, _F).drop("selected")
    return S.above_mean(scores, 2)


@register("vote_deterministic", _PEARSON_CTE.rstrip("\n") + ",\n" + _CHI2_CTE[len("WITH "):]
          .replace(V.SIG_SQL + ",\n", "", 1) + """,
p AS (SELECT feature, ROW_NUMBER() OVER (ORDER BY score DESC NULLS LAST, position DESC) <= 3 AS sel FROM ps),
c AS (SELECT feature, ROW_NUMBER() OVER (ORDER BY score DESC NULLS LAST, position DESC) <= 3 AS sel FROM cs),
v AS (SELECT p.feature AS "Feature", p.sel AS "Pearson", c.sel AS "Chi-2",
             CAST(p.sel AS INTEGER) + CAST(c.sel AS INTEGER) AS "Total"
      FROM p JOIN c ON p.feature = c.feature)
SELECT CAST(ROW_NUMBER() OVER (ORDER BY "Total" DESC, "Feature" DESC) AS INTEGER) AS rank, *
FROM v QUALIFY rank <= 3""")
def q_vote_deterministic(spark, sf_dir):
    return S.vote(_sig(spark, sf_dir), "label", 3, _F, methods=["Pearson", "Chi-2"])


@register("select_logistic")
def q_select_logistic(spark, sf_dir):
    return S.select_logistic(_sig(spark, sf_dir), "label", 2, _F)


@register("select_forest")
def q_select_forest(spark, sf_dir):
    return S.select_forest(_sig(spark, sf_dir), "label", 2, _F)


@register("select_boosted")
def q_select_boosted(spark, sf_dir):
    return S.select_boosted(_sig(spark, sf_dir), "label", 2, _F)


@register("select_extra")
def q_select_extra(spark, sf_dir):
    return S.select_extra(_sig(spark, sf_dir), "label", 2, _F)


@register("vote")
def q_vote(spark, sf_dir):
    return S.vote(_sig(spark, sf_dir), "label", 3, _F)


@register("select_features")
def q_select_features(spark, sf_dir):
    d = _sig(spark, sf_dir).select(*_F, "label")
    return S.select_features(d, "label", 2, _F)
