"""Scaling, fit/apply pairs.

Fit = one aggregation (standard, min-max) or the exact distributed quantile
(robust); the fitted parameters are a few numbers per column.  Apply = one
narrow projection with literals, so it runs on batch or streaming frames alike.

Semantics (fixed): standard uses the *population* standard deviation; a zero
spread divides by 1; min-max maps a constant column to the lower bound.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabforge.functions.numeric import col
from tabforge.functions.quantile import quantiles

METHODS = ("standardscaler", "minmax", "robust")


def fit_scale(df: DataFrame, cols: list[str], method: str = "standardscaler",
              feature_range: tuple[float, float] = (0, 1), approx: bool = False) -> dict:
    if feature_range[0] >= feature_range[1]:
        raise ValueError("the scaling range must ascend")
    if method not in METHODS:
        raise ValueError(f"unknown scaling {method!r}; known: {', '.join(METHODS)}")
    params: dict = {"method": method, "range": tuple(feature_range), "cols": list(cols)}
    if not cols:
        params["stats"] = {}
        return params
    if method == "standardscaler":
        r = df.agg(*[x for i, c in enumerate(cols) for x in (
            F.avg(col(c)).alias(f"m{i}"), F.stddev_pop(col(c)).alias(f"s{i}"))]).first()
        params["stats"] = {c: (r[f"m{i}"], r[f"s{i}"]) for i, c in enumerate(cols)}
    elif method == "minmax":
        r = df.agg(*[x for i, c in enumerate(cols) for x in (
            F.min(col(c)).cast("double").alias(f"a{i}"),
            F.max(col(c)).cast("double").alias(f"b{i}"))]).first()
        params["stats"] = {c: (r[f"a{i}"], r[f"b{i}"]) for i, c in enumerate(cols)}
    else:
        qs = quantiles(df, cols, [0.25, 0.5, 0.75], approx=approx)
        params["stats"] = {c: tuple(qs[c]) for c in cols}
    return params


def scale_expr(x: Column, method: str, stats: tuple, feature_range=(0, 1)) -> Column:
    x = x.cast("double")
    if method == "standardscaler":
        mean, sd = stats
        if mean is None:
            return x
        return (x - F.lit(mean)) / F.lit(sd if sd else 1.0)
    if method == "minmax":
        lo, hi = feature_range
        mn, mx = stats
        if mn is None:
            return x
        rng = (mx - mn) or 1.0
        return (x - F.lit(mn)) / F.lit(rng) * F.lit(float(hi - lo)) + F.lit(float(lo))
    q25, med, q75 = stats
    if med is None:
        return x
    iqr = (q75 - q25) or 1.0
    return (x - F.lit(med)) / F.lit(iqr)


def apply_scale(df: DataFrame, params: dict) -> DataFrame:
    """T4: apply fitted parameters (to the same rows or to other rows)."""
    stats = params["stats"]
    return df.select(*[
        scale_expr(col(c), params["method"], stats[c], params["range"]).alias(c)
        if c in stats else col(c) for c in df.columns])


def scale(df: DataFrame, cols: list[str], method: str = "standardscaler",
          feature_range: tuple[float, float] = (0, 1), approx: bool = False) -> DataFrame:
    """Fit on ``df`` and apply to it."""
    return apply_scale(df, fit_scale(df, cols, method, feature_range, approx))
