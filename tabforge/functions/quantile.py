"""Exact quantiles with linear interpolation, without gathering a column.

``percentile`` keeps every distinct value of a group in one buffer, and a global
aggregate ends in one task.  Here: distinct (column, value) counts (map-side
combined), a running count per column (``functions.prefix``), and only the rows
at the wanted ranks go to the driver: two per column and probability.
``approx=True`` switches to ``percentile_approx`` (one pass, bounded memory).
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabforge.functions.numeric import col
from tabforge.functions.prefix import running_sum


def _long(df: DataFrame, cols: list[str]) -> DataFrame:
    stack = ", ".join(f"'{c.replace(chr(39), chr(39) * 2)}', CAST(`{c.replace('`', '``')}` AS DOUBLE)"
                      for c in cols)
    return df.selectExpr(f"stack({len(cols)}, {stack}) AS (column_name, value)") \
             .where(F.col("value").isNotNull())


def _interpolate(n: int, probs: list[float], at: dict[int, float]) -> list[float]:
    out = []
    for p in probs:
        pos = (n - 1) * p
        lo, hi = math.floor(pos), math.ceil(pos)
        out.append(at[lo] + (pos - lo) * (at[hi] - at[lo]))
    return out


def quantiles(df: DataFrame, cols: list[str], probs: list[float], approx: bool = False,
              accuracy: int = 100_000) -> dict[str, list[float | None]]:
    """Exact (default) or approximate quantiles of each column, linear interpolation.

    Exact path: (1) a ``percentile_approx`` sketch gives, for each wanted rank,
    a bracket [lo, hi] that must contain it (sketch rank error <= n/accuracy,
    widened 2x); (2) one aggregation counts the values below each bracket and
    groups the values inside it; (3) a distributed running count over those
    finds the exact ones.  Only the wanted ranks reach the driver; a bracket that
    misses falls back to the running count over all values.
    """
    if not cols:
        return {}
    if approx:
        r = df.agg(*[F.percentile_approx(col(c), probs, accuracy).alias(c) for c in cols]).first()
        return {c: list(r[c]) if r[c] is not None else [None] * len(probs) for c in cols}
    long = _long(df, cols)
    eps = 2.0 / accuracy
    # pass 1: counts and sketch brackets together (ranks derived from n after)
    brk_p = sorted({min(1.0, max(0.0, p + d)) for p in probs for d in (-2 * eps, 2 * eps)})
    sk = df.agg(*[F.count(col(c)).alias(f"n{i}") for i, c in enumerate(cols)],
                *[F.percentile_approx(col(c), brk_p, accuracy).alias(f"q{i}")
                  for i, c in enumerate(cols)]).first()
    n_by = {c: sk[f"n{i}"] for i, c in enumerate(cols) if sk[f"n{i}"]}
    wanted, brackets = {}, {}
    for i, c in enumerate(cols):
        if c not in n_by:
            continue
        n = n_by[c]
        qv = dict(zip(brk_p, sk[f"q{i}"]))
        ks, bl = set(), []
        for p in probs:
            pos = (n - 1) * p
            for k in {math.floor(pos), math.ceil(pos)}:
                if k not in ks:
                    ks.add(k)
                    bl.append((k, qv[min(1.0, max(0.0, p - 2 * eps))],
                               qv[min(1.0, max(0.0, p + 2 * eps))]))
        wanted[c], brackets[c] = sorted(ks), bl
    # pass 2: one aggregation: the distinct values inside each (merged) bracket,
    # and for values outside, only a count per gap between brackets
    merged: dict[str, list[list[float]]] = {}
    for c, bl in brackets.items():
        iv = sorted([lo, hi] for _, lo, hi in bl)
        out = [iv[0]]
        for lo, hi in iv[1:]:
            if lo <= out[-1][1]:
                out[-1][1] = max(out[-1][1], hi)
            else:
                out.append([lo, hi])
        merged[c] = out
    v = F.col("value")
    in_band = F.lit(False)
    gap = F.lit(None).cast("int")
    for c, iv in merged.items():
        is_c = F.col("column_name") == c
        inside = F.lit(False)
        for lo, hi in iv:
            inside = inside | ((v >= F.lit(lo)) & (v <= F.lit(hi)))
        above = sum((F.when(v > F.lit(hi), 1).otherwise(0) for _, hi in iv), F.lit(0))
        in_band = in_band | (is_c & inside)
        gap = F.when(is_c & ~inside, above).otherwise(gap)
    # one order for gaps and bracket values: gap g lies before bracket g
    seg = F.lit(None).cast("int")
    for c, iv in merged.items():
        inside_at = F.lit(None).cast("int")
        for g, (lo, hi) in enumerate(iv):
            inside_at = F.when((v >= F.lit(lo)) & (v <= F.lit(hi)), 2 * g + 1).otherwise(inside_at)
        seg = F.when(F.col("column_name") == c, F.coalesce(inside_at, 2 * gap)).otherwise(seg)
    bands = (long.select("column_name", seg.alias("_seg"), F.when(in_band, v).alias("_v"))
             .groupBy("column_name", "_seg", "_v").agg(F.count(F.lit(1)).alias("n")))
    cum = running_sum(bands, [F.col("_seg").asc(), F.col("_v").asc()], ["n"], partition_by=["column_name"])
    at = _pick(cum.where(F.col("_v").isNotNull()), "_v", wanted)
    if any(k not in at[c] for c, ks in wanted.items() for k in ks):       # a bracket missed its rank
        return _quantiles_running(long, cols, probs, n_by)
    return {c: (_interpolate(n_by[c], probs, at[c]) if c in n_by else [None] * len(probs)) for c in cols}


def _pick(cum: DataFrame, value: str, wanted: dict) -> dict[str, dict[int, float]]:
    """The values at the wanted ranks of each column (two rows per column and probability at most)."""
    cond = F.lit(False)
    for c, ks in wanted.items():
        for k in ks:
            cond = cond | ((F.col("column_name") == c) & (F.col("cum_n") - F.col("n") <= k) & (F.col("cum_n") > k))
    at: dict[str, dict[int, float]] = {c: {} for c in wanted}
    for r in cum.where(cond).select("column_name", value, "n", "cum_n").collect():
        for k in wanted[r["column_name"]]:
            if r["cum_n"] - r["n"] <= k < r["cum_n"]:
                at[r["column_name"]][k] = r[value]
    return at


def _quantiles_running(long: DataFrame, cols: list[str], probs: list[float],
                       n_by: dict[str, int]) -> dict[str, list[float | None]]:
    """Fallback: distinct-value counts + distributed running count per column."""
    counts = long.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))
    cum = running_sum(counts, [F.col("value").asc()], ["n"], partition_by=["column_name"])
    wanted = {c: {k for p in probs for k in (math.floor((n - 1) * p), math.ceil((n - 1) * p))} for c, n in n_by.items()}
    at = _pick(cum, "value", wanted)
    return {c: (_interpolate(n_by[c], probs, at[c]) if c in n_by else [None] * len(probs)) for c in cols}
