"""Feature synthesis.

Transform primitives build Column expression trees on the driver; the whole
feature matrix is ONE projection, and Catalyst's sub-expression elimination
shares the inner sums that several products reuse.

Stacking rule: primitives run in alphabetical order; the inputs of primitive k
are the base columns plus the outputs of earlier primitives whose depth is
below ``max_depth`` (never its own outputs); binary commutative primitives
take unordered pairs of distinct inputs, named with the operands in
lexicographic order of their names.  Names carry no parentheses, so
``"feat1 * feat2 + feat3"`` is feat1 * (feat2 + feat3).

Aggregation primitives group a child table by its key (map-side partial
aggregates, so a key holding a third of all rows is combined before the
shuffle) and left-join the one-row-per-key result to the parent.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabforge.session import written
from tabforge.functions.numeric import adjusted_skew, col, is_numeric_type

EARTH_RADIUS_MILES = 3958.8


@dataclass(frozen=True)
class Primitive:
    name: str
    arity: int
    fn: Callable[..., Column]
    label: Callable[..., str]
    input_kind: str = "numeric"        # numeric | datetime | text | latlong
    commutative: bool = True
    output_kind: str = "numeric"


@dataclass
class Feature:
    name: str
    expr: Column
    depth: int
    kind: str
    key: tuple = field(default=())


def _haversine(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    p1, p2 = F.radians(lat1), F.radians(lat2)
    dphi = F.radians(lat2 - lat1)
    dlmb = F.radians(lon2 - lon1)
    a = F.pow(F.sin(dphi / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(dlmb / 2), 2)
    return F.lit(2 * EARTH_RADIUS_MILES) * F.asin(F.sqrt(a))


def _num_words(t: Column) -> Column:
    return (F.length(t) - F.length(F.replace(t, F.lit(" "), F.lit("")))) + 1


TRANSFORMS: dict[str, Primitive] = {
    "add_numeric": Primitive("add_numeric", 2, lambda a, b: a + b, lambda a, b: f"{a} + {b}"),
    "multiply_numeric": Primitive("multiply_numeric", 2, lambda a, b: a * b,
                                  lambda a, b: f"{a} * {b}"),
    "day": Primitive("day", 1, F.dayofmonth, lambda a: f"DAY({a})", "datetime"),
    "month": Primitive("month", 1, F.month, lambda a: f"MONTH({a})", "datetime"),
    "year": Primitive("year", 1, F.year, lambda a: f"YEAR({a})", "datetime"),
    "weekday": Primitive("weekday", 1, F.weekday, lambda a: f"WEEKDAY({a})", "datetime"),
    "num_characters": Primitive("num_characters", 1, F.length,
                                lambda a: f"NUM_CHARACTERS({a})", "text"),
    "num_words": Primitive("num_words", 1, _num_words, lambda a: f"NUM_WORDS({a})", "text"),
    "haversine": Primitive("haversine", 2, lambda a, b: _haversine(*a, *b),
                           lambda a, b: f"HAVERSINE({a}, {b})", "latlong"),
}


def register_primitive(name: str, arity: int, fn: Callable[..., Column],
                       label: Callable[..., str] | None = None, commutative: bool = True,
                       input_kind: str = "numeric") -> Primitive:
    """Add a user transform primitive (a Column function; use a pandas_udf
    inside ``fn`` only when no built-in expression can say it)."""
    if label is None:
        label = (lambda *xs: f"{name.upper()}({', '.join(xs)})")
    p = Primitive(name, arity, fn, label, input_kind, commutative)
    TRANSFORMS[name] = p
    return p


def _kind(dt: T.DataType) -> str | None:
    if isinstance(dt, T.BooleanType):
        return "bool"
    if is_numeric_type(dt):
        return "numeric"
    if isinstance(dt, (T.TimestampType, T.DateType, T.TimestampNTZType)):
        return "datetime"
    if isinstance(dt, T.StringType):
        return "text"
    return None


def feature_definitions(df: DataFrame, trans: list[str] | None = None, max_depth: int = 1,
                        columns: list[str] | None = None,
                        latlong: list[tuple[str, str]] | None = None) -> list[Feature]:
    """The feature list (names, expressions) for ``df`` - no job runs."""
    if not isinstance(max_depth, int):
        raise TypeError(f"max_depth is {max_depth!r}, not a whole number")
    trans = ["multiply_numeric"] if trans is None else list(trans)
    for t in trans:
        if not isinstance(t, str) or t not in TRANSFORMS:
            raise TypeError(f"a primitive is named by a string, not by {t!r}"
                            if not isinstance(t, str) else f"unknown primitive {t!r}")
    types = {f.name: f.dataType for f in df.schema.fields}
    columns = list(df.columns) if columns is None else list(columns)
    base = [Feature(c, col(c), 0, _kind(types[c]) or "other", ("col", c)) for c in columns]
    for a, b in latlong or []:
        base.append(Feature(f"({a}, {b})", F.array(col(a), col(b)), 0, "latlong",
                            ("ll", a, b)))
    feats = list(base)
    produced: list[Feature] = []
    seen_keys = {f.key for f in base}
    seen_names = {f.name for f in base}
    for pname in sorted(trans):
        p = TRANSFORMS[pname]
        pool = [f for f in base + produced if f.depth < max_depth and f.kind == p.input_kind]
        if p.input_kind == "latlong":
            pool = [f for f in base if f.kind == "latlong"]
        pool = sorted(pool, key=lambda f: f.name)
        new: list[Feature] = []
        if p.arity == 1:
            combos = [(f,) for f in pool]
        elif p.commutative:
            combos = [(pool[i], pool[j]) for i in range(len(pool)) for j in range(i + 1, len(pool))]
        else:
            combos = [(a, b) for a in pool for b in pool if a is not b]
        for combo in combos:
            key = (pname,) + (tuple(sorted(f.key for f in combo)) if p.commutative
                              else tuple(f.key for f in combo))
            if key in seen_keys:
                continue
            seen_keys.add(key)
            if p.input_kind == "latlong":
                args = [(F.col(f"`{f.key[1]}`"), F.col(f"`{f.key[2]}`")) for f in combo]
            else:
                args = [f.expr for f in combo]
            name = p.label(*[f.name for f in combo])
            base_name, k = name, 2
            while name in seen_names:           # two trees can print the same
                name = f"{base_name} #{k}"
                k += 1
            seen_names.add(name)
            new.append(Feature(name, p.fn(*args), 1 + max(f.depth for f in combo),
                               p.output_kind, key))
        produced.extend(new)
        feats.extend(new)
    return [f for f in feats if f.kind != "latlong" or f.depth > 0]


def synthesize(df: DataFrame, trans: list[str] | None = None, max_depth: int = 1,
               numeric: list[str] | None = None, passthrough: list[str] | None = None,
               latlong: list[tuple[str, str]] | None = None,
               keep_base: bool = True) -> DataFrame:
    """One projection of base columns, synthesized features and
    pass-through columns (categoricals, keys, label) carried in the same row."""
    passthrough = list(passthrough or [])
    columns = [c for c in (numeric if numeric is not None else df.columns)
               if c not in passthrough]
    feats = feature_definitions(df, trans, max_depth, columns, latlong)
    out = [f.expr.alias(f.name) for f in feats if keep_base or f.depth > 0]
    return df.select(*out, *[col(c) for c in passthrough])


def new_features(df: DataFrame, label: str | None = None, categorical: list[str] | None = None,
                 trans: list[str] | None = None, max_depth: int = 1) -> DataFrame:
    """Reference flow: numeric features only (else error), categoricals re-attached."""
    categorical = list(categorical or [])
    feats = [c for c in df.columns if c != label and c not in categorical]
    types = {f.name: f.dataType for f in df.schema.fields}
    if not all(is_numeric_type(types[c]) for c in feats):
        raise ValueError("Data Frame contains non-numeric values")
    keep = categorical + ([label] if label else [])
    return synthesize(df, trans or ["multiply_numeric"], max_depth, feats, keep)


def drop_correlated(df: DataFrame, threshold: float = 0.8, cols: list[str] | None = None,
                    keep: list[str] | None = None) -> tuple[DataFrame, list[str]]:
    """In column order i, for j < i: |r_ij| >= threshold and j not dropped -> drop i.

    A NULL/NaN r (constant column) never drops.  The columns are compared in tiles
    (``wide.keep_uncorrelated``), so neither a task nor the driver holds d x d numbers.
    """
    if not isinstance(threshold, float):
        raise TypeError(f"threshold is {threshold!r}, not a float")
    if threshold < 0 or threshold > 1:
        raise ValueError(f"threshold {threshold} is not between 0 and 1")
    from tabforge.operators import wide
    keep = list(keep or [])
    types = {f.name: f.dataType for f in df.schema.fields}
    cols = [c for c in (cols or df.columns) if c not in keep and is_numeric_type(types[c])]
    stay = set(wide.keep_uncorrelated(df, wide.plain(cols), threshold)) if cols else set()
    dropped = [c for i, c in enumerate(cols) if i not in stay]
    return df.drop(*dropped) if dropped else df, dropped


def build_features(df: DataFrame, label: str, categorical: list[str] | None = None,
                   trans: list[str] | None = None, max_depth: int = 1,
                   threshold: float = 0.8, persist: bool = True) -> DataFrame:
    """Synthesize -> drop correlated -> label renamed ``target`` (clash refused)."""
    from tabforge.operators.clean import attach_target
    if "target" in [c for c in df.columns if c != label]:
        raise ValueError("Data Frame already contains target column")
    fm = new_features(df, label, categorical, trans, max_depth)
    if persist:
        fm = written(fm, "features")
    numeric = [c for c in fm.columns if c != label and c not in (categorical or [])]
    fm, _ = drop_correlated(fm, threshold, numeric)
    ordered = [c for c in fm.columns if c != label] + [label]
    return attach_target(fm.select(*[col(c) for c in ordered]), label)


# ---------------------------------------------------------------- aggregation primitives

AGGREGATIONS = ("sum", "std", "max", "skew", "min", "mean", "count", "percent_true",
                "num_unique", "mode")


def aggregate_features(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str,
                       prims: list[str], numeric: list[str] | None = None,
                       boolean: list[str] | None = None,
                       categorical: list[str] | None = None) -> DataFrame:
    """Per parent key, aggregates of the child's columns, left-joined to the parent.

    Output names: ``<prim>_<column>``; ``count`` is ``count_rows``.
    """
    for p in prims:
        if p not in AGGREGATIONS:
            raise TypeError(f"unknown aggregation primitive {p!r}")
    types = {f.name: f.dataType for f in child.schema.fields}
    numeric = numeric if numeric is not None else [
        c for c in child.columns if c != child_key and _kind(types[c]) == "numeric"]
    boolean = boolean if boolean is not None else [
        c for c in child.columns if _kind(types[c]) == "bool"]
    categorical = categorical if categorical is not None else []
    k = col(child_key)
    aggs: list[Column] = []
    for p in prims:
        if p == "count":
            aggs.append(F.count(F.lit(1)).alias("count_rows"))
        for c in numeric:
            x = col(c).cast("double")
            if p == "sum":
                aggs.append(F.sum(x).alias(f"sum_{c}"))
            elif p == "std":
                aggs.append(F.stddev_samp(x).alias(f"std_{c}"))
            elif p == "max":
                aggs.append(F.max(x).alias(f"max_{c}"))
            elif p == "min":
                aggs.append(F.min(x).alias(f"min_{c}"))
            elif p == "mean":
                aggs.append(F.avg(x).alias(f"mean_{c}"))
            elif p == "skew":
                aggs.append(adjusted_skew(x).alias(f"skew_{c}"))
        if p == "percent_true":
            for c in boolean:
                aggs.append(F.avg(col(c).cast("double")).alias(f"percent_true_{c}"))
    out = child.groupBy(k.alias("__key")).agg(*aggs) if aggs else None
    if "num_unique" in prims or "mode" in prims:
        # (key, value) counts first: both primitives then reduce one row per value
        for c in (categorical if categorical else numeric):
            vc = (child.where(col(c).isNotNull())
                  .groupBy(k.alias("__key"), col(c).alias("__v")).agg(F.count(F.lit(1)).alias("__n")))
            per = []
            if "num_unique" in prims:
                per.append(F.count(F.lit(1)).alias(f"num_unique_{c}"))
            if "mode" in prims:
                per.append(F.min_by("__v", F.struct((-F.col("__n")).alias("a"), F.col("__v")))
                           .alias(f"mode_{c}"))
            t = vc.groupBy("__key").agg(*per)
            out = t if out is None else out.join(t, "__key", "full")
    res = parent.join(out, col(parent_key) == F.col("__key"), "left").drop("__key")
    if "count" in prims:
        res = res.withColumn("count_rows", F.coalesce(F.col("count_rows"), F.lit(0)))
    return res
