"""Wide feature synthesis (D3, D10, D11): feature matrices of any width without a wide plan.

A ``Recipe`` lists features as places of their operands, without expressions.  Spark
carries the narrow base columns only; a task computes the features it needs, a tile
of them at a time, in numpy batches.  The matrix, where it is wanted, is one
array column.

Decorrelation compares a tile of features with the tiles of those kept so far.  Every
(tile, kept tile) pair is a branch of its own over the rows, so a task holds the products of
one pair; partial products are summed by chunks of features, and a feature hands on whether
it reaches the threshold.  The driver holds three numbers for each feature and the close
pairs within one tile, as bits.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabforge.functions.numeric import col, is_numeric_type
from tabforge.session import written

TILE = 2048               # features of a tile
CHUNK = 64                # features of a tile whose products are summed together
ROWS = 1024               # rows of a numpy batch
ACTIONS = {"add_numeric": np.add, "multiply_numeric": np.multiply}


@dataclass(frozen=True)
class Recipe:
    """Features by place: base columns first, then pairs of earlier places under an action."""

    names: list[str]
    base: list[str]
    action: np.ndarray               # place in ``actions``, -1 for a base column
    left: np.ndarray
    right: np.ndarray
    actions: tuple[str, ...]

    def __len__(self) -> int:
        return len(self.names)

    def values(self, x: np.ndarray, places: np.ndarray) -> np.ndarray:
        """Columns ``places`` of the feature matrix of the rows ``x`` (a column for each base column)."""
        out = np.empty((len(x), len(places)))
        plain = self.action[places] < 0
        out[:, plain] = x[:, places[plain]]
        rest = np.flatnonzero(~plain)
        if len(rest):
            own = places[rest]
            needed, at = np.unique(np.concatenate([self.left[own], self.right[own]]), return_inverse=True)
            below = self.values(x, needed)
            a, b = at[:len(own)], at[len(own):]
            for k, name in enumerate(self.actions):
                s = self.action[own] == k
                out[:, rest[s]] = ACTIONS[name](below[:, a[s]], below[:, b[s]])
        return out


def recipe(columns: list[str], trans: list[str] | None = None, max_depth: int = 1) -> Recipe:
    """The features that ``synth.feature_definitions`` lists for numeric columns, in its order and by its names."""
    if not isinstance(max_depth, int):
        raise TypeError(f"max_depth is {max_depth!r}, not a whole number")
    trans = sorted({"multiply_numeric"} if trans is None else set(trans))
    other = [t for t in trans if t not in ACTIONS]
    if other:
        raise ValueError(f"{other} are not built in wide matrices; use synthesize")
    names, depth = list(columns), [0] * len(columns)
    action, left, right = [-1] * len(names), [-1] * len(names), [-1] * len(names)
    seen = set(names)
    for k, t in enumerate(trans):
        pool = sorted((i for i in range(len(names)) if depth[i] < max_depth), key=names.__getitem__)
        sign = " + " if t == "add_numeric" else " * "
        for p, i in enumerate(pool):
            for j in pool[p + 1:]:
                name, n = names[i] + sign + names[j], 2
                first = name
                while name in seen:                     # two trees can print the same
                    name, n = f"{first} #{n}", n + 1
                seen.add(name)
                names.append(name)
                depth.append(1 + max(depth[i], depth[j]))
                action.append(k)
                left.append(i)
                right.append(j)
    return Recipe(names, list(columns), np.array(action), np.array(left), np.array(right), tuple(trans))


def plain(columns: list[str]) -> Recipe:
    """The columns themselves."""
    return recipe(columns, [], 0)


def _rows(df: DataFrame, r: Recipe) -> DataFrame:
    return df.select(*[col(c).cast("double").alias(f"x{i}") for i, c in enumerate(r.base)])


def _batches(batches):
    """Base values in numpy batches of bounded size, NULL as NaN."""
    for b in batches:
        for lo in range(0, b.num_rows, ROWS):
            part = b.slice(lo, ROWS)
            yield np.stack([c.to_numpy(zero_copy_only=False).astype(float) for c in part.columns], 1)


def matrix(df: DataFrame, r: Recipe, places: list[int] | None = None, passthrough: list[str] | None = None,
           output: str = "features") -> DataFrame:
    """``passthrough`` columns and the features at ``places`` (all by default) as one array of doubles.

    A feature with a NULL or NaN operand is NaN.
    """
    keep = list(passthrough or [])
    if output in keep:
        raise ValueError(f"{output!r} is a column that is passed through")
    at = np.arange(len(r)) if places is None else np.asarray(places, np.int64)
    narrow = df.select(*[col(c) for c in keep], *[col(c).cast("double").alias(f"__x{i}") for i, c in enumerate(r.base)])
    schema = narrow.select(*[col(c) for c in keep], F.array().cast("array<double>").alias(output)).schema
    step = max(1, min(ROWS, (32 << 20) // (8 * max(1, len(at)))))

    def run(batches):
        for b in batches:
            for lo in range(0, b.num_rows, step):
                part = b.slice(lo, step)
                x = np.stack([c.to_numpy(zero_copy_only=False).astype(float) for c in part.columns[len(keep):]], 1)
                v = r.values(x, at)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(v) + 1, dtype=np.int32) * len(at), pa.int32()), pa.array(v.ravel()))
                yield pa.RecordBatch.from_arrays([*part.columns[:len(keep)], lists], [*keep, output])

    return narrow.mapInArrow(run, schema)


def moments(rows: DataFrame, r: Recipe) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rows with a value, mean, sum of squared deviations) of each feature: three numbers a feature reach the driver."""
    tiles = [np.arange(lo, min(lo + TILE, len(r))) for lo in range(0, len(r), TILE)]

    def run(batches):
        n, mean, dev = np.zeros(len(r)), np.zeros(len(r)), np.zeros(len(r))
        for x in _batches(batches):
            for t in tiles:
                v = r.values(x, t)
                here = ~np.isnan(v)
                m = here.sum(0)
                mu = np.where(here, v, 0).sum(0) / np.maximum(m, 1)
                d = mu - mean[t]
                both = np.maximum(n[t] + m, 1)
                dev[t] += (np.where(here, v - mu, 0) ** 2).sum(0) + d * d * n[t] * m / both
                mean[t] += d * m / both
                n[t] += m
        for k, t in enumerate(tiles):
            yield pa.RecordBatch.from_arrays([pa.array([k]), *[pa.array([y[t]], pa.list_(pa.float64())) for y in (n, mean, dev)]],
                                             ["tile", "n", "mean", "dev"])

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        n, mean, dev = (np.stack(pdf[c].to_list()) for c in ("n", "mean", "dev"))
        total = n.sum(0)
        mu = (n * mean).sum(0) / np.maximum(total, 1)
        return pd.DataFrame({"tile": pdf["tile"].iloc[:1], "n": [total], "mean": [mu], "dev": [dev.sum(0) + (n * (mean - mu) ** 2).sum(0)]})

    schema = "tile bigint, n array<double>, mean array<double>, dev array<double>"
    got = rows.mapInArrow(run, schema).groupBy("tile").applyInPandas(merge, schema).toPandas().sort_values("tile")
    if got.empty:
        return np.zeros(len(r)), np.zeros(len(r)), np.zeros(len(r))
    n, mean, dev = (np.concatenate(got[c].to_list()) for c in ("n", "mean", "dev"))
    return n, mean, dev


def _pair_products(rows: DataFrame, r: Recipe, mean: np.ndarray, pair: int, a: np.ndarray, b: np.ndarray, whole: bool) -> DataFrame:
    """Partial products of the centred features ``a`` with ``b``: one row for each chunk of ``a`` and task.

    With gaps, the sums of both features and of their squares over the rows where both are
    present, and the number of these rows, lie beside the products.
    """
    def run(batches):
        sums = np.zeros((len(a), 1 if whole else 6, len(b)))
        for x in _batches(batches):
            v = r.values(x, a) - mean[a]
            w = v if pair == 0 else r.values(x, b) - mean[b]
            if whole:
                sums[:, 0] += v.T @ w
                continue
            m, k = (~np.isnan(v)).astype(float), (~np.isnan(w)).astype(float)
            v, w = np.where(m > 0, v, 0), np.where(k > 0, w, 0)
            for s, (p, q) in enumerate(((v, w), (v, k), (m, w), (v * v, k), (m, w * w), (m, k))):
                sums[:, s] += p.T @ q
        for lo in range(0, len(a), CHUNK):
            yield pa.RecordBatch.from_arrays([pa.array([pair]), pa.array([lo]), pa.array([sums[lo:lo + CHUNK].ravel()], pa.list_(pa.float64()))],
                                             ["pair", "lo", "sums"])

    return rows.mapInArrow(run, "pair bigint, lo bigint, sums array<double>")


def _r(row: np.ndarray, size: int, dev_a: float, dev_b: np.ndarray) -> np.ndarray:
    """Correlations of one feature with ``size`` others from its summed products; NaN for a constant one."""
    if len(row) == 1:
        row = row[0]
        cov, va, vb, sa, sb = row, np.full(size, dev_a), dev_b, np.full(size, dev_a), dev_b
    else:
        xy, x, y, sa, sb, c = row
        c = np.maximum(c, 1)
        cov, va, vb = xy - x * y / c, sa - x * x / c, sb - y * y / c
    flat = (va <= 1e-12 * np.maximum(sa, 1e-300)) | (vb <= 1e-12 * np.maximum(sb, 1e-300))
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(flat, np.nan, cov / np.sqrt(va * vb))


def keep_uncorrelated(df: DataFrame, r: Recipe, threshold: float = 0.8, parts: int | None = None) -> list[int]:
    """D10 at any width: places of the features that stay.

    In order, a feature goes if |r| >= ``threshold`` with an earlier one that stayed; NaN (a
    constant feature) never goes and drops none.  ``df`` is read once for the moments and once for
    each tile pair: pass a written table.  ``parts``: partial products of a tile pair (by default
    as many as keep all cores busy; it does not grow with the rows).
    """
    rows = _rows(df, r)
    n, mean, dev = moments(rows, r)
    total = n.max(initial=0)
    whole = bool((n == total).all()) and bool(np.isfinite(dev).all())
    # a feature that hardly differs from its mean is constant: rounding is all it holds
    if whole:
        dev = np.where(dev <= 1e-24 * total * mean * mean, 0.0, dev)
    cores = rows.sparkSession.sparkContext.defaultParallelism
    kept: list[int] = []
    for lo in range(0, len(r), TILE):
        a = np.arange(lo, min(lo + TILE, len(r)))
        others = [a] + [np.array(kept[s:s + TILE], np.int64) for s in range(0, len(kept), TILE)]
        share = parts or max(2, -(-cores // len(others)))
        part = rows.coalesce(share)
        products = None
        for k, b in enumerate(others):
            p = _pair_products(part, r, mean, k, a, b, whole)
            products = p if products is None else products.unionAll(p)

        def close(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
            k, lo = (int(v) for v in key)
            b = others[k]
            sums = sum(pdf["sums"]).reshape(-1, 1 if whole else 6, len(b))
            out = []
            for i, row in enumerate(sums, lo):
                corr = np.abs(_r(row, len(b), dev[a[i]], dev[b])) >= threshold
                if k:
                    out.append((i, bool(corr.any()), None))
                elif corr[:i].any():
                    out.append((i, False, np.packbits(corr[:i]).tobytes()))
            return pd.DataFrame(out, columns=["i", "goes", "near"])

        got = products.groupBy("pair", "lo").applyInPandas(close, "i bigint, goes boolean, near binary").where("goes OR near IS NOT NULL").collect()
        goes = {x["i"] for x in got if x["goes"]}
        near = {x["i"]: np.unpackbits(np.frombuffer(x["near"], np.uint8), count=x["i"]).astype(bool) for x in got if x["near"] is not None}
        stay = np.ones(len(a), bool)
        for i in range(len(a)):
            stay[i] = i not in goes and not (i in near and (near[i] & stay[:i]).any())
        kept.extend(int(v) for v in a[stay])
    return kept


def build_wide_features(df: DataFrame, label: str, categorical: list[str] | None = None, trans: list[str] | None = None,
                        max_depth: int = 1, threshold: float = 0.8) -> tuple[DataFrame, list[str]]:
    """D11 at any width: (categorical columns, ``features`` array of the uncorrelated ones, ``target``), and their names.

    Features are doubles.  The base columns are written once below the checkpoint folder.
    """
    categorical = list(categorical or [])
    if "target" in [c for c in df.columns if c != label]:
        raise ValueError("Data Frame already contains target column")
    types = {f.name: f.dataType for f in df.schema.fields}
    base = [c for c in df.columns if c != label and c not in categorical]
    if not all(is_numeric_type(types[c]) for c in base):
        raise ValueError("Data Frame contains non-numeric values")
    table = written(df.select(*[col(c) for c in [*base, *categorical, label]]), "wide-base")
    r = recipe(base, trans, max_depth)
    kept = keep_uncorrelated(table, r, threshold)
    out = matrix(table, r, kept, [*categorical, label])
    return out.select(*[col(c) for c in categorical], "features", col(label).alias("target")), [r.names[i] for i in kept]
