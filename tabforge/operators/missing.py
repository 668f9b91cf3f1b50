"""Missing values and encoding.

Fit functions run a bounded number of aggregations and return small state;
apply functions are projections and joins with fitted tables.  Nothing
row-sized ever reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabforge.functions.numeric import col
from tabforge.functions.partitioning import computed_once
from tabforge.session import scratch_path, written


def _long_counts(df: DataFrame, cols: list[str], by: str | None = None) -> DataFrame:
    """One aggregate row per (class) -> long table (column_name, n_rows, n_missing)."""
    keys = [col(by)] if by else []
    aggs = [F.count(F.lit(1)).alias("__rows")]
    aggs += [(F.count(F.lit(1)) - F.count(col(c))).alias(f"__m{i}") for i, c in enumerate(cols)]
    wide = df.groupBy(*keys).agg(*aggs)
    stack = ", ".join(f"'{c.replace(chr(39), chr(39) * 2)}', `__m{i}`" for i, c in enumerate(cols))
    ids = [by] if by else []
    return wide.selectExpr(*[f"`{i}`" for i in ids], "`__rows` AS n_rows",
                           f"stack({len(cols)}, {stack}) AS (column_name, n_missing)")


def missing_counts(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """M1: (column_name, n_missing) for every column; one aggregation."""
    cols = df.columns if cols is None else cols
    return _long_counts(df, cols).select("column_name", F.col("n_missing").cast("bigint"))


def missing_percent(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """M2: (column_name, pct_missing) = 100 * missing / rows (DOUBLE arithmetic)."""
    cols = df.columns if cols is None else cols
    return _long_counts(df, cols).select(
        "column_name",
        (F.lit(100.0) * F.col("n_missing") / F.col("n_rows")).alias("pct_missing"))


def sparse_columns(df: DataFrame, threshold: float | None = 50,
                   cols: list[str] | None = None) -> list[str]:
    """Columns whose missing percent is strictly above ``threshold``."""
    if threshold is None:
        return []
    rows = missing_percent(df, cols).where(F.col("pct_missing") > float(threshold)).collect()
    return [r["column_name"] for r in rows]


def drop_sparse_columns(df: DataFrame, threshold: float | None = 50,
                        cols: list[str] | None = None) -> DataFrame:
    """M3: drop columns with more than ``threshold`` percent missing."""
    drop = sparse_columns(df, threshold, cols)
    return df.drop(*drop) if drop else df


def drop_missing_rows(df: DataFrame) -> DataFrame:
    """M4: drop rows with any NULL."""
    return df.dropna(how="any")


# ---------------------------------------------------------------- imputation

def fit_means(df: DataFrame, cols: list[str]) -> dict[str, float | None]:
    if not cols:
        return {}
    r = df.agg(*[F.avg(col(c)).alias(c) for c in cols]).first()
    return {c: r[c] for c in cols}


def apply_fill(df: DataFrame, values: dict, means: bool = False) -> DataFrame:
    """Replace NULLs by literal values; columns filled with ``means`` become DOUBLE, others keep their type."""
    types = {f.name: "double" if means else f.dataType for f in df.schema.fields}
    return df.select(*[
        F.coalesce(col(c).cast(types[c]), F.lit(values[c]).cast(types[c])).alias(c)
        if values.get(c) is not None else col(c) for c in df.columns])


def impute_mean(df: DataFrame, cols: list[str]) -> DataFrame:
    """M5: numeric NULLs <- column mean."""
    return apply_fill(df, fit_means(df, cols), means=True)


def value_counts(df: DataFrame, cols: list[str]) -> DataFrame:
    """(column_name, value, n) for non-NULL values of each column, one shuffle.

    The unpivot is followed by a map-side partial aggregate, so a value that
    holds a third of all rows is reduced to one row per task before the shuffle.
    """
    stack = ", ".join(f"'{c.replace(chr(39), chr(39) * 2)}', CAST({_bq(c)} AS STRING)"
                      for c in cols)
    long = df.selectExpr(f"stack({len(cols)}, {stack}) AS (column_name, value)")
    return (long.where(F.col("value").isNotNull())
            .groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n")))


def modes_from_counts(counts: DataFrame) -> dict[str, str]:
    """Most frequent value per column; ties -> smallest value."""
    rows = (counts.groupBy("column_name")
            .agg(F.min_by("value", F.struct((-F.col("n")).alias("k"), F.col("value")))
                 .alias("mode"))
            .collect())
    return {r["column_name"]: r["mode"] for r in rows}


def fit_modes(df: DataFrame, cols: list[str]) -> dict[str, str]:
    if not cols:
        return {}
    return modes_from_counts(value_counts(df, cols))


def impute_mode(df: DataFrame, cols: list[str]) -> DataFrame:
    """M6: categorical NULLs <- most frequent value (ties: smallest)."""
    return apply_fill(df, fit_modes(df, cols))


# ---------------------------------------------------------------- rare categories

def rare_from_counts(counts: DataFrame, threshold: int,
                     bump: dict[str, tuple[str, int]] | None = None) -> dict[str, DataFrame]:
    """{column: DataFrame (column_name, value)} of rare values (count <= threshold).

    ``bump``: {column: (mode, nulls)} - counts as they are after mode filling.
    The rare values are one written table, so applying them computes nothing anew.
    """
    n = F.col("n")
    if bump:
        for c, (mode, extra) in bump.items():
            n = F.when((F.col("column_name") == c) & (F.col("value") == mode),
                       n + F.lit(extra)).otherwise(n)
    path = scratch_path(counts.sparkSession, "rare")
    counts.where(n <= threshold).select("column_name", "value").write.parquet(path)
    rare = counts.sparkSession.read.schema("column_name string, value string").parquet(path)
    present = [r[0] for r in rare.select("column_name").distinct().collect()]     # one row a column at most
    return {c: rare.where(F.col("column_name") == c) for c in sorted(present)}


def apply_lump(df: DataFrame, rare: dict[str, DataFrame], other: str = "Other") -> DataFrame:
    """Replace rare values by ``other``: a left join with the fitted rare values of each column.

    A hot value has no partner among the rare ones, so its rows can be split;
    on a stream the join is stream-static.
    """
    out = df
    for c, table in rare.items():
        side = table.select(F.col("value").alias("__rare"))
        joined = out.join(side, col(c).cast("string") == F.col("__rare"), "left")
        out = joined.select(*[
            F.when(F.col("__rare").isNotNull(), F.lit(other)).otherwise(col(x).cast("string")).alias(x)
            if x == c else col(x) for x in df.columns])
    return out


def lump_rare(df: DataFrame, cols: list[str], threshold: int = 1,
              other: str = "Other") -> DataFrame:
    """M7: values seen at most ``threshold`` times (NULLs not counted) -> ``other``."""
    if not isinstance(threshold, int):
        raise TypeError(f"threshold is {threshold!r}, not a whole number")
    if not cols:
        return df
    return apply_lump(df, rare_from_counts(value_counts(df, cols), threshold), other)


# ---------------------------------------------------------------- composed

def fit_missing(df: DataFrame, numeric: list[str], categorical: list[str] | None = None,
                method: str = "fill", drop_threshold: float | None = 50,
                category_threshold: int = 1, gate: bool = True) -> dict:
    """M8 fit: one profile aggregation + one category-count aggregation."""
    if method not in ("fill", "drop"):
        raise ValueError(f"unknown handling of missing values {method!r}")
    if drop_threshold is not None:
        try:
            float(drop_threshold)
        except (TypeError, ValueError):
            raise TypeError(f"drop_threshold is {drop_threshold!r}, neither a number nor None") from None
    if not isinstance(category_threshold, int):
        raise TypeError(f"category_threshold is {category_threshold!r}, not a whole number")
    categorical = list(categorical or [])
    numeric = list(numeric)
    cols = df.columns
    mean_idx = {c: i for i, c in enumerate(numeric)}
    prof = df.agg(F.count(F.lit(1)).alias("__rows"),
                  *[(F.count(F.lit(1)) - F.count(col(c))).alias(f"__m{i}")
                    for i, c in enumerate(cols)],
                  *[F.avg(col(c)).alias(f"__a{i}") for i, c in enumerate(numeric)]).first()
    rows = prof["__rows"]
    miss = {c: prof[f"__m{i}"] for i, c in enumerate(cols)}
    state = {"method": method, "dropped": [], "means": {}, "modes": {}, "rare": {},
             "numeric": numeric, "categorical": categorical, "active": True}
    if gate and not any(miss.values()):
        state["active"] = False
        return state
    if method == "drop":
        return state
    if drop_threshold is not None and rows:
        state["dropped"] = [c for c in cols if 100.0 * miss[c] / rows > float(drop_threshold)]
    numeric = [c for c in numeric if c not in state["dropped"]]
    categorical = [c for c in categorical if c not in state["dropped"]]
    state["numeric"], state["categorical"] = numeric, categorical
    if any(miss[c] for c in numeric):
        state["means"] = {c: prof[f"__a{mean_idx[c]}"] for c in numeric}
    if categorical:
        counts = written(value_counts(df, categorical), "counts")      # read for the modes and for the rare values
        if any(miss[c] for c in categorical):
            state["modes"] = modes_from_counts(counts)
        bump = {c: (state["modes"][c], miss[c]) for c in categorical
                if c in state["modes"] and miss[c]}
        state["rare"] = rare_from_counts(counts, category_threshold, bump)
    return state


def apply_missing(df: DataFrame, state: dict, other: str = "Other") -> DataFrame:
    """M8 apply: the fitted drop / fill / lump as projections."""
    if not state["active"]:
        return df
    if state["method"] == "drop":
        return drop_missing_rows(df)
    if state["dropped"]:
        df = df.drop(*state["dropped"])
    if state["means"]:
        df = apply_fill(df, state["means"], means=True)
    if state["modes"]:
        df = apply_fill(df, state["modes"])
    if state["rare"]:
        df = apply_lump(df, state["rare"], other)
    return df


def handle_missing(df: DataFrame, numeric: list[str], categorical: list[str] | None = None,
                   method: str = "fill", drop_threshold: float | None = 50,
                   category_threshold: int = 1, gate: bool = True) -> DataFrame:
    """M8: any missing? -> drop rows, or (sparse columns -> mean -> mode -> lump).

    The input is read by the profile, the counts and the result, so an input behind a
    shuffle (such as a de-duplication) is written first.
    """
    df = computed_once(df, "missing")
    state = fit_missing(df, numeric, categorical, method, drop_threshold,
                        category_threshold, gate)
    return apply_missing(df, state)


# ---------------------------------------------------------------- encoding, profile

def fit_label_encoder(df: DataFrame, target: str) -> DataFrame:
    """(label, code): sorted distinct labels -> 0..k-1, as a written table."""
    from tabforge.functions.prefix import running_sum
    labels = df.select(col(target).alias("label")).where(F.col("label").isNotNull()).distinct()
    codes = running_sum(labels.withColumn("one", F.lit(1)), [F.col("label").asc()], ["one"]).select(
        "label", (F.col("cum_one") - 1).cast("int").alias("code"))
    path = scratch_path(df.sparkSession, "labels")
    codes.write.parquet(path)
    return df.sparkSession.read.schema(codes.schema).parquet(path)


def apply_label_encoder(df: DataFrame, target: str, labels: DataFrame) -> DataFrame:
    """``target`` replaced by its code; unseen labels become NULL.  Works on streams (stream-static join)."""
    side = labels.select(F.col("label").alias("__label"), F.col("code").alias("__code"))
    joined = df.join(side, col(target) == F.col("__label"), "left")
    return joined.select(*[F.col("__code").alias(c) if c == target else col(c) for c in df.columns])


def encode_target(df: DataFrame, target: str) -> DataFrame:
    """M9: sorted distinct labels -> 0..k-1."""
    df = computed_once(df, "encode")
    return apply_label_encoder(df, target, fit_label_encoder(df, target))


def missing_by_class(df: DataFrame, target: str, cols: list[str] | None = None) -> DataFrame:
    """(target, column_name, n_missing, n_present) per class and column."""
    cols = [c for c in (df.columns if cols is None else cols) if c != target]
    return _long_counts(df, cols, by=target).select(
        col(target), "column_name", F.col("n_missing").cast("bigint").alias("n_missing"),
        (F.col("n_rows") - F.col("n_missing")).cast("bigint").alias("n_present"))


def _bq(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
