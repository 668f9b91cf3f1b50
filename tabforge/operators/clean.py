"""Projection, filter and cleaning operators.

All are narrow projections/filters except ``drop_duplicates`` (one hash
aggregate on the whole row, partial on the map side, so a row repeated a
billion times collapses before the shuffle).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabforge.functions.numeric import col, is_numeric_type, to_double


def coerce_numeric(df: DataFrame, cols: list[str]) -> DataFrame:
    """Cast ``cols`` to DOUBLE; unparsable values and NaN become NULL."""
    _require_list(cols, "numeric features")
    types = {f.name: f.dataType for f in df.schema.fields}
    missing = [c for c in cols if c not in types]
    if missing:
        raise ValueError(f"columns not found: {missing}")
    wanted = set(cols)
    return df.select(*[
        to_double(col(f), types[f]).alias(f) if f in wanted else col(f)
        for f in df.columns])


def filter_labels(df: DataFrame, target: str, labels: list) -> DataFrame:
    """Keep rows whose target, compared as a string, is one of ``labels``."""
    if not isinstance(labels, (list, tuple)) or not labels:
        raise TypeError("labels must be a non-empty list")
    return df.where(col(target).cast("string").isin([str(v) for v in labels]))


def drop_duplicates(df: DataFrame) -> DataFrame:
    """Whole-row distinct (NULL equals NULL)."""
    return df.dropDuplicates()


def remove_invalid_duplicates(df: DataFrame, numeric: list[str], target: str,
                              labels: list) -> DataFrame:
    """C4: coerce numbers, keep valid labels, then drop duplicates - in that order."""
    return drop_duplicates(filter_labels(coerce_numeric(df, numeric), target, labels))


def split_label(df: DataFrame, target: str | int | None = None) -> tuple[DataFrame, DataFrame, str]:
    """(features, label, label name).  ``target`` by name or by position.

    Both frames are projections of the same rows; keep them together (Spark rows
    have no position) and use the name to re-select.
    """
    if target is None:
        target = -1
    if isinstance(target, int):
        target = df.columns[target]
    if target not in df.columns:
        raise ValueError(f"label column {target!r} not found")
    return df.drop(target), df.select(col(target)), target


def split_roles(df: DataFrame, target: str | None = None,
                categorical: list[str] | None = None) -> tuple[list[str], list[str], str | None]:
    """(numeric columns, categorical columns, label) by name."""
    categorical = list(categorical or [])
    feats = [c for c in df.columns if c != target]
    numeric = [c for c in feats if c not in categorical]
    return numeric, [c for c in feats if c in categorical], target


def require_numeric(df: DataFrame, cols: list[str] | None = None) -> None:
    """Schema check, no job."""
    cols = df.columns if cols is None else cols
    types = {f.name: f.dataType for f in df.schema.fields}
    if not all(is_numeric_type(types[c]) for c in cols):
        raise ValueError("Data Frame contains non-numeric values")


def keep_columns(df: DataFrame, features: list[str], target: str | None = None) -> DataFrame:
    """Chosen features in their original order, then the target (never dropped)."""
    target = df.columns[-1] if target is None else target
    keep = set(features)
    return df.select(*[col(c) for c in df.columns if c in keep and c != target], col(target))


def attach_target(df: DataFrame, label: str, features: list[str] | None = None) -> DataFrame:
    """Rename the label to ``target``; refuse when a feature is already named so."""
    features = [c for c in df.columns if c != label] if features is None else features
    if "target" in features:
        raise ValueError("Data Frame already contains target column")
    return df.withColumnRenamed(label, "target")


def _require_list(v, what: str) -> None:
    if not isinstance(v, (list, tuple)) or not all(isinstance(s, str) for s in v):
        raise TypeError(f"{what} must be a list of strings")
