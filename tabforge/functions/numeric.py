"""Column-level helpers shared by all operators (JVM-side expressions only).

Null rules (hold everywhere):
* unparsable numbers become NULL, never errors: ``try_cast`` with a guard for
  the Java-only float suffixes (``1d``, ``2f``) that a plain number parser rejects;
* NaN is turned into NULL once at ingest, so NULL is the only missing value;
* correlation uses ``try_divide`` so a constant column gives NULL, not an error.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
                 T.DoubleType, T.DecimalType)


def q(name: str) -> str:
    """Back-tick a column name (names may hold spaces, '+', '*')."""
    return "`" + name.replace("`", "``") + "`"


def col(name: str) -> Column:
    return F.col(q(name))


def nan_to_null(c: Column) -> Column:
    return F.when(F.isnan(c), F.lit(None).cast("double")).otherwise(c)


def to_double(c: Column, source_type: T.DataType | None = None) -> Column:
    """Coerce any column to DOUBLE; invalid -> NULL, NaN -> NULL."""
    if source_type is not None and isinstance(source_type, NUMERIC_TYPES):
        return nan_to_null(c.cast("double"))
    s = F.trim(c.cast("string"))
    guarded = F.when(s.rlike("[dDfF]$"), F.lit(None).cast("string")).otherwise(s)
    return nan_to_null(guarded.try_cast("double"))


def is_numeric_type(dt: T.DataType) -> bool:
    return isinstance(dt, NUMERIC_TYPES)


def numeric_columns(df: DataFrame, exclude: list[str] | tuple = ()) -> list[str]:
    return [f.name for f in df.schema.fields
            if is_numeric_type(f.dataType) and f.name not in exclude]


def safe_corr(x: Column, y: Column) -> Column:
    """Pearson r as an aggregate; NULL for a constant column (no error).

    Pairwise-complete: only rows where both sides are non-null count.
    """
    both = x.isNotNull() & y.isNotNull()
    xx = F.when(both, x)
    yy = F.when(both, y)
    return F.try_divide(F.covar_pop(xx, yy),
                        F.stddev_pop(xx) * F.stddev_pop(yy))


def adjusted_skew(c: Column) -> Column:
    """Bias-adjusted sample skewness sqrt(n(n-1))/(n-2) * g1, NULL for n < 3."""
    n = F.count(c).cast("double")
    return F.when(n >= 3, F.sqrt(n * (n - 1)) / (n - 2) * F.skewness(c))

