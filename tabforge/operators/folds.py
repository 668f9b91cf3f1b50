"""Train/test split, stratified folds, class weights (L1-L3).

Folds need a row's position inside its class.  A ``row_number`` window
partitioned by a binary label would put half of the table in one task, so the
position is a distributed running count per class instead (range partitions
on (class, order), exact).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabforge.functions.numeric import col
from tabforge.functions.prefix import running_sum
from tabforge.session import written
from tabforge.sources.io import first_k_flag


def split(df: DataFrame, test: float = 0.3, seed: int = 0, keys: list[str] | None = None,
          bucket: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """L1 (fast): deterministic hash split, no shuffle.

    A row is in the test part when ``bucket`` (default: seeded hash of
    ``keys`` mapped to [0, 1)) is below ``test``; without keys, ``randomSplit``.
    """
    if not 0 < test < 1:
        raise ValueError("test fraction must be in (0, 1)")
    if bucket is None and not keys:
        tr, te = df.randomSplit([1 - test, test], seed=seed)
        return tr, te
    if bucket is None:
        bucket = F.pmod(F.xxhash64(*[col(c) for c in keys], F.lit(seed)), F.lit(1_000_003)) \
            / F.lit(1_000_003.0)
    flag = bucket < F.lit(test)
    return df.where(~flag), df.where(flag)


def split_exact(df: DataFrame, test: float = 0.3, order: list[Column] | None = None,
                lead: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """L1 (exact): the first round(test*n) rows in ``order`` form the test part.

    ``lead``: the numeric first sort key (ascending), which lets the cut be
    found without positioning every row."""
    n = df.count()
    k = int(round(test * n))
    flagged = first_k_flag(df, k, order or [], out="__test", lead=lead, n=n)
    return (flagged.where(~F.col("__test")).drop("__test"),
            flagged.where(F.col("__test")).drop("__test"))


def assign_folds(df: DataFrame, label: str, k: int = 5, order: list[Column] | None = None,
                 out: str = "fold") -> DataFrame:
    """L2: fold = (position within class - 1) mod k, positions in ``order``."""
    keyed = df.withColumn("__rid", F.monotonically_increasing_id()).withColumn("__one", F.lit(1))
    pos = running_sum(keyed, list(order or []) + [F.col("__rid").asc()], ["__one"],
                      partition_by=[label])
    return pos.withColumn(out, ((F.col("cum___one") - 1) % k).cast("int")) \
              .drop("__rid", "__one", "cum___one")


def deal_folds(df: DataFrame, label: str, k: int = 5, out: str = "fold") -> DataFrame:
    """L2 without an order: fold = (position within class - 1) mod k, rows in the order they are read.

    The table is written once, each row with its task and its running number within the
    class in that task; the classes' counts by task (a row for each) are the offsets.  No
    sort and no shuffle of rows.  Folds of a class differ by one row at most; a NULL
    label is a class of its own.
    """
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields]
    staged = written(df.mapInArrow(_numbered(label), ", ".join([*fields, "__task long", "__at long"])), "dealt")
    counts = staged.groupBy(col(label).alias("__class"), F.col("__task").alias("__of")).agg(F.count("*").alias("__n"))
    before = F.sum("__n").over(Window.partitionBy("__class").orderBy("__of").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select("__class", "__of", F.coalesce(before, F.lit(0)).alias("__before"))
    placed = staged.join(F.broadcast(offsets), col(label).eqNullSafe(F.col("__class")) & (F.col("__task") == F.col("__of")))   # tasks x classes rows
    return placed.withColumn(out, ((F.col("__before") + F.col("__at")) % k).cast("int")).select(*[col(c) for c in df.columns], out)


def _numbered(label: str):
    def run(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext
        task, seen = TaskContext.get().partitionId(), {}
        for b in batches:
            if not b.num_rows:
                continue
            coded = b.column(b.schema.get_field_index(label)).dictionary_encode(null_encoding="encode")
            codes, at = coded.indices.to_numpy(zero_copy_only=False), np.empty(b.num_rows, np.int64)
            for i, value in enumerate(coded.dictionary.to_pylist()):
                rows = np.flatnonzero(codes == i)
                at[rows] = seen.get(value, 0) + np.arange(len(rows))
                seen[value] = seen.get(value, 0) + len(rows)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.full(b.num_rows, task)), pa.array(at)],
                                             [*b.schema.names, "__task", "__at"])
    return run


def class_weight_value(df: DataFrame, label: str) -> float:
    r = df.agg(F.sum(F.when(col(label) == 0, 1).otherwise(0)).alias("n0"),
               F.sum(F.when(col(label) == 1, 1).otherwise(0)).alias("n1")).first()
    return (r["n0"] / r["n1"]) if r["n1"] else 1.0


def with_class_weight(df: DataFrame, label: str, out: str = "weight",
                      ratio: float | None = None) -> DataFrame:
    """L3: weight of class 1 = n0/n1, else 1."""
    ratio = class_weight_value(df, label) if ratio is None else ratio
    return df.withColumn(out, F.when(col(label) == 1, F.lit(float(ratio))).otherwise(F.lit(1.0)))
