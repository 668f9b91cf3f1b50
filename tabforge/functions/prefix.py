"""Distributed running sum over a *global* order.

A window with an ORDER BY and no PARTITION BY runs in a single task.  Here the
input is range-partitioned on the sort key, written with its range number, and
each range is scanned by a window over that number.  Only the first and the last
group of a range can continue in another one, so two totals per range (a number
of rows bounded by the ranges, whatever the data) give the offsets.  Equal sort
keys always land in the same range, so the result is exact.  Callers pass one
row per distinct key (aggregate first).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabforge.functions.numeric import col
from tabforge.session import scratch_path


def range_totals(ranged: DataFrame, partition_by: list[str], measures: list[str]) -> list:
    """Totals of the first and the last group of each range: two rows a range at most."""
    group = F.struct(F.lit(0).alias("_"), *[col(c) for c in partition_by])
    totals = ranged.groupBy("_pid", group.alias("_group")).agg(*[F.sum(col(m)).alias(f"_t{i}") for i, m in enumerate(measures)])
    ends = ranged.groupBy("_pid").agg(F.min(group).alias("_first"), F.max(group).alias("_last"))
    return (totals.join(ends.withColumnRenamed("_pid", "_end"), F.col("_pid") == F.col("_end"))
            .where(F.col("_group").eqNullSafe(F.col("_first")) | F.col("_group").eqNullSafe(F.col("_last")))
            .select("_pid", "_group", *[f"_t{i}" for i in range(len(measures))]).collect())


def running_sum(df: DataFrame, order: list[Column], measures: list[str],
                partition_by: list[str] | tuple = (), prefix: str = "cum_",
                num_partitions: int | None = None) -> DataFrame:
    """Append ``prefix + m`` = inclusive running sum of each measure.

    ``order``: sort expressions (``F.col('x').desc()`` allowed), unique within
    ``partition_by``.  ``partition_by``: independent groups (e.g. column name).
    """
    partition_by = list(partition_by)
    spark = df.sparkSession
    sort_exprs = [col(c) for c in partition_by] + list(order)
    n = num_partitions or max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2)
    path = scratch_path(spark, "ranges")
    staged = df.repartitionByRange(n, *sort_exprs).withColumn("_pid", F.spark_partition_id())
    staged.write.parquet(path)
    ranged = spark.read.schema(staged.schema).parquet(path)

    # offset of a range = sum of the same group's totals in earlier ranges
    running: dict[tuple, list] = {}
    offsets = []
    for r in sorted(range_totals(ranged, partition_by, measures), key=lambda r: r["_pid"]):
        group = tuple(r["_group"])
        acc = running.setdefault(group, [0] * len(measures))
        if any(acc):
            offsets.append((r["_pid"], r["_group"], acc))
        running[group] = [a + (r[f"_t{i}"] or 0) for i, a in enumerate(acc)]
    w = (Window.partitionBy("_pid", *[col(c) for c in partition_by]).orderBy(*order)
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = ranged.select("*", *[F.sum(col(m)).over(w).alias(prefix + m) for m in measures])
    if not offsets:
        return local.drop("_pid")
    group = F.struct(F.lit(0).alias("_"), *[col(c) for c in partition_by])
    typed = local.select("_pid", group.alias("_group"), F.array(*[col(prefix + m).cast(local.schema[prefix + m].dataType) for m in measures])
                         .alias("_acc")).schema
    table = spark.createDataFrame([(p, g, [float(a) if typed["_acc"].dataType.elementType.typeName() == "double" else a for a in acc])
                                   for p, g, acc in offsets], typed)
    j = local.withColumn("_group", group).join(
        F.broadcast(table.select(F.col("_pid").alias("_op"), F.col("_group").alias("_og"), "_acc")),     # two rows a range at most
        (F.col("_pid") == F.col("_op")) & F.col("_group").eqNullSafe(F.col("_og")), "left")
    keep = [col(c) for c in df.columns]
    return j.select(*keep, *[(col(prefix + m) + F.coalesce(F.get("_acc", F.lit(i)), F.lit(0))).cast(local.schema[prefix + m].dataType)
                             .alias(prefix + m) for i, m in enumerate(measures)])
