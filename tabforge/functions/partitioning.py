"""Parallelism guard for CPU-heavy per-row stages (numpy in ``mapInPandas``).

A big input already arrives in thousands of splits, and an extra shuffle of
it would cost more than it saves; a small or unsplittable input (one parquet
row group) arrives as one task and would leave the cluster idle.  So rows are
spread round-robin only when the plan has fewer partitions than the cluster
runs at once.  Only shuffle-free plans are inspected: for those, counting
partitions just lists the file splits (no job); anything after a shuffle
already has the configured shuffle parallelism and is left alone (asking an
adaptive plan for its partitions would run its shuffle stages).
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame

_SHUFFLING = re.compile(r"\b(Aggregate|Join|Repartition\w*|Sort|Window|Deduplicate\w*|Distinct|"
                        r"Expand|Union|Generate|MapInPandas|Python\w*)\b")


def computed_once(df: DataFrame, name: str) -> DataFrame:
    """``df`` written, if several passes over it would each repeat a shuffle; a plain scan stays as it is."""
    from tabforge.session import written
    return written(df, name) if _SHUFFLING.search(df._jdf.queryExecution().optimizedPlan().toString()) else df


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    if _SHUFFLING.search(plan):
        return df
    target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < target:
        return df.repartition(target)
    return df
