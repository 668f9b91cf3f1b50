"""Distributed running sum equals the single-task window; curve goldens."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from tabforge.functions.prefix import running_sum
from tabforge.operators import metrics as M


def test_running_sum_range_path_matches_window(spark):
    df = spark.range(0, 5000).select(
        (F.col("id") % 7).cast("string").alias("g"), F.col("id").alias("k"),
        (F.col("id") % 13).alias("v"))
    w = Window.partitionBy("g").orderBy(F.col("k").desc())
    a = df.withColumn("cum_v", F.sum("v").over(w))
    b = running_sum(df, [F.col("k").desc()], ["v"], partition_by=["g"], num_partitions=5)
    ra = sorted(tuple(r) for r in a.collect())
    rb = sorted(tuple(r) for r in b.collect())
    assert ra == rb


def test_roc_and_pr_small(spark):
    rows = [(0, 0.1), (0, 0.4), (1, 0.35), (1, 0.8)]
    df = spark.createDataFrame(rows, ["label", "score"])
    roc = sorted(tuple(r) for r in M.roc_curve(df).collect())
    assert (1.8, 0.0, 0.0) in roc  # leading point: max + 1
    assert M.roc_auc(df).first()[0] == 0.75
    pr = M.pr_curve(df).collect()
    # first point (lowest threshold kept) has full recall, end point (precision 1, recall 0)
    assert any(r["threshold"] is None and r["precision"] == 1.0 and r["recall"] == 0.0
               for r in pr)
    assert min(r["threshold"] for r in pr if r["threshold"] is not None) == 0.35
    conf = {(r["actual"], r["predicted"]): r["n"] for r in M.confusion(df).collect()}
    assert conf == {(0, 0): 2, (0, 1): 0, (1, 0): 1, (1, 1): 1}


def test_roc_drop_intermediate_range_path(spark):
    df = spark.range(0, 3000).select(
        (F.col("id") % 3 == 0).cast("int").alias("label"),
        (F.col("id") % 101 / 101.0).alias("score"))
    full = M.roc_curve(df, drop_intermediate=True).count()
    assert 2 < full <= 102
