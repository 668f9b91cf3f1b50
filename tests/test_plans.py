"""Plan checks: the JVM-only operators stay JVM-only, scans are pruned, and a
large running sum never becomes a window without PARTITION BY."""

import re

import pytest
from pyspark.sql import functions as F

from tabforge.functions import prefix
from tabforge.plans import registry

SF = "/root/testdata/sf0.001"
JVM_ONLY = ["coerce_numeric", "clean_invalid_dups", "handle_missing", "encode_target",
            "scale_standard", "scale_minmax", "histogram", "corr_pearson", "dfs_depth2",
            "dfs_dates", "dfs_text", "agg_mode", "select_chi2", "classify", "confusion",
            "log_loss", "f1_at_half", "best_trial", "power_yj_fixed"]


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", JVM_ONLY)
def test_no_python_in_plan(spark, name):
    plan = _plan(registry.queries()[name](spark, SF))
    assert not re.search(r"BatchEvalPython|ArrowEvalPython|MapInPandas|FlatMapGroupsInPandas", plan)


def test_scan_is_pruned(spark):
    plan = _plan(registry.queries()["roc_auc"](spark, SF))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert schemas and all("l_shipdate" not in s and "l_tax" not in s for s in schemas)


def test_running_sum_has_no_global_window(spark):
    df = spark.range(1000).select(F.col("id").alias("k"), F.lit(1).alias("v"))
    plan = _plan(prefix.running_sum(df, [F.col("k").asc()], ["v"]))
    assert "_pid" in plan and "Exchange SinglePartition" not in plan and "InPandas" not in plan


@pytest.mark.parametrize("values", [500, 5000])
def test_running_sum_collects_two_rows_a_range(spark, monkeypatch, values):
    seen = []
    real = prefix.range_totals
    monkeypatch.setattr(prefix, "range_totals", lambda *a: seen.append(real(*a)) or seen[-1])
    df = spark.range(values).select((F.col("id") % (values // 2)).alias("g"), F.col("id").alias("k"), F.lit(1).alias("v"))
    out = prefix.running_sum(df, [F.col("k").asc()], ["v"], partition_by=["g"], num_partitions=4)
    assert {r[0] for r in out.groupBy("g").agg(F.max("cum_v")).select("max(cum_v)").collect()} == {2}
    assert len(seen[0]) <= 8
