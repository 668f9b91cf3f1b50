"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints ONE JSON line.

Each query is executed in full through the ``noop`` sink (no collect), after
an unbilled warm-up pass of the same queries on sf0.001 (JIT, Python workers).
BENCH_QUERIES=a,b,c restricts the set.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "preprocess_summary", "preprocess_chain", "clean_invalid_dups", "handle_missing",
    "encode_target", "scale_robust", "power_yj_fit", "sample_exact", "stratified_folds",
    "histogram_by_class", "corr_spearman", "dfs_depth2", "agg_mode", "agg_num_unique",
    "drop_correlated", "select_chi2", "roc_curve", "roc_auc", "pr_auc", "evaluate",
    "best_trial", "boost_train", "staged_f1", "importance_gain", "sampled_shap", "tree_shap",
    "corr_kendall",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    wanted = os.environ.get("BENCH_QUERIES")
    names = wanted.split(",") if wanted else HEADLINE
    from tabforge.plans import registry
    from tabforge.session import local_session
    spark = local_session(cpus, shuffle_partitions=max(8, int(cpus) * 2))
    qs = registry.queries()
    # warm-up (JIT, Python workers): every headline query once on the smallest
    # sibling data, not billed
    warm = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    if os.path.isdir(warm) and warm != sf_dir.rstrip("/"):
        for n in names:
            qs[n](spark, warm).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for n in names:
        spark.catalog.clearCache()          # no query reads what another one left
        t0 = time.time()
        qs[n](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[n] = round(time.time() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times,
                      "sf": float(m.group(1)) if m else None}))


if __name__ == "__main__":
    main()
