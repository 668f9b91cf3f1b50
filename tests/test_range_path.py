"""Every operator built on the running sum against DuckDB at sf0.001; plus Kendall
against a brute-force pair count on continuous values."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "scripts"))

from check_oracle import compare, duck  # noqa: E402

from tabforge.operators import profile  # noqa: E402
from tabforge.plans import registry  # noqa: E402

SF = "/root/testdata/sf0.001"
RANGE_QUERIES = ["roc_curve", "roc_curve_dropped", "fpr_fnr_dropped", "roc_auc", "pr_curve", "pr_auc", "fpr_fnr",
                 "scale_robust", "corr_spearman", "corr_kendall", "sample_exact", "split_exact",
                 "stratified_folds"]


@pytest.mark.parametrize("name", RANGE_QUERIES)
def test_range_path_matches_oracle(spark, name):
    qs, ors = registry.queries(), registry.oracle_sql()
    assert compare(spark, duck(SF), name, qs[name], ors[name], SF) is None


def test_kendall_query_holds_the_continuous_column(spark):
    rows = {(r["feature_1"], r["feature_2"]): r["r"] for r in registry.queries()["corr_kendall"](spark, SF).collect()}
    names = ["f1", "f2", "f3", "f4", "ln"]
    assert {tuple(sorted(p)) for p in rows} >= {(a, b) for i, a in enumerate(names) for b in names[i:]}
    assert rows[("f2", "f2")] == pytest.approx(1) and rows.get(("f2", "f1"), rows.get(("f1", "f2"))) == pytest.approx(-0.006527893556069719, abs=1e-9)


def test_kendall_brute_force(spark):
    import itertools
    rows = [(float((i * 37) % 23), float((i * 11) % 7) + (i % 3) * 0.5, float(i % 4)) for i in range(60)]
    df = spark.createDataFrame(rows, ["a", "b", "c"])
    got = {(r["feature_1"], r["feature_2"]): r["r"] for r in profile.kendall(df, ["a", "b", "c"]).collect()}

    def tau(u, v):
        nc = nd = tx = ty = 0
        for (x1, y1), (x2, y2) in itertools.combinations(zip(u, v), 2):
            s = (x1 - x2) * (y1 - y2)
            if x1 == x2 and y1 == y2:
                continue
            if x1 == x2:
                tx += 1
            elif y1 == y2:
                ty += 1
            elif s > 0:
                nc += 1
            else:
                nd += 1
        return (nc - nd) / ((nc + nd + tx) * (nc + nd + ty)) ** 0.5

    cols = {"a": [r[0] for r in rows], "b": [r[1] for r in rows], "c": [r[2] for r in rows]}
    for (f1, f2), r in got.items():
        assert r == pytest.approx(tau(cols[f1], cols[f2]), abs=1e-12)


def test_weighted_inversions_brute_force():
    import numpy as np
    rng = np.random.default_rng(4)
    for n in (0, 1, 2, 63, 64, 65, 300, 1500):
        for span in (2, 50, 10 ** 6):
            y, w = rng.integers(0, span, n).astype(float), rng.integers(1, 5, n).astype(float)
            want = float((w[:, None] * w[None, :] * np.triu(y[:, None] > y[None, :], 1)).sum())
            assert profile.weighted_inversions(y, w) == want


@pytest.mark.parametrize("block", [1 << 20, 40])
def test_kendall_blocks_nulls_and_hot_values(spark, monkeypatch, block):
    """Many ranges, a value with a third of the rows, NULL and NaN: as over all pairs of rows."""
    import numpy as np
    monkeypatch.setattr(profile, "KENDALL_BLOCK", block)
    rng = np.random.default_rng(1)
    rows = [(float(rng.integers(40)) if i % 3 else 7.0, float(rng.normal()) if i % 11 else None, float(rng.integers(3)) if i % 7 else float("nan"), 1.0)
            for i in range(500)]
    df = spark.createDataFrame(rows, ["a", "b", "c", "same"]).repartition(3)
    got = {(r["feature_1"], r["feature_2"]): r["r"] for r in profile.kendall(df, ["a", "b", "c", "same"]).collect()}
    v = {k: np.array([np.nan if r[i] is None else r[i] for r in rows]) for i, k in enumerate(["a", "b", "c", "same"])}
    for (f1, f2), r in got.items():
        ok = ~np.isnan(v[f1]) & ~np.isnan(v[f2])
        sx, sy = (np.sign(v[k][ok][:, None] - v[k][ok][None, :]) for k in (f1, f2))
        under = ((sx != 0).sum() * (sy != 0).sum()) ** 0.5
        assert r == (pytest.approx((sx * sy).sum() / under, abs=1e-12) if under else None)
    assert len(got) == 10 and got["same", "same"] is None
    assert profile.kendall(df.where("false"), ["a", "b"]).where("r IS NULL").count() == 3
