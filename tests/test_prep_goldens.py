"""Goldens of the reference's preprocessing tests, on re-typed in-code rows."""

import pytest
from pyspark.sql import functions as F

from tabforge.operators import clean, missing, scale
from tabforge.plans.pipeline import apply_preprocess, preprocess

# data_duplicate fixture, read as the CSV reader would (all strings, blanks -> NULL)
DUP_ROWS = [
    ("0", "1", "2", "3", "a"), ("1", "2", "5", None, "2"), ("0", "1", "2", "w", "b"),
    ("0", "1", "2", "3", "a"), ("?", "2", "3", "4", "c"), ("8", "9", "7", "3", "a"),
    ("1", "3", "3", "4", "a"), ("0", "2", "2", "3", "b"), ("1", "2", "4", None, "c"),
    ("1", "2", None, "3", "c"), ("0", "5", "7", "3", "a"),
]
COLS = ["target", "feat1", "feat2", "feat3", "feat4"]
NUM = ["feat1", "feat2", "feat3"]


def _df(spark):
    return spark.createDataFrame(DUP_ROWS, COLS)


def _sorted(df):
    return sorted(tuple(r) for r in df.collect())


def test_remove_invalid_duplicates(spark):
    out = clean.remove_invalid_duplicates(_df(spark), NUM, "target", ["0", "1"])
    rows = _sorted(missing.drop_missing_rows(out))
    assert rows == sorted([("0", 1.0, 2.0, 3.0, "a"), ("1", 3.0, 3.0, 4.0, "a"),
                           ("0", 2.0, 2.0, 3.0, "b"), ("0", 5.0, 7.0, 3.0, "a")])
    assert out.count() == 8


def test_remove_missing_values(spark):
    df = clean.remove_invalid_duplicates(_df(spark), NUM, "target", ["0", "1"])
    out = missing.handle_missing(df, NUM, ["feat4"], "fill", 50, 1)
    r = out.agg(F.max(F.round("feat2", 3)).alias("m")).first()
    vals = {tuple(x) for x in out.select(F.round("feat2", 3), F.round("feat3", 3)).collect()}
    assert (3.571, 3.0) in vals  # row 9: feat2 filled with 25/7
    assert (5.0, 3.2) in vals    # row 1: feat3 filled with 16/5
    assert r["m"] == 7.0
    feat4 = sorted(x[0] for x in out.select("feat4").collect())
    assert feat4 == sorted(["a", "Other", "b", "a", "b", "c", "c", "a"])


def test_scale_standard_population_sd(spark):
    df = clean.remove_invalid_duplicates(_df(spark), NUM, "target", ["0", "1"])
    df = missing.handle_missing(df, NUM, ["feat4"], "fill", 50, 1)
    out = scale.scale(df, NUM, "standardscaler")
    f1 = sorted(round(x[0], 3) for x in out.select("feat1").collect())
    assert f1 == sorted([-1.043, -0.209, -1.043, 0.626, -0.209, -0.209, -0.209, 2.294])
    f3 = sorted(round(x[0], 3) for x in out.select("feat3").collect())
    assert f3 == sorted([-0.632, 0.0, 0.0, 2.53, -0.632, 0.0, -0.632, -0.632])


def test_encode_target(spark):
    rows = [("p", "1"), ("n", "2"), ("o", "3"), ("?", "4"), ("8", "5"), ("p", "6")]
    df = spark.createDataFrame(rows, ["target", "feat1"])
    df = clean.filter_labels(df, "target", ["o", "p", "n"])
    enc = dict((r[1], r[0]) for r in missing.encode_target(df, "target").collect())
    assert enc == {"1": 2, "2": 0, "3": 1, "6": 2}


def test_minmax_constant_maps_to_lower(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 4.0)], ["a", "b"])
    out = scale.scale(df, ["a", "b"], "minmax", (-1, 1)).collect()
    assert {r["a"] for r in out} == {-1.0}
    assert sorted(r["b"] for r in out) == [-1.0, 1.0]


def test_robust_exact_quantiles(spark):
    df = spark.createDataFrame([(float(x),) for x in [1, 2, 3, 4, 10]], ["a"])
    p = scale.fit_scale(df, ["a"], "robust")
    assert p["stats"]["a"] == (2.0, 3.0, 4.0)


def test_bad_arguments(spark):
    df = _df(spark)
    with pytest.raises(ValueError, match="unknown handling of missing values"):
        missing.fit_missing(df, NUM, ["feat4"], method="mean")
    with pytest.raises(TypeError, match="category_threshold is 1.5"):
        missing.fit_missing(df, NUM, ["feat4"], category_threshold=1.5)
    with pytest.raises(ValueError, match="must ascend"):
        scale.fit_scale(df, [], "minmax", (1, 0))


def test_gate_no_missing_does_nothing(spark):
    df = spark.createDataFrame([("0", 1.0, "a"), ("1", 2.0, "b")], ["target", "x", "c"])
    st = missing.fit_missing(df, ["x"], ["c"], "fill", 50, 1)
    assert st["active"] is False
    assert _sorted(missing.apply_missing(df, st)) == _sorted(df)


def test_chain_fit_apply_on_test_rows(spark):
    df = _df(spark)
    out, state = preprocess(df, NUM, "target", ["0", "1"], ["feat4"], transform=False)
    again = apply_preprocess(_df(spark), state)
    assert _sorted(out) == _sorted(again)


def test_exact_quantiles_bracket_and_fallback(spark):
    import numpy as np

    from tabforge.functions import quantile
    vals = [float((i * 7919) % 1000) / 7.0 for i in range(3000)] + [5.0] * 1000
    df = spark.createDataFrame([(v, -v) for v in vals], ["a", "b"])
    probs = [0.25, 0.5, 0.75, 0.9]
    want = {"a": list(np.quantile(vals, probs)), "b": list(np.quantile([-v for v in vals], probs))}
    for acc in (100_000, 3):                     # a coarse sketch exercises the fallback
        got = quantile.quantiles(df, ["a", "b"], probs, accuracy=acc)
        for c in ("a", "b"):
            assert got[c] == pytest.approx(want[c], abs=1e-12)


def test_first_k_flag_ties_and_nulls(spark):
    from tabforge.sources.io import first_k_flag
    rows = [(i % 5 if i % 17 else None, i) for i in range(200)]   # heavy ties, some NULL leads
    df = spark.createDataFrame(rows, "h INT, i INT")
    for k in (0, 1, 37, 120, 199, 200):
        got = first_k_flag(df, k, [F.col("h").asc(), F.col("i").asc()], lead=F.col("h"))
        sel = sorted(r["i"] for r in got.where("_sel").collect())
        want = sorted(r[1] for r in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))[:k])
        assert sel == want and got.count() == 200
    clean = spark.createDataFrame([(i % 5, i) for i in range(200)], "h INT, i INT")
    got = first_k_flag(clean, 77, [F.col("h").asc(), F.col("i").asc()], lead=F.col("h"), n=200)
    sel = sorted(r["i"] for r in got.where("_sel").collect())
    assert sel == sorted(i for _, i in sorted([(i % 5, i) for i in range(200)])[:77])
