"""Wide feature matrices: same features, values and choice as the named-column path, at widths it cannot plan."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabforge.operators import synth, wide

BOTH = ["add_numeric", "multiply_numeric"]


def table(spark, rows=60, cols=4, gaps=False, seed=3):
    rng = np.random.default_rng(seed)
    x = rng.normal(1, 1, (rows, cols))
    x[:, -1] = 2 * x[:, 0] + 0.01 * x[:, -1]
    data = [(i % 2, *(None if gaps and rng.random() < 0.2 else float(v) for v in r)) for i, r in enumerate(x)]
    return spark.createDataFrame(data, "y int, " + ", ".join(f"c{i} double" for i in range(cols)))


@pytest.mark.parametrize("depth", [1, 2, 3])
def test_names_and_values_of_the_narrow_path(spark, depth):
    df = table(spark, gaps=True)
    names = ["c0", "c1", "c2", "c3"]
    narrow = synth.synthesize(df, BOTH, depth, names, ["y"])
    r = wide.recipe(names, BOTH, depth)
    assert r.names == [c for c in narrow.columns if c != "y"]
    want = np.array([[np.nan if v is None else v for v in row[:-1]] for row in narrow.collect()], float)
    got = np.array([row["features"] for row in wide.matrix(df, r, passthrough=["y"]).collect()])
    assert np.allclose(got, want, equal_nan=True)


@pytest.mark.parametrize("gaps", [False, True])
def test_choice_does_not_depend_on_the_tile(spark, monkeypatch, gaps):
    df = table(spark, gaps=gaps)
    r = wide.recipe(["c0", "c1", "c2", "c3"], BOTH, 2)
    m = np.array([row["features"] for row in wide.matrix(df, r).collect()])
    want = []
    for i in range(m.shape[1]):
        def corr(j):
            ok = ~np.isnan(m[:, i]) & ~np.isnan(m[:, j])
            return abs(np.corrcoef(m[ok, i], m[ok, j])[0, 1])
        if not any(corr(j) >= 0.8 for j in want):
            want.append(i)
    assert 0 < len(want) < m.shape[1]
    for tile in (2048, 7):
        monkeypatch.setattr(wide, "TILE", tile)
        assert wide.keep_uncorrelated(df, r, 0.8) == want


def test_constant_and_empty(spark):
    df = spark.createDataFrame([(1.0, 0.1, None), (2.0, 0.1, None), (3.0, 0.1, None)], "a double, b double, e double")
    assert wide.keep_uncorrelated(df, wide.plain(["a", "b", "e"]), 0.5) == [0, 1, 2]
    assert wide.keep_uncorrelated(df.limit(0), wide.plain(["a", "b", "e"]), 0.5) == [0, 1, 2]
    assert wide.matrix(df.limit(0), wide.plain(["a"])).count() == 0


def test_refusals(spark):
    df = table(spark)
    with pytest.raises(ValueError, match="use synthesize"):
        wide.recipe(["c0"], ["haversine"], 1)
    with pytest.raises(ValueError, match="non-numeric"):
        wide.build_wide_features(df.withColumn("s", F.lit("x")), "y")
    with pytest.raises(ValueError, match="target column"):
        wide.build_wide_features(df.withColumn("target", F.lit(1)), "y")


def test_forty_columns_at_depth_two(spark):
    """336,610 features: no plan of named columns survives that."""
    df = table(spark, rows=6, cols=40)
    r = wide.recipe([f"c{i}" for i in range(40)], BOTH, 2)
    assert len(r) == 40 + 780 + 820 * 819 // 2
    sizes = wide.matrix(df, r, passthrough=["y"]).select(F.size("features").alias("n"), F.element_at("features", -1).alias("last")).collect()
    assert {x["n"] for x in sizes} == {len(r)} and all(np.isfinite(x["last"]) for x in sizes)


def test_three_hundred_columns_decorrelated(spark):
    """300 base columns at depth 1: 45,150 features, of which copies of columns and their products go."""
    rng = np.random.default_rng(5)
    x = rng.normal(0, 1, (120, 24))
    x = np.concatenate([x] * 12 + [x[:, :12]], 1)                     # twelve and a half copies of 24 columns
    names = [f"c{i:03d}" for i in range(300)]
    df = spark.createDataFrame([(i % 2, *map(float, row)) for i, row in enumerate(x)], "y int, " + ", ".join(f"{c} double" for c in names))
    out, kept = wide.build_wide_features(df, "y", None, ["multiply_numeric"], 1, 0.95)
    assert kept[:24] == names[:24] and not set(kept) & set(names[24:])
    # unordered pairs of 24 different columns, and the squares, which copies multiply to
    assert len(kept) == 24 + 24 * 23 // 2 + 24
    row = out.first()
    assert len(row["features"]) == len(kept) and out.columns == ["features", "target"]
