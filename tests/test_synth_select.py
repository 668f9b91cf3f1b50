"""Feature synthesis and selection goldens (reference fixtures re-typed as rows)."""

import pytest
from pyspark.sql import functions as F

from tabforge.operators import select as S
from tabforge.operators import synth

GOLDEN_21 = ['feat1', 'feat2', 'feat3', 'feat1 + feat3', 'feat1 + feat2', 'feat2 + feat3',
             'feat1 * feat3', 'feat2 * feat3', 'feat1 * feat2', 'feat1 + feat2 * feat2 + feat3',
             'feat1 + feat3 * feat2 + feat3', 'feat1 + feat2 * feat3',
             'feat1 + feat2 * feat1 + feat3', 'feat1 + feat2 * feat2', 'feat1 * feat2 + feat3',
             'feat1 * feat1 + feat2', 'feat1 + feat3 * feat2', 'feat1 + feat3 * feat3',
             'feat2 + feat3 * feat3', 'feat1 * feat1 + feat3', 'feat2 * feat2 + feat3']


def _file1(spark):
    return spark.createDataFrame([(0, 1, 2, 3), (1, 1, 5, 0)], ["target", "feat1", "feat2", "feat3"])


def test_depth2_names(spark):
    fm = synth.new_features(_file1(spark), "target", None, ["add_numeric", "multiply_numeric"], 2)
    names = [c for c in fm.columns if c != "target"]
    assert sorted(names) == sorted(GOLDEN_21)
    assert len(names) == 21


def test_no_parentheses_value(spark):
    fm = synth.new_features(_file1(spark), "target", None, ["add_numeric", "multiply_numeric"], 2)
    r = fm.orderBy("target").select("`feat1 * feat2 + feat3`").collect()
    assert [x[0] for x in r] == [5, 5]        # 1 * (2 + 3), 1 * (5 + 0)


def test_non_numeric_refused(spark):
    df = spark.createDataFrame([(0, 1, 2, "3"), (1, 1, 5, "a")], ["target", "feat1", "feat2", "feat3"])
    with pytest.raises(ValueError, match="Data Frame contains non-numeric values"):
        synth.new_features(df, "target", None, ["add_numeric"], 1)


def test_target_clash(spark):
    with pytest.raises(ValueError, match="Data Frame already contains target column"):
        synth.build_features(_file1(spark), "feat1", None, ["add_numeric", "multiply_numeric"], 2)


def test_drop_correlated_golden(spark):
    fm = synth.new_features(_file1(spark), "target", None, ["add_numeric", "multiply_numeric"], 4)
    out, dropped = synth.drop_correlated(fm, 0.5, keep=["target"])
    kept = [c for c in out.columns if c != "target"]
    # constant columns have no correlation and are never dropped
    assert kept == ["feat1", "feat2", "feat2 + feat3", "feat1 * feat2 + feat3"]
    final = S.select_features(synth.build_features(_file1(spark), "target", None,
                                                   ["add_numeric", "multiply_numeric"], 4, 0.5),
                              "target", 3, methods=["Pearson", "Chi-2"])
    assert final.columns == ["feat2", "feat2 + feat3", "feat1 * feat2 + feat3", "target"]
    assert sorted(tuple(r) for r in final.collect()) == [(2, 5, 5, 0), (5, 5, 5, 1)]


def test_vote_order_total_then_name_desc(spark):
    rows = [(i % 2, float(i), float(i % 3), float((i * 7) % 5), 1.0) for i in range(40)]
    df = spark.createDataFrame(rows, ["y", "a", "b", "c", "d"])
    v = S.vote(df, "y", 4, ["a", "b", "c", "d"], methods=["Pearson", "Chi-2"]).collect()
    keys = [(-r["Total"], r["Feature"]) for r in v]
    totals = [r["Total"] for r in v]
    assert totals == sorted(totals, reverse=True)
    for t in set(totals):
        names = [r["Feature"] for r in v if r["Total"] == t]
        assert names == sorted(names, reverse=True)
    assert [r["rank"] for r in v] == list(range(1, len(v) + 1))
    assert keys


def test_pearson_tie_later_column_wins(spark):
    df = spark.createDataFrame([(0, 1.0, 1.0), (1, 2.0, 2.0), (0, 1.0, 1.0)], ["y", "a", "b"])
    sel = {r["feature"]: r["selected"] for r in S.select_pearson(df, "y", 1, ["a", "b"]).collect()}
    assert sel == {"a": False, "b": True}


def test_chi2_matches_numpy(spark):
    import numpy as np
    rows = [(i % 2, float(i), float((i * 3) % 7)) for i in range(30)]
    df = spark.createDataFrame(rows, ["y", "a", "b"])
    got = {r["feature"]: r["score"] for r in S.select_chi2(df, "y", 1, ["a", "b"]).collect()}
    X = np.array([[r[1], r[2]] for r in rows]); y = np.array([r[0] for r in rows])
    X = (X - X.min(0)) / (X.max(0) - X.min(0))
    obs = np.array([X[y == c].sum(0) for c in (0, 1)])
    exp = np.array([(y == c).mean() * X.sum(0) for c in (0, 1)])
    ref = ((obs - exp) ** 2 / exp).sum(0)
    assert got["a"] == pytest.approx(ref[0]) and got["b"] == pytest.approx(ref[1])


def test_aggregate_mode_and_unique(spark):
    child = spark.createDataFrame([(1, "x"), (1, "y"), (1, "y"), (2, "z"), (2, "w")], ["k", "c"])
    parent = spark.createDataFrame([(1,), (2,), (3,)], ["pk"])
    out = {r["pk"]: (r["mode_c"], r["num_unique_c"]) for r in synth.aggregate_features(
        child, parent, "k", "pk", ["mode", "num_unique"], numeric=[], categorical=["c"]).collect()}
    assert out == {1: ("y", 2), 2: ("w", 2), 3: (None, None)}


def test_correlation_paths_agree_with_numpy(spark):
    import numpy as np

    from tabforge.operators import profile
    rng = np.random.default_rng(3)
    X = rng.normal(size=(300, 15)) + np.arange(15) * 1000.0      # large offsets
    X[:, 3] = X[:, 2] * 2 + 1
    cols = [f"c{i}" for i in range(15)]
    df = spark.createDataFrame([tuple(map(float, r)) for r in X], cols)
    ref = np.corrcoef(X, rowvar=False)
    for sub in (cols[:5], cols):                        # centred sums / Spark ML (105 pairs)
        got = profile.correlation(df, sub).collect()
        for r in got:
            i, j = cols.index(r["feature_1"]), cols.index(r["feature_2"])
            assert r["r"] == pytest.approx(ref[i, j], abs=1e-9)
    # NULLs: pairwise-complete
    rows = [(float(a), None if k % 4 == 0 else float(b)) for k, (a, b) in enumerate(X[:, :2])]
    dn = spark.createDataFrame(rows, "a DOUBLE, b DOUBLE")
    keep = np.array([k % 4 != 0 for k in range(300)])
    want = np.corrcoef(X[keep, 0], X[keep, 1])[0, 1]
    got = {(r["feature_1"], r["feature_2"]): r["r"] for r in profile.correlation(dn, ["a", "b"]).collect()}
    assert got[("b", "a")] == pytest.approx(want, abs=1e-9)


def test_selection_queries_do_the_whole_job(monkeypatch):
    """The registered queries leave rounds and methods at the operators' defaults: 500 rounds, six methods."""
    from tabforge.operators import select
    from tabforge.plans import q_select
    seen = {}

    class Table:
        def select(self, *cols):
            return self

    monkeypatch.setattr(q_select, "_sig", lambda spark, sf_dir: Table())
    for name in ("select_boosted", "vote", "select_features"):
        monkeypatch.setattr(select, name, lambda d, *a, _n=name, **kw: seen.update({_n: (a, kw)}))
    q_select.q_select_boosted(None, ""), q_select.q_vote(None, ""), q_select.q_select_features(None, "")
    assert set(seen) == {"select_boosted", "vote", "select_features"}
    assert all(len(a) == 3 and not kw for a, kw in seen.values())


def test_extremely_randomised_trees(spark):
    """Cut points differ between trees, equal seeds give equal scores, the telling features win."""
    from tabforge.operators import select as S
    rows = [(float(i % 17), float(i * 7 % 101), float(i % 3), 5.0, int(i % 17 > 8)) for i in range(400)]
    df = spark.createDataFrame(rows, ["a", "b", "c", "same", "y"])
    names = ["a", "b", "c", "same"]
    scores = [{r["feature"]: (r["score"], r["selected"]) for r in S.select_extra(df, "y", 2, names, num_trees=6, seed=s).collect()} for s in (1, 1, 2)]
    assert scores[0] == scores[1] != scores[2]
    assert max(scores[0], key=lambda f: scores[0][f][0]) == "a" and scores[0]["same"][0] == 0
    data = df.selectExpr("a AS __v0", "b AS __v1", "c AS __v2", "same AS __v3", "double(y) AS __label").cache()
    grids = data.approxQuantile(["__v0", "__v1", "__v2", "__v3"], [i / 100 for i in range(101)], 0.001)
    cuts = [S.extra_tree(data, names, grids, 3, t)[0] for t in (1, 2)]
    assert cuts[0][0] != cuts[1][0] and cuts[0][1] != cuts[1][1] and cuts[0][3] == [5.0]
