"""Argument validation (C10): error types and messages."""

import pytest

from tabforge.operators import clean, explain, missing, power, profile, scale, search, select, synth
from tabforge.plans.pipeline import preprocess


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame([("0", 1.0, "a"), ("1", 2.0, "b")], ["target", "x", "c"])


def test_messages(spark, df):
    with pytest.raises(ValueError, match="unknown correlation 'cosine'"):
        profile.correlation(df, ["x"], "cosine")
    with pytest.raises(TypeError, match="bins is 2.5"):
        profile.histogram(df, ["x"], bins=2.5)
    with pytest.raises(ValueError, match="unknown scaling"):
        scale.fit_scale(df, ["x"], "zscore")
    with pytest.raises(ValueError, match="unknown power transform 'log'"):
        power.fit_power(df, ["x"], "log")
    with pytest.raises(ValueError, match="strictly positive"):
        power.fit_power(spark.createDataFrame([(0.0,), (1.0,)], ["x"]), ["x"], "box-cox")
    with pytest.raises(TypeError, match="threshold is 1, not a float"):
        synth.drop_correlated(df, 1)
    with pytest.raises(ValueError, match="not between 0 and 1"):
        synth.drop_correlated(df, 1.5)
    with pytest.raises(TypeError, match="max_depth is 2.0"):
        synth.feature_definitions(df, ["add_numeric"], 2.0)
    with pytest.raises(TypeError, match="number of features is 1.0"):
        select.select_pearson(df, "target", 1.0, ["x"])
    with pytest.raises(ValueError, match="no search strategy named grid"):
        search.search(df, ["x"], "target", {}, "grid")
    with pytest.raises(TypeError, match="drop_threshold is 'half'"):
        missing.fit_missing(df, ["x"], ["c"], drop_threshold="half")
    with pytest.raises(ValueError, match="must ascend"):
        preprocess(df, ["x"], "target", ["0", "1"], scale_range=(1, 1))
    with pytest.raises(ValueError, match="Data Frame contains non-numeric values"):
        clean.require_numeric(df)
    with pytest.raises(ValueError, match="Data Frame already contains target column"):
        clean.attach_target(df.withColumnRenamed("x", "target2").withColumnRenamed("target2", "target")
                            .withColumnRenamed("c", "label"), "label", ["target"])
    with pytest.raises(TypeError, match="numeric features must be a list of strings"):
        clean.coerce_numeric(df, "x")


def test_importance_kind(spark):
    nodes = spark.createDataFrame([(0, 0, 0, 1.0, 1.0, 10, 1, 2, 0.0, 1.0)],
                                  "tree INT, node INT, feature INT, threshold DOUBLE, gain DOUBLE, "
                                  "count LONG, left INT, right INT, prediction DOUBLE, weight DOUBLE")
    with pytest.raises(ValueError, match="unknown importance 'shapley'"):
        explain.importance(nodes, ["a"], "shapley")
