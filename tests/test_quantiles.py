import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from tabsieve.functions.quantiles import exact_quantiles

PROBS = (0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0)


def check(spark, values, **limits):
    df = spark.createDataFrame(pd.DataFrame({"v": values})).repartition(4)
    got = exact_quantiles(df, {"v": F.col("v")}, PROBS, **limits)["v"]
    want = pd.Series(values).quantile(list(PROBS)).tolist()
    assert got == pytest.approx(want, rel=1e-12, abs=1e-12)


@pytest.mark.parametrize("shape", ["uniform", "heavy_tail", "ties", "hot", "two", "constant", "negative"])
@pytest.mark.parametrize("limits", [{}, {"accuracy": 20, "grid": 10, "inside_limit": 30}])
def test_shapes(spark, shape, limits):
    rng = np.random.default_rng(7)
    n = 5000
    values = {
        "uniform": rng.random(n), "heavy_tail": np.exp(rng.normal(0, 8, n)), "ties": rng.integers(0, 6, n).astype(float),
        "hot": np.where(rng.random(n) < 0.4, 3.0, rng.random(n) * 10), "two": np.array([1.0, 2.0]),
        "constant": np.full(n, 4.2), "negative": -rng.random(n) * 1e-9,
    }[shape]
    check(spark, values, **limits)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(-1e6, 1e6), min_size=1, max_size=60))
def test_any_values(spark, values):
    check(spark, values, accuracy=10, grid=5, inside_limit=3)


def test_missing_values(spark):
    df = spark.createDataFrame([(1.0, None), (None, None), (4.0, None), (9.0, None)], "a double, b double")
    got = exact_quantiles(df, {"a": F.col("a"), "b": F.col("b")}, (0.5,))
    assert got == {"a": [4.0], "b": [None]}
    assert exact_quantiles(df.limit(0), {"a": F.col("a")}, (0.5, 0.9)) == {"a": [None, None]}
    assert exact_quantiles(df, {}, (0.5,)) == {}


def test_between_infinities(spark):
    df = spark.createDataFrame([(float("inf"),), (1.0,), (float("-inf"),)], "a double")
    assert exact_quantiles(df, {"a": F.col("a")}, (0.25, 0.75))["a"] == [float("-inf"), float("inf")]
    assert exact_quantiles(df.where("a <> 1"), {"a": F.col("a")}, (0.5,))["a"] == [None]
    wide = spark.createDataFrame([(-1e308,), (1e308,)], "a double")
    assert exact_quantiles(wide, {"a": F.col("a")}, (0.5,))["a"] == [0.0]


def test_many_columns(spark):
    df = spark.range(500).select(*[((F.col("id") * (i + 3)) % 499).cast("double").alias(f"v{i}") for i in range(60)])
    got = exact_quantiles(df, {c: F.col(c) for c in df.columns}, (0.25, 0.5, 0.75))
    want = df.toPandas().quantile([0.25, 0.5, 0.75])
    assert all(got[c] == pytest.approx(want[c].tolist()) for c in df.columns)


def test_infinities(spark):
    df = spark.createDataFrame([(float("inf"),), (1.0,), (2.0,), (float("-inf"),), (3.0,)], "a double")
    assert exact_quantiles(df, {"a": F.col("a")}, (0.0, 0.5, 1.0))["a"] == [float("-inf"), 2.0, float("inf")]
