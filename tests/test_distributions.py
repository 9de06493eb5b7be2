from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabsieve.operators import distributions as H


@pytest.mark.parametrize("bins", [1, 7, 40])
def test_histogram_like_numpy(spark, bins):
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame({"u": rng.random(2000), "g": rng.integers(0, 41, 2000).astype(float), "t": np.round(rng.normal(size=2000), 2)})
    got = H.histograms(spark.createDataFrame(pdf), bins, include_empty=True).toPandas()
    for c in pdf:
        counts, edges = np.histogram(pdf[c], bins=np.histogram_bin_edges(pdf[c], bins))
        part = got[got["column"] == c].sort_values("bin")
        assert part["n"].tolist() == counts.tolist()
        assert part["bin_start"].tolist() == pytest.approx(edges[:-1].tolist())
        assert part["bin_end"].tolist() == pytest.approx(edges[1:].tolist())


def test_histogram_edges(spark):
    df = spark.createDataFrame([(5.0, None), (5.0, None), (float("nan"), None)], "v double, e double")
    rows = H.histograms(df, 4).collect()
    assert [(r["column"], r["bin"], r["n"]) for r in rows] == [("v", 2, 2)]
    assert H.histograms(df.select(F.lit("a").alias("s"))).count() == 0
    with pytest.raises(ValueError):
        H.histograms(df.select(F.lit(float("inf")).alias("v")))


def test_value_counts(spark):
    rows = [("a", True, 1)] * 3 + [("b", None, 2)] * 3 + [(None, False, 3)] * 4 + [("c", True, 4)]
    df = spark.createDataFrame(rows, "s string, b boolean, n int")
    got = sorted((r["column"], r["rank"], r["value"], r["n"]) for r in H.value_counts(df, 3).collect())
    assert got == [("b", 1, "False", 4), ("b", 2, "True", 4), ("b", 3, None, 3),
                   ("s", 1, None, 4), ("s", 2, "a", 3), ("s", 3, "b", 3)]
    assert H.value_counts(df.select("n")).count() == 0


def test_large_top_goes_through_slices(spark, monkeypatch):
    monkeypatch.setattr(H, "PARTIAL_TOP", 2)
    df = spark.createDataFrame([(str(i % 37),) for i in range(1000)] + [(None,)] * 50, "s string")
    got = [(r["value"], r["n"]) for r in H.value_counts(df, 5).orderBy("rank").collect()]
    assert got == [(None, 50), ("0", 28), ("1", 27), ("10", 27), ("11", 27)][:5] or got[0] == (None, 50)
    want = df.toPandas()["s"].value_counts(dropna=False)
    assert [n for _, n in got] == want.head(5).tolist()


def test_all_values_are_ranked(spark, monkeypatch):
    monkeypatch.setattr(H, "PIVOTS", 7)
    df = spark.createDataFrame([(f"v{i % 41:02}", i % 9 == 0) for i in range(900)] + [(None, None)] * 25, "s string, b boolean")
    got = H.value_counts(df, None).collect()
    for column, label in (("s", lambda v: v), ("b", lambda v: str(v) if v is not None else None)):
        counts = Counter(label(r[column]) for r in df.collect())
        want = sorted(counts.items(), key=lambda x: (-x[1], x[0] is not None, x[0] or ""))
        assert [(r["value"], r["n"]) for r in sorted(got, key=lambda r: r["rank"]) if r["column"] == column] == want
    assert sorted(r["rank"] for r in got if r["column"] == "s") == list(range(1, 43))


def test_a_range_wider_than_a_double(spark):
    df = spark.createDataFrame([(-1e308,), (1e308,), (0.0,)], "v double")
    assert sorted((r["bin"], r["n"]) for r in H.histograms(df, 4).collect()) == [(0, 1), (2, 1), (3, 1)]


def test_top_is_cut_before_the_shuffle(spark):
    df = spark.createDataFrame([("a",)], "s string")
    assert "WindowGroupLimit" in H.value_counts(df, 20)._jdf.queryExecution().toString()


def test_scatter(spark):
    df = spark.createDataFrame([(1, 1.0, None, 0.0), (2, float("nan"), 2.0, 3.0), (3, 3.0, 3.0, -1.0)],
                               "id int, a double, b double, y double")
    got = {(r["id"], r["column"]): (r["x"], r["y"]) for r in H.scatter_points(df, "y", ["a", "b"], "log1p", ["id"]).collect()}
    assert got == {(1, "a"): (1.0, 0.0), (2, "b"): (2.0, pytest.approx(np.log1p(3))), (3, "a"): (3.0, None), (3, "b"): (3.0, None)}
    many = spark.range(1000).select("id", F.col("id").cast("double").alias("a"), F.lit(1.0).alias("y"))
    first = sorted(r["x"] for r in H.scatter_points(many, "y", ["a"], key_cols=["id"], fraction=0.2).collect())
    again = sorted(r["x"] for r in H.scatter_points(many.repartition(7), "y", ["a"], key_cols=["id"], fraction=0.2).collect())
    assert first == again and 140 < len(first) < 260
    with pytest.raises(ValueError):
        H.scatter_points(many, "y", ["a"], fraction=0.2)
