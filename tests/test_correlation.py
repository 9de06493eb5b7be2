import itertools
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabsieve.functions import ranks as rank_tables
from tabsieve.functions.ranks import average_ranks, bucket_of
from tabsieve.operators import correlation as R


def tau_b(x, y):
    """Brute force over all pairs."""
    c = d = tx = ty = 0
    for i, j in itertools.combinations(range(len(x)), 2):
        a, b = np.sign(x[i] - x[j]), np.sign(y[i] - y[j])
        c += a * b > 0
        d += a * b < 0
        tx += a != 0
        ty += b != 0
    return (c - d) / math.sqrt(tx * ty) if tx and ty else None


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(3)
    a = rng.normal(size=400)
    b = np.round(a + rng.normal(size=400), 1)
    c = np.where(rng.random(400) < 0.4, 1.0, rng.integers(0, 20, 400))
    pdf = pd.DataFrame({"a": a, "b": b, "c": c, "k": np.full(400, 5.0)})
    pdf.loc[rng.random(400) < 0.2, "a"] = np.nan
    pdf.loc[rng.random(400) < 0.1, "c"] = np.nan
    return pdf


@pytest.fixture(scope="module")
def df(spark, data):
    return spark.createDataFrame(data).repartition(5)


def as_matrix(frame):
    return {(r["row"], r["col"]): r["corr"] for r in frame.collect()}


@pytest.mark.parametrize("method,small", [("pearson", 0), ("spearman", 0), ("spearman", 10_000)])
def test_matrix_like_pandas(df, data, method, small, monkeypatch):
    monkeypatch.setattr(rank_tables, "SMALL", small)
    got = as_matrix(R.correlation_matrix(df, method=method))
    if method == "pearson":
        want = data.corr()
    for a, b in itertools.product(data.columns, repeat=2):
        if method == "spearman":
            pair = data[[a, b]].dropna() if a != b else data[[a]].dropna()
            ranks = pair.rank()
            w = (ranks[a].corr(ranks[b]) if a != b else (1.0 if ranks[a].nunique() > 1 else np.nan))
        else:
            w = want.loc[a, b]
        g = got[(a, b)]
        assert g is None if math.isnan(w) else g == pytest.approx(w)


@pytest.mark.parametrize("strip,groups,values", [(64, 16, 1 << 20), (2, 1, 7)])
def test_many_pearson_pairs_from_one_scan(spark, monkeypatch, strip, groups, values):
    """Gaps, constants, infinities, far offsets and a pair that only varies outside its complete rows."""
    from tabsieve.functions import comoments
    for module, name, value in ((R, "PAIRS_PER_JOB", 3), (comoments, "STRIP", strip), (comoments, "GROUPS", groups), (comoments, "BLOCK_VALUES", values)):
        monkeypatch.setattr(module, name, value)
    rng = np.random.default_rng(6)
    a = rng.normal(size=300)
    pdf = pd.DataFrame({"a": a, "b": 1e9 + a + rng.normal(size=300), "c": 1e-200 * rng.random(300), "d": 1e300 * a, "k": 7.0, "none": np.nan,
                        "inf": np.where(np.arange(300) == 5, np.inf, a), "gaps": np.where(rng.random(300) < 0.6, np.nan, a * a),
                        "half": np.where(np.arange(300) < 150, np.nan, a), "flat": np.where(np.arange(300) < 150, a, 0.1)})
    got = as_matrix(R.correlation_matrix(spark.createDataFrame(pdf).repartition(5)))
    for x, y in itertools.combinations(pdf.columns, 2):
        pair = pdf[[x, y]].dropna()
        if np.isinf(pair).any(axis=None):
            assert got[x, y] is None or math.isnan(got[x, y])
        elif len(pair) < 2 or (pair.nunique() < 2).any():
            assert got[x, y] is None, (x, y)
        else:
            scaled = (pair - pair.iloc[0]) / (pair - pair.iloc[0]).abs().max()
            assert got[x, y] == pytest.approx(np.corrcoef(scaled[x], scaled[y])[0, 1], abs=1e-6), (x, y)
    assert R.correlation_matrix(spark.createDataFrame(pdf).limit(0)).where("corr is not null").count() == 0


@pytest.mark.parametrize("small", [0, 10_000])
def test_kendall_against_brute_force(df, data, monkeypatch, small):
    monkeypatch.setattr(rank_tables, "SMALL", small)
    for a, b in [("a", "b"), ("b", "c"), ("a", "c")]:
        pair = data[[a, b]].dropna().to_numpy()
        assert R.kendall_tau(df, a, b) == pytest.approx(tau_b(pair[:, 0], pair[:, 1]))
    assert R.kendall_tau(df, "a", "k") is None


@pytest.mark.parametrize("small,per_job", [(0, 400), (15, 2), (10_000, 1)])
def test_all_kendall_pairs_at_once(df, data, monkeypatch, small, per_job):
    monkeypatch.setattr(rank_tables, "SMALL", small)
    monkeypatch.setattr(R, "PAIRS_PER_JOB", per_job)
    got = as_matrix(R.correlation_matrix(df, method="kendall"))
    for a, b in itertools.combinations(data.columns, 2):
        pair = data[[a, b]].dropna().to_numpy()
        want = tau_b(pair[:, 0], pair[:, 1])
        assert got[(a, b)] == got[(b, a)] == (want if want is None else pytest.approx(want))


def test_kendall_counts_of_pairs(spark):
    rows = [(0, 0, 1), (1, 0, 1), (2, None, 1), (0, 1, None), (1, 1, 1), (0, 0, 1)]
    coded = spark.createDataFrame(rows, "a long, b long, c long")
    found = R._kendall_counts(coded, [("a", "b"), ("b", "c")], {"a": 3, "b": 2, "c": 2})
    # of (a, b): rows 0, 1, 3, 4, 5; equal a: 0 3 5 and 1 4, equal b: 0 1 5 and 3 4, crossed: 1 with 3
    assert found == [{"rows": 5, "a": 2 * 4, "b": 2 * 4, "both": 2 * 1, "discordant": 1},
                     {"rows": 4, "a": 2 * 3, "b": 2 * 6, "both": 2 * 3, "discordant": 0}]


def test_inversions_by_brute_force():
    rng = np.random.default_rng(4)
    for size, most in [(0, 1), (1, 1), (2, 2), (40, 3), (200, 1000), (300, 20)]:
        values = rng.integers(0, most, size).astype(float)
        assert R.inversions(values) == sum(a > b for a, b in itertools.combinations(values, 2))


def test_blocks_of_heavy_values():
    blocks = rank_tables.Blocks.between([1.0, 2.0, 2.0, np.nextafter(2.0, 3.0), math.inf, math.inf])
    assert blocks.bounds == [1.0, 2.0, np.nextafter(2.0, 3.0), math.inf]
    assert blocks.single == [False, False, True, False, True]


@pytest.mark.parametrize("few", [0, 512])
def test_kendall_shuffles_each_row_to_its_blocks_only(spark, monkeypatch, few):
    """Many blocks, heavy values on either side, gaps and infinite values; no row is copied once for each binary digit."""
    monkeypatch.setattr(rank_tables, "FEW", few)
    monkeypatch.setattr(rank_tables, "BLOCK_ROWS", 10)

    def explode(*c):
        raise AssertionError("a copy of each row for each digit")

    monkeypatch.setattr(R.F, "explode", explode)
    rng = np.random.default_rng(7)
    n = 300
    pdf = pd.DataFrame({"x": rng.normal(size=n), "y": rng.normal(size=n).round(1), "z": np.where(rng.random(n) < 0.4, 0.0, rng.normal(size=n)),
                        "k": rng.integers(0, 3, n).astype(float)})
    pdf["w"] = (pdf["x"] + rng.normal(size=n)).where(rng.random(n) < 0.8)
    pdf.loc[:5, "x"], pdf.loc[6:9, "y"] = math.inf, -math.inf
    got = as_matrix(R.correlation_matrix(spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None), ", ".join(f"{c} double" for c in pdf)), method="kendall"))
    for a, b in itertools.combinations(pdf.columns, 2):
        pair = pdf[[a, b]].dropna().clip(-1e9, 1e9).to_numpy()
        assert got[a, b] == pytest.approx(tau_b(pair[:, 0], pair[:, 1]))


def test_kendall_extremes(spark):
    df = spark.range(50).select(F.col("id").cast("double").alias("x"), (-F.col("id")).cast("double").alias("y"))
    assert R.kendall_tau(df, "x", "y") == -1.0
    assert R.kendall_tau(df.limit(1), "x", "y") is None


@pytest.mark.parametrize("path", ["broadcast", "buckets", "estimate too low"])
def test_ranks_with_hot_value(spark, monkeypatch, path):
    if path == "buckets":
        monkeypatch.setattr(rank_tables, "SMALL", 0)
    if path == "estimate too low":
        monkeypatch.setattr(rank_tables, "BROADCAST_ROWS", 20)
    values = [3.0] * 40 + [float(i) for i in range(30)]
    df = spark.createDataFrame([(v, v) for v in values], "v double, w double")
    got = sorted(tuple(r) for r in average_ranks(df.select("w", "v"), ["w", "v"], buckets=7).collect())
    want = sorted((x, x) for x in pd.Series(values).rank())
    assert got == want


@pytest.mark.parametrize("leaves", [256, 3, 2])
def test_buckets(spark, monkeypatch, leaves):
    monkeypatch.setattr(rank_tables, "TREE_LEAVES", leaves)
    bounds = [1.0, 2.0, 2.5, 7.0, 9.0, 11.0, 20.0]
    points = [0.0, 1.0, 1.5, 2.0, 2.4, 2.5, 8.0, 9.0, 19.9, 20.0, 21.0]
    df = spark.createDataFrame([(p,) for p in points], "v double")
    for n in range(len(bounds) + 1):
        got = {r["v"]: r["b"] for r in df.select("v", bucket_of("v", bounds[:n]).alias("b")).collect()}
        assert got == {p: sum(b <= p for b in bounds[:n]) for p in points}


def test_constant_target_and_order(spark):
    df = spark.createDataFrame([(1.0, 2.0, 5.0, 1), (2.0, 4.0, 5.0, 0), (3.0, 6.0, 5.0, 1), (4.0, 8.1, 5.0, 1)],
                               "x double, y double, k double, t int")
    rows = [tuple(r) for r in R.target_correlations(df, "t", 5).collect()]
    assert [r[0] for r in rows][-1] == "k" and rows[-1][1] is None
    assert R.target_correlations(df, "t", 1).count() == 1
    assert R.target_correlation_bars(df, "t").first()["target"] == "t"
    pairs = R.feature_collinearity(df.drop("t"), 0.8)
    assert [p[:2] for p in pairs] == [("y", "x")]
    assert [(r["row"], r["col"]) for r in R.lower_triangle(df.drop("t")).collect()] == [("y", "x"), ("k", "x"), ("k", "y")]
    with pytest.raises(ValueError):
        R.target_correlations(df.withColumn("s", F.lit("a")), "s")
    with pytest.raises(ValueError):
        R.correlation_matrix(df, method="cosine")


def test_tied_values_keep_generation_order(spark):
    df = spark.createDataFrame([(1.0, 2.0, 4.0), (2.0, 4.0, 8.0), (5.0, 10.0, 20.0)], "a double, b double, c double")
    assert [p[:2] for p in R.feature_collinearity(df, 0.5)] == [("b", "a"), ("c", "a"), ("c", "b")]
