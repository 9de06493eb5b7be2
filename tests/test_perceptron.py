import pytest

from tabsieve.operators import perceptron as N
from tabsieve.sources import generators as G


def test_golden(spark):
    df = spark.createDataFrame([(1, [2, 5, 1, 8])], "id int, x array<int>")
    row = N.perceptron_predict(df, "x", [.4, .3, .2, .1], threshold=.5).first()
    assert row["weighted_sum"] == pytest.approx(3.3) and row["output"] == 1
    steps = N.partial_sums(df, "x", [.4, .3, .2, .1], ["id"]).orderBy("pos").collect()
    assert [r["running_sum"] for r in steps] == pytest.approx([.8, 2.3, 2.5, 3.3])
    assert [r["product"] for r in steps] == pytest.approx([.8, 1.5, .2, .8])


def test_boundary_bias_and_missing(spark):
    df = spark.createDataFrame([([1.0],), ([0.9],), ([None],), (None,)], "x array<double>")
    out = [r["output"] for r in N.perceptron_predict(df, "x", [0.5], threshold=0.5).collect()]
    assert out == [1, 0, None, None]
    assert N.perceptron_predict(df, "x", [0.5], threshold=0.5, bias=0.05).collect()[1]["output"] == 1


def test_lengths(spark):
    df = spark.createDataFrame([([1.0, 2.0, 4.0],)], "x array<double>")
    with pytest.raises(Exception, match="weights"):
        N.perceptron_predict(df, "x", [1.0, 1.0], threshold=0).collect()
    assert N.perceptron_predict(df, "x", [1.0, 1.0], threshold=0, truncate=True).first()["weighted_sum"] == 3.0
    assert N.partial_sums(df.selectExpr("1 as id", "x"), "x", [1.0] * 5, ["id"]).count() == 3


def test_columns(spark):
    df = spark.createDataFrame([(1, 2.0, None), (1, 2.0, 3.0)], "a int, b double, c double")
    assert [r["output"] for r in N.perceptron_predict(df, ["a", "b", "c"], [1, 1, 1], threshold=6).collect()] == [None, 1]
    with pytest.raises(ValueError):
        N.perceptron_predict(df, ["a", "b"], [1.0], threshold=0)


def test_partial_sums_of_uneven_and_missing_vectors(spark, monkeypatch):
    monkeypatch.setattr(N, "TERMS_AT_ONCE", 5)
    rows = [(1, [1.0, 2.0, 3.0]), (2, None), (3, []), (4, [1.0, None, 2.0]), (5, [float("nan"), 1.0]), (6, [2.0] * 9)]
    got = N.partial_sums(spark.createDataFrame(rows, "id int, x array<double>"), "x", [1.0, 10.0, 100.0, 0.5], ["id"]).collect()
    sums = {i: [r["running_sum"] for r in sorted((r for r in got if r["id"] == i), key=lambda r: r["pos"])] for i in range(1, 7)}
    assert sums == {1: [1.0, 21.0, 321.0], 2: [], 3: [], 4: [1.0, None, None], 5: [None, None], 6: [2.0, 22.0, 222.0, 223.0]}


def test_generators(spark):
    out = G.random_vectors(spark, 500, 4, seed=7)
    rows = out.collect()
    xs, ws = [x for r in rows for x in r["x"]], [w for r in rows for w in r["w"]]
    assert set(xs) == set(range(11)) and 0 <= min(ws) and max(ws) < 1 and abs(sum(ws) / len(ws) - 0.5) < 0.03
    assert rows == G.random_vectors(spark, 500, 4, seed=7).collect() != G.random_vectors(spark, 500, 4, seed=8).collect()
    terms = G.random_terms(spark.range(3), ["id"], 5, seed=7)
    assert terms.count() == 15
    scored = N.perceptron_predict(out, "x", [0.5] * 4, threshold=10)
    assert {r["output"] for r in scored.collect()} == {0, 1}


def test_vectors_of_size_zero(spark):
    assert G.random_terms(spark.range(3), ["id"], 0).count() == 0
    assert [(r["x"], r["w"]) for r in G.keyed_vectors(spark.range(1), ["id"], 0).collect()] == [([], [])]
    for draw in (G.random_terms, G.keyed_vectors):
        with pytest.raises(ValueError):
            draw(spark.range(1), ["id"], -1)
