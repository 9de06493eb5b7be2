import math

import pytest
from pyspark.sql import functions as F

from tabsieve.operators import alignment, splitting as S


@pytest.fixture(scope="module")
def df(spark):
    hot = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") < 40, "rare").when(F.col("id") < 60, F.lit(None)).otherwise("mid")
    return spark.range(3001).select("id", hot.alias("c")).repartition(6)


def counts(frame, *cols):
    return {tuple(r[c] for c in cols): r["count"] for r in frame.groupBy(*cols).count().collect()}


def test_split_sizes_and_determinism(df):
    out = S.train_test_split(df, ["id"], "c", 0.2)
    sizes = counts(df, "c")
    got = counts(out, "c", "split")
    want = S.allocate_test_rows({c: n for (c,), n in sizes.items()}, 0.2)
    assert {c: got.get((c, "test"), 0) for (c,) in sizes} == want
    assert sum(want.values()) == math.ceil(3001 * 0.2)
    for (c,), n in sizes.items():
        assert abs(want[c] - 601 / 3001 * n) < 1
    again = S.train_test_split(df.orderBy(F.desc("id")).repartition(2), ["id"], "c", 0.2)
    pick = lambda f: {r["id"] for r in f.where("split = 'test'").collect()}
    assert pick(out) == pick(again) != pick(S.train_test_split(df, ["id"], "c", 0.2, seed=1))
    assert out.count() == 3001


def test_windows_only_steer(df):
    sizes = lambda counts: {c: [n // 3, n // 2, n] for c, n in counts.items()}
    narrow = S.find_cuts(df, ["id"], "c", 42, sizes, slack=0.001)       # misses at first, then widens
    wide = S.find_cuts(df, ["id"], "c", 42, sizes, slack=1000.0)        # whole digest range
    assert narrow.cuts == wide.cuts == S.find_cuts(df, ["id"], "c", 42, sizes).cuts
    assert all(len(c) == 32 for cuts in wide.cuts.values() for c in cuts[:2])
    edges = S.rank_windows(10**12, [2 * 10**11, 8 * 10**11])
    assert edges == sorted(edges) and len(edges) == 4


def test_unstratified(df):
    got = counts(S.train_test_split(df, ["id"], None, 0.25), "split")
    assert got == {("test",): 751, ("train",): 2250}
    sizes = {r["split"]: (r["n_rows"], r["n_columns"]) for r in S.split_sizes(S.train_test_split(df, ["id"])).collect()}
    assert sizes == {"test": (601, 2), "train": (2400, 2)}
    with pytest.raises(ValueError):
        S.train_test_split(df, ["id"], test_size=1.5)


def test_largest_remainder():
    assert S.allocate_test_rows({"a": 5, "b": 5}, 0.5) == {"a": 2, "b": 3}
    assert sum(S.allocate_test_rows({"a": 1, "b": 7, "c": 3}, 0.2).values()) == 3
    assert S.allocate_test_rows({}, 0.2) == {}


def test_folds(df):
    out = S.assign_folds(df, ["id"], 5, "c")
    per = counts(out, "c", "fold")
    for (c,), n in counts(df, "c").items():
        sizes = [per.get((c, i), 0) for i in range(5)]
        assert sum(sizes) == n and max(sizes) - min(sizes) <= 1
    whole = counts(out, "fold").values()
    assert max(whole) - min(whole) <= 1
    plain = counts(S.assign_folds(df, ["id"], 4), "fold")
    assert sorted(plain.values()) == [750, 750, 750, 751]
    with pytest.raises(ValueError):
        S.assign_folds(df, ["id"], 1)


def test_many_classes_are_split_as_few_are(spark, df, monkeypatch):
    odd = df.withColumns({"b": F.col("id") % 7 < 3, "i": F.when(F.col("id") % 5 > 0, F.col("id") % 23), "c.1": F.lit(1),
                          "d": F.when(F.col("id") % 2 > 0, F.lit(0.0)).when(F.col("id") % 3 > 0, F.lit(-0.0)).otherwise(F.lit(float("nan")))})

    def both(c):
        return [sorted(map(str, f.collect())) for f in (S.train_test_split(odd, ["id"], c), S.assign_folds(odd, ["id"], 4, c))]

    few = {c: both(c) for c in ("c", "b", "i", "d")}
    monkeypatch.setattr(S, "MANY_CLASSES", 1)
    for c, want in few.items():
        assert both(c) == want


def test_more_classes_than_the_driver_holds(spark):
    df = spark.range(330_000).select("id", F.when(F.col("id") < 110_000, F.lit(0)).otherwise(F.col("id") % 110_000).alias("c"))
    sides = S.train_test_split(df, ["id"], "c", 0.25)
    assert sides.where("split = 'test'").count() == 82_500
    per = sides.groupBy("c").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("split") == "test").alias("test"))
    assert per.where("abs(test - n / 4) >= 1").count() == 0
    folds = S.assign_folds(df, ["id"], 5, "c")
    assert {r["count"] for r in folds.groupBy("fold").count().collect()} == {66_000}
    per = folds.groupBy("c", "fold").count().groupBy("c").agg(F.max("count").alias("most"), F.sum("count").alias("n"))
    assert per.where("most > ceil(n / 5)").count() == 0


def test_keys_are_told_apart(spark):
    """Parts that join to one text, and missing parts, are still different keys."""
    rows = [("a:b", "c"), ("a", "b:c"), (None, "2"), ("2", None), ("", "2"), ("1", "11"), ("11", "1"), ("x", "y")]
    df = spark.createDataFrame([(a, b, i) for i in range(5) for a, b in rows], "a string, b string, i int")
    for share, n in ((0.225, 9), (0.125, 5)):
        assert S.train_test_split(df, ["a", "b", "i"], test_size=share).where("split = 'test'").count() == n


def test_tiny_class_and_no_rows(spark, df):
    tiny = spark.createDataFrame([(1, "a"), (2, "b"), (3, "b")], "id int, c string")
    assert S.assign_folds(tiny, ["id"], 5, "c").agg(F.max("fold")).first()[0] <= 4
    assert S.train_test_split(df.limit(0), ["id"], "c").count() == 0


def test_split_is_a_projection(df):
    plan = S.train_test_split(df, ["id"], "c")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "Window" not in plan


def test_attach_target(spark):
    x = spark.createDataFrame([(1, "a"), (2, "b")], "id int, f string")
    y = spark.createDataFrame([(2, 0.5), (1, 0.1)], "id int, y double")
    assert {tuple(r) for r in alignment.attach_target(x, y, ["id"]).collect()} == {(1, "a", 0.1), (2, "b", 0.5)}
    with pytest.raises(ValueError, match="no key"):
        alignment.attach_target(x.union(x), y, ["id"])
    with pytest.raises(ValueError):
        alignment.attach_target(x, y.withColumnRenamed("y", "f"), ["id"])
