import pytest
from pyspark.sql import functions as F

from tabsieve.operators import columns as C, profile as P

NAN = float("nan")


@pytest.fixture(scope="module")
def mixed(spark):
    rows = [(1, "a", 1.0, True, None, 0, "x"), (2, "na", NAN, None, None, 1, "x"), (3, "", 4.0, False, None, 0, "x"),
            (4, None, 9.0, True, None, 1, "x"), (5, "Na", None, None, None, 0, "x")]
    return spark.createDataFrame(rows, "id int, s string, d double, b boolean, e double, z int, k string")


@pytest.fixture(scope="module")
def no_rows(spark):
    return spark.createDataFrame([], "id int, s string, d double")


def test_lists(mixed):
    assert P.empty_columns(mixed) == ["e"]
    assert P.unique_value_columns(mixed) == ["e", "k"]
    assert P.boolean_columns(mixed) == ["b", "e", "z"]
    assert P.high_na_columns(mixed, 0.5) == ["e"]
    assert P.high_na_columns(mixed, 0.4) == ["e"]          # strictly above: d and b miss exactly 2 of 5
    assert P.high_na_columns(mixed, 0.39) == ["d", "b", "e"]
    assert P.missing_like_columns(mixed) == ["s", "d", "b", "e"]
    assert P.high_cardinality_columns(mixed, 3) == ["s"]
    assert P.high_cardinality_columns(mixed, 4) == []
    assert C.string_columns(mixed) == ["s", "k"] and C.numeric_columns(mixed) == ["id", "d", "e", "z"]
    assert C.identify_column_types(mixed, ["id"]) == (["d", "e", "z"], ["s", "b", "k"])


def test_keys_are_left_out(mixed):
    assert "id" not in [r["column"] for r in P.profile(mixed, key_cols=["id"]).collect()]
    with pytest.raises(ValueError):
        P.profile(mixed, key_cols=["nope"])


def test_no_rows(no_rows):
    assert P.empty_columns(no_rows) == ["id", "s", "d"] == P.unique_value_columns(no_rows)
    assert P.high_na_columns(no_rows, 0.0) == [] == P.missing_like_columns(no_rows)
    assert [r["fill_rate"] for r in P.fill_rate(no_rows).collect()] == [None] * 3
    assert not any(r["is_sparse"] for r in P.profile(no_rows).collect())


def test_fill_rate_and_missing(mixed):
    rates = {r["column"]: r["fill_rate"] for r in P.fill_rate(mixed).collect()}
    assert rates == {"id": 100.0, "s": 80.0, "d": 60.0, "b": 60.0, "e": 0.0, "z": 100.0, "k": 100.0}
    top = [tuple(r) for r in P.missing_percent(mixed, 3).collect()]
    assert top == [("e", 100.0), ("b", 40.0), ("d", 40.0)]


def test_null_is_a_value_of_its_own(spark):
    df = spark.createDataFrame([("a",), (None,)], "s string")
    assert P.unique_value_columns(df) == []
    assert [r["n_distinct"] for r in P.distinct_counts(df).collect()] == [1]
    assert [r["n_distinct"] for r in P.distinct_counts(df, dropna=False).collect()] == [2]


def test_high_cardinality_far_and_near(spark):
    df = spark.range(5000).select(F.col("id").cast("string").alias("far"), (F.col("id") % 21).cast("string").alias("near"),
                                  (F.col("id") % 20).cast("string").alias("at"))
    assert P.high_cardinality_columns(df, 20) == ["far", "near"]


def test_describe_like_pandas(spark, mixed):
    got = {r["column"]: r for r in P.describe_numeric(mixed).collect()}
    want = mixed.select("id", "d", "z").toPandas().astype("float64").describe()
    for c in ("id", "d", "z"):
        for ours, theirs in (("count", "count"), ("mean", "mean"), ("std", "std"), ("min", "min"), ("q25", "25%"),
                             ("q50", "50%"), ("q75", "75%"), ("max", "max")):
            assert got[c][ours] == pytest.approx(want[c][theirs])
    assert got["e"]["count"] == 0 and got["e"]["q50"] is None
    one = P.describe_numeric(spark.createDataFrame([(2.0,)], "v double")).first()
    assert one["std"] is None and one["q25"] == 2.0


def test_info_and_shape(mixed):
    rows = P.info(mixed).collect()
    assert [(r["column"], r["dtype"], r["non_null"]) for r in rows][:3] == [("id", "int", 5), ("s", "string", 4), ("d", "double", 3)]
    assert P.shape(mixed) == (5, 7)


def test_profile_does_not_depend_on_layout(mixed):
    a = P.profile(mixed).collect()
    b = P.profile(mixed.orderBy(F.desc("id")).repartition(3)).collect()
    assert a == b


def test_column_choice(mixed):
    log = []
    rest, gone = C.drop_columns(mixed, ["s", "d"])
    assert rest.columns == ["id", "b", "e", "z", "k"] and gone == ["s", "d"]
    rest, gone = C.drop_one_column(mixed, "k")
    assert rest.columns[-1] == "z" and gone == ["k"]
    with pytest.raises(ValueError):
        C.drop_columns(mixed, ["zzz"])
    assert C.drop_columns_if_present(mixed, ["zzz", "k"]).columns == mixed.columns[:-1]
    assert C.select_existing(mixed, ["z", "q", "id", "z"]).columns == ["z", "id", "z"]
    assert "e" not in C.drop_empty_columns(mixed).columns
    x, y = C.features_and_target(mixed, "k")
    assert "k" not in x.columns and y.columns == ["k"]
    assert C.where_known(mixed, "d").count() == 3
    assert C.class_share(mixed, "s", "a").first()[0] == pytest.approx(20.0)
    assert [r["id"] for r in C.head(mixed, 2, ["id"]).collect()] == [1, 2]


def test_odd_column_names(spark):
    df = spark.createDataFrame([(1.0, "u")], "`a.b` double, `c``d` string")
    assert [r["column"] for r in P.profile(df).collect()] == ["a.b", "c`d"]
    assert P.fill_rate(df).count() == 2
