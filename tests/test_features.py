import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabsieve.operators import cleaner as L, features as X


@pytest.fixture(scope="module")
def train(spark):
    rows = [(1, 1.0, 5.0, "b", True), (2, 2.0, 5.0, "a", None), (3, 3.0, 5.0, None, False), (4, 10.0, 5.0, "b", True), (5, None, 5.0, "c", True)]
    return spark.createDataFrame(rows, "id int, x double, k double, s string, b boolean")


def test_expand(train, spark):
    out, model = X.preprocess_data(train, key_cols=["id"])
    assert out.columns == ["id", "num__x", "num__k", "cat__s_b", "cat__s_c", "cat__s_None", "cat__b_True", "cat__b_None"]
    assert model.feature_names == out.columns[1:]
    rows = {r["id"]: r for r in out.collect()}
    # quartiles of 1, 2, 3, 10: 1.75, 2.5, 4.75; the constant column is divided by 1
    assert rows[1]["num__x"] == pytest.approx((1 - 2.5) / 3.0) and rows[5]["num__x"] is None and rows[1]["num__k"] == 0.0
    assert [rows[i]["cat__s_None"] for i in (1, 2, 3)] == [0, 0, 1] and rows[2]["cat__b_None"] == 1
    unseen = spark.createDataFrame([(9, 2.5, 6.0, "zzz", False)], train.schema)
    assert tuple(model.expand(unseen).first()) == (0.0, 1.0, 0, 0, 0, 0, 0)


def test_vectors_agree_with_columns(train, tmp_path):
    model = X.FeaturePreprocessor(key_cols=["id"]).fit(train)
    path = str(tmp_path / "model")
    model.save(path)
    for m in (model, X.FeaturePreprocessorModel.load(path)):
        out = m.transform(train)
        assert out.columns == train.columns + ["features"]
        wide = {r["id"]: [r[c] for c in m.feature_names] for r in m.expand(train, ["id"]).collect()}
        for r in out.collect():
            got = [None if v != v else v for v in r["features"].toArray().tolist()]
            assert got == pytest.approx(wide[r["id"]])


def test_feature_lists(train):
    only = X.FeaturePreprocessor(["x"], []).fit(train)
    assert only.feature_names == ["num__x"]
    detected = X.FeaturePreprocessor(["x"], None, key_cols=["id"]).fit(train)      # one list missing: both detected
    assert "num__k" in detected.feature_names
    with pytest.raises(ValueError):
        X.FeaturePreprocessor([], []).fit(train)
    with pytest.raises(ValueError, match="categories"):
        X.FeaturePreprocessor([], ["s"], max_categories=2).fit(train)


def test_label_encoder(spark, train):
    known = train.where("s is not null")
    model = X.LabelEncoder("s", "y").fit(known)
    assert model.classes == ["a", "b", "c"] and model.mapping == {"a": 0, "b": 1, "c": 2}
    assert {(r["s"], r["y"]) for r in model.transform(known).collect()} == {("a", 0), ("b", 1), ("c", 2)}
    assert dict(X.LabelEncoder("s", "y", "tinyint").fit(known).transform(known).dtypes)["y"] == "tinyint"
    with pytest.raises(Exception):
        model.transform(known.withColumn("s", F.lit("new"))).collect()
    numbers = spark.createDataFrame([(10,), (9,), (2,)], "s int")
    assert X.LabelEncoder("s", "y").fit(numbers).classes == ["2", "9", "10"]
    with pytest.raises(ValueError):
        X.LabelEncoder("s", "y").fit(train)


# --- learned cleaning ---

CONFIG = {"drop_na_threshold": 0.5, "binary_cols": ["b", "gone", "zzz"], "floor_col": "floor", "floor_replace": {"bajo": 0},
          "numeric_median_cols": ["size", "rent"], "rent_col": "rent", "rent_invalid_below": 0}


@pytest.fixture(scope="module")
def houses(spark):
    rows = [(1, True, "bajo", "10", 5.0, None), (2, None, "2", "x", -3.0, None), (3, False, "4", None, None, 1.0),
            (4, True, "nn", "30", 9.0, None)]
    return spark.createDataFrame(rows, "id int, b boolean, floor string, size string, rent double, gone double")


def test_clean_by_hand(houses):
    """Three of four `gone` are missing; the medians are of 0, 2, 4, of 10, 30, of 5, -3, 9 and then of 5, 5, 9."""
    got, stats = L.clean_data(houses, CONFIG)
    assert stats == {"cols_to_drop": ["gone"], "bin_modes": {"b": True}, "floor_median": 2.0, "num_medians": {"size": 20.0, "rent": 5.0}, "rent_median": 5.0}
    assert got.columns == ["id", "b", "floor", "size", "rent"]
    assert [tuple(r) for r in got.orderBy("id").collect()] == [
        (1, True, 0.0, 10.0, 5.0), (2, True, 2.0, 20.0, 5.0), (3, False, 4.0, 20.0, 5.0), (4, True, 2.0, 30.0, 9.0)]


def test_learned_once_applied_unchanged(spark, houses, tmp_path):
    model = L.DataCleaner(CONFIG).fit(houses)
    test = spark.createDataFrame([(7, None, None, None, -1.0, 2.0)], houses.schema)
    row = model.transform(test).first()
    assert row.asDict() == {"id": 7, "b": True, "floor": model.stats["floor_median"], "size": model.stats["num_medians"]["size"],
                            "rent": model.stats["rent_median"]}
    once = model.transform(houses)
    assert once.orderBy("id").collect() == model.transform(houses.repartition(3)).orderBy("id").collect()
    path = str(tmp_path / "cleaner")
    model.save(path)
    assert L.DataCleanerModel.load(path).transform(test).first() == row
    plan = once._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_given_statistics_are_kept(houses):
    _, stats = L.clean_data(houses, CONFIG, {"rent_median": 77.0, "num_medians": {"size": 1.0}})
    assert stats["rent_median"] == 77.0 and stats["num_medians"] == {"size": 1.0}
    before = {"floor_median": 3.0}
    L.clean_data(houses, CONFIG, before)
    assert before == {"floor_median": 3.0}


def test_partial_configurations(houses):
    same, stats = L.clean_data(houses, {})
    assert same.collect() == houses.collect() and stats == {}
    out, stats = L.clean_data(houses, {"floor_col": "nowhere", "rent_col": "rent", "rent_median_key": "m"})
    assert set(stats) == {"m"} and stats["m"] == 5.0
    with pytest.raises(ValueError):
        L.clean_data(houses, {"flor_col": "floor"})
