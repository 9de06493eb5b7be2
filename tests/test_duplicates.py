from collections import Counter

import pandas as pd
import pytest

from tabsieve.operators import duplicates as D

ROWS = [(1, "a", 1.0), (2, "a", 1.0), (3, None, float("nan")), (4, None, None), (5, "b", 2.0), (6, "a", 1.0), (7, None, None)]


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame(ROWS, "id int, s string, d double").repartition(4)


def ids(frame):
    return sorted(r["id"] for r in frame.collect())


@pytest.mark.parametrize("keep,want", [("first", [2, 4, 6, 7]), ("last", [1, 2, 3, 4]), (False, [1, 2, 3, 4, 6, 7])])
def test_keep(df, keep, want):
    assert ids(D.duplicate_rows(df, keep=keep, key_cols=["id"])) == want
    assert ids(D.duplicate_rows(df, ["s", "d"], keep, order_by=None if keep is False else ["id"])) == want


def test_count(df):
    assert D.count_duplicates(df, key_cols=["id"]) == 4
    assert D.count_duplicates(df) == 0
    assert D.count_duplicates(df, ["s"]) == 4
    assert D.count_duplicates(df.limit(0)) == 0


def test_matches_pandas_on_ties(spark):
    rows = [(i % 3, i % 2, i % 5) for i in range(300)]
    df = spark.createDataFrame(rows, "a int, b int, c int").repartition(5)
    pdf = pd.DataFrame(rows, columns=["a", "b", "c"])
    # order_by leaves ties, and some rows are alike in every column
    got = D.duplicate_rows(df, ["a"], "first", order_by=["b"])
    assert got.count() == int(pdf.duplicated(["a"]).sum()) == 297
    whole = Counter(tuple(r) for r in D.duplicate_rows(df).collect())
    assert whole == Counter(map(tuple, pdf[pdf.duplicated()].to_numpy().tolist()))


@pytest.mark.parametrize("keep", ["first", "last"])
def test_missing_key_values(spark, keep):
    rows = [("a", None, 1), ("a", 5, 2), ("a", 3, 3), ("b", None, 4), ("b", 1, 5), ("c", None, 6)]
    df = spark.createDataFrame(rows, "s string, id int, n int").repartition(3)
    got = sorted(r["n"] for r in D.duplicate_rows(df, ["s"], keep, key_cols=["id"]).collect())
    ordered = pd.DataFrame(rows, columns=["s", "id", "n"]).sort_values("id", na_position="first")
    assert got == sorted(ordered[ordered.duplicated(["s"], keep=keep)]["n"])
    # the same through order_by alone, where nothing promises unique values
    again = sorted(r["n"] for r in D.duplicate_rows(df, ["s"], keep, order_by=["id"]).collect())
    assert again == got


@pytest.mark.parametrize("keep", ["first", "last"])
def test_single_column_ordered_by_itself(spark, keep):
    df = spark.createDataFrame([(None,)] * 3 + [(1,)] * 2 + [(2,)], "id int")
    got = Counter(r["id"] for r in D.duplicate_rows(df, ["id"], keep, order_by=["id"]).collect())
    assert got == {None: 2, 1: 1}


def test_many_copies(spark, monkeypatch):
    monkeypatch.setattr(D, "COPIES_PER_ROW", 7)
    df = spark.createDataFrame([("hot",)] * 50 + [("cold",)], "s string")
    assert Counter(r["s"] for r in D.duplicate_rows(df).collect()) == {"hot": 49}


def test_hot_group_is_not_gathered(spark):
    plan = D.duplicate_rows(spark.createDataFrame(ROWS, "id int, s string, d double"), ["s"], key_cols=["id"])
    assert "Window" not in plan._jdf.queryExecution().toString()


def test_arguments(df):
    with pytest.raises(ValueError):
        D.duplicate_rows(df, keep="middle")
    with pytest.raises(ValueError):
        D.duplicate_rows(df, ["s"])
    with pytest.raises(ValueError):
        D.require_unique_key(df, ["s"])
    D.require_unique_key(df, ["id"])


def test_no_text_is_an_exchange_key(spark):
    """Rows are grouped and joined by digests of long texts; only rows that repeat are fetched."""
    text = "a text of more than sixty-four bytes, which is compared by its digest "
    df = spark.createDataFrame([(text, 1.0), (text, 1.0), (text, 1.0), (text + "x", 1.0), ("short", None), ("short", float("nan"))], "text string, x double")
    rows = D.duplicate_rows(df)
    exchanges = [line for line in rows._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange hashpartitioning" in line]
    assert exchanges and not any("text#" in line and "sha2(" not in line for line in exchanges)
    assert sorted(map(tuple, rows.collect()), key=str) == [("a text of more than sixty-four bytes, which is compared by its digest ", 1.0)] * 2 + [("short", None)]
