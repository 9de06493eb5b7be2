import math

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabsieve.functions import text
from tabsieve.operators import cleaning as K, imputation as I

NAN = float("nan")


def column(frame, name):
    return [r[name] for r in frame.orderBy("id").collect()]


def frame(spark, values, dtype):
    return spark.createDataFrame(list(enumerate(values)), f"id int, v {dtype}")


def test_bool_to_uint8(spark):
    df = frame(spark, [True, False, None], "boolean")
    assert column(K.convert_bool_to_uint8(df, ["v"]), "v") == [1, 0, None]
    assert column(K.convert_bool_to_uint8(df, ["v"], keep_na=False), "v") == [1, 0, 0]
    assert column(K.convert_bool_to_uint8(frame(spark, [1.0, 0.0, NAN], "double"), ["v"]), "v") == [1, 0, None]
    with pytest.raises(Exception, match="no boolean"):
        K.convert_bool_to_uint8(frame(spark, [2], "int"), ["v"]).collect()
    with pytest.raises(ValueError):
        K.convert_bool_to_uint8(frame(spark, ["true"], "string"), ["v"])


def test_lower_ignores_others(spark):
    df = frame(spark, ["ÀB", None], "string")
    assert column(K.lower_columns(df, ["v", "id", "zzz"]), "v") == ["àb", None]


def test_keyword_category(spark):
    df = frame(spark, ["piso grande", "Piso", "casa y piso", None, "finca"], "string")
    got = K.add_type_column(df, "v", {"casa": "house", "piso": "flat", "inc": None, "f.nca$": "land"})
    assert column(got, "type") == ["flat", None, "house", None, "land"]
    with pytest.raises(ValueError):
        K.add_type_column(df, "v", {}, "v")


WORDS = ["TRUE", "False", "Éa", "한국", "Straße", "ŁØ", "ÎÑ", "İstanbul", "ΑΣ", "", None, "é", "naïve café", "Ǆ",
         "ẞ", "ﬁn", "q̣̇", "日本", "בּ"]


def test_normalize_text(spark):
    got = column(K.normalize_columns(frame(spark, WORDS, "string"), ["v"]), "v")
    assert got == [text.plain_text(w) for w in WORDS]
    assert got[:4] == ["TRUE", "False", "ea", "한국"]


def test_every_latin_character(spark):
    chars = [chr(p) for a, b in ((0x00, 0x24F), (0x300, 0x36F), (0x1E00, 0x1EFF), (0x2010, 0x205E)) for p in range(a, b + 1)]
    words = chars + ["é" + c + "A" for c in chars] + ["B" + c for c in chars]
    assert column(K.normalize_columns(frame(spark, words, "string"), ["v"]), "v") == [text.plain_text(w) for w in words]


def test_only_text_beyond_ascii_reaches_python(spark):
    plan = K.normalize_columns(frame(spark, ["a"], "string"), ["v"])._jdf.queryExecution().toString()
    assert "ArrowEvalPython [cleaned(CASE WHEN NOT (octet_length" in plan


def test_to_numeric(spark):
    values = ["1", " 12 ", "1e3", "+3", ".5", "1d", "1.5f", "abc", "", None, "1_000", "0x1A", "1,5", "inf", "nan"]
    got = column(K.to_numeric(frame(spark, values, "string"), ["v"]), "v")
    assert got == [1.0, 12.0, 1000.0, 3.0, 0.5, None, None, None, None, None, None, None, None, math.inf, None]
    want = pd.to_numeric(pd.Series(values), errors="coerce")
    assert [None if math.isnan(x) else x for x in want] == got
    assert column(K.to_numeric(frame(spark, [True, None], "boolean"), ["v"]), "v") == [1.0, None]
    with pytest.raises(ValueError):
        K.to_numeric(spark.sql("select 0 as id, timestamp'2020-01-01' as v"), ["v"])


def test_replace_then_coerce_then_void(spark):
    df = frame(spark, ["bajo", "3", "-1", "x", None, "alto"], "string")
    got = K.replace_and_invalidate(df, "v", {"bajo": 0, "alto": "9", 3: 100}, invalid_below=0)
    assert column(got, "v") == [0.0, 3.0, None, None, None, 9.0]
    numbers = frame(spark, [5.0, NAN, -2.0], "double")
    assert column(K.replace_and_invalidate(numbers, "v", {5: 1, "5": 7}, 0), "v") == [1.0, None, None]


def test_log1p(spark):
    got = column(K.log1p_column(frame(spark, [0.0, -1.0, -2.0, None, NAN], "double"), "v"), "v")
    assert got == [0.0, None, None, None, None]


@pytest.mark.parametrize("strategy,fill", [("median", 4.0), ("mean", 14 / 3), ("zero", 0.0)])
def test_impute_numeric(spark, strategy, fill):
    df = frame(spark, [1.0, None, NAN, 4.0, 9.0], "double").withColumn("e", F.lit(None).cast("double"))
    got = I.impute_numeric(df, ["v", "e"], strategy)
    assert column(got, "v") == pytest.approx([1.0, fill, fill, 4.0, 9.0])
    assert set(column(got, "e")) == ({0.0} if strategy == "zero" else {None})
    with pytest.raises(ValueError):
        I.impute_numeric(df, strategy="mode")


def test_modes(spark):
    df = spark.createDataFrame([(10, True, "b", None), (9, None, "b", None), (9, False, "a", None), (10, None, "a", None)],
                               "n int, b boolean, s string, e string")
    assert I.modes(df, ["n", "b", "s", "e"]) == {"n": 9, "b": False, "s": "a"}
    filled = I.impute_mode(df, ["b", "e", "zzz"])
    assert [r["b"] for r in filled.collect()].count(False) == 3 and filled.schema["b"].dataType.simpleString() == "boolean"
    assert [r["e"] for r in I.impute_categorical(df, ["e"]).collect()] == ["missing"] * 4
