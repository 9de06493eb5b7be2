"""Running totals by ranges, and the class codes made of them."""

import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tabsieve.functions import ordering
from tabsieve.operators import distributions, features


def totals_by_hand(rows, amount):
    out, upto = {}, {}
    for g, k, v, n in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] is not None, r[2] or "")):
        upto[g] = upto.get(g, 0) + (n if amount else 1)
        out[g, k, v] = upto[g]
    return out


@pytest.mark.parametrize("pivots", [1, 3, 50, 4096])
@pytest.mark.parametrize("amount", [None, "n"])
def test_running_totals(spark, pivots, amount):
    rng = random.Random(pivots)
    rows = {(rng.choice(["a", "b", None]), rng.choice([None, -2, 0, 7]), rng.choice([None, "", "é\"\n", "z"]) if i % 3 else f"v{i}"): i
            for i in range(400)}
    rows = [(*k, n) for k, n in rows.items()]
    df = spark.createDataFrame(rows, "`g.x` string, k int, v string, n bigint").repartition(5)
    got = ordering.running_totals(df, ["g.x"], ["k", "v"], amount, "upto", pivots).collect()
    assert {(r[0], r["k"], r["v"]): r["upto"] for r in got} == totals_by_hand(rows, amount)
    assert ordering.running_totals(df.limit(0), ["g.x"], ["k", "v"]).collect() == []


def test_doubles_order_as_numbers(spark):
    values = [float("-inf"), -1.5, -0.1, 1e-300, 0.1, 3.0, float("inf")]
    df = spark.createDataFrame([(v,) for v in reversed(values)], "v double")
    got = ordering.running_totals(df, [], ["v"], pivots=4).collect()
    assert [r["v"] for r in sorted(got, key=lambda r: r["upto"])] == values


def test_values_with_a_long_common_beginning_are_cut_evenly(spark):
    df = spark.range(200_000).select(F.concat(F.lit("x" * 70), F.col("id").cast("string")).alias("s"))
    got = distributions.value_counts(df, None)
    assert got.agg(F.min("rank"), F.max("rank"), F.countDistinct("rank")).first()[:] == (1, 200_000, 200_000)
    want = sorted(str(i) for i in range(200_000))
    some = got.where("rank % 9973 = 1").select("rank", "value").collect()
    assert all(r["value"] == "x" * 70 + want[r["rank"] - 1] for r in some)
    # what a window holds: ranges between neighbouring pivots
    place = F.struct(F.col("s").alias("k0"))
    cuts = [p["k0"] for p in ordering._pivots(df, place, ["s"], 200_000, 76 * 200_000, 256)]
    places = {v: i for i, v in enumerate(want)}
    at = [0, *(places[c[70:]] for c in cuts), 200_000]
    assert max(b - a for a, b in zip(at, at[1:])) < 2 * 200_000 / len(cuts)


def test_class_codes_are_those_of_the_encoder(spark):
    df = spark.createDataFrame([("b", 10, 0.5, True), ("a", 9, -3.0, False), ("B", -1, 100.0, True)], "s string, i bigint, d double, b boolean")
    for c in df.columns:
        codes = features.class_codes(df, c)
        want = features.LabelEncoder(c, "y").fit(df).mapping
        assert {r["class"]: r["code"] for r in codes.collect()} == want
        assert [want[r["l"]] for r in features.encode_classes(df.withColumn("l", features._label(df, c)), c, codes, "y").collect()] == [
            r["y"] for r in features.encode_classes(df, c, codes, "y").collect()]


def test_many_classes(spark):
    df = spark.range(300_000).select((F.col("id") % 200_000).alias("k")).withColumn("k.1", F.col("k"))
    codes = features.class_codes(df, "k", "int")
    assert codes.schema["code"].dataType.simpleString() == "int"
    assert features.encode_classes(df, "k", codes, "code").where("code = k").count() == 300_000


def test_classes_that_cannot_be_coded(spark):
    df = spark.createDataFrame([("a",), (None,)], "s string")
    with pytest.raises(ValueError, match="missing"):
        features.class_codes(df, "s")
    with pytest.raises(ValueError, match="do not fit"):
        features.class_codes(spark.range(200), "id", "tinyint")
    codes = features.class_codes(df.where("s is not null"), "s")
    for bad in ("c", None):
        with pytest.raises(PySparkException, match="without a code"):
            features.encode_classes(spark.createDataFrame([(bad,)], "s string"), "s", codes, "y").collect()
    assert features.class_codes(df.limit(0), "s").collect() == []
