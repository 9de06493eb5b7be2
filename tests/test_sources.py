import pytest
from pyspark.sql import functions as F

from tabsieve.operators import columns as C, profile as P
from tabsieve.sources import csv, encoding, export, scratch


def write(path, content):
    path.write_bytes(content if isinstance(content, bytes) else content.encode())
    return str(path)


def test_read_csv(spark, tmp_path):
    path = write(tmp_path / "a.csv", 'id,kind,x,flag,n,\n1,M,1.5,True,3,\n2,NA,null,False,4,\n3,"a ""q"", b",2,,5,\n')
    df = csv.read_csv(spark, path)
    assert dict(df.dtypes) == {"id": "bigint", "kind": "string", "x": "double", "flag": "boolean", "n": "bigint",
                               "Unnamed: 5": "double"}
    assert [tuple(r) for r in df.orderBy("id").collect()] == [
        (1, "M", 1.5, True, 3, None), (2, None, None, False, 4, None), (3, 'a "q", b', 2.0, None, 5, None)]
    assert P.empty_columns(df) == ["Unnamed: 5"] and "Unnamed: 5" not in C.drop_empty_columns(df).columns
    assert csv.key_columns(df, "id") == ["id"] == csv.key_columns(df, 0) == csv.key_columns(df, ["id"])
    assert csv.key_columns(df, None) == []
    with pytest.raises(ValueError):
        csv.key_columns(df, 17)


def test_read_with_schema_and_tokens(spark, tmp_path):
    path = write(tmp_path / "b.csv", "a,b\n1,x\n-,y\n")
    df = csv.read_csv(spark, path, schema="a int", na_values=["-"])
    assert [tuple(r) for r in df.collect()] == [(1, "x"), (None, "y")] and dict(df.dtypes)["a"] == "int"
    with pytest.raises(Exception):
        csv.read_csv(spark, path, schema="a int").collect()


MALFORMED = {
    "fields": "a,b\n1,2\n3,4,5\n6\n", "too few": "a,b\n1,2\n6\n", "too many": "a,b\n1,2\n3,4,5\n",
    "quoted break that fits": 'a,b\n0,z\n1,"x,5\n7,y"\n', "break in the last field": 'a,b\n1,"x\ny"\n',
    "break after doubled quotes": 'a,b\n1,"say ""x"", 5\n7,y"\n', "break in the first field": 'a,b\n"x\n1",y\n'}


@pytest.mark.parametrize("name", MALFORMED)
@pytest.mark.parametrize("read", ["all", "first", "second", "count", "literal"])
def test_a_malformed_row_is_an_error_whatever_is_read(spark, tmp_path, name, read):
    path = write(tmp_path / "m.csv", MALFORMED[name])
    df = csv.read_csv(spark, path, schema="a string, b string")
    with pytest.raises(Exception, match="malformed CSV row|Malformed|MALFORMED") as error:
        {"all": df.collect, "first": df.select("a").collect, "second": df.select("b").collect, "count": df.count,
         "literal": df.select(F.lit(1)).collect}[read]()
    if "break" in name:
        assert "multi_line=True" in str(error.value)
        whole = csv.read_csv(spark, path, schema="a string, b string", multi_line=True)
        assert whole.count() == len(whole.collect()) == MALFORMED[name].count("\n") - 2


@pytest.mark.parametrize("name", ["fields", "too few", "too many"])
def test_malformed_rows_with_line_breaks_allowed(spark, tmp_path, name):
    df = csv.read_csv(spark, write(tmp_path / "m.csv", MALFORMED[name]), schema="a string, b string", multi_line=True)
    for read in (df.collect, df.select("a").collect, df.select("b").collect, df.count):
        with pytest.raises(Exception, match="malformed CSV row"):
            read()


def test_quotes_that_open_no_field(spark, tmp_path):
    path = write(tmp_path / "q.csv", 'a,b,c\n5" pipe,x"y,"z"\n"a,""",",",""\n,"""",\n"x"y,"p,q",1\n')
    rows = [tuple(r) for r in csv.read_csv(spark, path, schema="a string, b string, c string").collect()]
    assert rows == [('5" pipe', 'x"y', "z"), ('a,"', ",", None), (None, '"', None), ('"x"y', "p,q", "1")]
    assert rows == [tuple(r) for r in csv.read_csv(spark, path, schema="a string, b string, c string", multi_line=True).collect()]


def test_long_quoted_fields_and_other_separators(spark, tmp_path):
    text = '"' + 'x""' * 60_000 + '"'
    path = write(tmp_path / "l.csv", f"a|b\n{text}|1\n2|{text}\n")
    rows = csv.read_csv(spark, path, sep="|", schema="a string, b string").collect()
    assert rows[0]["a"] == 'x"' * 60_000 == rows[1]["b"] and rows[1]["a"] == "2"
    double = write(tmp_path / "d.csv", 'a::b\n"x::y"::2\n')
    assert [tuple(r) for r in csv.read_csv(spark, double, sep="::").collect()] == [("x::y", 2)]
    with pytest.raises(Exception, match="multi_line=True"):
        csv.read_csv(spark, write(tmp_path / "e.csv", 'a::b\n1::"x::y\n'), sep="::", schema="a int").count()


def test_several_files_and_no_header(spark, tmp_path):
    one, two = write(tmp_path / "1.csv", "a,b\n1,x\n"), write(tmp_path / "2.csv", "a,b\n2,y\n\n3,z\n")
    assert sorted(tuple(r) for r in csv.read_csv(spark, [one, two]).collect()) == [(1, "x"), (2, "y"), (3, "z")]
    plain = csv.read_csv(spark, one, header=False)
    assert plain.columns == ["Unnamed: 0", "Unnamed: 1"] and plain.count() == 2
    assert csv.read_csv(spark, write(tmp_path / "3.csv", "a,b\n"), schema="a int, b int").count() == 0


def test_latin1(spark, tmp_path):
    path = write(tmp_path / "c.csv", "a\ncafé\n".encode("latin-1"))
    assert csv.read_csv(spark, path, encoding="ISO-8859-1").first()[0] == "café"


def test_roundtrip(spark):
    df = spark.createDataFrame([(1, 'x "y", z', None, 1.25), (2, None, True, None)], "id bigint, s string, b boolean, d double")
    path = csv.write_csv(df, scratch.scratch_dir(spark, "t"))
    assert sorted(csv.read_csv(spark, path).collect()) == sorted(df.collect())


def test_encodings(spark, tmp_path):
    files = {"plain.csv": b"id,x\n1,2\n", "utf8.csv": "é,ü\n".encode(), "latin.csv": "é,ü\n".encode("latin-1"),
             "bom.csv": b"\xef\xbb\xbfid\n", "u16.csv": "id".encode("utf-16"), "u32.csv": "id".encode("utf-32"),
             "cut.csv": b"a" * 9_999 + "é".encode() + b"b" * 50, "late.csv": b"a" * 10_000 + b"\xff"}
    for name, content in files.items():
        write(tmp_path / name, content)
    got = {r["path"].rsplit("/", 1)[1]: r["encoding"] for r in encoding.detect_encodings(spark, str(tmp_path)).collect()}
    assert got == {"plain.csv": "ascii", "utf8.csv": "utf-8", "latin.csv": "ISO-8859-1", "bom.csv": "UTF-8-SIG",
                   "u16.csv": "UTF-16", "u32.csv": "UTF-32", "cut.csv": "utf-8", "late.csv": "ISO-8859-1"}


def test_encodings_of_odd_paths_and_edges(spark, tmp_path):
    files = {"s p/a b.txt": "é\n".encode(), "ñandú/%41 #x.txt": b"\xff\n", "e/none.txt": b"", "e/mark.txt": b"\xef\xbb\xbf",
             "e/markline.txt": b"\xef\xbb\xbf\n\n", "e/open.txt": b"\xef\xbb\xbfa\r\nb", "e/breaks.txt": b"\n\r\n\r",
             "e/cr.txt": "a\ré".encode(), "e/inner.txt": b"a\xef\xbb\xbf\n", "e/le.txt": "a\nb\n".encode("utf-16-le"),
             "e/u16.txt": "\u0a0a\n\u0a0a".encode("utf-16"), "e/half.txt": b"\xc3\n\xa9", "e/nul.txt": b"\x00\n"}
    for name, content in files.items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        write(tmp_path / name, content)
    got = {r["path"].rsplit(f"{tmp_path.name}/", 1)[1]: (r["n_bytes"], r["encoding"]) for r in encoding.detect_encodings(spark, str(tmp_path)).collect()}
    kinds = {"s p/a b.txt": "utf-8", "ñandú/%41 #x.txt": "ISO-8859-1", "e/none.txt": None, "e/mark.txt": "UTF-8-SIG",
             "e/markline.txt": "UTF-8-SIG", "e/open.txt": "UTF-8-SIG", "e/breaks.txt": "ascii", "e/cr.txt": "utf-8",
             "e/inner.txt": "utf-8", "e/le.txt": "ascii", "e/u16.txt": "UTF-16", "e/half.txt": "ISO-8859-1", "e/nul.txt": "ascii"}
    assert got == {name: (len(files[name]), kind) for name, kind in kinds.items() if files[name]}


def test_one_file_is_looked_at_by_many_tasks(spark, tmp_path):
    write(tmp_path / "big.txt", b"\xef\xbb\xbf" + "äöü words\n".encode() * 40_000 + b"\xff\n")
    write(tmp_path / "small.txt", b"\xff\xfea\x00")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", 1 << 14)
    try:
        found = encoding.detect_encodings(spark, str(tmp_path))
        assert sorted((r["n_bytes"], r["encoding"]) for r in found.collect()) == [(4, "UTF-16"), (40_000 * 13 + 5, "UTF-8-SIG")]
        assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 20
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_export(spark, tmp_path):
    df = spark.range(10).select("id", F.col("id").cast("double").alias("y"), F.lit("a").alias("f"), F.lit(0).alias("noise"))
    paths = export.export_train_test(df.where("id < 8"), df.where("id >= 8"), "y", ["id"], str(tmp_path / "m"),
                                     transform_y="log1p", drop_cols=["noise", "zzz"])
    sides = export.read_exported(spark, str(tmp_path / "m"))
    assert list(paths) == ["X_train", "X_test", "y_train", "y_test"]
    assert sides["X_train"].columns == ["id", "f"] == sides["X_test"].columns and sides["X_train"].count() == 8
    assert sides["y_test"].columns == ["id", "log_buy_price"]
    joined = sides["X_test"].join(sides["y_test"], "id").select(F.expm1("log_buy_price")).collect()
    assert sorted(r[0] for r in joined) == pytest.approx([8.0, 9.0])
    plain = export.export_train_test(df, df, "y", ["id"], str(tmp_path / "p"), target_name="t", transform_y="sqrt")
    assert spark.read.parquet(plain["y_train"]).agg(F.sum("t")).first()[0] == 45.0


def test_export_split_prunes(spark, tmp_path):
    df = spark.range(10).withColumn("split", F.when(F.col("id") < 8, "train").otherwise("test"))
    path = export.export_split(df, str(tmp_path / "s"))
    test = spark.read.parquet(path).where("split = 'test'")
    assert test.count() == 2 and "PartitionFilters: [isnotnull(split" in test._jdf.queryExecution().toString()


def test_scratch_follows_the_session(spark):
    assert scratch.scratch_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
