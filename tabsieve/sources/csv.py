"""Delimited files with missing-value tokens, row keys and unnamed columns."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..functions.nulls import ref, require_columns, to_numeric

# The texts read as missing.
NA_TOKENS = ("", "na", "NA", "null", "NULL", "NaN", "nan", "N/A", "None")
# The texts read as booleans.
TRUE_TOKENS = ("True", "TRUE", "true")
FALSE_TOKENS = ("False", "FALSE", "false")


def _name_blank_headers(df: DataFrame) -> DataFrame:
    """A blank header is called ``Unnamed: <position>``."""
    return df.toDF(*[f"Unnamed: {i}" if c == f"_c{i}" else c for i, c in enumerate(df.columns)])


def key_columns(df: DataFrame, index_col: str | int | Sequence[str | int] | None) -> list[str]:
    """Resolve a row key given by names or 0-based positions."""
    if index_col is None:
        return []
    wanted = [index_col] if isinstance(index_col, (str, int)) else list(index_col)
    for c in wanted:
        if isinstance(c, int) and not 0 <= c < len(df.columns):
            raise ValueError(f"no column at position {c}")
    return require_columns(df, [df.columns[c] if isinstance(c, int) else c for c in wanted])


def _boolean(c: Column) -> Column:
    return F.when(c.isin(*TRUE_TOKENS), True).when(c.isin(*FALSE_TOKENS), False)


def _infer(df: DataFrame) -> dict[str, T.DataType]:
    """The narrowest of boolean, bigint, double, string that every value fits; one scan for all columns."""
    aggs = []
    for i, c in enumerate(df.columns):
        v = ref(c)
        aggs += [F.count(v).alias(f"n{i}"), F.count(_boolean(v)).alias(f"b{i}"),
                 F.count(F.when(v.rlike(r"^\s*[+-]?[0-9]{1,19}\s*$"), v.try_cast("bigint"))).alias(f"i{i}"),
                 F.count(to_numeric(v, T.StringType())).alias(f"f{i}")]
    row = df.agg(*aggs).first()
    types: dict[str, T.DataType] = {}
    for i, c in enumerate(df.columns):
        n = row[f"n{i}"]
        if n == 0:
            types[c] = T.DoubleType()
        elif row[f"b{i}"] == n:
            types[c] = T.BooleanType()
        elif row[f"i{i}"] == n:
            types[c] = T.LongType()
        elif row[f"f{i}"] == n:
            types[c] = T.DoubleType()
        else:
            types[c] = T.StringType()
    return types


def _typed(c: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.StringType):
        return c
    if isinstance(dtype, T.BooleanType):
        refused = F.raise_error(F.concat(F.lit("not a boolean: "), c)).cast("boolean")
        return F.when(c.isNull(), None).otherwise(F.coalesce(_boolean(c), refused))
    return F.trim(c).cast(dtype)


def _ends_within_quotes(sep: str) -> str:
    """Pattern of lines whose last field opens a quote and never closes it; linear, whatever a line holds."""
    end = re.escape(sep)
    field = f"[^{end}]*+" if len(sep) == 1 else f"(?:(?!{end}).)*+"
    quoted = '"(?:[^"]++|"")*+'
    return f'^(?:{quoted}"{field}{end}|(?!"){field}{end})*+{quoted}$'


def _broken(reason: Column) -> Column:
    return F.raise_error(F.concat(F.lit("malformed CSV row: "), reason))


def _by_line(raw: DataFrame, lines: DataFrame, sep: str) -> DataFrame:
    """Rows of lines that are whole records; one that is not is an error, whichever columns are read.

    A row comes out of a generator, so even counting rows parses each line.
    """
    fields = ", ".join(f"c{i} string" for i in range(len(raw.columns)))
    parsed = F.from_csv("line", fields, {"sep": sep, "quote": '"', "escape": '"', "mode": "FAILFAST"})
    hint = F.concat(F.lit("a quote is not closed at the end of a line; with line breaks inside quotes, set multi_line=True: "),
                    F.substring("line", 1, 200))
    record = F.when(F.col("line").rlike(_ends_within_quotes(sep)), _broken(hint)).otherwise(parsed)
    return lines.select(F.inline(F.array(record))).toDF(*raw.columns)


def _by_file(raw: DataFrame, sources: list[str], options: dict) -> DataFrame:
    """Records that may hold line breaks; one with too few or too many fields is an error, whichever columns are read."""
    schema = T.StructType([*(T.StructField(f"c{i}", T.StringType()) for i in range(len(raw.columns))),
                           T.StructField("__corrupt", T.StringType())])
    records = (raw.sparkSession.read.options(**options).options(multiLine=True, mode="PERMISSIVE", columnPruning=False,
                                                                columnNameOfCorruptRecord="__corrupt")
               .schema(schema).csv(sources))
    whole = F.when(F.col("__corrupt").isNotNull(), _broken(F.substring("__corrupt", 1, 200)).cast("boolean"))
    # the corrupt record may not be read alone, so a plain column that is never below 0 stands beside it
    return records.where(whole.otherwise(F.coalesce(F.length("c0"), F.lit(0)) >= 0)).drop("__corrupt").toDF(*raw.columns)


def read_csv(spark: SparkSession, path: str | Sequence[str], schema: T.StructType | str | None = None,
             encoding: str = "UTF-8", sep: str = ",", header: bool = True,
             na_values: Sequence[str] = NA_TOKENS, multi_line: bool = False) -> DataFrame:
    """Read delimited files; ``na_values`` become NULL before types are applied.

    Give a ``schema`` for large inputs: without one the types are inferred, which
    reads the files once more.  ``multi_line`` allows line breaks inside quotes,
    at the price of one task per file.  Without it such a break is an error that
    names the option, also where the parts happen to have the right number of
    fields.  Rows with too few or too many fields are an error, never cut or
    filled.  All this holds for any selection of the columns and for a count.
    """
    sources = [path] if isinstance(path, str) else list(path)
    options = {"header": header, "encoding": encoding, "sep": sep, "quote": '"', "escape": '"'}
    raw = _name_blank_headers(spark.read.options(**options, multiLine=multi_line).csv(sources))
    if multi_line:
        raw = _by_file(raw, sources, options)
    else:
        # whole lines: no quotes, and a separator that no text has (U+FFFF is not a character)
        lines = (spark.read.options(**{**options, "sep": "\uffff", "quote": "", "mode": "FAILFAST"}).schema("line string")
                 .csv(sources))
        raw = _by_line(raw, lines, sep)
    texts = raw.select([F.when(~ref(c).isin(*na_values), ref(c)).alias(c) for c in raw.columns])
    if schema is None:
        types = _infer(texts)
    else:
        declared = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
        types = {f.name: f.dataType for f in declared}
        require_columns(texts, types)
    return texts.select([_typed(ref(c), types[c]).alias(c) if c in types else ref(c) for c in texts.columns])


def write_csv(df: DataFrame, path: str, sep: str = ",", na_token: str = "", encoding: str = "UTF-8") -> str:
    """Write with a header line, doubling quotes inside quoted values."""
    (df.write.mode("overwrite").option("header", True).option("sep", sep).option("quote", '"')
     .option("escape", '"').option("encoding", encoding).option("nullValue", na_token).option("emptyValue", '""')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))
    return path
