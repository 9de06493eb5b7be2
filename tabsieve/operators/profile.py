"""Column diagnostics.

Everything that one scan can tell about all columns comes from one aggregation
(:func:`column_facts`).  Distinct counts are the exception: many exact distincts
in one aggregation multiply the rows, so a sketch decides the columns that are
far beyond the limit and only the others are counted exactly.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.nulls import doubles, is_nested, is_numeric, known, known_double, require_columns, type_of
from ..functions.quantiles import exact_quantiles
from .columns import numeric_columns, string_columns

# The texts that stand for a missing value.
MISSING_TOKENS = ("", "na", "NA", "null", "NULL")

# A distinct count is taken from the sketch only when the sketch says at least
# this many times the limit; its standard error is 5 %, so that is 20 sigma away.
SKETCH_FACTOR = 2


@dataclass(frozen=True)
class ColumnFacts:
    """What one scan says about one column."""

    position: int
    column: str
    dtype: str
    kind: str
    rows: int
    non_null: int
    constant: bool
    boolean: bool
    missing_like: bool
    distinct_estimate: int | None

    @property
    def empty(self) -> bool:
        return self.non_null == 0

    @property
    def null_share(self) -> float | None:
        return 1.0 - self.non_null / self.rows if self.rows else None

    @property
    def fill_rate(self) -> float | None:
        return 100.0 * self.non_null / self.rows if self.rows else None


def kind_of(dtype: T.DataType) -> str:
    if isinstance(dtype, T.BooleanType):
        return "boolean"
    if is_numeric(dtype):
        return "numeric"
    if isinstance(dtype, T.StringType):
        return "string"
    if isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return "temporal"
    return "other"


def plain_columns(df: DataFrame, key_cols: Sequence[str] = ()) -> list[str]:
    """Columns the diagnostics look at: not a key, not nested."""
    keys = set(require_columns(df, key_cols))
    return [f.name for f in df.schema if f.name not in keys and not is_nested(f.dataType)]


def column_facts(df: DataFrame, key_cols: Sequence[str] = (),
                 cols: Sequence[str] | None = None) -> list[ColumnFacts]:
    """One aggregation over all (or the given) columns, in frame order."""
    names = plain_columns(df, key_cols) if cols is None else require_columns(df, cols)
    if not names:
        return []
    tokens = ", ".join(f"'{t}'" for t in MISSING_TOKENS)
    values = df.select(*[known(df, c).alias(f"c{i}") for i, c in enumerate(names)])
    aggs = ["count(1) as rows"]
    for i, name in enumerate(names):
        c, dtype = f"c{i}", df.schema[name].dataType
        aggs.append(f"count({c}) as n{i}")
        if isinstance(dtype, T.StringType):
            aggs += [f"count_if({c} in ({tokens})) as m{i}", f"approx_count_distinct({c}) as d{i}"]
        if is_numeric(dtype):
            aggs.append(f"count_if({c} not in (0, 1)) as other{i}")
        if not isinstance(dtype, T.NullType):
            aggs.append(f"min({c}) = max({c}) as same{i}")
    row = values.agg(*map(F.expr, aggs)).first().asDict()
    facts = []
    for i, name in enumerate(names):
        dtype, total, non_null = df.schema[name].dataType, row["rows"], row[f"n{i}"]
        uniform = bool(row.get(f"same{i}"))
        boolean = (isinstance(dtype, T.BooleanType) or non_null == 0
                   or (is_numeric(dtype) and row[f"other{i}"] == 0))
        facts.append(ColumnFacts(
            position=df.columns.index(name), column=name, dtype=dtype.simpleString(),
            kind=kind_of(dtype), rows=total, non_null=non_null,
            constant=non_null == 0 or (uniform and non_null == total),
            boolean=boolean, missing_like=non_null < total or bool(row.get(f"m{i}")), distinct_estimate=row.get(f"d{i}"),
        ))
    return facts


def empty_columns(df: DataFrame, key_cols: Sequence[str] = ()) -> list[str]:
    """Columns without a value; in a frame without rows, every column."""
    names = plain_columns(df, key_cols)
    if not names:
        return []
    counts = df.agg(*[F.count(known(df, c)).alias(f"n{i}") for i, c in enumerate(names)]).first()
    return [c for c, n in zip(names, counts) if n == 0]


def unique_value_columns(df: DataFrame, key_cols: Sequence[str] = ()) -> list[str]:
    """Columns with at most one distinct value, a missing value being one of them."""
    return [f.column for f in column_facts(df, key_cols) if f.constant]


def boolean_columns(df: DataFrame, key_cols: Sequence[str] = ()) -> list[str]:
    """Columns whose values are all true/false or 1/0."""
    return [f.column for f in column_facts(df, key_cols) if f.boolean]


def high_na_columns(df: DataFrame, threshold: float = 0.5, key_cols: Sequence[str] = ()) -> list[str]:
    """Columns whose share of missing values is strictly above ``threshold``."""
    names = plain_columns(df, key_cols)
    if not names:
        return []
    row = df.agg(F.count(F.lit(1)), *[F.count(known(df, c)).alias(f"n{i}") for i, c in enumerate(names)]).first()
    total = row[0]
    return [c for c, n in zip(names, row[1:]) if total and (total - n) / total > threshold]


def missing_like_columns(df: DataFrame, key_cols: Sequence[str] = ()) -> list[str]:
    """Columns holding a missing value or a text that stands for one."""
    return [f.column for f in column_facts(df, key_cols) if f.missing_like]


def _one_zero(df: DataFrame, col: str) -> Column:
    """The known value; of floating-point numbers, -0.0 as 0.0."""
    kind = type_of(df, col)
    return known(df, col) + F.lit(0).cast(kind) if isinstance(kind, (T.DoubleType, T.FloatType)) else known(df, col)


def long_values(df: DataFrame, cols: Sequence[str], texts: dict[str, Column] | None = None) -> DataFrame:
    """Unpivot columns to (column, value as text), one pass for all of them."""
    texts = texts or {}
    pairs = [F.struct(F.lit(c).alias("column"),
                      texts.get(c, _one_zero(df, c).cast("string")).alias("value")) for c in cols]
    return df.select(F.inline(F.array(*pairs)))


def distinct_counts(df: DataFrame, cols: Sequence[str] | None = None, dropna: bool = True,
                    key_cols: Sequence[str] = ()) -> DataFrame:
    """Exact number of distinct values per column: ``(column, n_distinct)``.

    Values are first reduced to one row per distinct value, so a value that
    fills half of the table weighs no more than any other.
    """
    cols = plain_columns(df, key_cols) if cols is None else require_columns(df, cols)
    values = long_values(df, cols).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    counted = F.count("value") if dropna else F.count(F.lit(1))
    found = values.groupBy("column").agg(counted.alias("n_distinct"))
    names = df.sparkSession.createDataFrame([(c,) for c in cols], "column string")
    return names.join(found, "column", "left").select(
        "column", F.coalesce("n_distinct", F.lit(0).cast("bigint")).alias("n_distinct"))


def _beyond_limit(df: DataFrame, estimates: dict[str, int], limit: int) -> set[str]:
    sure = {c for c, n in estimates.items() if n > max(SKETCH_FACTOR * limit, 100)}
    close = [c for c in estimates if c not in sure]
    if close:
        exact = distinct_counts(df, close).where(F.col("n_distinct") > limit).collect()
        sure.update(r["column"] for r in exact)
    return sure


def high_cardinality_columns(df: DataFrame, max_modalities: int = 20,
                             key_cols: Sequence[str] = ()) -> list[str]:
    """Text columns with more than ``max_modalities`` distinct values."""
    names = [c for c in string_columns(df) if c not in set(key_cols)]
    if not names:
        return []
    row = df.agg(*[F.approx_count_distinct(known(df, c)).alias(f"d{i}")
                   for i, c in enumerate(names)]).first()
    beyond = _beyond_limit(df, dict(zip(names, row)), max_modalities)
    return [c for c in names if c in beyond]


PROFILE_SCHEMA = T.StructType([
    T.StructField("position", T.IntegerType(), False),
    T.StructField("column", T.StringType(), False),
    T.StructField("kind", T.StringType(), False),
    T.StructField("n_rows", T.LongType(), False),
    T.StructField("non_null", T.LongType(), False),
    T.StructField("fill_rate", T.DoubleType(), True),
    T.StructField("is_empty", T.BooleanType(), False),
    T.StructField("is_constant", T.BooleanType(), False),
    T.StructField("is_boolean", T.BooleanType(), False),
    T.StructField("is_string", T.BooleanType(), False),
    T.StructField("is_numeric", T.BooleanType(), False),
    T.StructField("is_sparse", T.BooleanType(), False),
    T.StructField("is_missing_like", T.BooleanType(), False),
    T.StructField("is_high_cardinality", T.BooleanType(), False),
])


def profile(df: DataFrame, na_threshold: float = 0.5, max_modalities: int = 20,
            key_cols: Sequence[str] = ()) -> DataFrame:
    """The full diagnosis: one row per column, with every flag."""
    facts = column_facts(df, key_cols)
    texts = {f.column: f.distinct_estimate for f in facts if f.distinct_estimate is not None}
    crowded = _beyond_limit(df, texts, max_modalities)
    rows = [(f.position, f.column, f.kind, f.rows, f.non_null, f.fill_rate, f.empty, f.constant,
             f.boolean, f.kind == "string", f.kind == "numeric",
             f.rows > 0 and (f.rows - f.non_null) / f.rows > na_threshold,
             f.missing_like, f.column in crowded) for f in facts]
    return df.sparkSession.createDataFrame(rows, PROFILE_SCHEMA)


def _per_column(df: DataFrame, cols: Sequence[str], measure, alias: str) -> DataFrame:
    """One aggregation, turned into ``(position, column, <alias>)`` rows."""
    wide = df.agg(*[measure(known(df, c)).alias(f"v{i}") for i, c in enumerate(cols)])
    rows = F.array(*[F.struct(F.lit(df.columns.index(c)).alias("position"), F.lit(c).alias("column"),
                              F.col(f"v{i}").alias(alias)) for i, c in enumerate(cols)])
    return wide.select(F.inline(rows))


def fill_rate(df: DataFrame, key_cols: Sequence[str] = ()) -> DataFrame:
    """Percentage of rows with a value: ``(position, column, fill_rate)``, NULL without rows."""
    total = F.nullif(F.count(F.lit(1)), F.lit(0))
    return _per_column(df, plain_columns(df, key_cols),
                       lambda c: F.lit(100.0) * F.count(c) / total, "fill_rate")


def missing_percent(df: DataFrame, top_n: int | None = None, key_cols: Sequence[str] = ()) -> DataFrame:
    """Percentage of missing values, highest first: ``(column, missing_pct)``."""
    total = F.nullif(F.count(F.lit(1)), F.lit(0))
    rates = _per_column(df, plain_columns(df, key_cols),
                        lambda c: F.lit(100.0) * (F.count(F.lit(1)) - F.count(c)) / total, "missing_pct")
    ordered = rates.orderBy(F.desc_nulls_last("missing_pct"), "column").select("column", "missing_pct")
    return ordered if top_n is None else ordered.limit(top_n)


DESCRIBE_SCHEMA = ("position int, column string, count bigint, mean double, std double, min double, "
                   "q25 double, q50 double, q75 double, max double")


def describe_numeric(df: DataFrame, cols: Sequence[str] | None = None,
                     key_cols: Sequence[str] = ()) -> DataFrame:
    """Count, mean, sample deviation, minimum, exact quartiles and maximum per numeric column."""
    names = [c for c in numeric_columns(df) if c not in set(key_cols)] if cols is None else require_columns(df, cols)
    if not names:
        return df.sparkSession.createDataFrame([], DESCRIBE_SCHEMA)
    row = doubles(df, names).agg(*[
        F.expr(f"{f}(c{i}) as {f}{i}") for i in range(len(names))
        for f in ("count", "avg", "stddev_samp", "min", "max")]).first()
    values = {c: known_double(df, c) for c in names}
    quartiles = exact_quantiles(df, values, (0.25, 0.5, 0.75))
    return df.sparkSession.createDataFrame(
        [(df.columns.index(c), c, row[f"count{i}"], row[f"avg{i}"], row[f"stddev_samp{i}"],
          row[f"min{i}"], *quartiles[c], row[f"max{i}"]) for i, c in enumerate(names)], DESCRIBE_SCHEMA)


def info(df: DataFrame) -> DataFrame:
    """Name, type and number of values per column: ``(position, column, dtype, non_null)``."""
    counts = _per_column(df, df.columns, F.count, "non_null")
    types = F.array(*[F.lit(f.dataType.simpleString()) for f in df.schema])
    return counts.select("position", "column", F.get(types, F.col("position")).alias("dtype"), "non_null")


def shape(df: DataFrame) -> tuple[int, int]:
    return df.count(), len(df.columns)


def diagnose(df: DataFrame, key_cols: Sequence[str] = ()) -> DataFrame:
    """The profile with the limits of a first look: half missing, more than two modalities."""
    return profile(df, na_threshold=0.5, max_modalities=2, key_cols=key_cols)
