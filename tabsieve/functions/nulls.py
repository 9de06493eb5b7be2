"""One notion of "missing", and the conversions that can create it.

Spark has two missing values for floating point columns, NULL and NaN.  Every
operator of this package reads its columns through :func:`known`, which folds
NaN into NULL, so counts, averages, sorts and joins agree on what is missing.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F, types as T

NESTED = (T.ArrayType, T.MapType, T.StructType, T.VariantType, T.BinaryType)


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def ref(name: str) -> Column:
    """Reference a top-level column whose name may hold dots or backticks."""
    return F.col(quoted(name))


def sql_double(v: float) -> str:
    """A double as a SQL literal, to the last digit."""
    return f"double('{float(v)!r}')" if math.isinf(v) or math.isnan(v) else f"{float(v)!r}D"


def doubles(df: DataFrame, cols: Sequence[str], prefix: str = "c") -> DataFrame:
    """Project numeric columns to ``c0, c1, …`` as doubles, NaN read as NULL."""
    return df.select(*[known_double(df, c).alias(f"{prefix}{i}") for i, c in enumerate(cols)])


def type_of(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


def is_numeric(dtype: T.DataType) -> bool:
    return isinstance(dtype, T.NumericType)


def is_float(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.FloatType, T.DoubleType))


def is_nested(dtype: T.DataType) -> bool:
    return isinstance(dtype, NESTED)


def require_columns(df: DataFrame, cols: Iterable[str]) -> list[str]:
    """Return ``cols`` as a list; raise if one of them does not exist."""
    cols = list(cols)
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"unknown columns {missing}; the frame has {df.columns}")
    return cols


def known(df: DataFrame, name: str) -> Column:
    """The column with NaN read as NULL."""
    c = ref(name)
    return F.when(~F.isnan(c), c) if is_float(type_of(df, name)) else c


def known_double(df: DataFrame, name: str) -> Column:
    """A numeric column as double, NaN read as NULL."""
    return known(df, name).cast("double")


def unify_nulls(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Replace NaN by NULL in all (or the given) floating point columns."""
    wanted = set(df.columns if cols is None else require_columns(df, cols))
    return df.select(
        [known(df, c).alias(c) if c in wanted else ref(c) for c in df.columns]
    )


# What counts as a number in text: no type letter ("1d"), hexadecimal or digit separator.
NUMBER = r"^\s*[+-]?([0-9]+\.?[0-9]*([eE][+-]?[0-9]+)?|\.[0-9]+([eE][+-]?[0-9]+)?|(?i:inf|infinity))\s*$"


def to_numeric(c: Column, dtype: T.DataType) -> Column:
    """Coerce to double; what does not parse becomes NULL.

    The pattern is stricter than Java's parser, and it keeps other texts away
    from ``try_cast``, where each failure costs an exception.
    """
    if isinstance(dtype, T.StringType):
        return F.when(c.rlike(NUMBER), c.try_cast("double"))
    if isinstance(dtype, (T.NumericType, T.BooleanType, T.NullType)):
        value = c.cast("double")
        return F.when(~F.isnan(value), value)
    raise ValueError(f"cannot read {dtype.simpleString()} as a number")


def replace_values(c: Column, dtype: T.DataType, mapping: Mapping[Any, Any]) -> Column:
    """Swap exact values, then coerce to double.

    A key only ever equals values of its own kind: text keys on text columns,
    number keys on numeric columns.
    """
    def as_number(v: Any) -> Column:
        if v is None:
            return F.lit(None).cast("double")
        if isinstance(v, str):
            return to_numeric(F.lit(v), T.StringType())
        return F.lit(float(v))

    coerced = to_numeric(c, dtype)
    text = isinstance(dtype, T.StringType)
    chain = None
    for key, value in mapping.items():
        if isinstance(key, str) != text:
            continue
        hit = c == F.lit(key)
        chain = F.when(hit, as_number(value)) if chain is None else chain.when(hit, as_number(value))
    return coerced if chain is None else chain.otherwise(coerced)


def drop_below(c: Column, bound: float | None) -> Column:
    """NULL for numbers strictly below ``bound``."""
    return c if bound is None else F.when(c >= F.lit(float(bound)), c)


def log1p_or_null(c: Column) -> Column:
    """log(1 + c), NULL where it is not a finite number."""
    return F.when(c > -1, F.log1p(c))
