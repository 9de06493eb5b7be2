"""Cleaning projections: every function is one ``select``, no shuffle."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions import nulls, text
from ..functions.nulls import known, ref, require_columns, type_of
from .columns import string_columns


def with_replaced(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """Replace columns in place, keeping their order, in a single projection."""
    return df.select([columns[c].alias(c) if c in columns else ref(c) for c in df.columns])


def _zero_or_one(df: DataFrame, name: str) -> Column:
    c, dtype = known(df, name), type_of(df, name)
    if isinstance(dtype, T.BooleanType):
        return c.cast("tinyint")
    if nulls.is_numeric(dtype):
        refused = F.raise_error(F.concat(F.lit(f"{name} is no boolean column, it holds "), c.cast("string")))
        return F.when(c.isNull() | c.isin(0, 1), c.cast("tinyint")).otherwise(refused.cast("tinyint"))
    raise ValueError(f"{name} is no boolean column but {dtype.simpleString()}")


def convert_bool_to_uint8(df: DataFrame, cols: Iterable[str], keep_na: bool = True) -> DataFrame:
    """True/false to 1/0; missing stays missing, or becomes 0 with ``keep_na=False``."""
    zero = F.lit(0).cast("tinyint")
    bits = {c: _zero_or_one(df, c) for c in require_columns(df, cols)}
    return with_replaced(df, {c: e if keep_na else F.coalesce(e, zero) for c, e in bits.items()})


def lower_columns(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Lower-case the named text columns; other and unknown names are left alone."""
    texts = set(string_columns(df))
    return with_replaced(df, {c: F.lower(ref(c)) for c in cols if c in texts})


def add_type_column(df: DataFrame, col_source: str, mapping: Mapping[str, str | None],
                    col_dest: str = "type") -> DataFrame:
    """Add the category of the first keyword found in ``col_source``."""
    require_columns(df, [col_source])
    if col_dest == col_source:
        raise ValueError("col_dest must differ from col_source")
    return df.withColumn(col_dest, text.keyword_category(ref(col_source), mapping))


def normalize_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return with_replaced(df, {c: text.normalize_text(ref(c)) for c in require_columns(df, cols)})


def normalize_all_text_columns(df: DataFrame) -> DataFrame:
    """Lower case without accents in every text column."""
    return normalize_columns(df, string_columns(df))


def to_numeric(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Read columns as numbers; what does not parse becomes NULL."""
    return with_replaced(df, {c: nulls.to_numeric(ref(c), type_of(df, c)) for c in require_columns(df, cols)})


def replace_and_invalidate(df: DataFrame, col: str, replace_map: Mapping[Any, Any] | None = None,
                           invalid_below: float | None = None) -> DataFrame:
    """Swap exact values, coerce to numbers, then void numbers below a bound (in that order)."""
    require_columns(df, [col])
    number = nulls.replace_values(ref(col), type_of(df, col), replace_map or {})
    return with_replaced(df, {col: nulls.drop_below(number, invalid_below)})


def log1p_column(df: DataFrame, col: str) -> DataFrame:
    return with_replaced(df, {col: nulls.log1p_or_null(nulls.known_double(df, col))})
