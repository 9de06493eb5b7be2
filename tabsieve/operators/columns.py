"""Choosing and dropping columns; everything here but the all-null drop reads only the schema."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.nulls import is_numeric, known, ref, require_columns


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]


def numeric_columns(df: DataFrame) -> list[str]:
    """Integer, floating point and decimal columns; booleans are not numbers."""
    return [f.name for f in df.schema if is_numeric(f.dataType)]


def identify_column_types(df: DataFrame, key_cols: Sequence[str] = ()) -> tuple[list[str], list[str]]:
    """Numeric columns, and everything else, keys left out."""
    columns = [f for f in df.schema if f.name not in set(key_cols)]
    return ([f.name for f in columns if is_numeric(f.dataType)],
            [f.name for f in columns if not is_numeric(f.dataType)])


def drop_columns(df: DataFrame, cols: Iterable[str]) -> tuple[DataFrame, list[str]]:
    """The frame without these columns, all of which must exist, and their names."""
    gone = require_columns(df, cols)
    return df.drop(*gone), gone


def drop_one_column(df: DataFrame, col: str) -> tuple[DataFrame, list[str]]:
    return drop_columns(df, [col])


def drop_columns_if_present(df: DataFrame, cols: Iterable[str] | None) -> DataFrame:
    return df.drop(*(cols or []))


def select_existing(df: DataFrame, features: Iterable[str]) -> DataFrame:
    """Those of the wanted columns that the schema has, in the wanted order, as often as wanted."""
    known_names = {field.name: ref(field.name) for field in df.schema}
    return df.select(*filter(lambda column: column is not None, map(known_names.get, features)))


def drop_empty_columns(df: DataFrame, key_cols: Sequence[str] = ()) -> DataFrame:
    """Drop the columns without a single value: one aggregation, then a projection."""
    from .profile import empty_columns

    return df.drop(*empty_columns(df, key_cols))


def features_and_target(df: DataFrame, target: str) -> tuple[DataFrame, DataFrame]:
    """Two views of one frame: the features, and the target column."""
    require_columns(df, [target])
    return df.drop(target), df.select(ref(target))


def where_known(df: DataFrame, col: str) -> DataFrame:
    """Rows that have a value in ``col``."""
    require_columns(df, [col])
    return df.where(known(df, col).isNotNull())


def share_of(df: DataFrame, col: str, value: object) -> Column:
    """Percentage of rows equal to ``value``; missing values count as different."""
    require_columns(df, [col])
    hit = F.coalesce(known(df, col) == F.lit(value), F.lit(False))
    return F.avg(hit.cast("double")) * 100


def class_share(df: DataFrame, col: str, value: object) -> DataFrame:
    return df.agg(share_of(df, col, value).alias("share"))


def head(df: DataFrame, n: int, order_by: Sequence[str]) -> DataFrame:
    """The first ``n`` rows in key order."""
    return df.orderBy(*[ref(c) for c in require_columns(df, order_by)]).limit(n)
