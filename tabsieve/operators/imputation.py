"""Filling missing values with statistics of the column itself."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.nulls import is_numeric, known, known_double, ref, require_columns, type_of
from ..functions.quantiles import exact_quantiles
from .cleaning import with_replaced
from .columns import numeric_columns, string_columns
from .profile import long_values


def medians(df: DataFrame, values: Mapping[str, Column]) -> dict[str, float | None]:
    return {c: q[0] for c, q in exact_quantiles(df, values, (0.5,)).items()} if values else {}


def modes(df: DataFrame, cols: Sequence[str]) -> dict[str, Any]:
    """Most frequent value per column; the smallest one on a tie; nothing for an all-null column.

    One pre-aggregated count over (column, value), then one minimum per column.
    """
    cols = require_columns(df, cols)
    if not cols:
        return {}
    numbers = [c for c in cols if is_numeric(type_of(df, c))]
    counts = (long_values(df, cols).where(F.col("value").isNotNull())
              .groupBy("column", "value").agg(F.count(F.lit(1)).alias("n")))
    as_number = F.when(F.col("column").isin(numbers), F.col("value").try_cast("double"))
    best = counts.groupBy("column").agg(
        F.min(F.struct((-F.col("n")).alias("rank"), as_number.alias("number"), "value")).alias("best"))
    found = {r["column"]: r["best"]["value"] for r in best.collect()}
    if not found:
        return {}
    names = [c for c in cols if c in found]
    typed = df.sparkSession.range(1).select(
        *[F.lit(found[c]).cast(type_of(df, c)).alias(f"v{i}") for i, c in enumerate(names)]).first()
    return dict(zip(names, typed))


def impute_numeric(df: DataFrame, cols: Sequence[str] | None = None, strategy: str = "median") -> DataFrame:
    """Fill numeric columns with their median, mean or zero; an all-null column stays as it is."""
    if strategy not in ("median", "mean", "zero"):
        raise ValueError("strategy must be 'median', 'mean' or 'zero'")
    cols = numeric_columns(df) if cols is None else require_columns(df, cols)
    if not cols:
        return df
    if strategy == "zero":
        return with_replaced(df, {c: F.coalesce(known(df, c), F.lit(0).cast(type_of(df, c))) for c in cols})
    values = {c: known_double(df, c) for c in cols}
    if strategy == "median":
        fills = medians(df, values)
    else:
        row = df.agg(*[F.avg(values[c]).alias(f"a{i}") for i, c in enumerate(cols)]).first()
        fills = dict(zip(cols, row))
    return with_replaced(df, {c: F.coalesce(v, F.lit(fills[c]).cast("double")) for c, v in values.items()})


def impute_categorical(df: DataFrame, cols: Sequence[str] | None = None,
                       fill_value: str = "missing") -> DataFrame:
    """Fill missing texts with a constant."""
    cols = string_columns(df) if cols is None else require_columns(df, cols)
    return with_replaced(df, {c: F.coalesce(ref(c), F.lit(fill_value)) for c in cols})


def impute_mode(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Fill columns with their most frequent value; names that do not exist are skipped."""
    cols = [c for c in cols if c in df.columns]
    fills = modes(df, cols)
    return with_replaced(df, {c: F.coalesce(known(df, c), F.lit(v).cast(type_of(df, c))) for c, v in fills.items()})
