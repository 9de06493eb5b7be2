"""Seeded random inputs and weights for the perceptron."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.hashing import digest_int, digest_unit, key_digest
from ..functions.nulls import ref, require_columns

MAX_INPUT = 10      # fixed value: inputs are integers from 0 to 10 inclusive


def _positions(size: int) -> Column:
    """0 … size - 1, none for size 0."""
    if size < 0:
        raise ValueError("size must not be negative")
    return F.sequence(F.lit(0), F.lit(size - 1)) if size else F.array().cast("array<int>")


def random_terms(df: DataFrame, key_cols: Sequence[str], size: int, seed: int = 42) -> DataFrame:
    """``size`` terms per row of ``df``: ``(key…, pos, x, w)``, x in 0…10 and w in [0, 1).

    Each term is a function of the key, its position and the seed, so a task
    that runs again draws the same numbers.
    """
    require_columns(df, key_cols)
    rows = df.select(*[ref(c) for c in key_cols], F.explode(_positions(size)).alias("pos"))
    keys = [*key_cols, "pos"]
    return rows.select(*[ref(c) for c in keys],
                       digest_int(key_digest(keys, seed, "x"), MAX_INPUT + 1).alias("x"),
                       digest_unit(key_digest(keys, seed, "w")).alias("w"))


def keyed_vectors(df: DataFrame, key_cols: Sequence[str], size: int, seed: int = 42) -> DataFrame:
    """One sample ``(key…, x array<int>, w array<double>)`` of the given size per row of ``df``."""
    require_columns(df, key_cols)
    positions = _positions(size)

    def drawn(salt: str) -> Callable[[Column], Column]:
        return lambda p: key_digest([*key_cols, p], seed, salt)

    x, w = drawn("x"), drawn("w")
    return df.select(*[ref(c) for c in key_cols],
                     F.transform(positions, lambda p: digest_int(x(p), MAX_INPUT + 1)).alias("x"),
                     F.transform(positions, lambda p: digest_unit(w(p))).alias("w"))


def random_vectors(spark: SparkSession, n: int, size: int, seed: int = 42) -> DataFrame:
    """``n`` samples ``(id, x array<int>, w array<double>)`` of the given size."""
    return keyed_vectors(spark.range(n), ["id"], size, seed)
