"""Duplicate rows, without ever gathering a group of copies in one task.

Groups with copies are found by a pre-aggregated count, so a text that makes up
a third of the table is one row per task when it is shuffled.  The rows of
those groups come back by a join whose right side has one row per group: small
sides are broadcast at run time, and a hot group on the left is split by
adaptive execution.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import Literal

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.nulls import is_nested, known, ref, require_columns, type_of

COPIES_PER_ROW = 10_000
LONG_TEXT = 64      # bytes; longer texts are compared by digest


def _compared(df: DataFrame, subset: Sequence[str] | None, key_cols: Sequence[str]) -> list[str]:
    if subset is not None:
        return require_columns(df, subset)
    keys = set(require_columns(df, key_cols))
    return [c for c in df.columns if c not in keys]


def _group_key(df: DataFrame, name: str) -> Column:
    """What a value is compared by: long texts by their SHA-256, so no document is shuffled to be counted."""
    value = known(df, name)
    if not isinstance(type_of(df, name), T.StringType):
        return value
    # the first letter keeps a text that looks like a digest apart from a digest
    return F.when(F.octet_length(value) > LONG_TEXT, F.concat(F.lit("h"), F.sha2(value, 256))).otherwise(
        F.concat(F.lit("t"), value))


def _same_group(rows: DataFrame, cols: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b,
                  [_group_key(rows, c).eqNullSafe(F.col(f"__g{i}")) for i, c in enumerate(cols)])


def _group_keys(df: DataFrame, cols: Sequence[str]) -> list[Column]:
    return [_group_key(df, c).alias(f"__g{i}") for i, c in enumerate(cols)]


def _repeat(counted: DataFrame, times: str, cols: Sequence[str]) -> DataFrame:
    """Emit each row ``times`` times; a huge count is cut into pieces, and these again, spread over tasks."""
    def cut(rows: DataFrame, size: int, within: int) -> DataFrame:
        steps = F.sequence(F.col("__from"), F.least(F.col("__from") + within, F.col(times)) - 1, F.lit(size).cast("bigint"))
        return rows.select(*[ref(c) for c in cols], times, "__spread", F.explode(steps).alias("__from"))

    spread = F.xxhash64(*[ref(c) for c in cols])
    whole = counted.select("*", F.lit(0).cast("bigint").alias("__from"), spread.alias("__spread"))
    coarse = cut(whole, COPIES_PER_ROW**2, 1 << 62)
    fine = cut(coarse.repartition("__from", "__spread"), COPIES_PER_ROW, COPIES_PER_ROW**2)
    each = cut(fine.repartition("__from", "__spread"), 1, COPIES_PER_ROW)
    return each.select(*[ref(c) for c in cols])


def _surplus_copies(rows: DataFrame) -> DataFrame:
    """Each row that comes more than once, with ``__copies``, how often beyond the first; digests are the group keys."""
    cols = rows.columns
    whole = F.struct(*[known(rows, c).alias(f"v{i}") for i, c in enumerate(cols)])
    groups = rows.groupBy(*_group_keys(rows, cols)).agg(
        F.any_value(whole).alias("__row"), (F.count(F.lit(1)) - 1).alias("__copies"))
    return groups.where("__copies > 0").select(*[F.col(f"__row.v{i}").alias(c) for i, c in enumerate(cols)], "__copies")


def duplicate_rows(df: DataFrame, subset: Sequence[str] | None = None,
                   keep: Literal["first", "last", False] = "first",
                   order_by: Sequence[str] | None = None, key_cols: Sequence[str] = ()) -> DataFrame:
    """The duplicate rows: all but the first, all but the last, or all rows of a repeated group.

    ``subset`` defaults to every column but the keys.  "First" and "last" follow
    ``order_by`` (default: the keys).  ``key_cols`` name rows uniquely and break
    ties; without them, ties in ``order_by`` are broken by the other columns, and
    rows alike in every column are interchangeable, so all but one are returned.
    """
    if keep not in ("first", "last", False):
        raise ValueError("keep must be 'first', 'last' or False")
    cols = _compared(df, subset, key_cols)
    if not cols:
        raise ValueError("no columns to compare")
    keys = _group_keys(df, cols)
    names = [f"__g{i}" for i in range(len(cols))]
    if keep is False:
        repeated = df.groupBy(*keys).count().where("count > 1").select(*names)
        return df.join(repeated, _same_group(df, cols), "left_semi")

    if order_by is None and not key_cols and set(cols) == set(df.columns):
        # digests are counted first, so only rows that repeat are fetched whole
        repeated = df.groupBy(*keys).agg((F.count(F.lit(1)) - 1).alias("__copies")).where("__copies > 0")
        rows = df.join(repeated, _same_group(df, cols), "inner").select(*[ref(c) for c in df.columns])
        return _repeat(_surplus_copies(rows), "__copies", df.columns)
    if order_by is None and not key_cols:
        raise ValueError("keep='first'/'last' needs order_by or key_cols: rows have no order of their own")

    order = list(require_columns(df, order_by or ())) + [c for c in key_cols if c not in (order_by or ())]
    if not key_cols:
        order += [c for c in df.columns if c not in order and not is_nested(type_of(df, c))]
    kept_first = keep == "first"
    if len(order) == 1 and isinstance(type_of(df, order[0]), (T.NumericType, T.DatetimeType)):
        # a fixed-width value is aggregated by hash; a missing one comes before all others
        place = known(df, order[0])
        behind = (place > F.col("__kept")) | (F.col("__gaps") > 0)
        before = place.isNull() & F.col("__kept").isNotNull() | (place < F.col("__kept"))
        beyond = place.isNotNull() & behind if kept_first else before
        tied = place.eqNullSafe(F.when((F.col("__gaps") == 0) | F.lit(not kept_first), F.col("__kept")))
    else:
        place = F.struct(*[known(df, c).alias(f"o{i}") for i, c in enumerate(order)])
        beyond = place > F.col("__kept") if kept_first else place < F.col("__kept")
        tied = place == F.col("__kept")
    groups = df.groupBy(*keys).agg(
        (F.min(place) if kept_first else F.max(place)).alias("__kept"), F.count(F.lit(1)).alias("__n"),
        (F.count(F.lit(1)) - F.count(place)).alias("__gaps")).where("__n > 1")
    joined = df.join(groups, _same_group(df, cols), "inner")
    surplus = joined.where(beyond).select(*[ref(c) for c in df.columns])
    if key_cols:
        return surplus
    # Rows equal to the kept one in every column: all but one of them are surplus, too.
    level = _surplus_copies(joined.where(tied).select(*[ref(c) for c in df.columns]))
    return surplus.unionByName(_repeat(level, "__copies", df.columns))


def duplicate_count(df: DataFrame, subset: Sequence[str] | None = None,
                    key_cols: Sequence[str] = ()) -> DataFrame:
    """Rows beyond the first of each group, as a one-row frame ``(n_duplicates)``."""
    keys = _group_keys(df, _compared(df, subset, key_cols))
    groups = df.groupBy(*keys).agg((F.count(F.lit(1)) - 1).alias("surplus"))
    return groups.agg(F.coalesce(F.sum("surplus"), F.lit(0).cast("bigint")).alias("n_duplicates"))


def count_duplicates(df: DataFrame, subset: Sequence[str] | None = None,
                     key_cols: Sequence[str] = ()) -> int:
    return duplicate_count(df, subset, key_cols).first()[0]


def require_unique_key(df: DataFrame, key_cols: Sequence[str]) -> None:
    """Raise if two rows share a key."""
    surplus = count_duplicates(df, subset=list(key_cols))
    if surplus:
        raise ValueError(f"{list(key_cols)} is no key: {surplus} rows repeat one")
