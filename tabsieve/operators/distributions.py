"""The data behind the distribution charts."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F, types as T

from ..functions.hashing import digest_unit, key_digest
from ..functions.nulls import doubles, known, known_double, log1p_or_null, ref, require_columns, sql_double, type_of
from ..functions.ordering import running_totals
from .columns import numeric_columns
from .profile import long_values

HISTOGRAM_SCHEMA = "column string, bin int, bin_start double, bin_end double, n bigint"
PARTIAL_TOP = 1_000     # up to here Spark keeps only the top rows of each task before the shuffle
PIVOTS = 4_096          # values, about, that part a full ranking into ranges


def bin_width(lo: float, hi: float, bins: int) -> float:
    """Width of equal bins; of a range too wide for a double, from the widths of its two parts."""
    return (hi - lo) / bins if math.isfinite(hi - lo) else hi / bins - lo / bins


def _bin_of(v: str, lo: float, hi: float, bins: int) -> str:
    """Index of the bin whose edges ``lo + i * step`` enclose the value; the last bin is closed.

    The division may round across an edge, so the guess is compared with the edges themselves.
    """
    start, step = sql_double(lo), sql_double(bin_width(lo, hi, bins))
    place = f"({v} - {start}) / {step}" if math.isfinite(hi - lo) else f"{v} / {step} - {start} / {step}"
    guess = f"cast(least(floor({place}), {bins - 1}) as int)"
    down = f"if({v} < {start} + {guess} * {step}, 1, 0)"
    up = f"if({v} >= {start} + ({guess} + 1) * {step} and {guess} < {bins - 1}, 1, 0)"
    return f"case when {v} is not null then {guess} - {down} + {up} end"      # least() skips NULL


def histograms(df: DataFrame, bins: int = 40, cols: Sequence[str] | None = None,
               key_cols: Sequence[str] = (), include_empty: bool = False) -> DataFrame:
    """Equal-width counts per numeric column: ``(column, bin, bin_start, bin_end, n)``.

    One aggregation for the ranges, then one count over all columns.  A column
    with a single value v gets the range v - 0.5 to v + 0.5.
    """
    if bins < 1:
        raise ValueError("bins must be at least 1")
    spark = df.sparkSession
    names = [c for c in numeric_columns(df) if c not in set(key_cols)] if cols is None else require_columns(df, cols)
    if not names:
        return spark.createDataFrame([], HISTOGRAM_SCHEMA)
    values = doubles(df, names)
    row = values.agg(*[F.expr(f"{f}(c{i}) as {f}{i}") for i in range(len(names)) for f in ("min", "max")]).first()
    ranges = {}
    for i, c in enumerate(names):
        lo, hi = row[f"min{i}"], row[f"max{i}"]
        if lo is None:
            continue
        if math.isinf(lo) or math.isinf(hi):
            raise ValueError(f"{c} holds infinite values: no finite range")
        ranges[c] = (lo, hi) if lo < hi else (lo - 0.5, hi + 0.5)
        if not 0 < bin_width(*ranges[c], bins) < math.inf:
            raise ValueError(f"{c}: no {bins} bins of a width that a double holds between {lo} and {hi}")
    if not ranges:
        return spark.createDataFrame([], HISTOGRAM_SCHEMA)
    entries = [f"named_struct('i', {i}, 'bin', {_bin_of(f'c{i}', *ranges[c], bins)})"
               for i, c in enumerate(names) if c in ranges]
    counts = (values.selectExpr(f"inline(array({', '.join(entries)}))").where("bin is not null")
              .groupBy("i", "bin").agg(F.count(F.lit(1)).alias("n")))
    edges = spark.createDataFrame(
        [(names.index(c), c, b, lo + b * width, hi if b == bins - 1 else lo + (b + 1) * width)
         for c, (lo, hi) in ranges.items() for width in [bin_width(lo, hi, bins)] for b in range(bins)],
        "i int, column string, bin int, bin_start double, bin_end double")
    joined = edges.join(counts, ["i", "bin"], "left" if include_empty else "inner")
    return joined.select("column", "bin", "bin_start", "bin_end",
                         F.coalesce("n", F.lit(0).cast("bigint")).alias("n"))


def qualitative_columns(df: DataFrame, key_cols: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema if f.name not in set(key_cols)
            and isinstance(f.dataType, (T.StringType, T.BooleanType))]


def value_counts(df: DataFrame, top_n: int | None = 20, cols: Sequence[str] | None = None,
                 key_cols: Sequence[str] = ()) -> DataFrame:
    """Most frequent values per text or boolean column, a missing value being one of them.

    ``(column, value, n, rank)``; equal counts are ordered by value, missing first.
    Counting is pre-aggregated per task.  Of a short list only the top rows of
    each task meet; a long one, or all values (``top_n=None``), is ranked by ranges.
    """
    cols = qualitative_columns(df, key_cols) if cols is None else require_columns(df, cols)
    if not cols:
        return df.sparkSession.createDataFrame([], "column string, value string, n bigint, rank bigint")
    labels = {c: F.initcap(known(df, c).cast("string")) for c in cols if isinstance(type_of(df, c), T.BooleanType)}
    counts = (long_values(df, cols, labels).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n")))
    if top_n is None or top_n > PARTIAL_TOP:
        ranked = _ranked_by_ranges(counts)
        return ranked if top_n is None else ranked.where(F.col("rank") <= top_n)
    order = [F.desc("n"), F.asc_nulls_first("value")]
    ranked = counts.withColumn("rank", F.row_number().over(Window.partitionBy("column").orderBy(*order)))
    ranked = ranked.withColumn("rank", F.col("rank").cast("bigint"))
    return ranked.where(F.col("rank") <= top_n)


def _ranked_by_ranges(counts: DataFrame) -> DataFrame:
    """Rank of every (column, value) by count, without one task that sees a whole column."""
    ranked = running_totals(counts.withColumn("fewest", -F.col("n")), ["column"], ["fewest", "value"], name="rank", pivots=PIVOTS)
    return ranked.select("column", "value", "n", "rank")


def target_counts(df: DataFrame, target: str) -> DataFrame:
    """Rows per class: ``(target, n)``."""
    require_columns(df, [target])
    return df.groupBy(known(df, target).alias(target)).agg(F.count(F.lit(1)).alias("n"))


def scatter_points(df: DataFrame, target: str, cols: Sequence[str], transform_y: str | None = None,
                   key_cols: Sequence[str] = (), fraction: float | None = None, seed: int = 42) -> DataFrame:
    """Points ``(column, x, y)`` for every row with a value in the column.

    All points by default; charts of large tables ask for a ``fraction``, drawn
    reproducibly by key.
    """
    cols = require_columns(df, cols)
    y = known_double(df, target)
    y = log1p_or_null(y) if transform_y == "log1p" else y
    rows = df
    if fraction is not None:
        if not key_cols:
            raise ValueError("a fraction is drawn by key: give key_cols")
        rows = df.where(digest_unit(key_digest(key_cols, seed)) < fraction)
    keys = [ref(c) for c in key_cols]
    points = [F.struct(F.lit(c).alias("column"), known_double(df, c).alias("x"), y.alias("y")) for c in cols]
    return rows.select(*keys, F.inline(F.array(*points))).where(F.col("x").isNotNull())
