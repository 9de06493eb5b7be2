"""Correlations between numeric columns: Pearson, Spearman, Kendall.

All coefficients are pairwise complete: a pair uses the rows where both columns
have a value.  A pair with a constant side has no coefficient (NULL).
"""

from __future__ import annotations

import math
import operator
from collections.abc import Sequence
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..functions.comoments import PARTS as COMOMENTS, Scale, comoments
from ..functions.nulls import doubles, is_numeric, known_double, ref, require_columns, type_of
from ..functions.ranks import Blocks, average_ranks, bucket_of, value_blocks
from .columns import numeric_columns

PAIRS_PER_JOB = 400
# Of the sum of squares about the middle of a column; below it, a pair's variation is computed with more care.
LEAST_SHARE = 1e-8
MATRIX_SCHEMA = "row_pos int, col_pos int, row string, col string, corr double"


def _numeric(df: DataFrame, cols: Sequence[str] | None, key_cols: Sequence[str]) -> list[str]:
    if cols is None:
        return [c for c in numeric_columns(df) if c not in set(key_cols)]
    cols = require_columns(df, cols)
    bad = [c for c in cols if not is_numeric(type_of(df, c))]
    if bad:
        raise ValueError(f"not numeric: {bad}")
    return cols


@dataclass(frozen=True)
class Extent:
    """What one scan tells of a column: no missing value, and the smallest and largest value (None without any)."""

    complete: bool
    low: float | None
    high: float | None

    @property
    def varies(self) -> bool:
        return self.low is not None and self.low < self.high

    @property
    def finite(self) -> bool:
        return self.low is not None and math.isfinite(self.low) and math.isfinite(self.high)


def _extents(df: DataFrame, cols: Sequence[str]) -> dict[str, Extent]:
    n = len(cols)
    row = doubles(df, cols).agg(F.count(F.lit(1)), *[F.expr(f"count(c{i})") for i in range(n)],
                                *[F.expr(f"min(c{i})") for i in range(n)], *[F.expr(f"max(c{i})") for i in range(n)]).first()
    return {c: Extent(row[1 + i] == row[0], row[1 + n + i], row[1 + 2 * n + i]) for i, c in enumerate(cols)}


def _pearson(a: str, b: str, complete: bool) -> str:
    """Covariance over deviations, both taken over the pair's complete rows."""
    left = a if complete else f"case when {b} is not null then {a} end"
    right = b if complete else f"case when {a} is not null then {b} end"
    return f"covar_pop({a}, {b}) / nullif(stddev_pop({left}) * stddev_pop({right}), 0)"


def _pearson_pairs(df: DataFrame, pairs: Sequence[tuple[str, str]], complete: set[str]) -> dict[tuple[str, str], float | None]:
    """One generated expression per pair; a scan for every PAIRS_PER_JOB of them."""
    cols = list(dict.fromkeys(c for p in pairs for c in p))
    name = {c: f"c{i}" for i, c in enumerate(cols)}
    values = doubles(df, cols)
    out = {}
    for start in range(0, len(pairs), PAIRS_PER_JOB):
        chunk = pairs[start:start + PAIRS_PER_JOB]
        row = values.agg(*[F.expr(f"{_pearson(name[a], name[b], a in complete and b in complete)} as r{i}")
                           for i, (a, b) in enumerate(chunk)]).first()
        out.update(zip(chunk, row))
    return out


def _pearson_many(df: DataFrame, pairs: Sequence[tuple[str, str]], extents: dict[str, Extent]) -> dict[tuple[str, str], float | None]:
    """All pairs from one scan that multiplies blocks of columns.

    Pairs with a constant or empty column have no coefficient.  Columns with
    infinite values, and pairs whose complete rows hardly vary on one side, where
    sums of squares lose their digits, go by expressions.
    """
    if len(pairs) <= PAIRS_PER_JOB:
        return _pearson_pairs(df, pairs, {c for c, e in extents.items() if e.complete})
    out: dict[tuple[str, str], float | None] = {p: None for p in pairs}
    varying = [p for p in pairs if all(extents[c].varies for c in p)]
    blocked = [p for p in varying if all(extents[c].finite for c in p)]
    apart = [p for p in varying if not all(extents[c].finite for c in p)]
    if blocked:
        left, right = (list(dict.fromkeys(side)) for side in zip(*blocked))
        cols = list(dict.fromkeys([*left, *right]))
        name = {c: f"c{i}" for i, c in enumerate(cols)}
        scales = {name[c]: Scale.between(extents[c].low, extents[c].high) for c in cols}
        sums = comoments(doubles(df, cols), [name[c] for c in left], [name[c] for c in right], scales)
        at_left, at_right = {c: i for i, c in enumerate(left)}, {c: i for i, c in enumerate(right)}
        for a, b in blocked:
            n, x, y, xx, yy, xy = (float(sums[part][at_left[a], at_right[b]]) for part in COMOMENTS)
            if n < 2:
                continue
            vary_x, vary_y = xx - x * x / n, yy - y * y / n
            if vary_x <= LEAST_SHARE * xx or vary_y <= LEAST_SHARE * yy:
                apart.append((a, b))
            else:
                out[a, b] = max(-1.0, min(1.0, (xy - x * y / n) / math.sqrt(vary_x) / math.sqrt(vary_y)))
    if apart:
        out.update(_pearson_pairs(df, apart, {c for c, e in extents.items() if e.complete}))
    return out


def _ranked_pairs(df: DataFrame, pairs: Sequence[tuple[str, str]],
                  extents: dict[str, Extent]) -> dict[tuple[str, str], float | None]:
    """Spearman: Pearson over mean ranks.

    Columns without gaps are ranked once for all their pairs; ranks of a pair
    with gaps depend on its complete rows, so it is ranked on its own.
    """
    complete = {c for c, e in extents.items() if e.complete}
    out: dict[tuple[str, str], float | None] = {}
    whole = [p for p in pairs if p[0] in complete and p[1] in complete]
    if whole:
        cols = list(dict.fromkeys(c for p in whole for c in p))
        ranks = average_ranks(df.select(*[known_double(df, c).alias(c) for c in cols]), cols)
        out.update(_pearson_pairs(ranks, whole, set(cols)))
    for a, b in pairs:
        if (a, b) not in out:
            ranks = average_ranks(_complete_rows(df, a, b), [a, b])
            out.update(_pearson_pairs(ranks, [(a, b)], {a, b}))
    return out


def _complete_rows(df: DataFrame, a: str, b: str) -> DataFrame:
    pair = df.select(known_double(df, a).alias(a), known_double(df, b).alias(b))
    return pair.where(ref(a).isNotNull() & ref(b).isNotNull())


def _same_pairs(counts: np.ndarray) -> int:
    """Ordered pairs of different rows within groups of these sizes."""
    return int((counts.astype(np.int64) * (counts - 1)).sum())


def inversions(values: np.ndarray) -> int:
    """Pairs of places whose earlier value is the greater one.

    Two values first differ at one binary digit of their codes: digit by digit,
    among the values that agree in all digits before, the ones that precede a
    zero are counted, and then the zeros go before the ones.
    """
    codes, total = np.unique(values, return_inverse=True)[1].astype(np.int32), 0
    at = np.arange(len(codes))
    for bit in reversed(range(int(codes.max(initial=0)).bit_length())):
        starts = np.flatnonzero(np.diff(codes >> (bit + 1), prepend=-1))
        sizes = np.diff(starts, append=len(codes))
        one = (codes >> bit & 1).astype(bool)
        ones = np.cumsum(one) - one
        ones -= np.repeat(ones[starts], sizes)
        total += int(ones[~one].sum())
        start = np.repeat(starts, sizes)
        zeros = sizes - np.add.reduceat(one, starts, dtype=np.int64)
        moved = np.empty_like(codes)
        moved[np.where(one, start + np.repeat(zeros, sizes) + ones, at - ones)] = codes
        codes = moved
    return total


COUNTS = ("rows", "a", "b", "both", "discordant")
COUNT_SCHEMA = "pair int, " + ", ".join(f"{c} decimal(38,0)" for c in COUNTS)


def _counted(pair: int, **counts: int) -> pa.Table:
    numbers = {c: pa.array([Decimal(counts.get(c, 0))], pa.decimal128(38, 0)) for c in COUNTS}
    return pa.table({"pair": pa.array([pair], pa.int32()), **numbers})


def _within_block(points: pa.Table) -> pa.Table:
    """Counts of row pairs that share a block: of ``a`` on side 0; on side 1 of ``b``, where ``x`` numbers the block of ``a``."""
    pair, side = points["pair"][0].as_py(), points["side"][0].as_py()
    x, y, same = (points[c].to_numpy() for c in ("x", "y", "same"))
    order = np.lexsort((y, x))
    x, y, same = x[order], y[order], same[order]
    changes = np.concatenate(([True], (x[1:] != x[:-1]) | (y[1:] != y[:-1])))
    cells = np.flatnonzero(changes)
    sizes = np.diff(cells, append=len(x))
    tied = _same_pairs(np.unique(y if side else x, return_counts=True)[1])
    return _counted(pair, discordant=inversions(y), both=_same_pairs(sizes[same[cells]]), **{"b" if side else "a": tied})


def _across_blocks(cells: pa.Table, single_a: np.ndarray, single_b: np.ndarray) -> pa.Table:
    """Counts of row pairs whose blocks differ on both sides, and of those that share a block of a single value."""
    x, y, w = (cells[c].to_numpy() for c in ("x", "y", "w"))
    grid = np.zeros((len(single_a), len(single_b)), np.int64)
    grid[x, y] = w
    earlier = np.cumsum(grid, axis=0) - grid
    greater = np.cumsum(earlier[:, ::-1], axis=1)[:, ::-1] - earlier

    def tied(sizes: np.ndarray) -> int:
        return sum(n * (n - 1) for n in sizes.tolist())

    # the products of two counts may pass 64 bits
    return _counted(cells["pair"][0].as_py(), rows=int(w.sum()), a=tied(grid.sum(axis=1)[single_a]), b=tied(grid.sum(axis=0)[single_b]),
                    both=tied(w[single_a[x] & single_b[y]]), discordant=sum(map(operator.mul, w.tolist(), greater[x, y].tolist())))


def _tau(n: int, tied_a: int, tied_b: int, tied_both: int, discordant: int) -> float | None:
    """Tau-b from counts of row pairs; ``n`` counts rows."""
    pairs = n * (n - 1) // 2
    free_a, free_b = pairs - tied_a, pairs - tied_b
    if free_a == 0 or free_b == 0:
        return None
    concordant_minus_discordant = pairs - tied_a - tied_b + tied_both - 2 * discordant
    tau = concordant_minus_discordant / math.sqrt(free_a) / math.sqrt(free_b)
    return max(-1.0, min(1.0, tau))


def _kendall_counts(values: DataFrame, pairs: Sequence[tuple[str, str]], blocks: dict[str, Blocks | int]) -> list[dict[str, int]]:
    """Per pair of columns: rows, tied rows (each of two rows once) and discordant row pairs, in one job.

    Two rows either have blocks that differ on both sides, which the numbers of
    rows per pair of blocks tell, or they share a block: a row goes with the rows
    of its block of ``a``, and with those of its block of ``b``, where two rows of
    one block of ``a`` are not looked at again.  Blocks of a single value need no
    look.  No pair of rows is ever listed, and no task holds more than a block.
    A number n in ``blocks`` stands for codes below n, each a block.
    """
    cols = list(dict.fromkeys(c for p in pairs for c in p))
    at = {c: i for i, c in enumerate(cols)}
    ranges = [Blocks.of_values(range(b)) if isinstance(b, int) else b for b in (blocks[c] for c in cols)]
    placed = (values.select(*[ref(c).cast("double").alias(f"v{i}") for i, c in enumerate(cols)])
              .select("*", *[bucket_of(f"v{i}", r.bounds).alias(f"b{i}") for i, r in enumerate(ranges)]))
    single = [F.lit(all(r.single)) if len(set(r.single)) == 1
              else F.get(F.expr(f"array({', '.join(map(str, r.single))})"), F.col(f"b{i}")) for i, r in enumerate(ranges)]
    in_cells, in_blocks = [], []
    for n, (i, j) in enumerate((at[a], at[b]) for a, b in pairs):
        known_pair = F.col(f"v{i}").isNotNull() & F.col(f"v{j}").isNotNull()
        a, b, x, y = (F.col(c) for c in (f"b{i}", f"b{j}", f"v{i}", f"v{j}"))
        in_cells.append(F.when(known_pair, F.struct(F.lit(n).alias("pair"), a.alias("x"), b.alias("y"))))
        for side, own, k, place, same in ((0, a, i, x, F.lit(True)), (1, b, j, a.cast("double"), single[i])):
            if not all(ranges[k].single):
                in_blocks.append(F.when(known_pair & ~single[k], F.struct(
                    F.lit(n).alias("pair"), F.lit(side).alias("side"), own.alias("block"), place.alias("x"), y.alias("y"), same.alias("same"))))
    flags = [tuple(np.array(ranges[at[c]].single) for c in p) for p in pairs]

    def across(cells: pa.Table) -> pa.Table:
        return _across_blocks(cells, *flags[cells["pair"][0].as_py()])

    cells = placed.select(F.inline(F.array(*in_cells))).where("pair is not null").groupBy("pair", "x", "y").agg(F.count(F.lit(1)).alias("w"))
    found = cells.groupBy("pair").applyInArrow(across, COUNT_SCHEMA)
    if in_blocks:
        points = placed.select(F.inline(F.array(*in_blocks))).where("pair is not null")
        found = found.unionByName(points.groupBy("pair", "side", "block").applyInArrow(_within_block, COUNT_SCHEMA))
    out: list[dict[str, int]] = [dict.fromkeys(COUNTS, 0) for _ in pairs]
    for r in found.groupBy("pair").agg(*[F.sum(c).alias(c) for c in COUNTS]).collect():       # one row a pair
        out[r["pair"]] = {c: int(r[c]) for c in COUNTS}
    return out


def _kendall_pairs(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> dict[tuple[str, str], float | None]:
    """Tau-b of many pairs, each over the rows where both columns have a value.

    The blocks of a column serve all its pairs.
    """
    cols = list(dict.fromkeys(c for p in pairs for c in p))
    name = {c: f"c{i}" for i, c in enumerate(cols)}
    values = doubles(df, cols)
    blocks = value_blocks(values, list(name.values()))
    out = {}
    for start in range(0, len(pairs), PAIRS_PER_JOB):
        chunk = pairs[start:start + PAIRS_PER_JOB]
        for pair, n in zip(chunk, _kendall_counts(values, [(name[a], name[b]) for a, b in chunk], blocks)):
            out[pair] = _tau(n["rows"], n["a"] // 2, n["b"] // 2, n["both"] // 2, n["discordant"])
    return out


def kendall_tau(df: DataFrame, a: str, b: str) -> float | None:
    """Tau-b over the rows where both columns have a value."""
    return _kendall_pairs(df, [(a, b)])[(a, b)]


def correlation_pairs(df: DataFrame, pairs: Sequence[tuple[str, str]], method: str = "pearson",
                      extents: dict[str, Extent] | None = None) -> dict[tuple[str, str], float | None]:
    """Coefficients of the given column pairs; ``extents`` is what ``_extents`` found, if it is known."""
    if method not in ("pearson", "spearman", "kendall"):
        raise ValueError("method must be 'pearson', 'spearman' or 'kendall'")
    if not pairs:
        return {}
    if method == "kendall":
        return _kendall_pairs(df, pairs)
    if extents is None:
        extents = _extents(df, list(dict.fromkeys(c for p in pairs for c in p)))
    return (_pearson_many if method == "pearson" else _ranked_pairs)(df, pairs, extents)


def correlation_matrix(df: DataFrame, cols: Sequence[str] | None = None, method: str = "pearson",
                       key_cols: Sequence[str] = ()) -> DataFrame:
    """The full matrix in long form: ``(row_pos, col_pos, row, col, corr)``."""
    cols = _numeric(df, cols, key_cols)
    if not cols:
        return df.sparkSession.createDataFrame([], MATRIX_SCHEMA)
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    extents = _extents(df, cols)
    found = correlation_pairs(df, pairs, method, extents)
    cells = []
    for i, a in enumerate(cols):
        for j, b in enumerate(cols):
            value = (1.0 if extents[a].varies else None) if i == j else found[(a, b) if i < j else (b, a)]
            cells.append((i, j, a, b, value))
    return df.sparkSession.createDataFrame(cells, MATRIX_SCHEMA)


def lower_triangle(df: DataFrame, cols: Sequence[str] | None = None, method: str = "pearson",
                   key_cols: Sequence[str] = ()) -> DataFrame:
    """Signed coefficients strictly below the diagonal: the data of the collinearity chart."""
    return correlation_matrix(df, cols, method, key_cols).where("row_pos > col_pos")


def collinear_pairs(df: DataFrame, threshold: float = 0.8, cols: Sequence[str] | None = None,
                    key_cols: Sequence[str] = ()) -> DataFrame:
    """Pairs with ``|r|`` strictly above the threshold, strongest first.

    ``(feature1, feature2, abs_corr)`` where feature1 is the later column.
    """
    lower = lower_triangle(df, cols, "pearson", key_cols)
    return (lower.withColumn("abs_corr", F.abs("corr")).where(F.col("abs_corr") > threshold)
            .orderBy(F.desc("abs_corr"), "row_pos", "col_pos")
            .select(F.col("row").alias("feature1"), F.col("col").alias("feature2"), "abs_corr"))


def feature_collinearity(df: DataFrame, threshold: float = 0.8,
                         key_cols: Sequence[str] = ()) -> list[tuple[str, str, float]]:
    return [tuple(r) for r in collinear_pairs(df, threshold, key_cols=key_cols).collect()]


def target_correlations(df: DataFrame, target: str, n_top: int | None = 10,
                        cols: Sequence[str] | None = None, key_cols: Sequence[str] = ()) -> DataFrame:
    """Features by ``|r|`` with a numeric target, strongest first: ``(feature, abs_corr)``."""
    require_columns(df, [target])
    if not is_numeric(type_of(df, target)):
        raise ValueError(f"target {target} must be numeric: encode it first")
    features = [c for c in _numeric(df, cols, key_cols) if c != target]
    found = correlation_pairs(df, [(c, target) for c in features])
    rows = [(c, None if found[(c, target)] is None else abs(found[(c, target)])) for c in features]
    ranked = (df.sparkSession.createDataFrame(rows, "feature string, abs_corr double")
              .orderBy(F.desc_nulls_last("abs_corr"), "feature"))
    return ranked if n_top is None else ranked.limit(n_top)


def target_correlation_bars(df: DataFrame, target: str, n_top: int = 15,
                            key_cols: Sequence[str] = ()) -> DataFrame:
    """The same with the target's name on each row, ready to chart."""
    return target_correlations(df, target, n_top, key_cols=key_cols).withColumn("target", F.lit(target))
