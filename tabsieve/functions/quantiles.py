"""Exact, interpolated quantiles of whole columns without gathering the column.

``percentile``/``median`` are exact, but their one final task holds every
distinct value.  Here each wanted order statistic is first bracketed with a
quantile sketch; the rows outside the brackets are only counted, and just the
few distinct values inside them are ordered, one task a column.  A bracket that may still
hold too many values is narrowed again, so the work is a handful of column
scans and no shuffle of the data, at any size.  The sketch only steers: the
counts prove that a bracket holds the wanted rank, and a miss widens it.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from .bounded import local_table
from .nulls import sql_double

SKETCH_ACCURACY = 2_000     # rank error of one sketch: 1/2000 of its rows
GRID = 1_000                # a bracket's sketch is read at 0/1000, 1/1000, … 1000/1000
INSIDE_LIMIT = 100_000      # distinct values one bracket may bring together
INF = math.inf


@dataclass
class _Target:
    """One wanted pair of neighbouring ranks of one column."""

    column: int
    prob: float
    low_rank: int = 0
    high_rank: int = 0
    weight: float = 0.0
    lo: float = -INF
    hi: float = INF
    expected: float = INF       # rows the bracket may hold
    slack: float = 1.0
    empty: bool = False         # the column has no value at all
    value: float | None = None

    def aim(self, n: int) -> None:
        position = self.prob * (n - 1)
        self.low_rank, self.high_rank = math.floor(position), math.ceil(position)
        self.weight = position - self.low_rank


def _array(values: Sequence[float]) -> str:
    return "array(" + ", ".join(sql_double(v) for v in values) + ")"


def _bracket(values: DataFrame, targets: list[_Target], accuracy: int) -> None:
    """One scan: count every column and sketch both sides of each wanted rank."""
    columns = sorted({t.column for t in targets})
    aggs = []
    for c in columns:
        points = []
        for t in targets:
            if t.column == c:
                margin = 2.0 * t.slack / accuracy
                points += [max(0.0, t.prob - margin), min(1.0, t.prob + margin)]
        aggs += [F.expr(f"count(q{c}) as n{c}"),
                 F.expr(f"percentile_approx(q{c}, {_array(points)}, {accuracy}) as p{c}")]
    row = values.agg(*aggs).first()
    for c in columns:
        n, points = row[f"n{c}"], iter(row[f"p{c}"] or ())
        for t in (t for t in targets if t.column == c):
            if n == 0:
                t.empty = True
                continue
            t.aim(n)
            margin = 2.0 * t.slack / accuracy
            lo, hi = next(points), next(points)
            t.lo = lo if t.prob - margin > 0 else -INF
            t.hi = hi if t.prob + margin < 1 else INF
            t.expected = 0 if t.lo == t.hi else n * (2 * margin + 2.0 / accuracy)


def _narrow(values: DataFrame, targets: list[_Target], accuracy: int, grid: int) -> None:
    """One scan: count below and inside each bracket, sketch its inside, tighten it."""
    percents = _array([i / grid for i in range(grid + 1)])
    aggs = []
    for i, t in enumerate(targets):
        v, lo, hi = f"q{t.column}", sql_double(t.lo), sql_double(t.hi)
        aggs += [F.expr(f"count_if({v} < {lo}) as below{i}"),
                 F.expr(f"count_if({v} between {lo} and {hi}) as inside{i}"),
                 F.expr(f"percentile_approx(case when {v} between {lo} and {hi} then {v} end, "
                        f"{percents}, {accuracy}) as grid{i}")]
    row = values.agg(*aggs).first()
    for i, t in enumerate(targets):
        below, inside, points = row[f"below{i}"], row[f"inside{i}"], row[f"grid{i}"]
        if t.low_rank < below or t.high_rank >= below + inside:
            t.lo, t.hi, t.expected, t.slack = -INF, INF, INF, t.slack * 4     # missed: wider
            continue
        margin = 2.0 * t.slack / accuracy
        left = math.floor(((t.low_rank - below) / inside - margin) * grid)
        right = math.ceil(((t.high_rank + 1 - below) / inside + margin) * grid)
        lo = points[left] if left > 0 else t.lo
        hi = points[right] if right < grid else t.hi
        share = (min(right, grid) - max(left, 0)) / grid + 2.0 / accuracy
        settled = lo == hi or (lo, hi) == (t.lo, t.hi)      # only ties are left inside
        t.lo, t.hi, t.expected = lo, hi, 0 if settled else inside * share


def _merged(bands: list[tuple[float, float]]) -> list[tuple[float, float]]:
    out: list[tuple[float, float]] = []
    for lo, hi in sorted(bands):
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(hi, out[-1][1]))
        else:
            out.append((lo, hi))
    return out


def between(low: float, high: float, weight: float) -> float:
    """Linear interpolation; towards an infinite neighbour it is infinite, between both infinities undefined (NaN)."""
    if weight == 0.0 or low == high:
        return low
    if math.isinf(low) or math.isinf(high):
        return math.nan if math.isinf(low) and math.isinf(high) else low if math.isinf(low) else high
    width = high - low
    return low * (1 - weight) + high * weight if math.isinf(width) else low + width * weight


def _read(values: DataFrame, targets: list[_Target]) -> None:
    """One scan: count outside the brackets and per distinct value inside them, pick the ranks.

    The regions of a column are numbered along its axis: even ones lie between
    brackets and are counted as a whole, odd ones are brackets.  Running counts
    find the two values that a target asks for; nothing else is returned.
    """
    entries = []
    for c in sorted({t.column for t in targets}):
        cases, region = [f"when q{c} is null then null"], 0
        for lo, hi in _merged([(t.lo, t.hi) for t in targets if t.column == c]):
            cases += [f"when q{c} < {sql_double(lo)} then {region}",
                      f"when q{c} <= {sql_double(hi)} then {region + 1}"]
            region += 2
        place = f"case {' '.join(cases)} else {region} end"
        entries.append(f"named_struct('c', {c}, 'r', {place}, 'v', q{c})")
    regions = values.selectExpr(f"inline(array({', '.join(entries)}))").where("r is not null")
    counts = (regions.selectExpr("c", "r", "case when r % 2 = 1 then v end as v")
              .groupBy("c", "r", "v").agg(F.count(F.lit(1)).alias("n")))
    running = counts.withColumn("upto", F.sum("n").over(Window.partitionBy("c").orderBy("r", "v")))
    asked = sorted({(t.column, rank) for t in targets for rank in (t.low_rank, t.high_rank)})
    ranks = local_table(values.sparkSession, asked, "of int, rank bigint")
    holds = (F.col("c") == F.col("of")) & (F.col("rank") < F.col("upto")) & (F.col("rank") >= F.col("upto") - F.col("n"))
    found = {(r["c"], r["rank"]): (r["r"], r["v"]) for r in running.join(ranks, holds).select("c", "rank", "r", "v").collect()}
    for t in targets:
        (region_low, low), (region_high, high) = found[t.column, t.low_rank], found[t.column, t.high_rank]
        if region_low % 2 == 1 and region_high % 2 == 1:
            t.value = between(low, high, t.weight)
        else:
            t.lo, t.hi, t.expected, t.slack = -INF, INF, INF, t.slack * 4


def exact_quantiles(df: DataFrame, values: Mapping[str, Column], probs: Sequence[float],
                    accuracy: int = SKETCH_ACCURACY, grid: int = GRID,
                    inside_limit: int = INSIDE_LIMIT) -> dict[str, list[float | None]]:
    """Quantiles (linear interpolation) of named double expressions over ``df``.

    NULL values are ignored; a column without any value has quantiles ``None``,
    and so has a place between minus and plus infinity.
    """
    if not values:
        return {}
    table = df.select(*[v.alias(f"q{i}") for i, v in enumerate(values.values())])
    targets = [_Target(i, float(p)) for i in range(len(values)) for p in probs]
    waiting = targets
    while waiting:
        fresh = [t for t in waiting if t.expected == INF]
        if fresh:
            _bracket(table, fresh, accuracy)
        waiting = [t for t in waiting if not t.empty]
        wide = [t for t in waiting if t.expected > inside_limit]
        while wide:
            _narrow(table, wide, accuracy, grid)
            wide = [t for t in wide if INF > t.expected > inside_limit]
        ready = [t for t in waiting if t.expected <= inside_limit]
        if ready:
            _read(table, ready)
        waiting = [t for t in waiting if t.value is None]
    # NaN is the one value that differs from itself
    return {name: [None if t.value != t.value else t.value for t in targets if t.column == i]
            for i, name in enumerate(values)}
