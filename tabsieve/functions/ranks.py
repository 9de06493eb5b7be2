"""Global ranks without a global sort in one task.

A column's value range is cut at sketched quantiles into buckets.  The buckets'
row counts give each bucket's starting rank; ranks inside a bucket come from a
window over its *distinct* values.  A value that fills a third of the table is
one row there, so no bucket is large because of it.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from .bounded import BROADCAST_ROWS
from .nulls import quoted, ref, sql_double

MIN_BUCKETS, MAX_BUCKETS = 64, 4096
TREE_LEAVES = 256
# Columns with at most so many distinct values are ranked by a broadcast table.
SMALL = BROADCAST_ROWS // 10
# Rows that a block of values should hold, and how many blocks a column is cut into at most.
BLOCK_ROWS = 200_000
MIN_BLOCKS, MAX_BLOCKS = 16, 1024
# Columns with at most so many distinct values have a block for each.
FEW = 512


def bucket_count(spark: SparkSession) -> int:
    """As many buckets as shuffle partitions, within reason."""
    wanted = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(MIN_BUCKETS, min(MAX_BUCKETS, wanted))


def _tree(column: str, bounds: Sequence[float], first: int = 0) -> str:
    """Nested IFs that count the bounds at or below the value by bisection."""
    if not bounds:
        return str(first)
    middle = len(bounds) // 2
    return (f"if({column} >= {sql_double(bounds[middle])}, {_tree(column, bounds[middle + 1:], first + middle + 1)}, "
            f"{_tree(column, bounds[:middle], first)})")


def bucket_of(column: str, bounds: Sequence[float]) -> Column:
    """Number of bounds at or below the value: an order-preserving bucket.

    A tree of comparisons runs as generated code, but only up to some size; many
    bounds are cut into blocks, the tree finds the block and the rest is a bisection.
    """
    if len(bounds) < TREE_LEAVES:
        return F.expr(_tree(column, bounds))
    size = -(-len(bounds) // TREE_LEAVES)
    blocks = [bounds[i:i + size] for i in range(0, len(bounds), size)]
    block = F.expr(_tree(column, [b[0] for b in blocks[1:]]))
    points = F.get(F.expr("array(" + ", ".join(f"array({', '.join(map(sql_double, b))})" for b in blocks) + ")"), block)
    steps = F.expr(f"array({', '.join(str(1 << i) for i in reversed(range(size.bit_length())))})")
    inside = F.aggregate(
        steps, F.lit(0),
        # past the end of the bounds get() is NULL, which is not at or below the value
        lambda at, step: F.when(F.get(points, at + step - 1) <= F.expr(column), at + step).otherwise(at))
    return block * size + inside


def _points(values: Sequence[float]) -> Column:
    return F.expr(f"array({', '.join(map(sql_double, values))})").cast("array<double>")


def bucket_bounds(df: DataFrame, cols: Sequence[str], buckets: int) -> dict[str, tuple[list[float], int]]:
    """Cut points and an estimate of the distinct values per double column, in one scan.

    The cuts only balance the buckets, so a coarse sketch does.
    """
    percents = _points([i / buckets for i in range(1, buckets)])
    aggs = []
    for i, c in enumerate(cols):
        aggs += [F.percentile_approx(ref(c), percents, buckets * 2).alias(f"b{i}"),
                 F.approx_count_distinct(ref(c)).alias(f"d{i}")]
    row = df.agg(*aggs).first()
    return {c: (sorted(set(row[f"b{i}"] or [])), row[f"d{i}"]) for i, c in enumerate(cols)}


@dataclass(frozen=True)
class Blocks:
    """Ranges of a column's values: one below all ``bounds`` and one from each bound on.

    ``single`` tells of each range whether it holds no two different values.
    """

    bounds: list[float]
    single: list[bool]

    @classmethod
    def of_values(cls, values: Sequence[float]) -> Blocks:
        """A range for each of the sorted values, which are all there are."""
        return cls(list(values[1:]), [True] * max(1, len(values)))

    @classmethod
    def between(cls, cuts: Sequence[float]) -> Blocks:
        """Ranges that start at the cuts; a value that is a cut more than once gets a range of its own."""
        bounds, single = [], [False]
        for value, n in sorted(Counter(cuts).items()):
            if bounds and bounds[-1] == value:      # the end of the range before
                bounds.pop(), single.pop()
            bounds.append(value)
            single.append(n > 1)
            if n > 1 and value < math.inf:
                bounds.append(math.nextafter(value, math.inf))
                single.append(False)
        return cls(bounds, single)


def value_blocks(df: DataFrame, cols: Sequence[str], rows: int | None = None, small: int | None = None) -> dict[str, Blocks]:
    """Per double column ranges of values of about ``rows`` rows; a value that has more rows is a range of its own.

    So is every value of a column with few distinct ones (by estimate, then checked).
    """
    rows, small = BLOCK_ROWS if rows is None else rows, min(FEW, SMALL if small is None else small)
    percents = _points([i / MAX_BLOCKS for i in range(1, MAX_BLOCKS)])
    aggs = [F.count(F.lit(1))]
    for c in cols:
        aggs += [F.percentile_approx(ref(c), percents, MAX_BLOCKS * 4), F.approx_count_distinct(ref(c))]
    n, *found = df.agg(*aggs).first()
    blocks = max(MIN_BLOCKS, min(MAX_BLOCKS, n // rows))
    cuts = {c: [points[i * MAX_BLOCKS // blocks - 1] for i in range(1, blocks)] if points else []
            for c, points in zip(cols, found[::2])}
    out = {c: Blocks.between(cuts[c]) for c in cols}
    few = [c for c, distinct in zip(cols, found[1::2]) if distinct <= small]
    if few:
        pairs = F.array(*[F.struct(F.lit(i).alias("c"), ref(c).alias("value")) for i, c in enumerate(few)])
        most = 2 * FEW * len(few)                   # half of it is left to the estimates' error
        values = df.select(F.inline(pairs)).where("value is not null").distinct().limit(most + 1).collect()
        if len(values) <= most:
            for i, c in enumerate(few):
                out[c] = Blocks.of_values(sorted(r["value"] for r in values if r["c"] == i))
    return out


RANK_SCHEMA = "value double, below bigint, ties bigint, code bigint"


def _small_tables(df: DataFrame, cols: Sequence[str]) -> dict[str, tuple[DataFrame, int]]:
    """Rank tables of columns with few distinct values, and how many those are, all from one pre-aggregated count.

    Empty if the values turn out to be more than a broadcast side may hold.
    """
    if not cols:
        return {}
    pairs = F.array(*[F.struct(F.lit(i).alias("c"), ref(c).alias("value")) for i, c in enumerate(cols)])
    counts = (df.select(F.inline(pairs)).where("value is not null").groupBy("c", "value")
              .agg(F.count(F.lit(1)).alias("ties")))
    rows = counts.limit(BROADCAST_ROWS + 1).toPandas().sort_values(["c", "value"])
    if len(rows) > BROADCAST_ROWS:
        return {}
    rows["below"] = rows.groupby("c")["ties"].cumsum() - rows["ties"]
    rows["code"] = rows.groupby("c").cumcount()
    own = {c: rows.loc[rows["c"] == i, ["value", "below", "ties", "code"]] for i, c in enumerate(cols)}
    return {c: (F.broadcast(df.sparkSession.createDataFrame(r, RANK_SCHEMA)), len(r)) for c, r in own.items()}


def order_codes(df: DataFrame, cols: Sequence[str], buckets: int | None = None,
                small: int | None = None) -> dict[str, tuple[DataFrame, int]]:
    """Per double column a table ``(value, below, ties, code)`` and a number that all its codes are below.

    ``below`` counts the column's rows under the value, ``ties`` those that have
    it; ``code`` grows with the value and is as small as can be told cheaply.
    Missing values are no rows.  Columns with at most ``small`` distinct values
    (by estimate, then checked) come back as broadcast sides, as many of them as
    fit one broadcast; the others are ranked by buckets.
    """
    small = SMALL if small is None else small
    cuts = bucket_bounds(df, cols, buckets or bucket_count(df.sparkSession))
    few = sorted((c for c in cols if cuts[c][1] <= small), key=lambda c: cuts[c][1])
    together = accumulate(cuts[c][1] for c in few)      # half of the room is left to the estimates' error
    tables = _small_tables(df, [c for c, n in zip(few, together) if n <= BROADCAST_ROWS // 2])
    many = [c for c in cols if c not in tables]
    if not many:
        return tables
    pairs = F.array(*[F.when(ref(c).isNotNull(), F.struct(F.lit(i).alias("c"), bucket_of(quoted(c), cuts[c][0]).alias("b")))
                      for i, c in enumerate(many)])
    sizes = df.select(F.inline(pairs)).where("c is not null").groupBy("c", "b").count().collect()
    for i, c in enumerate(many):
        bounds = cuts[c][0]
        per_bucket = [0] * (len(bounds) + 1)
        for r in sizes:
            if r["c"] == i:
                per_bucket[r["b"]] = r["count"]
        starts = [0, *accumulate(per_bucket)][:-1]
        offset = F.get(F.expr(f"array({', '.join(f'{s}L' for s in starts)})"), F.col("bucket"))
        values = (df.where(ref(c).isNotNull()).groupBy(ref(c).alias("value")).agg(F.count(F.lit(1)).alias("ties"))
                  .withColumn("bucket", bucket_of("value", bounds)))
        before = F.sum("ties").over(Window.partitionBy("bucket").orderBy("value")) - F.col("ties")
        below = offset + before
        tables[c] = values.select("value", below.alias("below"), "ties", below.alias("code")), sum(per_bucket)
    return tables


def value_ranks(df: DataFrame, cols: Sequence[str], buckets: int | None = None,
                small: int | None = None) -> dict[str, DataFrame]:
    """Per double column a table ``(value, below, ties, code)``, as ``order_codes`` gives it."""
    return {c: table for c, (table, _) in order_codes(df, cols, buckets, small).items()}


def attach(df: DataFrame, col: str, table: DataFrame, rank: Column, name: str, how: str = "inner") -> DataFrame:
    """Join a rank table back to the rows by value; a left join keeps the rows without one."""
    side = table.select(F.col("value").alias("__value"), rank.alias(name))
    return df.join(side, ref(col) == F.col("__value"), how).drop("__value")


def average_ranks(df: DataFrame, cols: Sequence[str], buckets: int | None = None) -> DataFrame:
    """Replace double columns without NULL by their ranks from 1, ties sharing their mean rank."""
    mean_rank = F.col("below") + (F.col("ties") + 1) / 2
    out, tables = df, value_ranks(df, cols, buckets)
    for i, c in enumerate(cols):
        out = attach(out, c, tables[c], mean_rank, f"__r{i}")
    return out.select(*[F.col(f"__r{i}").alias(c) for i, c in enumerate(cols)])
