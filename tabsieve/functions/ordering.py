"""Running totals along an order, without one task that sees a whole group.

A window over a group puts the group in one task.  Here some rows, chosen by the
hash of their content, cut the common order of all groups into ranges; the
ranges' totals give what each one starts with, and only inside a range a window
runs.  Pivots are whole values, so values that share a long beginning are cut
as evenly as others.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from .bounded import local_table
from .nulls import ref, type_of

PIVOTS = 4_096              # rows that cut the order, at most
SAMPLED = 32                # rows looked at for each, so that ranges are about equal
SAMPLE_CHARS = 1 << 24      # and about how much text these may hold: fewer of them where values are long


def _pivots(rows: DataFrame, place: Column, names: Sequence[str], n: int, chars: int, pivots: int) -> list[dict]:
    """Rows at even distances in the order of a sample of the ``n`` rows, at most ``pivots``."""
    share = max(1, n // (pivots * SAMPLED), chars // SAMPLE_CHARS)
    chosen = rows.where(F.pmod(F.xxhash64(*map(ref, names)), F.lit(share)) == 0).agg(F.array_sort(F.collect_set(place)).alias("p"))
    distance = F.greatest(F.lit(1), F.ceil(F.size("p") / pivots).cast("int"))
    return [p.asDict() for p in chosen.select(F.filter("p", lambda _, i: (i + 1) % distance == 0)).first()[0]]


def running_totals(rows: DataFrame, group: Sequence[str], keys: Sequence[str], amount: str | None = None,
                   name: str = "upto", pivots: int = PIVOTS) -> DataFrame:
    """Add the bigint ``name``: the sum of ``amount`` over the group's rows up to this one in the order of ``keys``.

    Without an amount rows count one each, which numbers them from 1.  Missing
    keys come first; rows that are equal in group and keys share the total after
    all of them.  Group and keys are text, booleans or numbers; ``amount`` is a
    bigint without missing values.  The driver holds the pivots and the totals of
    two groups a range, whatever the number of rows and groups.
    """
    spark, by = rows.sparkSession, [*group, *keys]
    texts = [F.coalesce(F.length(ref(c)), F.lit(0)) for c in by if isinstance(type_of(rows, c), T.StringType)]
    n, chars = rows.agg(F.count(F.lit(1)), F.sum(sum(texts, F.lit(0)).cast("bigint"))).first()
    place = F.struct(*[ref(c).alias(f"k{i}") for i, c in enumerate(by)])
    placed = rows.withColumn("__place", place)
    cuts = _pivots(rows, place, by, n, chars or 0, pivots)
    # one literal after constant folding
    table = F.from_json(F.lit(json.dumps(cuts, ensure_ascii=False)), T.ArrayType(placed.schema["__place"].dataType))
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(max(1, len(cuts).bit_length())))])
    # the number of pivots at or before the row, by bisection; past their end get() is NULL
    at = F.aggregate(steps, F.lit(0), lambda low, step: F.when(
        F.get(table, low + step - 1) <= F.col("__place"), low + step).otherwise(low))
    ranged = placed.withColumn("__range", at).drop("__place")
    add = F.lit(1).cast("bigint") if amount is None else ref(amount)
    # groups lie one after another, so only the first of a range can have begun before it
    labels = [f"__g{i}" for i in range(len(group))]
    totals = ranged.groupBy("__range", *[ref(c).alias(g) for c, g in zip(group, labels)]).agg(F.sum(add).alias("__total"))
    entry = F.struct(*labels, "__total")
    ends = totals.groupBy("__range").agg(F.min(entry).alias("first"), F.max(entry).alias("last")).collect()
    open_group, so_far, begun = None, 0, []
    for r in sorted(ends, key=lambda r: r["__range"]):
        *first, of_first = r["first"]
        *last, of_last = r["last"]
        before = so_far if first == open_group else 0
        if before:
            begun.append((r["__range"], *first, before))
        open_group, so_far = last, of_last + (before if first == last else 0)
    schema = T.StructType([T.StructField("__at", T.IntegerType()),
                           *[T.StructField(g, type_of(rows, c)) for g, c in zip(labels, group)],
                           T.StructField("__before", T.LongType())])
    window = Window.partitionBy("__range", *map(ref, group)).orderBy(*[F.asc_nulls_first(ref(c)) for c in keys])
    inside = ranged.withColumn("__inside", F.sum(add).over(window.rangeBetween(Window.unboundedPreceding, 0)))
    same = F.col("__range") == F.col("__at")
    for c, g in zip(group, labels):
        same = same & ref(c).eqNullSafe(F.col(g))
    joined = inside.join(local_table(spark, begun, schema), same, "left")
    return joined.select(*map(ref, rows.columns), (F.coalesce("__before", F.lit(0)) + F.col("__inside")).alias(name))
