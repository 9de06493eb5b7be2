"""Seeded splits and folds with exact class counts and no sort of the table.

Every row gets the md5 of its key and the seed.  Per class the rows with the
smallest digests form the test side (or the first fold, and so on).  Sorting a
class would put it in one task; instead the digest at each wanted rank is looked
up.  Digests are spread evenly, so the one at rank r of n lies close to r/n of
the way: rows outside a narrow window around that place are only counted, and
the few inside it are ordered.  What is left is a comparison with the cuts of the
class, a table of one row a class that Spark broadcasts while it is small, a map-only projection that gives a row the same side on every run.

With more classes than MANY_CLASSES nothing is kept by class on the driver: class
sizes, remainders and rows are numbered as tables, with the same outcome.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from itertools import accumulate
from typing import Any

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..functions.bounded import BROADCAST_ROWS, TooManyRows, collect_at_most, local_table
from ..functions.hashing import key_digest
from ..functions.nulls import is_float, known, ref, require_columns, type_of
from ..functions.ordering import running_totals

WINDOW_SIGMAS = 6.0         # half width of a window, in standard deviations of the rank
DIGEST_DIGITS = 13          # 52 bits of a digest, as many as a double holds
MANY_CLASSES = BROADCAST_ROWS

Sizes = Callable[[dict[Any, int]], dict[Any, list[int]]]


@dataclass(frozen=True)
class DigestCuts:
    """Per class the digests at which it is cut; applies to any frame with the same columns."""

    key_cols: list[str]
    stratify: str | None
    seed: int
    class_type: T.DataType
    cuts: dict[Any, list[str]] = field(default_factory=dict)

    def part(self, df: DataFrame, name: str) -> DataFrame:
        """Add the part number: how many of its class's cuts lie before the row."""
        digest = key_digest(self.key_cols, self.seed)
        n_cuts = len(next(iter(self.cuts.values()), ()))

        def number(cut: Callable[[int], Column]) -> Column:
            # one term per cut keeps this in generated code, where the digest is computed once
            return sum(((cut(i) < digest).cast("int") for i in range(n_cuts)), F.lit(0))

        if self.stratify is None:
            return df.withColumn(name, number(lambda i: F.lit(self.cuts[None][i])))
        schema = T.StructType([T.StructField("__class", self.class_type),
                               T.StructField("__cuts", T.ArrayType(T.StringType()))])
        table = local_table(df.sparkSession, list(self.cuts.items()), schema)
        return (df.join(table, known(df, self.stratify).eqNullSafe(F.col("__class")), "left")
                .withColumn(name, F.coalesce(number(lambda i: F.get("__cuts", F.lit(i))), F.lit(0)))
                .drop("__class", "__cuts"))


def class_sizes(df: DataFrame, stratify: str | None) -> dict[Any, int]:
    """Rows per class, of at most MANY_CLASSES."""
    if stratify is None:
        return {None: df.count()}
    counts = df.groupBy(known(df, stratify).alias("c")).agg(F.count(F.lit(1)).alias("n"))
    return {r["c"]: r["n"] for r in collect_at_most(counts, MANY_CLASSES, f"classes of {stratify}")}


def _sized_classes(df: DataFrame, stratify: str) -> DataFrame:
    """``(c, n, absent, label)`` per class: the last two order classes as ``_class_order`` does."""
    c = known(df, stratify)
    label = F.initcap(F.col("c").cast("string")) if isinstance(type_of(df, stratify), T.BooleanType) else F.col("c").cast("string")
    counts = df.groupBy(c.alias("c")).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumns({"absent": F.col("c").isNull(), "label": label})


def _parts_by_number(df: DataFrame, key_cols: Sequence[str], stratify: str, seed: int, ends: DataFrame, name: str) -> DataFrame:
    """Add the part number of each row: how many of its class's ``ends`` lie before its place by digest.

    ``ends`` holds ``(c, ends)``; classes and rows meet by a join, so neither is held in one place.
    """
    c = known(df, stratify)
    c = c + F.lit(0.0) if is_float(type_of(df, stratify)) else c        # both zeros are one class
    rows = df.withColumns({"__c": c.cast("string"), "__digest": key_digest(key_cols, seed)})
    numbered = running_totals(rows, ["__c"], ["__digest"], name="__place")
    side = ends.select(F.col("c").alias("__class"), F.col("ends").alias("__ends"))
    number = F.size(F.filter("__ends", lambda end: end < F.col("__place")))
    return (numbered.join(side, known(numbered, stratify).eqNullSafe(F.col("__class")))
            .withColumn(name, number).drop("__c", "__digest", "__place", "__class", "__ends"))


def _as_digest(fraction: float) -> str:
    """The digest prefix that lies at a fraction of the digest range."""
    if fraction >= 1.0:
        return "g"              # above every hexadecimal digest
    return format(int(max(fraction, 0.0) * 16**DIGEST_DIGITS), f"0{DIGEST_DIGITS}x")


def rank_windows(n: int, ranks: Sequence[int], slack: float = 1.0) -> list[str]:
    """Disjoint digest windows around the places of ranks 1…n: ``[from, to, from, to, …]``."""
    windows: list[list[float]] = []
    for rank in sorted(ranks):
        place = rank / n
        margin = slack * (WINDOW_SIGMAS * math.sqrt(place * (1 - place) / n) + 2 / n)
        if windows and place - margin <= windows[-1][1]:
            windows[-1][1] = place + margin
        else:
            windows.append([place - margin, place + margin])
    return [_as_digest(edge) for window in windows for edge in window]


def find_cuts(df: DataFrame, key_cols: Sequence[str], stratify: str | None, seed: int, sizes: Sizes,
              slack: float = 1.0) -> DigestCuts:
    """Find the digests at cumulative ranks ``sizes(class counts)`` of every class."""
    spark = df.sparkSession
    require_columns(df, key_cols)
    stratum: Column = F.lit(0) if stratify is None else known(df, stratify)
    class_type: T.DataType = T.IntegerType() if stratify is None else type_of(df, stratify)
    counts = class_sizes(df, stratify)
    wanted = sizes(counts)
    cuts: dict[Any, list[str]] = {c: [""] * len(ranks) for c, ranks in wanted.items()}
    missing: dict[Any, dict[int, int]] = {}
    for c, ranks in wanted.items():
        for i, rank in enumerate(ranks):
            if rank >= counts[c]:
                cuts[c][i] = _as_digest(1.0)
            elif rank > 0:
                missing.setdefault(c, {})[i] = rank

    def label(c: Any) -> Any:
        return 0 if stratify is None else c

    digests = df.select(stratum.alias("__c"), key_digest(key_cols, seed).alias("__digest"))
    while missing:
        edges = local_table(
            spark, [(label(c), rank_windows(counts[c], list(r.values()), slack)) for c, r in missing.items()],
            T.StructType([T.StructField("__class", class_type), T.StructField("__edges", T.ArrayType(T.StringType()))]))
        ranks = local_table(
            spark,
            [(label(c), i, rank) for c, r in missing.items() for i, rank in r.items()],
            T.StructType([T.StructField("__of", class_type), T.StructField("__cut", T.IntegerType()),
                          T.StructField("__rank", T.LongType())]))
        # regions of the digest range: even ones lie between windows, odd ones are windows
        most = max(2 * len(r) for r in missing.values())
        region = sum((F.coalesce((F.get("__edges", F.lit(i)) <= F.col("__digest")).cast("int"), F.lit(0))
                      for i in range(most)), F.lit(0))
        located = (digests.join(edges, F.col("__c").eqNullSafe(F.col("__class")), "inner")
                   .select("__class", region.alias("region"), "__digest")
                   .groupBy("__class", "region", F.when(F.col("region") % 2 == 1, F.col("__digest")).alias("digest"))
                   .agg(F.count(F.lit(1)).alias("__n")))
        running = F.sum("__n").over(Window.partitionBy("__class").orderBy("region", "digest"))
        picked = (located.withColumn("__upto", running)
                  .join(ranks, F.col("__class").eqNullSafe(F.col("__of")), "inner")
                  .where((F.col("__rank") <= F.col("__upto")) & (F.col("__rank") > F.col("__upto") - F.col("__n")))
                  .select("__class", "__cut", "digest"))
        for r in picked.collect():                  # one row per class and cut
            c = None if stratify is None else r["__class"]
            if r["digest"] is not None:             # else the rank fell outside its window
                cuts[c][r["__cut"]] = r["digest"]
                del missing[c][r["__cut"]]
        missing = {c: r for c, r in missing.items() if r}
        slack *= 4
    return DigestCuts(list(key_cols), stratify, seed, class_type, cuts)


def _class_order(value: Any) -> tuple[bool, str]:
    return (value is None, str(value))


def allocate_test_rows(counts: dict[Any, int], test_size: float) -> dict[Any, int]:
    """Test rows per class: ``ceil(n * test_size)`` in all, shared by largest remainder.

    The train side is shared out first and the test side gets the rest of each
    class; equal remainders go to the smaller class label.
    """
    total = sum(counts.values())
    n_train = total - math.ceil(total * test_size)
    exact = {c: n_train * n / total for c, n in counts.items()} if total else {}
    train = {c: math.floor(x) for c, x in exact.items()}
    left = n_train - sum(train.values())
    by_remainder = sorted(exact, key=lambda c: (-(exact[c] - train[c]), _class_order(c)))
    for c in by_remainder[:left]:
        train[c] += 1
    return {c: n - train[c] for c, n in counts.items()} if total else {c: 0 for c in counts}


def _test_ends(df: DataFrame, stratify: str, test_size: float) -> DataFrame:
    """``allocate_test_rows`` as a table: ``(c, ends)`` with the number of test rows of each class."""
    classes = _sized_classes(df, stratify)
    total = classes.agg(F.sum("n")).first()[0] or 0
    n_train = total - math.ceil(total * test_size)
    exact = F.lit(float(n_train)) * F.col("n") / F.lit(float(max(total, 1)))
    shared = classes.withColumn("whole", F.floor(exact)).withColumn("rest", F.col("whole") - exact)
    spare = n_train - (shared.agg(F.sum("whole")).first()[0] or 0)
    served = running_totals(shared, [], ["rest", "absent", "label"], name="place")
    test_rows = F.col("n") - F.col("whole") - (F.col("place") <= spare).cast("bigint")
    return served.select("c", F.array(test_rows).alias("ends"))


def train_test_split(df: DataFrame, key_cols: Sequence[str], stratify: str | None = None,
                     test_size: float = 0.2, seed: int = 42, split_col: str = "split") -> DataFrame:
    """Add ``split`` = 'train' or 'test', with exact class counts.

    ``key_cols`` must name rows uniquely.
    """
    if not 0 < test_size < 1:
        raise ValueError("test_size must lie between 0 and 1")

    def sizes(counts: dict[Any, int]) -> dict[Any, list[int]]:
        return {c: [n] for c, n in allocate_test_rows(counts, test_size).items()}

    try:
        parted = find_cuts(df, key_cols, stratify, seed, sizes).part(df, "__part")
    except TooManyRows:
        parted = _parts_by_number(df, key_cols, stratify, seed, _test_ends(df, stratify, test_size), "__part")
    side = F.when(F.col("__part") == 0, "test").otherwise("train")
    return parted.withColumn(split_col, side).drop("__part")


def fold_edges(n: int, k: int, before: int = 0) -> list[int]:
    """Cumulative sizes of the first k-1 of k folds.

    ``n % k`` folds hold one more: those that follow, in a circle, on the last
    one served by the ``before`` rows of the classes that came earlier.
    """
    sizes = [n // k + ((fold - before) % k < n % k) for fold in range(k)]
    return list(accumulate(sizes))[:-1]


def _fold_ends(df: DataFrame, stratify: str, k: int) -> DataFrame:
    """``fold_edges`` of all classes as a table: ``(c, ends)``."""
    counted = running_totals(_sized_classes(df, stratify), [], ["absent", "label"], "n", "upto")
    before = F.col("upto") - F.col("n")
    size = [F.floor(F.col("n") / k) + (F.pmod(F.lit(fold) - before, F.lit(k)) < F.col("n") % k).cast("bigint")
            for fold in range(k - 1)]
    return counted.select("c", F.array(*accumulate(size)).alias("ends"))


def assign_folds(df: DataFrame, key_cols: Sequence[str], k: int = 5, stratify: str | None = None,
                 seed: int = 42, fold_col: str = "fold") -> DataFrame:
    """Add a fold number 0…k-1; the folds differ by at most one row, within each class and in all."""
    if k < 2:
        raise ValueError("k must be at least 2")

    def sizes(counts: dict[Any, int]) -> dict[Any, list[int]]:
        ordered = sorted(counts, key=_class_order)
        before = accumulate((counts[c] for c in ordered), initial=0)
        return {c: fold_edges(counts[c], k, total) for c, total in zip(ordered, before)}

    try:
        return find_cuts(df, key_cols, stratify, seed, sizes).part(df, fold_col)
    except TooManyRows:
        return _parts_by_number(df, key_cols, stratify, seed, _fold_ends(df, stratify, k), fold_col)


def split_sizes(df: DataFrame, split_col: str = "split") -> DataFrame:
    """Rows and feature columns per side: ``(split, n_rows, n_columns)``."""
    require_columns(df, [split_col])
    return df.groupBy(ref(split_col).alias("split")).agg(F.count(F.lit(1)).alias("n_rows")).withColumn(
        "n_columns", F.lit(len(df.columns) - 1))
