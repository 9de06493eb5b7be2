"""Connected components of an edge table, as joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabsieve.llm.common import written


def connected_components(edges: DataFrame, folder: str) -> DataFrame:
    """(node, label) for every node of the edges (a, b); label is the smallest node of the component.

    Alternating large and small stars: every node is linked to the smallest node it knows, until only stars are left.
    Hubs are safe: the smallest neighbour is pre-aggregated, and the join back on a node can be split.  Each round is
    written to `folder`, so the plan stays short and a lost executor costs no more than a round.
    """
    now = written(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), folder, "edges-0")
    before, turn = None, 0
    while (mark := _mark(now)) != before:
        before, turn = mark, turn + 1
        both = now.select(F.col("a").alias("u"), F.col("b").alias("v")).union(now.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        large = written(large.distinct(), folder, f"large-{turn}")
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = written(small.union(low.select("a", F.col("m").alias("b"))).distinct(), folder, f"edges-{turn}")
    return now.select(F.col("a").alias("node"), F.col("b").alias("label")).union(now.select(F.col("b").alias("node"), F.col("b").alias("label"))).distinct()


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64("b", "a"))).first())
