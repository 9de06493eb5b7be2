"""Near duplicates by SimHash: fingerprints, pigeonhole blocks, Hamming distance, components.

Two fingerprints of at most `distance` differing bits agree in at least 3 of distance + 3 blocks of their bits.  So
each fingerprint is listed under every choice of 3 blocks, and only fingerprints under one key are compared.  With the
default distance of 3 a key has 31 to 33 bits: of 10 billion fingerprints about two meet by chance.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabsieve.llm.common import append_columns, quoted, scratch_folder, written
from tabsieve.llm.components import connected_components

#: Groups up to this size are compared within a row, larger ones in cells of two chunks.
SMALL = 32
CHUNK = 1_024
#: The bits of each byte value, lowest first.
BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def fingerprint(text: str | None, shingle: int = 3, seed: int = 42) -> int:
    """The SimHash of a text's word shingles, repeats included; 0 without words.  A-Z count as a-z."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    counts = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for start in range(0, n, 32_768):
        stop = min(n, start + 32_768)
        if len(words) < shingle:
            parts = [b" ".join(words)]
        else:
            parts = map(b" ".join, zip(*(words[start + k : stop + k] for k in range(shingle))))
        hashes = np.fromiter((digest(x, seed) for x in parts), np.uint64, stop - start)
        for k, column in enumerate(hashes.view(np.uint8).reshape(-1, 8).T):
            counts[8 * k : 8 * k + 8] += np.bincount(column, minlength=256) @ BITS
    return int(np.packbits(2 * counts > n, bitorder="little").view(np.int64)[0])


def fingerprints(df: DataFrame, text: str = "text", shingle: int = 3, seed: int = 42, keep: list[str] | None = None) -> DataFrame:
    """df with the fingerprint as a long, `fp`; null and empty texts have 0."""
    return append_columns(df, text, "fp long", lambda: lambda texts: [[fingerprint(t, shingle, seed) for t in texts]], keep)


def _masks(distance: int) -> list[int]:
    n = distance + 3
    bounds = [64 * i // n for i in range(n + 1)]
    blocks = [((1 << (hi - lo)) - 1) << lo for lo, hi in zip(bounds, bounds[1:])]
    return [m - (1 << 64) if m >> 63 else m for m in (a | b | c for a, b, c in combinations(blocks, 3))]


def _forest(distance: int):
    """Links a star to the smallest of each component within a cell; no more rows than fingerprints."""

    def run(cell: pd.DataFrame) -> pd.DataFrame:
        fp = np.unique(cell["fp"].to_numpy(np.int64))
        label, bits = np.arange(len(fp)), fp.view(np.uint64)
        near = np.bitwise_count(bits[:, None] ^ bits[None, :]) <= distance
        while True:
            new = np.where(near, label[None, :], len(fp)).min(axis=1)
            new = np.minimum(new, new[new])
            if (new == label).all():
                break
            label = new
        rest = label != np.arange(len(fp))
        return pd.DataFrame({"a": fp[rest], "b": fp[label[rest]]})

    return run


def near_pairs(prints: DataFrame, distance: int = 3) -> DataFrame:
    """Edges (a, b) that connect all distinct fingerprints `fp` which differ in at most `distance` bits.

    Under a key of up to SMALL fingerprints these are the pairs themselves.  A larger group is cut into chunks by
    hash, every two chunks are compared in a task of their own, and only a spanning forest of what they link is
    returned: the edges grow with the group, not with its square, and no link between components is lost.
    """
    keyed = prints.select("fp", F.explode(F.array(*(F.struct(F.lit(i).cast("byte").alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("k")) for i, m in enumerate(_masks(distance))))).alias("x")).select("fp", "x.t", "x.k")
    groups = keyed.groupBy("t", "k").agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("fp")).alias("s1"), F.bit_xor(F.xxhash64(F.lit(1), "fp")).alias("s2")).where("n > 1")
    # the same fingerprints often meet under many keys: one of these groups is enough
    groups = groups.groupBy("n", "s1", "s2").agg(F.min(F.struct("t", "k")).alias("x")).select("n", "x.t", "x.k")
    members = keyed.join(groups, ["t", "k"])
    lists = members.where(F.col("n") <= SMALL).groupBy("t", "k").agg(F.array_sort(F.collect_list("fp")).alias("g"))
    pairs = lists.select(F.explode(F.expr(f"flatten(transform(g, (x, i) -> transform(filter(slice(g, i + 2, {SMALL}), y -> bit_count(x ^ y) <= {distance}), y -> named_struct('a', x, 'b', y))))")).alias("p")).select("p.a", "p.b")
    large = members.where(F.col("n") > SMALL).withColumn("c", F.expr(f"CAST(ceil(n / {CHUNK}) AS INT)")).withColumn("i", F.pmod(F.xxhash64(F.lit(2), "fp"), F.col("c")))
    cells = large.select("t", "k", "fp", "i", F.explode(F.sequence(F.lit(0), F.col("c") - 1)).alias("j")).select("t", "k", F.least("i", "j").alias("i"), F.greatest("i", "j").alias("j"), "fp")
    return pairs.union(cells.groupBy("t", "k", "i", "j").applyInPandas(_forest(distance), "a long, b long")).distinct()


def simhash_components(df: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3, distance: int = 3, keep: list[str] | None = None) -> DataFrame:
    """df (or its columns `keep`) with fingerprint, component_id, root and n_first.

    fingerprint: 16 hex digits.  component_id: the smallest key among all documents that can be reached over links of
    at most `distance` bits, itself included (null keys count as none).  root: the component as a fingerprint.
    n_first: rows of the component that carry the key component_id.  Null and empty texts have fingerprint zero and
    are linked like any other.  Repeated rows each stay.  An input column of one of these names is replaced.
    """
    folder = scratch_folder(df.sparkSession)
    prints = written(fingerprints(df.select(quoted(key).alias("id"), quoted(text).alias("text")), "text", shingle, keep=["id"]), folder, "prints")
    distinct = prints.groupBy("fp").agg(F.min("id").alias("least"))
    distinct = written(distinct, folder, "distinct")
    labels = connected_components(near_pairs(distinct, distance), folder)
    rooted = distinct.join(labels, F.col("fp") == F.col("node"), "left").select("fp", "least", F.coalesce("label", "fp").alias("root"))
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    mapped = rooted.join(smallest, "root").select("fp", "root", "component_id")
    if keep == [key]:
        return _named(prints.join(mapped, "fp"), {key: "id"})
    firsts = prints.join(mapped, "fp").where("id <=> component_id").groupBy("root").agg(F.count(F.lit(1)).alias("n_first"))
    kept = [c for c in (df.columns if keep is None else keep) if c.lower() not in {"fingerprint", "component_id", "root", "n_first"}]
    own = {c: "__body" if c == text else f"__c{i}" for i, c in enumerate(kept)}  # no name of the joined tables
    body = [] if text in own else [quoted(text).alias("__body")]
    rows = fingerprints(df.select(*(quoted(c).alias(n) for c, n in own.items()), *body), "__body", shingle, keep=list(own.values()))
    joined = rows.join(mapped.join(firsts, "root", "left"), "fp")
    return _named(joined, own, "n_first")


def _named(rows: DataFrame, kept: dict[str, str], *more: str) -> DataFrame:
    """The columns to keep, by their names outside and in `rows`, and what was found."""
    return rows.select(*(F.col(n).alias(c) for c, n in kept.items()), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "root", *more)


def first_of_each_component(df: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3, distance: int = 3) -> DataFrame:
    """One row of df for each component: that of the smallest key; of repeated rows with this key, one.

    All columns of df stay as they are, whatever their names.
    """
    names = [f"__d{i}" for i in range(len(df.columns))]
    own_key, own_text = (names[df.columns.index(c)] for c in (key, text))
    found = simhash_components(df.toDF(*names), own_key, own_text, shingle, distance)
    first = found.where(F.col(own_key).eqNullSafe(F.col("component_id")))
    alone = first.where("n_first = 1")
    repeated = first.where("n_first > 1").dropDuplicates(["root"])
    return alone.select(*names).union(repeated.select(*names)).toDF(*df.columns)
