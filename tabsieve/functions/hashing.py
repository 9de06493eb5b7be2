"""Reproducible pseudo-randomness that is a pure function of a row's key.

``rand()`` depends on how rows are laid out over tasks, so a re-run task may
draw other numbers.  A keyed md5 gives every row the same draw on every run and
for every partitioning.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from .nulls import ref


def key_digest(key_cols: Sequence[str | Column], *salt: object) -> Column:
    """md5 (32 hex digits) of the key's and the salt's parts, each as ``length:text``, a missing one as ``-``.

    With the lengths written down no two different keys give the same text.
    """
    parts = [(c if isinstance(c, Column) else ref(c)).cast("string") for c in key_cols] + [F.lit(str(s)) for s in salt]
    marked = [F.coalesce(F.concat(F.length(p).cast("string"), F.lit(":"), p), F.lit("-")) for p in parts]
    return F.md5(F.concat(*marked).cast("binary"))


def digest_unit(digest: Column) -> Column:
    """Map a digest to a double in [0, 1): its first 52 bits over 2**52."""
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(2**52))


def digest_int(digest: Column, n: int) -> Column:
    """Map a digest to an integer in [0, n)."""
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("bigint") % F.lit(n)).cast("int")
