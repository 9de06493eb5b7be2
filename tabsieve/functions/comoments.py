"""Sums of products of many column pairs in one scan, over the rows where both columns have a value.

Tasks multiply blocks of values and of masks, and sum what comes out; the sums of
the tasks are added in two rounds, in strips of columns, so no task holds more
than a few strips.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

STRIP = 64                  # left columns per strip
GROUPS = 16                 # partial sums per strip after the first round
BLOCK_VALUES = 1 << 20      # values multiplied at a time
PARTS = ("n", "x", "y", "xx", "yy", "xy")


@dataclass(frozen=True)
class Scale:
    """Maps the values of a column into -1 … 1."""

    middle: float
    half: float

    @classmethod
    def between(cls, low: float, high: float) -> Scale:
        return cls(low / 2 + high / 2, high / 2 - low / 2)


def _products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The PARTS of a block of rows: (part, left column, right column)."""
    seen_left, seen_right = ~np.isnan(left), ~np.isnan(right)
    x, y = np.where(seen_left, left, 0.0), np.where(seen_right, right, 0.0)
    out = np.empty((len(PARTS), left.shape[1], right.shape[1]))
    if seen_left.all() and seen_right.all():
        out[0] = len(left)
        out[1], out[2] = x.sum(axis=0)[:, None], y.sum(axis=0)
        out[3], out[4] = (x * x).sum(axis=0)[:, None], (y * y).sum(axis=0)
    else:
        m, w = seen_left.astype(float), seen_right.astype(float)
        out[0] = m.T @ w
        out[1], out[2] = x.T @ w, m.T @ y
        out[3], out[4] = (x * x).T @ w, m.T @ (y * y)
    out[5] = x.T @ y
    return out


def _added(rows: DataFrame, *by: str) -> DataFrame:
    """Sums of the arrays in ``data`` over rows of equal keys; each task meets all rows of a key."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple, np.ndarray] = {}
        for batch in batches:
            keys = zip(*(batch.column(i).to_pylist() for i in range(len(by))))
            for key, data in zip(keys, batch.column(len(by))):
                own = np.frombuffer(data.as_buffer(), float)
                if key in sums:
                    sums[key] += own
                else:
                    sums[key] = own.copy()
        for key, total in sums.items():
            yield pa.RecordBatch.from_arrays([*(pa.array([k], pa.int32()) for k in key), pa.array([total.tobytes()])], names=[*by, "data"])

    return rows.select(*by, "data").repartition(*by).mapInArrow(run, ", ".join(f"{k} int" for k in by) + ", data binary")


def comoments(df: DataFrame, left: Sequence[str], right: Sequence[str], scales: dict[str, Scale]) -> dict[str, np.ndarray]:
    """Per part of PARTS a matrix (left column, right column) of sums over the pair's complete rows.

    ``df`` has double columns, NULL where a value is missing, and finite values
    within the scales; the sums are of scaled values: n counts rows, x and y sum
    the two sides, xx, yy and xy their products.
    """
    cols = list(dict.fromkeys([*left, *right]))
    at_left, at_right = ([cols.index(c) for c in side] for side in (left, right))
    middle, half = (np.array([getattr(scales[c], part) for c in cols]) for part in ("middle", "half"))
    rows = max(1, BLOCK_VALUES // max(1, len(cols)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(PARTS), len(left), len(right)))
        for batch in batches:
            for start in range(0, batch.num_rows, rows):
                part = batch.slice(start, rows)
                values = np.column_stack([c.to_numpy(zero_copy_only=False).astype(float) for c in part.columns])
                scaled = (values - middle) / half
                total += _products(scaled[:, at_left], scaled[:, at_right])
        strips = [np.ascontiguousarray(total[:, i:i + STRIP]).tobytes() for i in range(0, len(left), STRIP)]
        group = TaskContext.get().partitionId() % GROUPS
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(len(strips)), pa.int32()), pa.array([group] * len(strips), pa.int32()), pa.array(strips)],
            names=["strip", "group", "data"])

    partial = df.select(*[F.col(c) for c in cols]).mapInArrow(run, "strip int, group int, data binary")
    # one row per strip, as large together as the matrices that are asked for
    found = sorted(_added(_added(partial, "strip", "group"), "strip").collect(), key=lambda r: r["strip"])
    whole = np.concatenate([np.frombuffer(r["data"], float).reshape(len(PARTS), -1, len(right)) for r in found], axis=1)
    return dict(zip(PARTS, whole))
