"""A threshold perceptron as a scoring operator over a table."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.nulls import known_double, ref, require_columns, type_of


TERMS_AT_ONCE = 1_000_000     # of one output batch, about


def _array(features: Column) -> Column:
    return features.cast("array<double>")


def weighted_sum(df: DataFrame, features: str | Sequence[str], weights: Sequence[float],
                 bias: float = 0.0, truncate: bool = False) -> Column:
    """Sum of feature times weight, plus the bias; a missing feature makes it missing.

    ``features`` is an array column or a list of numeric columns.  Differing
    lengths are an error, unless ``truncate`` cuts both to the shorter one.
    """
    weights = [float(w) for w in weights]
    if isinstance(features, str):
        require_columns(df, [features])
        if not isinstance(type_of(df, features), T.ArrayType):
            raise ValueError(f"{features} is no array column")
        x = F.transform(_array(ref(features)), lambda v: F.when(~F.isnan(v), v))
        w = F.array(*[F.lit(v) for v in weights]).cast("array<double>")
        if truncate:
            size = F.least(F.size(x), F.lit(len(weights)))
            pairs = F.zip_with(F.slice(x, F.lit(1), size), F.slice(w, F.lit(1), size), lambda a, b: a * b)
        else:
            refused = F.raise_error(F.concat(F.lit(f"{len(weights)} weights, but features: "),
                                             F.size(x).cast("string"))).cast("array<double>")
            fitting = F.when(x.isNull() | (F.size(x) == len(weights)), x).otherwise(refused)
            pairs = F.zip_with(fitting, w, lambda a, b: a * b)
        return F.aggregate(pairs, F.lit(0.0), lambda total, v: total + v) + F.lit(float(bias))
    features = require_columns(df, features)
    if len(features) != len(weights) and not truncate:
        raise ValueError(f"{len(weights)} weights, but {len(features)} features")
    terms = [known_double(df, c) * F.lit(w) for c, w in zip(features, weights)]
    return reduce(lambda a, b: a + b, terms, F.lit(0.0)) + F.lit(float(bias))


def perceptron_predict(df: DataFrame, features: str | Sequence[str], weights: Sequence[float],
                       threshold: float, bias: float = 0.0, truncate: bool = False,
                       sum_col: str = "weighted_sum", output_col: str = "output") -> DataFrame:
    """Append the weighted sum and the step function of it: 1 at or above the threshold, else 0."""
    total = weighted_sum(df, features, weights, bias, truncate)
    step = F.when(F.col(sum_col).isNotNull(), (F.col(sum_col) >= F.lit(float(threshold))).cast("int"))
    return df.withColumn(sum_col, total).withColumn(output_col, step)


def partial_sums(df: DataFrame, features: str, weights: Sequence[float], key_cols: Sequence[str]) -> DataFrame:
    """Every term and the running sum: ``(key…, pos, x, w, product, running_sum)``.

    The running sums are made inside the rows, in Arrow batches, so no term is
    shuffled; a missing feature makes its row's sums missing from there on.
    """
    require_columns(df, [features, *key_cols])
    fields = [*(df.schema[c] for c in key_cols), T.StructField("pos", T.IntegerType()),
              *(T.StructField(n, T.DoubleType()) for n in ("x", "w", "product", "running_sum"))]
    x = F.transform(_array(ref(features)), lambda v: F.when(~F.isnan(v), v))
    factors, n_keys, names = np.array(weights, float), len(key_cols), [f.name for f in fields]

    def doubles(values: np.ndarray) -> pa.Array:
        return pa.array(values, mask=np.isnan(values))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column(n_keys)
            flat = vectors.values.to_numpy(zero_copy_only=False).astype(float)
            begin = vectors.offsets.to_numpy()
            size = np.where(vectors.is_null().to_numpy(zero_copy_only=False), 0, np.minimum(np.diff(begin), len(factors)))
            piece = np.cumsum(size) // TERMS_AT_ONCE
            for rows in np.split(np.arange(len(size)), np.flatnonzero(np.diff(piece)) + 1):
                ends = np.cumsum(size[rows])
                owner = np.repeat(rows, size[rows])
                pos = np.arange(len(owner)) - np.repeat(ends - size[rows], size[rows])
                values, w = flat[begin[owner] + pos], factors[pos]
                product = values * w
                running = [np.cumsum(own) for own in np.split(product, ends[:-1])]
                keys = [batch.column(i).take(pa.array(owner)) for i in range(n_keys)]
                yield pa.RecordBatch.from_arrays(
                    [*keys, pa.array(pos, pa.int32()), doubles(values), pa.array(w), doubles(product),
                     doubles(np.concatenate(running) if running else product)], names=names)

    return df.select(*[ref(c) for c in key_cols], x.alias("__x")).mapInArrow(run, T.StructType(fields))
