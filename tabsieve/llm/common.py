"""What the text operators share: tables, scratch tables and appending computed columns in Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabsieve.sources.scratch import scratch_dir

#: UTF-8 bytes of text that are turned into Python objects at a time.
SLICE_BYTES = 4_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def scratch_folder(spark: SparkSession) -> str:
    """A new folder under spark.checkpoint.dir; a local session may do without, a cluster is refused then."""
    return scratch_dir(spark, "llm")


#: For tables with rows of some MB: Parquet looks at the size from the first row on, and Spark reads a group at a time.
FAT_ROWS = {"parquet.block.size": 8 << 20, "parquet.block.size.row.check.min": 1, "parquet.page.size.row.check.min": 1}


def written(df: DataFrame, folder: str, name: str, options: dict | None = None) -> DataFrame:
    """df as a Parquet table: computed once, and safe from lost executors."""
    path = f"{folder}/{name}"
    df.write.options(**(options or {})).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def small_batches(spark: SparkSession, most: int) -> Iterator[None]:
    """What runs within it passes batches of some `most` bytes to Python, one row at least; Spark and Python hold one for a task."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(most))
    try:
        yield
    finally:
        spark.conf.set(key, before)


_resident: dict = {}


def resident(key: tuple, build: Callable):
    """What a worker process keeps from task to task: the state of the operator that ran last, and no other's."""
    if key not in _resident:
        _resident.clear()
        _resident[key] = build()
    return _resident[key]


def slices(batch: pa.RecordBatch, index: int, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of a batch whose texts in column `index` take about `most` bytes; at least one row each."""
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(index)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    number = np.cumsum(sizes) // most
    cuts = [0, *(np.flatnonzero(np.diff(number)) + 1).tolist(), batch.num_rows]
    for start, end in zip(cuts, cuts[1:]):
        yield batch.slice(start, end - start)


def append_columns(df: DataFrame, text: str, fields: str | T.StructType, make: Callable[[], Callable[..., list]], keep: list[str] | None = None, beside: str | None = None, most: int = SLICE_BYTES) -> DataFrame:
    """df with columns computed from the texts.

    make() runs once in each task and returns a function from a list of texts (None for null) to one list or Arrow
    array per new field; with `beside`, one of the columns that stay, it gets that column's values too.  keep names the
    columns of df that stay (default all); one of a new field's name is replaced.  most: bytes of text it gets at a time.
    """
    schema = fields if isinstance(fields, T.StructType) else T.StructType.fromDDL(fields)
    new = {f.name.lower() for f in schema}
    kept = [c for c in (df.columns if keep is None else keep) if c.lower() not in new]
    own = text in kept and isinstance(df.schema[text].dataType, T.StringType)
    at = kept.index(text) if own else len(kept)
    # mapInArrow takes no column whose name has a dot
    frame = df.select(*(quoted(c).alias(f"c{i}") for i, c in enumerate(kept)), *([] if own else [quoted(text).cast("string").alias("text")]))
    out = T.StructType([*(df.schema[c] for c in kept), *schema])
    n_kept, names = len(kept), [f.name for f in out]
    inputs = [at] if beside is None else [at, kept.index(beside)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa_type(f.dataType) for f in schema]
        work = make()
        for batch in batches:
            for part in slices(batch, at, most):
                made = work(*(part.column(i).to_pylist() for i in inputs))
                arrays = [x if isinstance(x, (pa.Array, pa.ChunkedArray)) else pa.array(x, kind) for x, kind in zip(made, types, strict=True)]
                yield pa.RecordBatch.from_arrays([*part.columns[:n_kept], *arrays], names=names)
        pa.default_memory_pool().release_unused()

    return frame.mapInArrow(run, out)


def pa_type(kind: T.DataType) -> pa.DataType:
    simple = {T.StringType: pa.string(), T.LongType: pa.int64(), T.IntegerType: pa.int32(), T.DoubleType: pa.float64(), T.BooleanType: pa.bool_(), T.BinaryType: pa.binary()}
    if isinstance(kind, T.ArrayType):
        return pa.list_(pa_type(kind.elementType))
    if isinstance(kind, T.StructType):
        return pa.struct([(f.name, pa_type(f.dataType)) for f in kind])
    return simple[type(kind)]
