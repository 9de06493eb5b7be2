"""Size checks for everything that leaves the cluster or is sent to every task."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

import pyarrow as pa
from pyspark.sql import DataFrame, Row, SparkSession, types as T
from pyspark.sql.pandas.types import to_arrow_schema

BROADCAST_ROWS = 100_000


class TooManyRows(ValueError):
    """A table that had to stay small did not."""


def local_table(spark: SparkSession, rows: Sequence[Sequence], schema: T.StructType | str) -> DataFrame:
    """A table made on the driver.  Spark knows its size, and chooses by it how to join."""
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    arrow = to_arrow_schema(schema)
    columns = list(zip(*rows)) if rows else [()] * len(schema)

    def plain(value):
        # collected timestamps are in local time, Arrow reads naive ones as UTC
        return value.astimezone() if isinstance(value, datetime) and value.tzinfo is None else value

    moments = [isinstance(f.dataType, T.TimestampType) for f in schema]
    arrays = [pa.array([plain(v) for v in c] if m else c, f.type) for c, f, m in zip(columns, arrow, moments)]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, schema=arrow), schema)


def collect_at_most(df: DataFrame, limit: int, what: str) -> list[Row]:
    """Collect a table that must hold at most ``limit`` rows, or refuse."""
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        raise TooManyRows(f"{what}: more than {limit} rows")
    return rows
