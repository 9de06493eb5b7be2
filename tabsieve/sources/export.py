"""Writing the train and test sides for model building."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from ..functions.nulls import known, log1p_or_null, ref, require_columns
from ..operators.columns import drop_columns_if_present

# The names of the four outputs.
PARTS = ("X_train", "X_test", "y_train", "y_test")


def _target(df: DataFrame, target_col: str, key_cols: Sequence[str], target_name: str,
            transform_y: str | None) -> DataFrame:
    y = known(df, target_col)
    y = log1p_or_null(y.cast("double")) if transform_y == "log1p" else y
    return df.select(*[ref(c) for c in key_cols], y.alias(target_name))


def export_train_test(train: DataFrame, test: DataFrame, target_col: str, key_cols: Sequence[str],
                      output_dir: str = "data_model", target_name: str = "log_buy_price",
                      transform_y: str | None = None, drop_cols: Sequence[str] | None = None) -> dict[str, str]:
    """Write X and y of both sides as Parquet; returns the four paths.

    The key stays in all four outputs, so features and target can be joined
    again.  ``drop_cols`` are left out of both feature tables.

    A side is computed once: it is kept in memory and on disk while its two
    outputs are written.  Both sides are written side by side.
    """
    root = output_dir.rstrip("/")
    sides = {"train": train, "test": test}
    for df in sides.values():
        require_columns(df, [target_col, *key_cols])
    extra = [c for c in drop_cols or [] if c not in key_cols]
    paths = {name: f"{root}/{name}" for name in PARTS}

    def write(side: str) -> None:
        kept = sides[side].persist(StorageLevel.MEMORY_AND_DISK)
        try:
            outputs = {f"X_{side}": drop_columns_if_present(kept, [target_col, *extra]),
                       f"y_{side}": _target(kept, target_col, key_cols, target_name, transform_y)}
            for name, frame in outputs.items():
                frame.write.mode("overwrite").parquet(paths[name])
        finally:
            kept.unpersist()

    in_threads = inheritable_thread_target(train.sparkSession)
    with ThreadPoolExecutor(max_workers=len(sides)) as pool:
        list(pool.map(in_threads(write), sides))
    return paths


def export_split(df: DataFrame, output_dir: str, split_col: str = "split",
                 drop_cols: Sequence[str] | None = None) -> str:
    """Write one dataset partitioned by side, so that reading a side skips the other's files."""
    require_columns(df, [split_col])
    drop_columns_if_present(df, [c for c in drop_cols or [] if c != split_col]).write.mode(
        "overwrite").partitionBy(split_col).parquet(output_dir)
    return output_dir


def read_exported(spark: SparkSession, output_dir: str) -> dict[str, DataFrame]:
    return {name: spark.read.parquet(f"{output_dir.rstrip('/')}/{name}") for name in PARTS}
