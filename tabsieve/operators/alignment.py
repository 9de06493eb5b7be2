"""Pairing features with a target that arrives in another frame."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from ..functions.nulls import require_columns
from .duplicates import require_unique_key


def attach_target(features: DataFrame, target: DataFrame, key_cols: Sequence[str],
                  check_keys: bool = True) -> DataFrame:
    """Join the target to the features one to one on their key.

    With unique keys on both sides no key is hot; the join strategy is Spark's choice.
    """
    keys = require_columns(features, key_cols)
    require_columns(target, keys)
    shared = (set(features.columns) & set(target.columns)) - set(keys)
    if shared:
        raise ValueError(f"columns on both sides: {sorted(shared)}")
    if check_keys:
        require_unique_key(features, keys)
        require_unique_key(target, keys)
    return features.join(target, keys, "inner")
