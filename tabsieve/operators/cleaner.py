"""A cleaning recipe that is learned on one table and applied unchanged to others.

Steps, in this order: drop columns with too many gaps, fill binary columns with
their mode, clean and fill the floor column, fill numeric columns with their
median, void and fill the rent column.  Learning reads the table a few times
(statistics that do not depend on each other share a scan); applying is one
projection.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from typing import Any

from pyspark.ml import Estimator, Model
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.nulls import drop_below, known, replace_values, to_numeric, type_of
from ..functions.persistence import JsonState
from .cleaning import with_replaced
from .columns import drop_columns_if_present
from .imputation import medians, modes
from .profile import high_na_columns

# The recognised configuration keys.
CONFIG_KEYS = (
    "drop_na_threshold", "binary_cols", "floor_col", "floor_replace", "floor_median_key",
    "numeric_median_cols", "numeric_median_key", "rent_col", "rent_invalid_below", "rent_median_key",
)


@dataclass
class _Draft:
    """A frame being cleaned: its columns as expressions over the source."""

    source: DataFrame
    columns: dict[str, Column] = field(default_factory=dict)

    def has(self, name: str) -> bool:
        return name in self.source.columns

    def dtype(self, name: str) -> T.DataType:
        return T.DoubleType() if name in self.columns else type_of(self.source, name)

    def get(self, name: str) -> Column:
        return self.columns.get(name, known(self.source, name))

    def frame(self) -> DataFrame:
        return with_replaced(self.source, self.columns)


def _number(draft: _Draft, name: str) -> Column:
    return to_numeric(draft.get(name), draft.dtype(name))


def _filled(c: Column, value: float | None) -> Column:
    return c if value is None else F.coalesce(c, F.lit(float(value)))


def _run(df: DataFrame, config: Mapping[str, Any], stats: dict[str, Any]) -> tuple[DataFrame, dict[str, Any]]:
    """Walk through the steps; learn what ``stats`` lacks, then build the projection."""
    unknown = set(config) - set(CONFIG_KEYS)
    if unknown:
        raise ValueError(f"unknown configuration keys {sorted(unknown)}")

    threshold = config.get("drop_na_threshold")
    if threshold is not None:
        if "cols_to_drop" not in stats:
            stats["cols_to_drop"] = high_na_columns(df, threshold)
        df = drop_columns_if_present(df, stats["cols_to_drop"])

    binary = [c for c in config.get("binary_cols") or [] if c in df.columns]
    if config.get("binary_cols"):
        if "bin_modes" not in stats:
            stats["bin_modes"] = modes(df, binary)
        fills = {c: stats["bin_modes"][c] for c in binary if c in stats["bin_modes"]}
        df = with_replaced(df, {c: F.coalesce(known(df, c), F.lit(v).cast(type_of(df, c))) for c, v in fills.items()})

    draft = _Draft(df)
    floor, rent = config.get("floor_col"), config.get("rent_col")
    numeric = [c for c in config.get("numeric_median_cols") or [] if draft.has(c)]
    floor_key = config.get("floor_median_key", "floor_median")
    numeric_key = config.get("numeric_median_key", "num_medians")
    rent_key = config.get("rent_median_key", "rent_median")

    # Three groups of medians; those over different columns are learned together.
    groups: list[tuple[str, dict[str, Column], bool]] = []
    if floor and draft.has(floor):
        cleaned = replace_values(draft.get(floor), draft.dtype(floor), config.get("floor_replace") or {})
        groups.append((floor_key, {floor: cleaned}, False))
    if config.get("numeric_median_cols"):
        groups.append((numeric_key, {c: None for c in numeric}, True))
    if rent and draft.has(rent):
        groups.append((rent_key, {rent: None}, False))

    def expression(key: str, name: str, given: Column | None) -> Column:
        if given is not None:
            return given
        number = _number(draft, name)
        return drop_below(number, config.get("rent_invalid_below")) if key == rent_key and name == rent else number

    pending: list[tuple[str, dict[str, Column], bool]] = []

    def settle() -> None:
        """Learn the pending medians in one go and fill the columns."""
        missing = {f"{i}:{c}": e for i, (key, exprs, _) in enumerate(pending) if key not in stats
                   for c, e in exprs.items()}
        learned = medians(df, missing)
        for i, (key, exprs, many) in enumerate(pending):
            if key not in stats:
                values = {c: learned[f"{i}:{c}"] for c in exprs}
                stats[key] = values if many else next(iter(values.values()))
        for key, exprs, many in pending:
            for c, e in exprs.items():
                draft.columns[c] = _filled(e, stats[key].get(c) if many else stats[key])
        pending.clear()

    for key, exprs, many in groups:
        touched = {c for _, p, _ in pending for c in p}
        if touched & set(exprs) or any(key == k for k, _, _ in pending):
            settle()
        pending.append((key, {c: expression(key, c, e) for c, e in exprs.items()}, many))
    settle()
    return draft.frame(), stats


def clean_data(df: DataFrame, config: Mapping[str, Any],
               stats: Mapping[str, Any] | None = None) -> tuple[DataFrame, dict[str, Any]]:
    """Clean ``df``; statistics already in ``stats`` are reused, the others learned.

    Returns the cleaned frame and the statistics, ready for the next table.
    """
    return _run(df, config, dict(stats or {}))


class DataCleaner(Estimator, JsonState):
    """``clean_data`` as a pipeline stage: ``fit`` learns, the model only projects."""

    def __init__(self, config: Mapping[str, Any] | None = None) -> None:
        super().__init__()
        self._set(state={"config": dict(config or {})})

    def _fit(self, dataset: DataFrame) -> "DataCleanerModel":
        config = self.get_state()["config"]
        return DataCleanerModel(config, clean_data(dataset, config)[1])


class DataCleanerModel(Model, JsonState):
    def __init__(self, config: Mapping[str, Any] | None = None, stats: Mapping[str, Any] | None = None) -> None:
        super().__init__()
        self._set(state={"config": dict(config or {}), "stats": dict(stats or {})})

    @property
    def stats(self) -> dict[str, Any]:
        return self.get_state()["stats"]

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return clean_data(dataset, self.get_state()["config"], self.stats)[0]
