"""A first study of a labelled table, from raw rows to a baseline score."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame

from ..operators.baseline import STRATEGIES, BaselineClassifier
from ..operators.columns import drop_columns, identify_column_types
from ..operators.correlation import collinear_pairs, target_correlations
from ..operators.distributions import target_counts
from ..operators.duplicates import count_duplicates, require_unique_key
from ..operators.features import FeaturePreprocessor, FeaturePreprocessorModel, LabelEncoder, LabelEncoderModel
from ..operators.profile import empty_columns, kind_of, profile
from ..operators.splitting import split_sizes, train_test_split
from .evaluate import ClassificationResult, eval_classification


@dataclass
class Study:
    n_duplicates: int
    profile: DataFrame
    class_counts: DataFrame
    split_sizes: DataFrame
    train: DataFrame
    test: DataFrame
    features: FeaturePreprocessorModel
    encoder: LabelEncoderModel
    collinear: DataFrame
    target_correlations: DataFrame
    baseline: ClassificationResult
    dropped: list[str] = field(default_factory=list)


def study(df: DataFrame, target: str, key_cols: Sequence[str], test_size: float = 0.2, seed: int = 42,
          collinear_threshold: float = 0.9, n_top: int = 10, cv: int = 5) -> Study:
    """Check the key, drop empty columns, profile, split, prepare features, correlate, fit the baseline.

    Everything learned comes from the train side only.
    """
    require_unique_key(df, key_cols)
    duplicates = count_duplicates(df, key_cols=key_cols)
    clean, dropped = drop_columns(df, empty_columns(df, key_cols))
    split = train_test_split(clean, key_cols, target, test_size, seed)
    # every step reads the train side, most of them more than once: the split is found once
    held = split.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return _study(clean, dropped, duplicates, held, target, key_cols, seed, collinear_threshold, n_top, cv)
    finally:
        held.unpersist()


def _study(clean: DataFrame, dropped: list[str], duplicates: int, split: DataFrame, target: str, key_cols: Sequence[str], seed: int,
           collinear_threshold: float, n_top: int, cv: int) -> Study:
    train, test = (split.where(f"split = '{side}'").drop("split") for side in ("train", "test"))
    numeric, categorical = identify_column_types(train.drop(target), key_cols)
    # a point in time is no category: one column a moment would follow
    categorical = [c for c in categorical if kind_of(train.schema[c].dataType) != "temporal"]
    features = FeaturePreprocessor(numeric, categorical, key_cols).fit(train)
    encoder = LabelEncoder(target, "__target").fit(train)
    coded = encoder.transform(train)
    result = eval_classification(BaselineClassifier(), {"strategy": list(STRATEGIES)}, train, test, target,
                                 key_cols, cv=cv, seed=seed)
    return Study(
        n_duplicates=duplicates, profile=profile(clean, key_cols=key_cols),
        class_counts=target_counts(clean, target), split_sizes=split_sizes(split), train=train, test=test,
        features=features, encoder=encoder,
        collinear=collinear_pairs(train, collinear_threshold, cols=numeric),
        target_correlations=target_correlations(coded, "__target", n_top, cols=numeric),
        baseline=result, dropped=dropped)
