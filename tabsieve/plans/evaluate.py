"""Fit, search and score a model on a train and a test table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace
from typing import Any

from pyspark.ml import Estimator, Model
from pyspark.sql import DataFrame

from ..operators import metrics
from ..operators.features import LabelEncoder
from ..operators.search import N_ITER, SearchResult, candidates, random_candidates, search
from ..operators.splitting import assign_folds

FOLD_COL = "__fold"


@dataclass
class ClassificationResult:
    best_params: dict[str, Any]
    accuracy: float
    classification_report: DataFrame
    confusion_matrix: DataFrame
    cv_results: DataFrame
    best_model: Model
    classes: list[str]
    predictions: DataFrame


@dataclass
class RegressionResult:
    best_params: dict[str, Any]
    r2: float
    rmse: float
    mae: float
    cv_results: DataFrame
    best_model: Model
    predictions: DataFrame


def _with_columns(algo: Estimator, label_col: str, key_cols: Sequence[str]) -> Estimator:
    """Point the estimator at the label column, and at the row key if it draws by key."""
    extra = {}
    if algo.hasParam("labelCol"):
        extra[algo.getParam("labelCol")] = label_col
    if algo.hasParam("keyCols") and not algo.getOrDefault("keyCols"):
        extra[algo.getParam("keyCols")] = list(key_cols)
    return algo.copy(extra)


def _prediction_col(algo: Estimator) -> str:
    return algo.getOrDefault("predictionCol") if algo.hasParam("predictionCol") else "prediction"


def _search(algo: Estimator, param_grid: Mapping | Sequence[Mapping] | None, folded: DataFrame, cv: int,
            scorer: metrics.Scorer, search_type: str, n_iter: int, seed: int, parallelism: int) -> SearchResult:
    if param_grid is not None and search_type not in ("grid", "random"):
        raise ValueError("search_type must be 'grid' or 'random'")
    if param_grid is None:
        params = {p.name: v for p, v in algo.extractParamMap().items()}
        return replace(search(algo, [{}], folded, FOLD_COL, cv, scorer, parallelism), best_params=params)
    maps = (candidates(algo, param_grid) if search_type == "grid"
            else random_candidates(algo, param_grid, n_iter, seed))
    return search(algo, maps, folded, FOLD_COL, cv, scorer, parallelism)


def eval_classification(algo: Estimator, param_grid: Mapping | Sequence[Mapping] | None, train: DataFrame,
                        test: DataFrame, target: str, key_cols: Sequence[str], search_type: str = "grid",
                        scoring: str = "accuracy", cv: int = 5, n_iter: int = N_ITER, seed: int = 42,
                        parallelism: int = 4, label_col: str = "label_index") -> ClassificationResult:
    """Encode the classes, search or fit with stratified folds, and score the test table.

    ``param_grid`` maps parameter names to candidate values; ``None`` fits the
    estimator as it is and reports its cross-validation scores.
    """
    encoder = LabelEncoder(target, label_col).fit(train)
    algo = _with_columns(algo, label_col, key_cols)
    prediction = _prediction_col(algo)
    folded = assign_folds(encoder.transform(train), key_cols, cv, stratify=target, seed=seed, fold_col=FOLD_COL)
    found = _search(algo, param_grid, folded, cv, metrics.Scorer(scoring, label_col, prediction),
                    search_type, n_iter, seed, parallelism)
    predictions = found.best_model.transform(encoder.transform(test))
    codes = list(range(len(encoder.classes)))
    # the test table is predicted once: all scores come from one count of pairs, which is kept
    confusion = metrics.pair_counts(predictions, label_col, prediction).persist()
    accuracy = metrics.accuracy_of_pairs(confusion).first()[0]
    report = metrics.report_of_pairs(confusion, codes, encoder.classes)
    return ClassificationResult(found.best_params, accuracy, report, confusion, found.cv_results,
                                found.best_model, encoder.classes, predictions)


def evaluate_model(algo: Estimator, param_grid: Mapping | Sequence[Mapping] | None, train: DataFrame,
                   test: DataFrame, target: str, key_cols: Sequence[str], search_type: str = "grid",
                   scoring: str = "r2", cv: int = 5, n_iter: int = N_ITER, seed: int = 42,
                   parallelism: int = 4) -> RegressionResult:
    """The regression counterpart: R², RMSE and MAE on the test table."""
    algo = _with_columns(algo, target, key_cols)
    prediction = _prediction_col(algo)
    folded = assign_folds(train, key_cols, cv, seed=seed, fold_col=FOLD_COL)
    found = _search(algo, param_grid, folded, cv, metrics.Scorer(scoring, target, prediction),
                    search_type, n_iter, seed, parallelism)
    predictions = found.best_model.transform(test)
    row = metrics.regression_metrics(predictions, target, prediction).first()
    return RegressionResult(found.best_params, row["r2"], row["rmse"], row["mae"], found.cv_results,
                            found.best_model, predictions)
