"""Cross validation and hyper-parameter search over folds that are a column of the table.

Spark's own ``CrossValidator`` checks a fold column with a row-at-a-time Python
function and keeps no score per fold, so the loop over (candidate, fold) is
written out here: each fold is a plain filter, and fits run side by side from a
small driver thread pool.
"""

from __future__ import annotations

import itertools
import math
import random
import statistics
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from typing import Any

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Estimator, Model
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.param import Param
from pyspark.sql import DataFrame

from ..functions.nulls import ref

N_ITER = 10         # fixed value: candidates of a random search

ParamMap = dict[Param, Any]
CV_SCHEMA = ("candidate int, params map<string,string>, split_scores array<double>, mean_score double, "
             "std_score double, rank int")


def candidates(estimator: Estimator, grid: Mapping | Sequence[Mapping]) -> list[ParamMap]:
    """All combinations of a grid, the last name varying fastest; a list of grids is concatenated."""
    grids = [grid] if isinstance(grid, Mapping) else list(grid)
    out = []
    for one in grids:
        params = [p if isinstance(p, Param) else estimator.getParam(p) for p in one]
        out += [dict(zip(params, values)) for values in itertools.product(*one.values())]
    return out


def random_candidates(estimator: Estimator, grid: Mapping | Sequence[Mapping], n_iter: int = N_ITER,
                      seed: int = 42) -> list[ParamMap]:
    """A seeded sample of the grid without repetition; the whole grid if it is not larger."""
    every = candidates(estimator, grid)
    return every if len(every) <= n_iter else random.Random(seed).sample(every, n_iter)


def cross_val_scores(estimator: Estimator, data: DataFrame, fold_col: str, k: int, evaluator: Evaluator,
                     param_maps: Sequence[ParamMap] = ({},), parallelism: int = 4) -> list[list[float]]:
    """Score of every candidate on every fold, each trained on the other folds.

    An estimator with a method ``fit_folds(data, fold_col, k)`` fits all folds
    of a candidate at once.
    """
    def models(params: ParamMap) -> list[Callable[[], Model]]:
        if hasattr(estimator, "fit_folds"):
            fitted = estimator.copy(params).fit_folds(data, fold_col, k)
            return [lambda model=model: model for model in fitted]
        return [lambda fold=fold: estimator.fit(data.where(ref(fold_col) != fold), params) for fold in range(k)]

    def score(job: tuple[Callable[[], Model], int]) -> float:
        fit, fold = job
        return evaluator.evaluate(fit().transform(data.where(ref(fold_col) == fold)))

    in_threads = inheritable_thread_target(data.sparkSession)
    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        fits = list(pool.map(in_threads(models), param_maps))
        jobs = [(fit, fold) for own in fits for fold, fit in enumerate(own)]
        scores = list(pool.map(in_threads(score), jobs))
    return [scores[i * k:(i + 1) * k] for i in range(len(param_maps))]


@dataclass
class SearchResult:
    best_model: Model
    best_params: dict[str, Any]
    best_index: int
    cv_results: DataFrame
    fold_scores: list[list[float]]


def _names(params: ParamMap) -> dict[str, Any]:
    return {p.name: v for p, v in params.items()}


def summarize(spark, param_maps: Sequence[ParamMap], scores: Sequence[Sequence[float]]) -> DataFrame:
    """One row per candidate: parameters, score per fold, mean, population deviation, rank.

    An undefined fold score makes mean and deviation undefined, and puts the candidate last.
    """
    means = [statistics.fmean(s) for s in scores]
    rows = [(i, {n: str(v) for n, v in _names(p).items()}, list(s), m, math.nan if math.isnan(m) else statistics.pstdev(s),
             1 + sum(not math.isnan(other) and (math.isnan(m) or other > m) for other in means))
            for i, (p, s, m) in enumerate(zip(param_maps, scores, means))]
    return spark.createDataFrame(rows, CV_SCHEMA)


def search(estimator: Estimator, param_maps: Sequence[ParamMap], data: DataFrame, fold_col: str, k: int,
           evaluator: Evaluator, parallelism: int = 4) -> SearchResult:
    """Score all candidates by cross validation and refit the best on all rows.

    The first of equally good candidates wins.
    """
    held = data.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        scores = cross_val_scores(estimator, held, fold_col, k, evaluator, param_maps, parallelism)
        means = [statistics.fmean(s) for s in scores]
        # a candidate whose score is undefined on some fold never wins over one that has a score
        best = max(range(len(means)), key=lambda i: (means[i] == means[i], means[i], -i))
        model = estimator.fit(held, param_maps[best])
    finally:
        held.unpersist()
    return SearchResult(model, _names(param_maps[best]), best, summarize(data.sparkSession, param_maps, scores), scores)
