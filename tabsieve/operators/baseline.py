"""A classifier that ignores the features: the bar every model has to clear."""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence
from itertools import accumulate

from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasLabelCol, HasPredictionCol, HasSeed
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.hashing import digest_unit, key_digest
from ..functions.nulls import known, ref, require_columns, sql_double
from ..functions.ranks import bucket_of

# The strategies.
STRATEGIES = ("most_frequent", "prior", "stratified", "uniform")


class _BaselineParams(HasLabelCol, HasPredictionCol, HasSeed, DefaultParamsReadable, DefaultParamsWritable):
    strategy = Param(Params._dummy(), "strategy", f"one of {', '.join(STRATEGIES)}", TypeConverters.toString)
    keyCols = Param(Params._dummy(), "keyCols", "row key, the source of random draws", TypeConverters.toListString)

    def __init__(self) -> None:
        super().__init__()
        self._setDefault(strategy="prior", labelCol="label", predictionCol="prediction", keyCols=[], seed=42)

    def getStrategy(self) -> str:
        return self.getOrDefault(self.strategy)

    def getKeyCols(self) -> list[str]:
        return self.getOrDefault(self.keyCols)

    def _checked_strategy(self) -> str:
        name = self.getStrategy()
        if name not in STRATEGIES:
            raise ValueError(f"strategy must be one of {STRATEGIES}")
        if name in ("stratified", "uniform") and not self.getKeyCols():
            raise ValueError(f"strategy {name} draws by row key: set keyCols")
        return name


class BaselineClassifier(Estimator, _BaselineParams):
    """Learns the class counts (one pre-aggregated groupBy) of a numeric label column.

    ``most_frequent`` and ``prior`` predict the biggest class, the lowest on a
    tie; ``stratified`` draws classes by their share and ``uniform`` evenly,
    both as a function of the row key and the seed.
    """

    def __init__(self, strategy: str = "prior", labelCol: str = "label", predictionCol: str = "prediction",
                 keyCols: Sequence[str] = (), seed: int = 42) -> None:
        super().__init__()
        self._set(strategy=strategy, labelCol=labelCol, predictionCol=predictionCol,
                  keyCols=list(keyCols), seed=seed)

    def _fit(self, dataset: DataFrame) -> "BaselineClassifierModel":
        return self._model({r["y"]: r["n"] for r in self._counts(dataset).collect()})

    def fit_folds(self, dataset: DataFrame, fold_col: str, k: int) -> list["BaselineClassifierModel"]:
        """One model per fold, each of all the other folds; a single count serves them all."""
        counts = [(r["fold"], r["y"], r["n"]) for r in self._counts(dataset, ref(fold_col).alias("fold")).collect()]
        total = Counter()
        for _, y, n in counts:
            total[y] += n
        own = [{y: n for fold, y, n in counts if fold == i} for i in range(k)]
        return [self._model({y: n - held.get(y, 0) for y, n in total.items() if n > held.get(y, 0)}) for held in own]

    def _counts(self, dataset: DataFrame, *by: Column) -> DataFrame:
        """Rows per class (and fold).  The class list is the model: one entry a class is all the driver gets."""
        label = self.getLabelCol()
        require_columns(dataset, [label])
        y = known(dataset, label)
        return dataset.where(y.isNotNull()).groupBy(*by, y.cast("double").alias("y")).agg(F.count(F.lit(1)).alias("n"))

    def _model(self, counts: dict[float, int]) -> "BaselineClassifierModel":
        self._checked_strategy()
        if not counts:
            raise ValueError("no labelled row to learn from")
        rows = sorted(counts.items())
        return self._copyValues(BaselineClassifierModel([y for y, _ in rows], [float(n) for _, n in rows]))


class BaselineClassifierModel(Model, _BaselineParams):
    classes = Param(Params._dummy(), "classes", "sorted class codes", TypeConverters.toListFloat)
    counts = Param(Params._dummy(), "counts", "training rows per class", TypeConverters.toListFloat)

    def __init__(self, classes: Sequence[float] = (), counts: Sequence[float] = ()) -> None:
        super().__init__()
        self._set(classes=list(classes), counts=list(counts))

    @property
    def priors(self) -> dict[float, float]:
        counts = self.getOrDefault(self.counts)
        return {c: n / sum(counts) for c, n in zip(self.getOrDefault(self.classes), counts)}

    def _transform(self, dataset: DataFrame) -> DataFrame:
        strategy = self._checked_strategy()
        classes, counts = self.getOrDefault(self.classes), self.getOrDefault(self.counts)
        if strategy in ("most_frequent", "prior"):
            guess = F.lit(classes[counts.index(max(counts))])
        else:
            weights = counts if strategy == "stratified" else [1.0] * len(counts)
            total = sum(weights)
            edges = [w / total for w in list(accumulate(weights))[:-1]]
            drawn = dataset.withColumn("__draw", digest_unit(key_digest(self.getKeyCols(), self.getSeed())))
            values = F.expr(f"array({', '.join(map(sql_double, classes))})")
            return drawn.withColumn(self.getPredictionCol(), F.get(values, bucket_of("__draw", edges))).drop("__draw")
        return dataset.withColumn(self.getPredictionCol(), guess)
