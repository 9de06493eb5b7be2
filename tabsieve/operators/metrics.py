"""Scores of predictions.  Classification scores all derive from one count per (actual, predicted)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.evaluation import Evaluator
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.nulls import is_float, known, require_columns, type_of


def accuracy(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Share of rows predicted right: ``(accuracy)``."""
    require_columns(df, [label, prediction])
    hit = F.coalesce(known(df, label) == known(df, prediction), F.lit(False))
    return df.agg(F.avg(hit.cast("double")).alias("accuracy"))


def pair_counts(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """``(actual, predicted, n)`` for all pairs that occur, missing values being one of them.

    Both sides have the wider of their types, so a prediction of 0.9 is no class 0.
    """
    require_columns(df, [label, prediction])
    kinds = [type_of(df, c) for c in (label, prediction)]
    y, p = known(df, label), known(df, prediction)
    if kinds[0] != kinds[1]:
        wide = df.select(F.coalesce(y, p).alias("c")).schema["c"].dataType
        y, p = y.cast(wide), p.cast(wide)
    return df.groupBy(y.alias("actual"), p.alias("predicted")).agg(F.count(F.lit(1)).alias("n"))


def accuracy_of_pairs(pairs: DataFrame) -> DataFrame:
    """The accuracy from the counts per (actual, predicted)."""
    hits = F.sum(F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(0))
    return pairs.agg((hits / F.nullif(F.sum("n"), F.lit(0).cast("bigint"))).alias("accuracy"))


def observed_classes(df: DataFrame, label: str, prediction: str) -> list:
    """The classes that occur as truth or prediction, sorted; missing values are no class."""
    pairs = pair_counts(df, label, prediction)
    seen = pairs.select(F.explode(F.array("actual", "predicted")).alias("c")).where(F.col("c").isNotNull()).distinct()
    return sorted(r["c"] for r in seen.collect())


def _class_frame(spark, classes: Sequence, dtype: T.DataType, names: Sequence[str] | None = None) -> DataFrame:
    """``(c, position, name)`` per class."""
    names = [str(c) for c in classes] if names is None else list(names)
    rows = [(i, float(c) if is_float(dtype) else int(c) if isinstance(dtype, T.IntegralType) else c, n)
            for i, (c, n) in enumerate(zip(classes, names, strict=True))]
    return spark.createDataFrame(rows, T.StructType().add("position", T.IntegerType()).add("c", dtype).add("name", T.StringType()))


def confusion_matrix(df: DataFrame, label: str, prediction: str, classes: Sequence | None = None) -> DataFrame:
    """Rows per pair of classes: ``(actual, predicted, n)``.

    The pairs that occur, every row counted: a missing value or a class that
    nobody named has lines of its own.  Named ``classes`` (as an encoder knows
    them) add their empty pairs with 0, a grid the caller asked for.
    """
    counts = pair_counts(df, label, prediction)
    if classes is None:
        return counts
    one = _class_frame(df.sparkSession, classes, counts.schema["actual"].dataType)
    every = F.array_sort(F.collect_list("c"))
    grid = (one.agg(every.alias("cs")).select(F.explode("cs").alias("actual"), "cs")
            .select("actual", F.explode("cs").alias("predicted"), F.lit(0).cast("bigint").alias("n")))
    return counts.unionByName(grid).groupBy("actual", "predicted").agg(F.sum("n").alias("n"))


def confusion_table(df: DataFrame, label: str, prediction: str, classes: Sequence | None = None) -> DataFrame:
    """The same with one column per predicted class, in class order, and ``other`` for all other predictions."""
    classes = observed_classes(df, label, prediction) if classes is None else list(classes)
    cells = confusion_matrix(df, label, prediction, classes)
    known_class = F.col("predicted").isin(list(classes)) if classes else F.lit(False)
    none = F.lit(0).cast("bigint")
    wide = [F.coalesce(F.sum(F.when(F.col("predicted") == F.lit(c), F.col("n"))), none).alias(str(c)) for c in classes]
    other = F.coalesce(F.sum(F.when(~F.coalesce(known_class, F.lit(False)), F.col("n"))), none)
    return cells.groupBy("actual").agg(*wide, other.alias("other")).orderBy("actual")


def _ratio(top: Column, bottom: Column) -> Column:
    return F.coalesce(top / F.nullif(bottom, F.lit(0).cast("bigint")), F.lit(0.0))


def class_scores(confusion: DataFrame) -> DataFrame:
    """Per class ``(label, precision, recall, f1_score, support, chosen, hits)``; an empty denominator scores 0.

    A row whose truth or prediction is missing counts for the class it names on the other side.
    """
    hit = F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(0)
    none = F.lit(0).cast("bigint")
    sides = F.array(
        F.struct(F.col("actual").alias("label"), F.col("n").alias("support"), none.alias("chosen"), hit.alias("hits")),
        F.struct(F.col("predicted").alias("label"), none.alias("support"), F.col("n").alias("chosen"), none.alias("hits")))
    sums = confusion.select(F.inline(sides)).where(F.col("label").isNotNull()).groupBy("label").agg(
        F.sum("support").alias("support"), F.sum("chosen").alias("chosen"), F.sum("hits").alias("hits"))
    return sums.select(
        "label", _ratio(F.col("hits"), F.col("chosen")).alias("precision"),
        _ratio(F.col("hits"), F.col("support")).alias("recall"),
        _ratio(2 * F.col("hits"), F.col("support") + F.col("chosen")).alias("f1_score"), "support", "chosen", "hits")


def classification_report(df: DataFrame, label: str, prediction: str, classes: Sequence | None = None,
                          class_names: Sequence[str] | None = None) -> DataFrame:
    """Scores per class, then the accuracy, macro average and weighted average rows.

    ``(position, label, precision, recall, f1_score, support)``.  The accuracy
    line is over all rows: one whose truth or prediction is missing is a miss.
    Named ``classes`` limit the other lines and the averages to them.
    """
    classes = observed_classes(df, label, prediction) if classes is None else list(classes)
    return report_of_pairs(pair_counts(df, label, prediction), classes, class_names)


def report_of_pairs(pairs: DataFrame, classes: Sequence, class_names: Sequence[str] | None = None) -> DataFrame:
    """The report from the counts per (actual, predicted)."""
    dtype = pairs.schema["actual"].dataType
    order = _class_frame(pairs.sparkSession, classes, dtype, class_names)
    none = F.lit(0).cast("bigint")
    # a named class that does not occur scores 0 everywhere
    scores = order.join(class_scores(pairs), F.col("c") == F.col("label"), "left").select(
        "position", F.col("name").alias("label"),
        *[F.coalesce(c, F.lit(0.0)).alias(c) for c in ("precision", "recall", "f1_score")],
        F.coalesce("support", none).alias("support"))
    total = F.sum("support")

    def weighted(c: str) -> Column:
        return F.sum(F.col(c) * F.col("support")) / F.nullif(total, F.lit(0).cast("bigint"))

    summary = scores.agg(total.alias("support"),
                         *[F.avg(c).alias(f"macro_{c}") for c in ("precision", "recall", "f1_score")],
                         *[weighted(c).alias(f"weighted_{c}") for c in ("precision", "recall", "f1_score")])
    k = len(classes)
    empty = F.lit(None).cast("double")

    def line(position: int, name: str, precision: Column, recall: Column, f1: Column) -> Column:
        return F.struct(F.lit(position).alias("position"), F.lit(name).alias("label"), precision.alias("precision"),
                        recall.alias("recall"), f1.alias("f1_score"), F.col("support"))

    lines = F.array(
        line(k + 1, "macro avg", *[F.col(f"macro_{c}") for c in ("precision", "recall", "f1_score")]),
        line(k + 2, "weighted avg", *[F.col(f"weighted_{c}") for c in ("precision", "recall", "f1_score")]))
    rows = pairs.agg(F.sum("n").alias("support"),
                     F.sum(F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(0)).alias("hits"))
    right = F.array(line(k, "accuracy", empty, empty, F.col("hits") / F.nullif(F.col("support"), none)))
    return scores.unionByName(rows.select(F.inline(right))).unionByName(summary.select(F.inline(lines)))


def regression_metrics(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """``(r2, rmse, mae)`` in one scan, over rows that have both values."""
    require_columns(df, [label, prediction])
    y, p = known(df, label).cast("double"), known(df, prediction).cast("double")
    rows = df.select(y.alias("y"), p.alias("p")).where("y is not null and p is not null")
    residual = F.col("y") - F.col("p")
    sums = rows.agg(F.count(F.lit(1)).alias("n"), F.sum(residual * residual).alias("rss"),
                    (F.var_pop("y") * F.count(F.lit(1))).alias("tss"), F.avg(F.abs(residual)).alias("mae"))
    # a constant target has no variance to explain: a perfect fit scores 1, any other 0
    r2 = F.when(F.col("tss") != 0, 1 - F.col("rss") / F.nullif(F.col("tss"), F.lit(0.0))).when(
        F.col("rss") == 0, 1.0).otherwise(0.0)
    return sums.select(F.when(F.col("n") > 1, r2).alias("r2"),
                       F.sqrt(F.col("rss") / F.nullif(F.col("n"), F.lit(0).cast("bigint"))).alias("rmse"), "mae")


# The accepted scoring names.
CLASSIFICATION_SCORING = ("accuracy", "f1_macro", "f1_weighted")
REGRESSION_SCORING = ("r2", "neg_root_mean_squared_error", "neg_mean_absolute_error")


class Scorer(Evaluator):
    """A named score where larger is better, as an evaluator for searches."""

    def __init__(self, scoring: str = "accuracy", label: str = "label", prediction: str = "prediction") -> None:
        super().__init__()
        if scoring not in CLASSIFICATION_SCORING + REGRESSION_SCORING:
            raise ValueError(f"scoring must be one of {CLASSIFICATION_SCORING + REGRESSION_SCORING}")
        self.scoring, self.label, self.prediction = scoring, label, prediction

    def isLargerBetter(self) -> bool:
        return True

    def _evaluate(self, dataset: DataFrame) -> float:
        if self.scoring == "accuracy":
            value = accuracy(dataset, self.label, self.prediction).first()[0]
        elif self.scoring in CLASSIFICATION_SCORING:
            # averaged over the classes that occur as truth or prediction in this fold
            scores = class_scores(pair_counts(dataset, self.label, self.prediction))
            support = F.nullif(F.sum("support"), F.lit(0).cast("bigint"))
            value = scores.agg(F.avg("f1_score") if self.scoring == "f1_macro"
                               else F.sum(F.col("f1_score") * F.col("support")) / support).first()[0]
        else:
            row = regression_metrics(dataset, self.label, self.prediction).first()
            value = {"r2": row["r2"], "neg_root_mean_squared_error": row["rmse"] and -row["rmse"],
                     "neg_mean_absolute_error": row["mae"] and -row["mae"]}[self.scoring]
        return float("nan") if value is None else float(value)
