import math

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from tabsieve.operators import features as X, metrics as M, search as Q, splitting as S
from tabsieve.operators.baseline import BaselineClassifier, BaselineClassifierModel
from tabsieve.plans import evaluate as E
from tabsieve.plans.study import study


@pytest.fixture(scope="module")
def points(spark):
    df = spark.range(300).select("id", (F.col("id") % 10).cast("double").alias("x"),
                                 F.when(F.col("id") % 10 < 3, "M").otherwise("B").alias("kind"),
                                 (F.col("id") % 10 * 2.0 + F.col("id") % 3).alias("y"))
    split = S.train_test_split(VectorAssembler(inputCols=["x"], outputCol="features").transform(df), ["id"], "kind")
    return split.where("split = 'train'").drop("split"), split.where("split = 'test'").drop("split")


def scored(spark, pairs):
    return spark.createDataFrame([(float(a), float(b)) for a, b in pairs], "y double, p double")


def test_confusion_and_report(spark):
    df = scored(spark, [(0, 0), (0, 0), (0, 1), (1, 1), (2, 0)])
    cells = {(r["actual"], r["predicted"]): r["n"] for r in M.confusion_matrix(df, "y", "p", [0, 1, 2, 3]).collect()}
    assert len(cells) == 16 and cells[(0.0, 0.0)] == 2 and cells[(3.0, 3.0)] == 0 and cells[(2.0, 0.0)] == 1
    table = M.confusion_table(df, "y", "p", [0.0, 1.0, 2.0]).collect()
    assert [tuple(r) for r in table] == [(0.0, 2, 1, 0, 0), (1.0, 0, 1, 0, 0), (2.0, 1, 0, 0, 0)]
    rows = {r["label"]: r for r in M.classification_report(df, "y", "p", [0, 1, 2], ["a", "b", "c"]).collect()}
    assert rows["a"]["precision"] == pytest.approx(2 / 3) and rows["a"]["recall"] == pytest.approx(2 / 3)
    assert rows["b"]["f1_score"] == pytest.approx(2 / 3) and rows["c"]["f1_score"] == 0.0 and rows["c"]["support"] == 1
    assert rows["accuracy"]["f1_score"] == pytest.approx(0.6) and rows["accuracy"]["precision"] is None
    assert rows["macro avg"]["f1_score"] == pytest.approx(4 / 9)
    assert rows["weighted avg"]["recall"] == pytest.approx(0.6)
    assert M.accuracy(df, "y", "p").first()[0] == pytest.approx(0.6)
    assert M.observed_classes(df, "y", "p") == [0.0, 1.0, 2.0]


def test_regression_metrics(spark):
    rng = np.random.default_rng(1)
    y, p = rng.normal(size=50), rng.normal(size=50)
    row = M.regression_metrics(scored(spark, zip(y, p)), "y", "p").first()
    assert row["r2"] == pytest.approx(1 - ((y - p) ** 2).sum() / ((y - y.mean()) ** 2).sum())
    assert row["rmse"] == pytest.approx(math.sqrt(((y - p) ** 2).mean())) and row["mae"] == pytest.approx(abs(y - p).mean())
    assert M.regression_metrics(scored(spark, [(1, 1), (1, 2)]), "y", "p").first()["r2"] == 0.0
    assert M.regression_metrics(scored(spark, [(1, 1), (1, 1)]), "y", "p").first()["r2"] == 1.0


@pytest.mark.parametrize("scoring,want", [("accuracy", 0.6), ("f1_macro", 4 / 9), ("f1_weighted", (3 * 2 / 3 + 2 / 3) / 5)])
def test_scorer(spark, scoring, want):
    df = scored(spark, [(0, 0), (0, 0), (0, 1), (1, 1), (2, 0)])
    assert M.Scorer(scoring, "y", "p").evaluate(df) == pytest.approx(want)


def test_macro_counts_classes_only_predicted(spark):
    # class 1 is predicted but never true: it scores 0 and counts; class 2 does not occur at all
    df = scored(spark, [(0, 0), (0, 0), (0, 1)])
    assert M.Scorer("f1_macro", "y", "p").evaluate(df) == pytest.approx(0.4)


def test_scorer_errors(spark):
    perfect = scored(spark, [(1, 1), (2, 2)])
    assert M.Scorer("neg_root_mean_squared_error", "y", "p").evaluate(perfect) == 0.0
    assert M.Scorer("neg_mean_absolute_error", "y", "p").evaluate(scored(spark, [(1, 2), (2, 2)])) == -0.5
    with pytest.raises(ValueError):
        M.Scorer("auc")


def test_baseline(spark, tmp_path):
    df = spark.range(4000).select("id", F.when(F.col("id") % 4 == 0, 0).otherwise(1).cast("int").alias("label"))
    share = lambda frame: {r["prediction"]: r["count"] / 4000 for r in frame.groupBy("prediction").count().collect()}
    assert share(BaselineClassifier("most_frequent").fit(df).transform(df)) == {1.0: 1.0}
    assert share(BaselineClassifier().fit(df).transform(df)) == {1.0: 1.0}
    drawn = BaselineClassifier("stratified", keyCols=["id"]).fit(df)
    assert share(drawn.transform(df))[0.0] == pytest.approx(0.25, abs=0.03)
    assert drawn.priors == {0.0: 0.25, 1.0: 0.75}
    uniform = BaselineClassifier("uniform", keyCols=["id"]).fit(df)
    assert share(uniform.transform(df))[0.0] == pytest.approx(0.5, abs=0.03)
    key = lambda frame: sorted((r["id"], r["prediction"]) for r in frame.collect())
    assert key(uniform.transform(df)) == key(uniform.transform(df.repartition(7)))
    tie = df.where("id < 2").withColumn("label", F.col("id").cast("int"))
    assert share(BaselineClassifier("most_frequent").fit(tie).transform(df)) == {0.0: 1.0}
    drawn.save(str(tmp_path / "m"))
    assert key(BaselineClassifierModel.load(str(tmp_path / "m")).transform(df)) == key(drawn.transform(df))
    with pytest.raises(ValueError):
        BaselineClassifier("uniform").fit(df)
    with pytest.raises(ValueError):
        BaselineClassifier("best").fit(df)


def test_candidates():
    lr = LogisticRegression()
    grid = {"regParam": [0.0, 0.1], "maxIter": [5, 6, 7]}
    maps = Q.candidates(lr, grid)
    assert [(m[lr.regParam], m[lr.maxIter]) for m in maps] == [(0.0, 5), (0.0, 6), (0.0, 7), (0.1, 5), (0.1, 6), (0.1, 7)]
    assert len(Q.candidates(lr, [grid, {"maxIter": [1]}])) == 7
    some = Q.random_candidates(lr, grid, 4, seed=3)
    assert some == Q.random_candidates(lr, grid, 4, seed=3) and len(some) == 4 and all(m in maps for m in some)
    assert Q.random_candidates(lr, grid, 99) == maps


def test_eval_classification(points):
    train, test = points
    found = E.eval_classification(BaselineClassifier(), {"strategy": ["uniform", "most_frequent", "prior"]}, train, test,
                                  "kind", ["id"], cv=3)
    assert found.classes == ["B", "M"] and found.best_params == {"strategy": "most_frequent"}      # first of equals
    assert found.accuracy == pytest.approx(0.7)
    cv = {r["candidate"]: r for r in found.cv_results.collect()}
    assert cv[1]["rank"] == 1 == cv[2]["rank"] and cv[0]["rank"] == 3 and len(cv[0]["split_scores"]) == 3
    report = {r["label"]: r for r in found.classification_report.collect()}
    assert report["M"]["recall"] == 0.0 and report["B"]["recall"] == 1.0 and report["M"]["support"] == 18


def test_eval_without_grid_and_with_a_real_model(points):
    train, test = points
    plain = E.eval_classification(LogisticRegression(), None, train, test, "kind", ["id"], cv=2, scoring="f1_macro")
    assert plain.accuracy == 1.0 and plain.cv_results.count() == 1 and plain.best_params["maxIter"] == 100
    with pytest.raises(ValueError, match="grid"):
        E.eval_classification(LogisticRegression(), {"maxIter": [1]}, train, test, "kind", ["id"], search_type="bayes")
    with pytest.raises(Exception):
        E.eval_classification(BaselineClassifier(), None, train, test.withColumn("kind", F.lit("new")), "kind", ["id"], cv=2)


def test_evaluate_model(points):
    train, test = points
    found = E.evaluate_model(LinearRegression(), {"regParam": [100.0, 0.0]}, train, test, "y", ["id"], cv=3)
    assert found.best_params == {"regParam": 0.0} and found.r2 > 0.95
    alone = E.evaluate_model(LinearRegression(), None, train, test, "y", ["id"], cv=3)
    assert alone.r2 == pytest.approx(found.r2) and alone.rmse == pytest.approx(found.rmse)
    random = E.evaluate_model(LinearRegression(), {"regParam": [0.0, 1.0, 10.0]}, train, test, "y", ["id"],
                              search_type="random", n_iter=2, cv=2, scoring="neg_mean_absolute_error")
    assert random.cv_results.count() == 2


def test_study(points):
    train, test = points
    df = train.unionByName(test).drop("features").withColumn("nothing", F.lit(None).cast("double"))
    found = study(df, "kind", ["id"], cv=2)
    assert found.dropped == ["nothing"] and found.n_duplicates == 270 and found.encoder.classes == ["B", "M"]
    assert {r["split"]: r["n_rows"] for r in found.split_sizes.collect()} == {"train": 240, "test": 60}
    assert [r["feature1"] for r in found.collinear.collect()] == ["y"]
    assert found.target_correlations.first()["feature"] == "x" or found.target_correlations.count() == 2
    assert found.features.transform(found.test).count() == 60


def test_nothing_drops_out_of_the_scores(spark):
    df = spark.createDataFrame([(0, 0.9), (1, 1.7), (0, 0.0), (1, None), (2, 2.0)], "y int, p double")
    cells = {(r["actual"], r["predicted"]): r["n"] for r in M.confusion_matrix(df, "y", "p").collect()}
    assert cells == {(0.0, 0.9): 1, (1.0, 1.7): 1, (0.0, 0.0): 1, (1.0, None): 1, (2.0, 2.0): 1}
    assert sum(r["n"] for r in M.confusion_matrix(df, "y", "p", [0, 1]).collect()) == 5
    assert M.confusion_table(df, "y", "p", [0, 1]).where("actual = 1").first()["other"] == 2
    report = {r["label"]: r for r in M.classification_report(df, "y", "p", [0, 1]).collect()}
    assert report["accuracy"]["f1_score"] == M.accuracy(df, "y", "p").first()[0] == 0.4 and report["accuracy"]["support"] == 5
    assert report["1"]["support"] == 2 and report["1"]["recall"] == 0.0


def test_many_classes(spark):
    """No step has a limit on the number of classes."""
    n = 20_000
    df = spark.range(2 * n).select("id", F.concat(F.lit("c"), F.col("id") % n).alias("kind"))
    split = S.train_test_split(df, ["id"], "kind", 0.5)
    assert {tuple(r) for r in split.groupBy("split").count().collect()} == {("train", n), ("test", n)}
    coded = X.LabelEncoder("kind", "y").fit(df).transform(df)
    assert coded.agg(F.max("y")).first()[0] == n - 1
    model = BaselineClassifier("uniform", labelCol="y", keyCols=["id"]).fit(coded)
    scored = model.transform(coded)
    assert scored.agg(F.count_distinct("prediction")).first()[0] > n // 2
    assert M.classification_report(scored, "y", "prediction").count() == n + 3
    with pytest.raises(ValueError, match="fit"):
        X.LabelEncoder("kind", "y", dtype="tinyint").fit(df)


def test_all_folds_are_fitted_at_once(spark):
    df = spark.range(60).select("id", (F.col("id") % 4 == 0).cast("int").alias("label"), (F.col("id") % 3).cast("int").alias("fold"))
    estimator = BaselineClassifier("stratified", keyCols=["id"])
    for fold, model in enumerate(estimator.fit_folds(df, "fold", 3)):
        assert model.priors == estimator.fit(df.where(f"fold <> {fold}")).priors


def test_search_with_rare_classes(spark):
    df = spark.range(300).select("id", F.concat(F.lit("c"), F.col("id") % 100).alias("kind"))
    folds = S.assign_folds(df, ["id"], 5, "kind").groupBy("fold").count().collect()
    assert [r["count"] for r in folds] == [60] * 5
    found = E.eval_classification(BaselineClassifier(), None, df, df, "kind", ["id"])
    assert found.cv_results.first()["rank"] == 1


def test_study_finds_its_split_once(spark, monkeypatch):
    import tabsieve.plans.study as plan
    seen, found = [], plan.collinear_pairs

    def recorded(df, *args, **named):
        seen.append(df._jdf.queryExecution().executedPlan().toString())
        return found(df, *args, **named)

    monkeypatch.setattr(plan, "collinear_pairs", recorded)
    df = spark.createDataFrame([(i, float(i), float(i * i % 7), "ab"[i % 2]) for i in range(40)], "k long, x double, y double, c string")
    out = plan.study(df, "c", ["k"], cv=2)
    assert "InMemoryTableScan" in seen[0] and not out.train.is_cached
    assert (out.train.count(), out.test.count()) == (32, 8)
