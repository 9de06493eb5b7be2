"""One query per operator; every one reads whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import (alignment, baseline, cleaner, cleaning, columns, correlation, distributions, duplicates,
                         features, imputation, metrics, perceptron, profile, splitting)
from ..plans import evaluate
from ..plans.study import study
from ..sources import csv, encoding, export, generators, scratch
from .tables import dirty_orders, rounded, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

KEYWORDS = {"URGENT|HIGH": "rush", "MEDIUM": "normal", "NOT": "unset", "LOW": "low", "": "other"}
CLEAN_CONFIG = {
    "drop_na_threshold": 0.40, "binary_cols": ["is_even"], "floor_col": "floor_txt", "floor_replace": {"bajo": 0},
    "numeric_median_cols": ["o_totalprice"], "rent_col": "o_totalprice", "rent_invalid_below": 50000,
}
LINE_NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
TIED_NUMBERS = ["l_quantity", "l_discount", "l_tax", "l_linenumber"]
WEIGHTS = [((i % 7) - 3) / 10 for i in range(64)]       # a rule both engines can follow
SEED = 42


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


# --- column diagnostics -----------------------------------------------------------------------

@query
def profile_flags(spark, sf):
    return rounded(profile.profile(dirty_orders(spark, sf), max_modalities=6), "fill_rate")


@query
def diagnose_part(spark, sf):
    return rounded(profile.profile(table(spark, sf, "part"), key_cols=["p_partkey"]), "fill_rate")


@query
def column_lists(spark, sf):
    df = dirty_orders(spark, sf)
    found = {
        "empty": profile.empty_columns(df), "unique_value": profile.unique_value_columns(df),
        "string": columns.string_columns(df), "boolean": profile.boolean_columns(df),
        "numeric": columns.numeric_columns(df), "high_na": profile.high_na_columns(df, 0.5),
        "high_cardinality": profile.high_cardinality_columns(df, 6),
        "missing_like": profile.missing_like_columns(df),
    }
    return spark.createDataFrame([(k, c) for k, v in found.items() for c in v], "list string, column string")


@query
def fill_rate(spark, sf):
    return rounded(profile.fill_rate(dirty_orders(spark, sf)), "fill_rate").drop("position")


@query
def missing_pct_top(spark, sf):
    return rounded(profile.missing_percent(dirty_orders(spark, sf), top_n=4), "missing_pct")


@query
def distinct_counts(spark, sf):
    df = dirty_orders(spark, sf)
    with_null = profile.distinct_counts(df, dropna=False).withColumnRenamed("n_distinct", "n_with_null")
    return profile.distinct_counts(df).join(with_null, "column")


@query
def describe_numeric(spark, sf):
    out = profile.describe_numeric(table(spark, sf, "events"), key_cols=["event_id"]).drop("position")
    return rounded(out, "mean", "std", "min", "q25", "q50", "q75", "max")


@query
def describe_with_gaps(spark, sf):
    out = profile.describe_numeric(dirty_orders(spark, sf), key_cols=["o_orderkey"]).drop("position")
    return rounded(out, "mean", "std", "min", "q25", "q50", "q75", "max")


@query
def column_info(spark, sf):
    return profile.info(dirty_orders(spark, sf))


@query
def class_share(spark, sf):
    return rounded(columns.class_share(dirty_orders(spark, sf), "o_orderstatus", "F"), "share")


# --- column selection, order ------------------------------------------------------------------

@query
def drop_empty_columns(spark, sf):
    return columns.drop_empty_columns(dirty_orders(spark, sf))


@query
def drop_columns(spark, sf):
    one, _ = columns.drop_one_column(dirty_orders(spark, sf), "const_col")
    return columns.drop_columns(one, ["empty_col", "sparse_col"])[0]


@query
def select_existing(spark, sf):
    return columns.select_existing(dirty_orders(spark, sf), ["is_even", "no_such_column", "o_orderkey"])


@query
def known_rows(spark, sf):
    kept = columns.where_known(dirty_orders(spark, sf), "o_totalprice")
    return kept.select("o_orderkey", "o_totalprice")


@query
def head_by_key(spark, sf):
    return columns.head(table(spark, sf, "orders"), 5, ["o_orderkey"])


# --- duplicates -------------------------------------------------------------------------------

def _copies(spark, sf, keep):
    docs = table(spark, sf, "documents")
    return duplicates.duplicate_rows(docs, ["text"], keep, key_cols=["doc_id"]).select("doc_id", "lang", "n_chars")


@query
def duplicate_rows_first(spark, sf):
    return _copies(spark, sf, "first")


@query
def duplicate_rows_last(spark, sf):
    return _copies(spark, sf, "last")


@query
def duplicate_rows_none(spark, sf):
    return _copies(spark, sf, False)


@query
def duplicate_rows_ordered(spark, sf):
    lines = table(spark, sf, "lineitem")
    return duplicates.duplicate_rows(lines, ["l_orderkey", "l_linenumber"], "first", order_by=["l_shipdate"])


@query
def duplicate_rows_identical(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_returnflag", "l_linestatus", "l_linenumber", "l_discount")
    return duplicates.duplicate_rows(lines)


@query
def count_duplicates(spark, sf):
    return duplicates.duplicate_count(table(spark, sf, "documents"), ["text"])


@query
def count_duplicates_lines(spark, sf):
    return duplicates.duplicate_count(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query
def key_duplicates(spark, sf):
    return duplicates.duplicate_count(table(spark, sf, "conversations"), ["conv_id", "turn"])


# --- cleaning ---------------------------------------------------------------------------------

@query
def bool_to_uint8_keep(spark, sf):
    return cleaning.convert_bool_to_uint8(dirty_orders(spark, sf), ["is_even"]).select("o_orderkey", "is_even")


@query
def bool_to_uint8_zero(spark, sf):
    bits = cleaning.convert_bool_to_uint8(dirty_orders(spark, sf), ["is_even"], keep_na=False)
    return bits.select("o_orderkey", "is_even")


@query
def lower_text(spark, sf):
    return cleaning.lower_columns(table(spark, sf, "documents"), ["text", "n_chars", "no_such_column"])


@query
def keyword_type(spark, sf):
    return cleaning.add_type_column(table(spark, sf, "orders"), "o_orderpriority", KEYWORDS).select("o_orderkey", "type")


@query
def normalize_text(spark, sf):
    return cleaning.normalize_columns(table(spark, sf, "documents"), ["text"]).select("doc_id", "text")


@query
def normalize_all_text(spark, sf):
    return cleaning.normalize_all_text_columns(table(spark, sf, "conversations"))


@query
def to_numeric(spark, sf):
    return cleaning.to_numeric(dirty_orders(spark, sf), ["floor_txt"]).select("o_orderkey", "floor_txt")


@query
def replace_invalid(spark, sf):
    out = cleaning.replace_and_invalidate(dirty_orders(spark, sf), "floor_txt", {"bajo": 0}, invalid_below=2)
    return out.select("o_orderkey", "floor_txt")


@query
def log1p_price(spark, sf):
    out = cleaning.log1p_column(table(spark, sf, "customer"), "c_acctbal").select("c_custkey", "c_acctbal")
    return rounded(out, "c_acctbal")


# --- imputation -------------------------------------------------------------------------------

def _filled(spark, sf, strategy):
    out = imputation.impute_numeric(dirty_orders(spark, sf), ["o_totalprice", "sparse_col"], strategy)
    return rounded(out.select("o_orderkey", "o_totalprice", "sparse_col"), "o_totalprice", "sparse_col", digits=4)


@query
def impute_median(spark, sf):
    return _filled(spark, sf, "median")


@query
def impute_mean(spark, sf):
    return _filled(spark, sf, "mean")


@query
def impute_zero(spark, sf):
    return _filled(spark, sf, "zero")


@query
def impute_categorical(spark, sf):
    out = imputation.impute_categorical(dirty_orders(spark, sf), ["o_orderstatus"])
    return out.select("o_orderkey", "o_orderstatus")


@query
def impute_mode(spark, sf):
    out = imputation.impute_mode(dirty_orders(spark, sf), ["is_even", "o_orderstatus", "floor_txt"])
    return out.select("o_orderkey", "is_even", "o_orderstatus", "floor_txt")


# --- correlations -----------------------------------------------------------------------------

#: 32 columns of other scales and gaps.
WIDE_COLUMNS = {f"{c}_{m}": f"CASE WHEN (l_orderkey + l_linenumber) % {m} <> 1 THEN {c} * {m} + l_linenumber * 1e{m - 4} END"
                for c in LINE_NUMBERS for m in range(2, 10)}


def _with_double(spark, sf):
    return table(spark, sf, "lineitem").select(*LINE_NUMBERS, (F.col("l_quantity") * 2 + F.col("l_tax")).alias("mixed"))


@query
def corr_matrix(spark, sf):
    return rounded(correlation.correlation_matrix(table(spark, sf, "lineitem"), LINE_NUMBERS), "corr")


@query
def corr_matrix_with_gaps(spark, sf):
    df = dirty_orders(spark, sf)
    matrix = correlation.correlation_matrix(df, ["o_totalprice", "sparse_col", "o_custkey", "empty_col"])
    return rounded(matrix, "corr")


@query
def corr_matrix_wide(spark, sf):
    """Enough columns, each with gaps of its own, to multiply them in blocks."""
    wide = [F.expr(e).alias(c) for c, e in WIDE_COLUMNS.items()]
    return _lower(table(spark, sf, "lineitem").select(*wide), list(WIDE_COLUMNS), "pearson")


@query
def corr_matrix_lower(spark, sf):
    return rounded(correlation.lower_triangle(table(spark, sf, "lineitem"), LINE_NUMBERS), "corr")


@query
def collinear_pairs(spark, sf):
    return rounded(correlation.collinear_pairs(_with_double(spark, sf), 0.8), "abs_corr")


def _returned(spark, sf):
    lines = table(spark, sf, "lineitem")
    return lines.select(*LINE_NUMBERS, (F.col("l_returnflag") == "R").cast("int").alias("returned"))


@query
def target_corr_top(spark, sf):
    return rounded(correlation.target_correlations(_returned(spark, sf), "returned", 3), "abs_corr")


@query
def features_part(spark, sf):
    return columns.features_and_target(table(spark, sf, "orders"), "o_totalprice")[0]


@query
def target_part(spark, sf):
    return columns.features_and_target(table(spark, sf, "orders"), "o_totalprice")[1]


@query
def target_corr_bars(spark, sf):
    return rounded(correlation.target_correlation_bars(_returned(spark, sf), "returned"), "abs_corr")


def _lower(df, cols, method):
    return rounded(correlation.lower_triangle(df, cols, method).select("row", "col", "corr"), "corr")


@query
def spearman(spark, sf):
    return _lower(table(spark, sf, "lineitem"), LINE_NUMBERS, "spearman")


@query
def spearman_with_gaps(spark, sf):
    return _lower(dirty_orders(spark, sf), ["o_totalprice", "sparse_col"], "spearman")


@query
def kendall(spark, sf):
    return _lower(table(spark, sf, "lineitem"), TIED_NUMBERS, "kendall")


@query
def kendall_wide(spark, sf):
    """Columns of almost as many values as rows, one with gaps and one with few values."""
    events = table(spark, sf, "events")
    seconds = F.col("ts").cast("timestamp").cast("double")
    wide = events.select("value", seconds.alias("seconds"), F.when(F.col("event_id") % 3 != 0, F.col("value") + F.col("user_id")).alias("gaps"), "user_id")
    return _lower(wide, ["value", "seconds", "gaps", "user_id"], "kendall")


# --- distributions ----------------------------------------------------------------------------

@query
def histogram_40(spark, sf):
    out = distributions.histograms(table(spark, sf, "events"), 40, ["value"])
    return rounded(out, "bin_start", "bin_end")


@query
def histogram_all_columns(spark, sf):
    return distributions.histograms(table(spark, sf, "lineitem"), 40, LINE_NUMBERS).select("column", "bin", "n")


@query
def histogram_with_gaps(spark, sf):
    columns_with_gaps = ["o_totalprice", "sparse_col", "empty_col"]
    return distributions.histograms(dirty_orders(spark, sf), 40, columns_with_gaps).select("column", "bin", "n")


@query
def value_counts_top(spark, sf):
    return distributions.value_counts(table(spark, sf, "documents"), 5, ["lang", "source"])


@query
def value_counts_with_gaps(spark, sf):
    return distributions.value_counts(dirty_orders(spark, sf), 4)


@query
def value_counts_all(spark, sf):
    return distributions.value_counts(table(spark, sf, "customer"), None, ["c_name", "c_mktsegment"])


@query
def target_counts(spark, sf):
    return distributions.target_counts(dirty_orders(spark, sf), "o_orderstatus")


@query
def scatter_log1p(spark, sf):
    out = distributions.scatter_points(dirty_orders(spark, sf), "o_custkey", ["o_totalprice", "sparse_col"],
                                       "log1p", key_cols=["o_orderkey"])
    return rounded(out, "y")


# --- learned cleaning -------------------------------------------------------------------------

def _dirty_split(spark, sf):
    return splitting.train_test_split(dirty_orders(spark, sf), ["o_orderkey"], "o_orderpriority", seed=SEED)


@query
def clean_fit_apply(spark, sf):
    df = _dirty_split(spark, sf)
    train = df.where("split = 'train'")
    model = cleaner.DataCleaner(CLEAN_CONFIG).fit(train)
    return model.transform(df).select("o_orderkey", "split", "is_even", "floor_txt", "o_totalprice")


# --- split, folds, features, labels -----------------------------------------------------------

@query
def stratified_split_ids(spark, sf):
    out = splitting.train_test_split(table(spark, sf, "orders"), ["o_orderkey"], "o_orderstatus", seed=SEED)
    return out.select("o_orderkey", "split")


@query
def stratified_split_counts(spark, sf):
    out = splitting.train_test_split(table(spark, sf, "orders"), ["o_orderkey"], "o_orderstatus", seed=SEED)
    return out.groupBy("o_orderstatus", "split").agg(F.count(F.lit(1)).alias("n"))


@query
def split_sizes(spark, sf):
    return splitting.split_sizes(splitting.train_test_split(table(spark, sf, "orders"), ["o_orderkey"], seed=SEED))


@query
def stratified_folds(spark, sf):
    out = splitting.assign_folds(table(spark, sf, "orders"), ["o_orderkey"], 5, "o_orderstatus", SEED)
    return out.select("o_orderkey", "fold")


@query
def robust_scale(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", *LINE_NUMBERS)
    out = features.preprocess_data(lines, LINE_NUMBERS, [], key_cols=["l_orderkey", "l_linenumber"])[0]
    return rounded(out, *[f"num__{c}" for c in LINE_NUMBERS])


@query
def one_hot_drop_first(spark, sf):
    orders = table(spark, sf, "orders")
    return features.preprocess_data(orders, [], ["o_orderstatus", "o_orderpriority"], key_cols=["o_orderkey"])[0]


@query
def preprocess_train_test(spark, sf):
    df = _dirty_split(spark, sf).select("o_orderkey", "split", "o_totalprice", "o_orderstatus", "is_even")
    model = features.FeaturePreprocessor(["o_totalprice"], ["o_orderstatus", "is_even"]).fit(df.where("split = 'train'"))
    return rounded(model.expand(df, keep=["o_orderkey", "split"]), "num__o_totalprice")


@query
def feature_vectors(spark, sf):
    """The vector form of the above, summed per slot."""
    df = dirty_orders(spark, sf).select("o_orderkey", "sparse_col", "o_orderstatus", "is_even")
    model = features.FeaturePreprocessor(["sparse_col"], ["o_orderstatus", "is_even"]).fit(df)
    values = model.transform(df).select(F.posexplode(vector_to_array("features")).alias("slot", "v"))
    sums = values.where(~F.isnan("v")).groupBy("slot").agg(F.sum("v").alias("total"))
    return rounded(sums, "total", digits=3)


@query
def label_encode(spark, sf):
    orders = table(spark, sf, "orders")
    return features.LabelEncoder("o_orderstatus", "code").fit(orders).transform(orders).select("o_orderkey", "code")


@query
def class_codes_text(spark, sf):
    """Codes of as many classes as there are customers; no list of them leaves the executors."""
    customers = table(spark, sf, "customer").select("c_custkey", "c_name")
    codes = features.class_codes(customers, "c_name")
    return features.encode_classes(customers, "c_name", codes, "code").select("c_custkey", "code")


@query
def class_codes_numeric(spark, sf):
    """Numbers as classes: codes follow their size."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    codes = features.class_codes(orders, "o_custkey")
    return features.encode_classes(orders, "o_custkey", codes, "code").select("o_orderkey", "code")


@query
def label_encode_int8(spark, sf):
    """Codes in the narrowest integer type."""
    orders = table(spark, sf, "orders")
    encoder = features.LabelEncoder("o_orderpriority", "code", dtype="tinyint")
    return encoder.fit(orders).transform(orders).select("o_orderkey", "code")


@query
def attach_target(spark, sf):
    orders = table(spark, sf, "orders")
    x, y = orders.select("o_orderkey", "o_orderpriority"), orders.select("o_orderkey", "o_totalprice")
    return alignment.attach_target(x, y, ["o_orderkey"])


# --- scores, baseline, search -----------------------------------------------------------------

@query
def accuracy(spark, sf):
    return rounded(metrics.accuracy(table(spark, sf, "labels"), "quality", "toxic"), "accuracy")


@query
def confusion(spark, sf):
    return metrics.confusion_matrix(table(spark, sf, "labels"), "quality", "toxic", [0, 1])


@query
def class_report(spark, sf):
    out = metrics.classification_report(table(spark, sf, "labels"), "quality", "toxic", [0, 1])
    return rounded(out, "precision", "recall", "f1_score")


@query
def confusion_pivot(spark, sf):
    out = metrics.confusion_table(table(spark, sf, "labels"), "quality", "toxic", [0, 1])
    return out.withColumnsRenamed({"0": "predicted_0", "1": "predicted_1"})


def _doubtful(spark, sf):
    """Predictions that are missing, or no class at all."""
    guess = F.when(F.col("doc_id") % 5 == 0, None).when(F.col("doc_id") % 7 == 0, F.col("toxic") + 0.9).otherwise(F.col("toxic"))
    return table(spark, sf, "labels").select("doc_id", "quality", guess.cast("double").alias("guess"))


@query
def confusion_with_gaps(spark, sf):
    return metrics.confusion_matrix(_doubtful(spark, sf), "quality", "guess")


@query
def class_report_with_gaps(spark, sf):
    out = metrics.classification_report(_doubtful(spark, sf), "quality", "guess", [0, 1])
    return rounded(out, "precision", "recall", "f1_score")


@query
def scores_by_name(spark, sf):
    labels = table(spark, sf, "labels")
    lines = table(spark, sf, "lineitem").select("l_extendedprice", (F.col("l_quantity") * 1500).alias("guess"))
    scores = [(name, metrics.Scorer(name, "quality", "toxic").evaluate(labels)) for name in metrics.CLASSIFICATION_SCORING]
    scores += [(name, metrics.Scorer(name, "l_extendedprice", "guess").evaluate(lines)) for name in metrics.REGRESSION_SCORING]
    return rounded(spark.createDataFrame(scores, "scoring string, score double"), "score", digits=4)


@query
def regression_metrics(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_extendedprice", (F.col("l_quantity") * 1500).alias("guess"))
    return rounded(metrics.regression_metrics(lines, "l_extendedprice", "guess"), "r2", "rmse", "mae")


def _baseline(spark, sf, strategy):
    df = table(spark, sf, "labels")
    model = baseline.BaselineClassifier(strategy, labelCol="quality", keyCols=["doc_id"], seed=SEED).fit(df)
    return model.transform(df).select("doc_id", F.col("prediction").cast("int").alias("prediction"))


@query
def baseline_most_frequent(spark, sf):
    return _baseline(spark, sf, "most_frequent")


@query
def baseline_prior(spark, sf):
    return _baseline(spark, sf, "prior")


@query
def baseline_stratified(spark, sf):
    return _baseline(spark, sf, "stratified")


@query
def baseline_uniform(spark, sf):
    return _baseline(spark, sf, "uniform")


def _label_sides(spark, sf):
    split = splitting.train_test_split(table(spark, sf, "labels"), ["doc_id"], "quality", seed=SEED)
    return [split.where(f"split = '{side}'").drop("split") for side in ("train", "test")]


@query
def baseline_search(spark, sf):
    train, test = _label_sides(spark, sf)
    found = evaluate.eval_classification(
        baseline.BaselineClassifier(seed=SEED), {"strategy": ["most_frequent", "prior", "stratified", "uniform"]},
        train, test, "quality", ["doc_id"], seed=SEED)
    out = found.cv_results.select(F.col("params")["strategy"].alias("strategy"), "mean_score", "std_score", "rank")
    return rounded(out, "mean_score", "std_score")


@query
def baseline_report(spark, sf):
    train, test = _label_sides(spark, sf)
    found = evaluate.eval_classification(baseline.BaselineClassifier("most_frequent"), None, train, test,
                                         "quality", ["doc_id"], seed=SEED)
    return rounded(found.classification_report, "precision", "recall", "f1_score")


RANDOM_GRID = {"strategy": ["stratified", "uniform"], "seed": list(range(8))}


@query
def random_search(spark, sf):
    train, test = _label_sides(spark, sf)
    found = evaluate.eval_classification(baseline.BaselineClassifier(), RANDOM_GRID, train, test, "quality", ["doc_id"],
                                         search_type="random", n_iter=4, cv=3, seed=SEED)
    params = F.col("params")
    out = found.cv_results.select("candidate", params["strategy"].alias("strategy"),
                                  params["seed"].cast("int").alias("seed"), "mean_score", "rank")
    return rounded(out, "mean_score")


@query
def regression_search(spark, sf):
    lines = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    vectors = VectorAssembler(inputCols=["o_custkey"], outputCol="features").transform(lines)
    split = splitting.train_test_split(vectors, ["o_orderkey"], seed=SEED)
    train, test = (split.where(f"split = '{s}'") for s in ("train", "test"))
    found = evaluate.evaluate_model(LinearRegression(), {"fitIntercept": [True, False]}, train, test, "o_totalprice",
                                    ["o_orderkey"], cv=3, seed=SEED)
    scores = spark.createDataFrame([(found.r2, found.rmse, found.mae)], "r2 double, rmse double, mae double")
    return rounded(rounded(scores, "r2"), "rmse", "mae", digits=4)


def _plain_regression(spark, sf, scoring):
    """Scores of each fold, without a grid."""
    lines = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    vectors = VectorAssembler(inputCols=["o_custkey"], outputCol="features").transform(lines)
    split = splitting.train_test_split(vectors, ["o_orderkey"], seed=SEED)
    train, test = (split.where(f"split = '{s}'") for s in ("train", "test"))
    found = evaluate.evaluate_model(LinearRegression(), None, train, test, "o_totalprice", ["o_orderkey"],
                                    scoring=scoring, cv=3, seed=SEED)
    out = found.cv_results.select(F.posexplode("split_scores").alias("fold", "score"))
    return rounded(out, "score", digits=4)


@query
def regression_folds_rmse(spark, sf):
    return _plain_regression(spark, sf, "neg_root_mean_squared_error")


@query
def regression_folds_mae(spark, sf):
    return _plain_regression(spark, sf, "neg_mean_absolute_error")


@query
def first_study(spark, sf):
    found = study(table(spark, sf, "orders"), "o_orderstatus", ["o_orderkey"], cv=3, seed=SEED)
    return rounded(found.target_correlations.withColumn("n_duplicates", F.lit(found.n_duplicates)), "abs_corr")


# --- perceptron -------------------------------------------------------------------------------

@query
def perceptron_score(spark, sf):
    out = perceptron.perceptron_predict(table(spark, sf, "embeddings"), "embedding", WEIGHTS, threshold=0.05, bias=0.01)
    return rounded(out.select("vec_id", "weighted_sum", "output"), "weighted_sum")


@query
def perceptron_columns(spark, sf):
    out = perceptron.perceptron_predict(table(spark, sf, "lineitem"), LINE_NUMBERS, [0.4, -0.0003, 2.0, 1.0], threshold=-5.0)
    return rounded(out.select("l_orderkey", "l_linenumber", "weighted_sum", "output"), "weighted_sum")


@query
def perceptron_partial_sums(spark, sf):
    out = perceptron.partial_sums(table(spark, sf, "embeddings"), "embedding", WEIGHTS, ["vec_id"])
    return rounded(out, "x", "product", "running_sum")


@query
def random_terms(spark, sf):
    return rounded(generators.random_terms(table(spark, sf, "customer"), ["c_custkey"], 4, SEED), "w", digits=9)


@query
def random_vectors(spark, sf):
    """Vectors drawn by the keys of a table, scored by their own weights."""
    drawn = generators.keyed_vectors(table(spark, sf, "customer"), ["c_custkey"], 4, SEED)
    total = F.aggregate(F.zip_with("x", "w", lambda x, w: x * w), F.lit(0.0), lambda a, b: a + b)
    return rounded(drawn.select("c_custkey", total.alias("total")), "total")


# --- files ------------------------------------------------------------------------------------

@query
def csv_roundtrip(spark, sf):
    """All types inferred; a time stays text."""
    path = scratch.scratch_dir(spark, "csv")
    csv.write_csv(dirty_orders(spark, sf), path)
    return csv.read_csv(spark, path)


@query
def csv_with_schema(spark, sf):
    df, path = dirty_orders(spark, sf), scratch.scratch_dir(spark, "csv")
    csv.write_csv(df, path)
    return csv.read_csv(spark, path, schema=df.schema)


@query
def csv_documents(spark, sf):
    """Texts with line breaks and quotes, there and back."""
    df, path = table(spark, sf, "documents"), scratch.scratch_dir(spark, "csv")
    csv.write_csv(df, path)
    return csv.read_csv(spark, path, schema=df.schema, multi_line=True)


@query
def csv_latin1(spark, sf):
    df, path = table(spark, sf, "customer"), scratch.scratch_dir(spark, "csv")
    accented = df.withColumn("c_name", F.concat(F.lit("É"), "c_name", F.lit("ñ")))
    csv.write_csv(accented, path, encoding="ISO-8859-1")
    return csv.read_csv(spark, path, schema=df.schema, encoding="ISO-8859-1")


@query
def csv_key_by_position(spark, sf):
    """A file whose second column has no name, its key given by position."""
    path = scratch.scratch_dir(spark, "csv")
    csv.write_csv(table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_custkey").toDF("o_orderkey", "", "o_custkey"), path)
    df = csv.read_csv(spark, path)
    return df.select(*csv.key_columns(df, [0, "o_custkey"]), F.col("`Unnamed: 1`").alias("unnamed"))


@query
def page_encodings(spark, sf):
    pages = table(spark, sf, "pages")
    return pages.select("page_id", encoding.encoding_of(F.encode("html", "UTF-8")).alias("encoding"))


@query
def file_encodings(spark, sf):
    """Files in folders whose path has blanks and accents."""
    path = f"{scratch.scratch_dir(spark, 'text')}/dos años, café"
    table(spark, sf, "documents").select("lang", "text").write.partitionBy("lang").text(path)
    found = encoding.detect_encodings(spark, f"{path}/*/*.txt")
    lang = F.regexp_extract("path", "lang=([^/]*)", 1)
    return found.groupBy(lang.alias("lang"), "encoding").agg(F.sum("n_bytes").alias("n_bytes"))


@query
def export_sides(spark, sf):
    split = splitting.train_test_split(table(spark, sf, "orders"), ["o_orderkey"], "o_orderstatus", seed=SEED)
    train, test = (split.where(f"split = '{s}'").drop("split") for s in ("train", "test"))
    path = scratch.scratch_dir(spark, "export")
    export.export_train_test(train, test, "o_totalprice", ["o_orderkey"], path, "log_price", "log1p", ["o_orderdate"])
    sides = export.read_exported(spark, path)
    out = sides["X_test"].join(sides["y_test"], "o_orderkey").withColumn("side", F.lit("test")).unionByName(
        sides["X_train"].join(sides["y_train"], "o_orderkey").withColumn("side", F.lit("train")))
    return rounded(out, "log_price")


@query
def export_split(spark, sf):
    split = splitting.train_test_split(table(spark, sf, "orders"), ["o_orderkey"], "o_orderstatus", seed=SEED)
    path = export.export_split(split, scratch.scratch_dir(spark, "export"), drop_cols=["o_orderdate"])
    return spark.read.parquet(path)
