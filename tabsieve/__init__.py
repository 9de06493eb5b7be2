"""Exploratory analysis, data preparation and baseline modelling on Spark DataFrames."""

from .functions.quantiles import exact_quantiles
from .functions.text import normalize_text, plain_text
from .operators.alignment import attach_target
from .operators.baseline import BaselineClassifier, BaselineClassifierModel
from .operators.cleaner import DataCleaner, DataCleanerModel, clean_data
from .operators.cleaning import (add_type_column, convert_bool_to_uint8, log1p_column, lower_columns,
                                 normalize_all_text_columns, normalize_columns, replace_and_invalidate, to_numeric)
from .operators.columns import (class_share, drop_columns, drop_columns_if_present, drop_empty_columns,
                                drop_one_column, features_and_target, head, identify_column_types, numeric_columns,
                                select_existing, string_columns, where_known)
from .operators.correlation import (collinear_pairs, correlation_matrix, feature_collinearity, kendall_tau,
                                    lower_triangle, target_correlation_bars, target_correlations)
from .operators.distributions import histograms, scatter_points, target_counts, value_counts
from .operators.duplicates import count_duplicates, duplicate_count, duplicate_rows, require_unique_key
from .operators.features import (FeaturePreprocessor, FeaturePreprocessorModel, LabelEncoder, LabelEncoderModel,
                                 class_codes, encode_classes, preprocess_data)
from .operators.imputation import impute_categorical, impute_mode, impute_numeric
from .operators.metrics import (Scorer, accuracy, classification_report, confusion_matrix, confusion_table,
                                regression_metrics)
from .operators.perceptron import partial_sums, perceptron_predict
from .operators.profile import (boolean_columns, describe_numeric, diagnose, distinct_counts, empty_columns,
                                fill_rate, high_cardinality_columns, high_na_columns, info, missing_like_columns,
                                missing_percent, profile, shape, unique_value_columns)
from .operators.search import candidates, cross_val_scores, random_candidates, search
from .operators.splitting import assign_folds, split_sizes, train_test_split
from .plans.evaluate import eval_classification, evaluate_model
from .plans.study import study
from .sources.csv import key_columns, read_csv, write_csv
from .sources.encoding import detect_encodings
from .sources.export import export_split, export_train_test, read_exported
from .sources.generators import keyed_vectors, random_terms, random_vectors

