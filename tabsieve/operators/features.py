"""Learned feature preparation: robust scaling, one-hot columns, class codes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import Estimator, Model
from pyspark.ml.feature import OneHotEncoder, StringIndexerModel, VectorAssembler
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.bounded import collect_at_most
from ..functions.nulls import is_nested, is_numeric, known, known_double, ref, require_columns, type_of
from ..functions.ordering import running_totals
from ..functions.persistence import JsonState
from ..functions.quantiles import exact_quantiles
from .columns import identify_column_types
from .profile import long_values


#: Integer types of class codes, and how many classes each holds.
CODE_TYPES = {"tinyint": 1 << 7, "smallint": 1 << 15, "int": 1 << 31, "bigint": 1 << 63}


def _label(df: DataFrame, name: str) -> Column:
    """A category as text; booleans read True/False."""
    c = known(df, name).cast("string")
    return F.initcap(c) if isinstance(type_of(df, name), T.BooleanType) else c


def _sorted_labels(values: Sequence[str | None], dtype: T.DataType) -> list[str | None]:
    """Natural order of the column's type, the missing value last."""
    present = [v for v in values if v is not None]
    present.sort(key=float if is_numeric(dtype) else str)
    return present + ([None] if len(present) < len(values) else [])


def learn_scaling(df: DataFrame, cols: Sequence[str]) -> dict[str, list[float | None]]:
    """Per column its median and the divisor: the interquartile range, or 1 where that is 0."""
    quartiles = exact_quantiles(df, {c: known_double(df, c) for c in cols}, (0.25, 0.5, 0.75)) if cols else {}
    return {c: [q2, None if q2 is None else (q3 - q1) or 1.0] for c, (q1, q2, q3) in quartiles.items()}


def robust_scaled(df: DataFrame, name: str, scaling: Sequence[float | None]) -> Column:
    """(x - median) / IQR; missing values stay missing."""
    center, width = scaling
    if center is None:
        return F.lit(None).cast("double")
    return (known_double(df, name) - F.lit(center)) / F.lit(width)


def learn_categories(df: DataFrame, cols: Sequence[str],
                     limit: int | None = None) -> dict[str, list[str | None]]:
    """Sorted categories per column, from one pre-aggregated count over all columns.

    The categories are the model: they travel with it, and one-hot columns are
    made of them.  A caller that fears identifiers sets a ``limit`` per column,
    beyond which a column is refused.
    """
    if not cols:
        return {}
    labels = {c: _label(df, c) for c in cols}
    pairs = long_values(df, cols, labels).distinct()
    rows = pairs.collect() if limit is None else collect_at_most(pairs, limit * len(cols), f"categories of {list(cols)}")
    found: dict[str, list[str | None]] = {c: [] for c in cols}
    for r in rows:
        found[r["column"]].append(r["value"])
    crowded = [c for c, v in found.items() if limit is not None and len(v) > limit]
    if crowded:
        raise ValueError(f"more than {limit} categories in {crowded}")
    return {c: _sorted_labels(v, type_of(df, c)) for c, v in found.items()}


class FeaturePreprocessor(Estimator, JsonState):
    """Robust scaling of numeric columns, then 0/1 columns for all but the first category.

    If either list is missing both are detected from the schema.
    """

    def __init__(self, numeric_columns: Sequence[str] | None = None,
                 categorical_columns: Sequence[str] | None = None, key_cols: Sequence[str] = (),
                 output_col: str = "features", max_categories: int | None = None) -> None:
        super().__init__()
        self._set(state={
            "numeric": None if numeric_columns is None else list(numeric_columns),
            "categorical": None if categorical_columns is None else list(categorical_columns),
            "keys": list(key_cols), "output": output_col, "max_categories": max_categories})

    def _fit(self, dataset: DataFrame) -> "FeaturePreprocessorModel":
        s = self.get_state()
        numeric, categorical = s["numeric"], s["categorical"]
        if numeric is None or categorical is None:
            numeric, categorical = identify_column_types(dataset, s["keys"])
        if not numeric and not categorical:
            raise ValueError("no numeric or categorical column to prepare")
        require_columns(dataset, [*numeric, *categorical])
        nested = [c for c in categorical if is_nested(type_of(dataset, c))]
        if nested:
            raise ValueError(f"nested columns cannot be categories: {nested}")
        return FeaturePreprocessorModel(learn_scaling(dataset, numeric),
                                        learn_categories(dataset, categorical, s["max_categories"]), s["output"])


class FeaturePreprocessorModel(Model, JsonState):
    def __init__(self, scaling: Mapping | None = None, categories: Mapping | None = None,
                 output_col: str = "features") -> None:
        super().__init__()
        self._set(state={"scaling": dict(scaling or {}), "categories": dict(categories or {}),
                         "output": output_col})

    @property
    def feature_names(self) -> list[str]:
        """Scaled columns first, then ``column_category`` for every category but the first."""
        s = self.get_state()
        return [f"num__{c}" for c in s["scaling"]] + [
            f"cat__{c}_{v}" for c, values in s["categories"].items() for v in values[1:]]

    def expand(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """One named column per feature, beside the columns to keep."""
        s = self.get_state()
        scaled = [robust_scaled(df, c, w).alias(f"num__{c}") for c, w in s["scaling"].items()]
        flags = [_label(df, c).eqNullSafe(F.lit(v)).cast("tinyint").alias(f"cat__{c}_{v}")
                 for c, values in s["categories"].items() for v in values[1:]]
        return df.select(*[ref(c) for c in keep], *scaled, *flags)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        """Append the feature vector; the columns it was made of are kept."""
        s = self.get_state()
        out, parts, scratch = dataset, [], []
        scaled = {f"__num{i}": robust_scaled(dataset, c, w) for i, (c, w) in enumerate(s["scaling"].items())}
        keys = {}
        for i, c in enumerate(c for c, v in s["categories"].items() if len(v) > 1):
            label = _label(dataset, c)
            keys[f"__cat{i}"] = F.when(label.isNull(), "n").otherwise(F.concat(F.lit("v"), label))
        out = out.withColumns({**scaled, **keys}) if scaled or keys else out
        parts += list(scaled)
        if keys:
            values = [v for v in s["categories"].values() if len(v) > 1]
            names = list(keys)
            index, slots, onehot = ([f"{n}_{x}" for n in names] for x in ("index", "slot", "onehot"))
            indexer = StringIndexerModel.from_arrays_of_labels(
                [["n" if x is None else f"v{x}" for x in v] for v in values], names, index)
            out = indexer.setHandleInvalid("keep").transform(out)
            # The first category and unseen ones take the last slot, the one the encoder leaves out.
            out = out.withColumns({
                slot: F.when(F.col(i).between(1, len(v) - 1), F.col(i) - 1).otherwise(float(len(v) - 1))
                for slot, i, v in zip(slots, index, values)})
            width = dataset.sparkSession.createDataFrame(
                [tuple(float(len(v) - 1) for v in values)], ", ".join(f"`{x}` double" for x in slots))
            encoder = OneHotEncoder(inputCols=slots, outputCols=onehot, dropLast=True).fit(width)
            out = encoder.transform(out)
            parts += onehot
            scratch += index + slots + onehot
        if not parts:
            raise ValueError("no feature left: every categorical column has a single category")
        out = VectorAssembler(inputCols=parts, outputCol=s["output"], handleInvalid="keep").transform(out)
        return out.drop(*scaled, *keys, *scratch)


def preprocess_data(df: DataFrame, numeric_columns: Sequence[str] | None = None,
                    categorical_columns: Sequence[str] | None = None,
                    key_cols: Sequence[str] = ()) -> tuple[DataFrame, FeaturePreprocessorModel]:
    """Fit on ``df`` and return its features as named columns, with the fitted model."""
    model = FeaturePreprocessor(numeric_columns, categorical_columns, key_cols).fit(df)
    return model.expand(df, keep=key_cols), model


class LabelEncoder(Estimator, JsonState):
    """Classes in sorted order to 0…k-1; a class not seen in training is an error.

    ``dtype`` is the integer type of the codes; one too narrow for the classes is refused.
    """

    def __init__(self, input_col: str = "label", output_col: str = "label_index", dtype: str = "int") -> None:
        super().__init__()
        if dtype not in CODE_TYPES:
            raise ValueError(f"dtype must be one of {sorted(CODE_TYPES)}")
        self._set(state={"input": input_col, "output": output_col, "dtype": dtype})

    def _fit(self, dataset: DataFrame) -> "LabelEncoderModel":
        s = self.get_state()
        require_columns(dataset, [s["input"]])
        classes = learn_categories(dataset, [s["input"]])[s["input"]]
        if None in classes:
            raise ValueError(f"{s['input']} has missing classes")
        if len(classes) > CODE_TYPES[s["dtype"]]:
            raise ValueError(f"{len(classes)} classes do not fit {s['dtype']}")
        return LabelEncoderModel(classes, s["input"], s["output"], s["dtype"])


class LabelEncoderModel(Model, JsonState):
    def __init__(self, classes: Sequence[str] = (), input_col: str = "label",
                 output_col: str = "label_index", dtype: str = "int") -> None:
        super().__init__()
        self._set(state={"classes": list(classes), "input": input_col, "output": output_col, "dtype": dtype})

    @property
    def classes(self) -> list[str]:
        return self.get_state()["classes"]

    @property
    def mapping(self) -> dict[str, int]:
        return {c: i for i, c in enumerate(self.classes)}

    def _transform(self, dataset: DataFrame) -> DataFrame:
        s = self.get_state()
        keyed = dataset.withColumn("__label", _label(dataset, s["input"]))
        index = StringIndexerModel.from_labels(s["classes"], "__label", "__code", handleInvalid="error")
        coded = index.transform(keyed).withColumn(s["output"], F.col("__code").cast(s["dtype"]))
        return coded.drop("__label", "__code")


def class_codes(df: DataFrame, col: str, dtype: str = "bigint") -> DataFrame:
    """Every class of a column and its code from 0 in natural order, as a table: ``(class, code)``.

    The codes are those of a ``LabelEncoder``, for columns with more classes than
    a driver should hold.  A missing class, and more classes than ``dtype`` holds,
    are errors.
    """
    require_columns(df, [col])
    if dtype not in CODE_TYPES:
        raise ValueError(f"dtype must be one of {sorted(CODE_TYPES)}")
    kind, label = type_of(df, col), _label(df, col)
    # whole numbers are compared as they are, other numbers as doubles, all else as text
    natural = known(df, col) if isinstance(kind, T.IntegralType) else known_double(df, col) if is_numeric(kind) else label
    classes = df.groupBy(label.alias("class"), natural.alias("natural")).agg(F.lit(1).alias("one")).drop("one")
    row = classes.agg(F.count(F.lit(1)).alias("all"), F.count("class").alias("named")).first()
    if row["all"] != row["named"]:
        raise ValueError(f"{col} has missing classes")
    if row["all"] > CODE_TYPES[dtype]:
        raise ValueError(f"{row['all']} classes do not fit {dtype}")
    numbered = running_totals(classes, [], ["natural", "class"], name="upto")
    return numbered.select("class", (F.col("upto") - 1).cast(dtype).alias("code"))


def encode_classes(df: DataFrame, col: str, codes: DataFrame, output_col: str) -> DataFrame:
    """Add the code of each row's class from a table of ``class_codes``; a class that it lacks is an error.

    A join by class: Spark broadcasts the table while it is small and splits classes that hold many rows.
    """
    require_columns(df, [col])
    side = codes.select(F.col("class").alias("__class"), F.col("code").alias("__code"))
    unseen = F.raise_error(F.concat(F.lit(f"{col} holds a class without a code: "), F.coalesce("__label", F.lit("missing"))))
    joined = df.withColumn("__label", _label(df, col)).join(side, F.col("__label") == F.col("__class"), "left")
    coded = joined.withColumn(output_col, F.when(F.col("__code").isNull(), unseen).otherwise(F.col("__code")))
    return coded.drop("__label", "__class", "__code")
