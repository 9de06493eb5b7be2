"""From raw documents to clean, encodable text: five stages, each over all that the one before has kept.

A stage takes (spark, docs, sf_dir) and returns documents; what it returns is written as Parquet and read again as the
next stage's input.  Stages that reject drop whole rows; the stage on personal data changes the text; the last adds
what encoding and decoding gave.  Columns beyond those of documents pass through under any name, but for one that is
named like a result of the last stage: the result takes its place.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabsieve.llm.bpe import round_trip
from tabsieve.llm.common import quoted, scratch_folder, table, written
from tabsieve.llm.decontamination import leaked_items
from tabsieve.llm.language import UNKNOWN, held_out, identify_language, language_samples
from tabsieve.llm.pii import find_personal_data
from tabsieve.llm.simhash import first_of_each_component


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def other_columns_apart(stage: Stage) -> Stage:
    """Gives columns beyond those of documents private names while the stage works."""

    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        named = {f"__other_{i}": c for i, c in enumerate(docs.columns) if c.lower() not in COLUMNS}
        out = stage(spark, docs.withColumnsRenamed({c: n for n, c in named.items()}), sf_dir)
        found = {c.lower() for c in out.columns if c not in named}
        kept = [c for c in out.columns if c not in named or named[c].lower() not in found]
        return out.select(*(quoted(c).alias(named.get(c, c)) for c in kept))

    return run_stage


@other_columns_apart
def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents of no language: null texts and texts without a letter."""
    samples = language_samples(docs.where(~held_out(F.col("doc_id")) & F.col("doc_id").isNotNull()))
    found = identify_language(docs, samples)
    # without any labelled text there is nothing to judge by: then only texts without letters go
    known = F.col("lang_pred") != UNKNOWN if samples else F.col("text").rlike("\\p{L}")
    return found.where(known).select(*docs.columns)


@other_columns_apart
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of the smallest doc_id of each group of linked fingerprints."""
    return first_of_each_component(docs)


@other_columns_apart
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item."""
    return leaked_items(docs, table(spark, sf_dir, "benchmark")).where(F.size("leaks") == 0).select(*docs.columns)


@other_columns_apart
def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Puts [KIND] in the place of personal data; n_chars follows the text."""
    found = find_personal_data(docs, mask=True)
    own = {"text": F.col("masked"), "n_chars": F.length("masked").cast("long")}
    return found.select(*(own[c].alias(c) if c in own else c for c in docs.columns))


@other_columns_apart
def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The text as decoded from its ids, with the counts and digests of the encoding; not to be decoded equal is an error."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    found = round_trip(docs, path, public_tokenizers.PATTERN, decoded=True)
    checked = F.when(F.col("decoded").eqNullSafe(F.col("text")), F.col("decoded")).otherwise(F.raise_error(F.lit("a text differs after decoding")))
    return found.select(*(checked.alias(c) if c == "text" else c for c in docs.columns), "n_tokens", "ids_sha256", "decoded_sha256")


STAGES = [
    ("language ID", language_id),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("PII", personal_data),
    ("byte-level BPE encoding and decoding", byte_bpe),
]

#: None of the stages can be expressed in SQL; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is written to the shared scratch folder."""
    docs, folder = table(spark, sf_dir, "documents"), scratch_folder(spark)
    for number, (_, stage) in enumerate(STAGES):
        docs = written(stage(spark, docs, sf_dir), folder, f"stage-{number}")
    return docs
