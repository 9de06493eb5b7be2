"""Guessing the text encoding of many files at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Names of files that the text source unpacks.
PACKED = r"\.(gz|bz2|zst|lz4|snappy|deflate|xz)$"

# Byte order marks (hexadecimal) and the encodings they announce; longer marks first.
BYTE_ORDER_MARKS = (
    ("FFFE0000", "UTF-32"),
    ("0000FEFF", "UTF-32"),
    ("EFBBBF", "UTF-8-SIG"),
    ("FFFE", "UTF-16"),
    ("FEFF", "UTF-16"),
)


def encoding_of(content: Column) -> Column:
    """Encoding of a binary column."""
    marks = F.hex(F.substring(content, 1, 4))
    text = content.cast("string")
    valid = F.is_valid_utf8(text)
    (first, name), *others = BYTE_ORDER_MARKS
    guess = F.when(marks.startswith(first), name)
    for mark, name in others:
        guess = guess.when(marks.startswith(mark), name)
    return (guess.when(valid & text.rlike(r"\A\p{ASCII}*\z"), "ascii")
            .when(valid, "utf-8").otherwise("ISO-8859-1"))


def detect_encodings(spark: SparkSession, path: str) -> DataFrame:
    """``(path, n_bytes, encoding)`` per file under ``path`` (a folder, file or glob).

    Spark lists and reads the files, so any path or store that it can read will
    do, and a large file is looked at by many tasks: no UTF-8 sequence holds a
    line break, hence a file is valid if each of its lines is.  The marks of
    UTF-16 and UTF-32 stand in a file's first line; that of UTF-8 is taken off
    before Spark sees the line, which shows as bytes missing from the file's
    length (not so for compressed files, which are looked at unpacked).  Spark's
    readers pass over empty files, so these have no row.
    """
    def source(kind: str, **options: str) -> DataFrame:
        return spark.read.options(recursiveFileLookup="true", **options).format(kind).load(path)

    files = source("binaryFile").select("path", F.col("length").alias("n_bytes"), F.col("_metadata.file_path").alias("file"))
    raw = F.col("value").cast("binary")
    lines = source("text", lineSep="\n").select(
        F.col("_metadata.file_path").alias("file"), F.octet_length(raw).alias("n"),
        F.is_valid_utf8("value").alias("valid"), (F.octet_length(raw) == F.char_length("value")).alias("plain"),
        # the lines of a task are numbered in their order, and a file's first bytes are in the part that begins at 0
        F.when(F.col("_metadata.file_block_start") == 0, F.monotonically_increasing_id()).alias("at"),
        F.hex(F.substring(raw, 1, 4)).alias("head"))
    seen = lines.groupBy("file").agg(
        F.bool_and("valid").alias("valid"), F.bool_and("plain").alias("plain"), F.min_by("head", "at").alias("head"),
        (F.sum("n") + F.count(F.lit(1))).alias("n_read"))
    missing = F.when(~F.lower("path").rlike(PACKED), F.col("n_bytes") - F.coalesce("n_read", F.lit(0)))
    guess = F.when(missing >= 2, "UTF-8-SIG")
    for mark, name in BYTE_ORDER_MARKS:
        guess = guess.when(F.col("head").startswith(mark), name)
    guess = (guess.when(F.col("valid") & F.col("plain"), "ascii").when(F.col("valid"), "utf-8")
             .when(~F.col("valid"), "ISO-8859-1"))
    return files.join(seen, "file", "left").select("path", "n_bytes", guess.alias("encoding"))
