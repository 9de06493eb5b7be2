"""Token ids in binary files: frequency-ranked ids in a byte-aligned code with separate control bytes.

Ids are replaced by their rank in the corpus, the most frequent first, so most take one byte.  Four values share a
control byte, two bits each, which say how many bytes (1 to 4) a value takes in the data that follows apart; both
coding and decoding are table lookups and gathers over whole blocks.

A file is a Parquet file of blocks in ascending order of the key: keys, tokens per document, control bytes, data bytes.
Spark commits the files, so a lost executor leaves none half written.  Beside them lies the table of ranks.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabsieve.llm.common import append_columns, pa_type, quoted, resident

BLOCK_TOKENS = 1 << 20
#: Tokens that one file holds, about.
FILE_TOKENS = 1 << 24
REMEMBERED = 500_000
#: UTF-8 bytes of text tokenized at a time: a word is looked up once in each slice.
TEXT_BYTES = 8_000_000
#: Marks behind a letter or digit and before white space; begins with a mark, so a search skips from mark to mark.
STOP = re.compile(r"[^\w\s](?<=[^\W_].)[^\w\s]*(?=[ \n])")
#: Characters that may join with their neighbours, or whose lower case does.
BEYOND = re.compile("[^\x00-\u012f\u0131-\u02ff]")
#: By control byte: the sizes of its four values.
SIZES = np.array([[(c >> (2 * k) & 3) + 1 for k in range(4)] for c in range(256)], np.uint8)


def pack(values: np.ndarray) -> tuple[bytes, bytes]:
    """(control bytes, data bytes) of unsigned 32-bit values."""
    values = np.ascontiguousarray(values, "<u4")
    size = (values > 0xFF).astype(np.uint8) + (values > 0xFFFF) + (values > 0xFFFFFF)
    longest = int(size.max(initial=0)) + 1
    data = values.view(np.uint8).reshape(-1, 4)[:, :longest][np.arange(longest) <= size[:, None]]
    four = np.concatenate((size, np.zeros(-len(size) % 4, np.uint8))).reshape(-1, 4)
    return (four << np.array([0, 2, 4, 6], np.uint8)).sum(axis=1, dtype=np.uint8).tobytes(), data.tobytes()


def unpack(control: bytes, data: bytes, count: int) -> np.ndarray:
    size = SIZES[np.frombuffer(control, np.uint8)].ravel()[:count]
    at = np.cumsum(size, dtype=np.int64) - size
    source = np.frombuffer(data, np.uint8)
    values = source[at].astype(np.uint32)
    for k in range(1, 4):
        longer = np.flatnonzero(size > k)
        values[longer] |= source[at[longer] + k].astype(np.uint32) << np.uint32(8 * k)
    return values


def _tokenizer(path: str):
    return resident(("tokenizer", path), lambda: _load(path))


def _load(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs the tasks side by side
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
    return tokenizer, {}


def _visible_bytes() -> dict[int, int]:
    """The character that stands for each byte in a byte-level vocabulary: a visible one for itself, others from 256 on."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in visible]
    return {b: 256 + n for n, b in enumerate(hidden)}


VISIBLE = _visible_bytes()


def encoded(tokenizer, pieces: list[str]) -> Iterator[list[int]]:
    """The ids of each piece.

    One of common small letters alone is not changed or parted by the steps before the model, so the model is asked
    directly; the others go the whole way.
    """
    model = tokenizer.model.tokenize
    plain = [w.isalpha() and w.islower() and not BEYOND.search(w) for w in pieces]
    others = iter(tokenizer.encode_batch_fast([w for w, own in zip(pieces, plain) if not own], add_special_tokens=False))
    for w, own in zip(pieces, plain):
        if own:
            yield [t.id for t in model(w if w.isascii() else w.encode().decode("latin-1").translate(VISIBLE))]
        else:
            yield next(others).ids


def id_bytes(path: str) -> int:
    """Bytes that hold any id of the vocabulary: 2 or 4."""
    return 2 if _tokenizer(path)[0].get_vocab_size(with_added_tokens=True) <= 1 << 16 else 4


def prepared(text: str) -> str:
    """The text with more of its pieces parted by blanks and in fewer spellings, which the tokenizer would do itself.

    In texts of common letters, lower case is taken here, letter by letter, and the marks between a letter or digit and
    white space, a piece of their own, are parted.
    """
    if not BEYOND.search(text):
        text = STOP.sub(r" \g<0>", text.lower())
    return text.replace("\n", " ")


def tokenize(df: DataFrame, path: str, text: str = "text", keep: list[str] | None = None, end: int | None = None) -> DataFrame:
    """df with `ids` and `tally`.

    ids: each text's ids as little-endian words of id_bytes(path), with the end id if there is one; null and empty
    texts have no others.  tally: once in a slice of texts the ids in it and how often each comes, two rows of 32-bit
    words, else null.  For vocabularies that drop white space and case: what blanks part is encoded apart and
    remembered.
    """
    kind = f"<u{id_bytes(path)}"
    code = np.dtype(kind).char

    def make():
        tokenizer, known = _tokenizer(path)

        def work(texts: list[str | None]) -> list[list]:
            parts = pc.split_pattern(pa.array([prepared(t) if t else "" for t in texts], pa.string()), " ")
            coded = pc.dictionary_encode(parts.flatten())
            distinct, which = coded.dictionary.to_pylist(), coded.indices.to_numpy()
            if len(known) > REMEMBERED:
                known.clear()
            new = [w for w in distinct if w not in known]
            for k in range(0, len(new), 20_000):
                some = new[k : k + 20_000]
                for word, ids in zip(some, encoded(tokenizer, some)):
                    known[word] = array(code, ids).tobytes()
            own = [known[w] for w in distinct]
            size = np.fromiter(map(len, own), np.int64, len(own)) // int(kind[-1])
            first, counts = (np.cumsum(size) - size)[which], size[which]
            last = np.cumsum(counts)
            ids = np.frombuffer(b"".join(own), kind)[np.arange(int(counts.sum())) + np.repeat(first - last + counts, counts)]
            cuts = np.concatenate(([0], last))[parts.offsets.to_numpy() - parts.offsets[0].as_py()].tolist()
            tail = b"" if end is None else np.array([end], kind).tobytes()
            rows = [ids[i:j].tobytes() + tail for i, j in zip(cuts, cuts[1:])]
            total = np.bincount(ids, minlength=(end or 0) + 1)
            if end is not None:
                total[end] += len(texts)
            seen = np.flatnonzero(total)
            return [rows, [np.array([seen, total[seen]], "<u4").tobytes(), *[None] * (len(texts) - 1)]]

        return work

    return append_columns(df, text, "ids binary, tally binary", make, keep, most=TEXT_BYTES)


def count_ids(tokens: DataFrame) -> DataFrame:
    """(id, n) over all documents, from the column tally."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for tally in batch.column(0).to_pylist():
                seen, total = np.frombuffer(tally, "<u4").reshape(2, -1)
                yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(total, pa.int64())], names=["id", "n"])

    return tokens.where("tally IS NOT NULL").select("tally").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def write_token_files(df: DataFrame, path: str, folder: str, key: str = "doc_id", text: str = "text", end: int = 1) -> None:
    """Tokenizes df and writes its ids to folder/blocks, each document's with the end id, in ascending order of the key.

    Null keys come first; rows of one key follow each other by the hash of their ids.  Null and empty texts have the end
    id alone.  The ids are kept as a table in folder/ids meanwhile, so texts are tokenized once.
    """
    spark = df.sparkSession
    width = id_bytes(path)
    plain = tokenize(df.select(quoted(key).alias("key"), quoted(text).alias("text")), path, keep=["key"], end=end)
    narrow = plain.withColumn("order", F.xxhash64("ids"))
    narrow.write.option("compression", "zstd").parquet(f"{folder}/ids")
    ids = spark.read.schema(narrow.schema).parquet(f"{folder}/ids")
    counts = count_ids(ids).collect()  # no more than the vocabulary has
    ranked = sorted(counts, key=lambda r: (-r.n, r.id))
    spark.createDataFrame([(i, r.id, r.n) for i, r in enumerate(ranked)], "rank long, id long, n long").coalesce(1).write.parquet(f"{folder}/ranks")
    rank = np.zeros(max((r.id for r in counts), default=0) + 1, np.uint32)
    rank[[r.id for r in ranked]] = np.arange(len(ranked))
    shared = spark.sparkContext.broadcast(rank)
    files = max(1, -(-sum(r.n for r in counts) // FILE_TOKENS))
    kind = df.schema[key].dataType
    block = T.StructType([T.StructField("shard", T.IntegerType()), T.StructField("first", T.LongType()), T.StructField("keys", T.ArrayType(kind)), T.StructField("sizes", T.ArrayType(T.LongType())), T.StructField("control", T.BinaryType()), T.StructField("data", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks, shard = shared.value, TaskContext.get().partitionId()
        first = held = 0
        keys: list = []
        parts: list[np.ndarray] = []

        def flush() -> pa.RecordBatch:
            control, data = pack(ranks[np.concatenate(parts)])
            values = [[shard], [first], [keys], [[len(p) for p in parts]], [control], [data]]
            return pa.RecordBatch.from_arrays([pa.array(v, pa_type(f.dataType)) for v, f in zip(values, block)], names=block.names)

        for batch in batches:
            for k, own in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                keys.append(k)
                parts.append(np.frombuffer(own, f"<u{width}"))
                held += len(parts[-1])
                if held >= BLOCK_TOKENS:
                    yield flush()
                    first, held, keys, parts = first + held, 0, [], []
        if parts:
            yield flush()

    ordered = ids.repartitionByRange(files, "key", "order").sortWithinPartitions("key", "order").select("key", "ids")
    ordered.mapInArrow(run, block).write.option("compression", "uncompressed").parquet(f"{folder}/blocks")


def read_token_files(spark: SparkSession, folder: str, key: str = "doc_id") -> DataFrame:
    """(key, start, n_tokens, ids, ids_crc32) of every document; ids as little-endian 32-bit words, start over all files."""
    blocks = spark.read.parquet(f"{folder}/blocks")
    sums = blocks.groupBy("shard").agg(F.sum(F.expr("aggregate(sizes, 0L, (a, x) -> a + x)")).alias("n")).collect()  # a row for each file
    starts, total = {}, 0
    for r in sorted(sums, key=lambda r: r.shard):
        starts[r.shard], total = total, total + r.n
    ranks = spark.read.parquet(f"{folder}/ranks").collect()
    table = np.zeros(len(ranks), "<u4")
    for r in ranks:
        table[r["rank"]] = r.id
    shared = spark.sparkContext.broadcast((starts, table))
    kind = blocks.schema["keys"].dataType.elementType
    out = T.StructType([T.StructField(key, kind), *(T.StructField(n, T.LongType()) for n in ("start", "n_tokens")), T.StructField("ids", T.BinaryType()), T.StructField("ids_crc32", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin, id_of = shared.value
        for batch in batches:
            for i in range(batch.num_rows):
                shard, first, keys, sizes, control, data = (c[i].as_py() for c in batch.columns)
                values = id_of[unpack(control, data, sum(sizes))]
                ends = np.cumsum(sizes)
                parts = [values[e - n : e].tobytes() for e, n in zip(ends.tolist(), sizes)]
                made = [keys, (begin[shard] + first + ends - np.array(sizes)).tolist(), sizes, parts, [zlib.crc32(p) for p in parts]]
                yield pa.RecordBatch.from_arrays([pa.array(v, pa_type(f.dataType)) for v, f in zip(made, out)], names=out.names)

    return blocks.select("shard", "first", "keys", "sizes", "control", "data").mapInArrow(run, out)
