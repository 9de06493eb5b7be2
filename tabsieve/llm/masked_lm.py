"""Masked pseudo-likelihood: how well each token is foretold by its neighbours on both sides.

The vocabulary grows with the corpus: every word found LEAST times or more is a token, other words are spelt as bytes,
a token each.  The tokens fall into 160 classes: the most frequent words each have their own, other words share some by
their endings, bytes by their upper half and by whether they begin a word.  A network sees the class before and the
class after (two embeddings, a hidden layer) and gives each class a probability; that of the token within its class
comes from the counts of the whole corpus.  So each token itself is foretold, and a document's score is the sum of the
log probabilities of all its tokens, each masked in turn.

Of the context the network sees only classes, so all it can learn from a corpus is how often each class stands between
each two: Spark counts these triples over all documents.  They are at most 160^3 whatever the corpus, so the training,
full-batch Adam in numpy, and the table of log probabilities that scoring looks up, have a fixed size; the vocabulary
and its counts have not.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabsieve.llm.common import append_columns, quoted, scratch_folder, slices, written

TOKEN = re.compile(r"\w+|[^\w\s]")
CLASSES = 160
ENDINGS = 32
NIBBLES = 32  # classes of bytes
BYTES = 512  # tokens of bytes: 256 that begin a word, 256 that go on
EDGE = 0  # before the first and after the last token
LEAST = 5  # how often a word must be found to be a token
REMEMBERED = 300_000
REMEMBERED_BYTES = 4_000_000


def tokens(text: str | None) -> list[str]:
    return TOKEN.findall(text.lower()) if text else []


def spelt(word: str) -> list[int]:
    """The tokens of a word that is none itself."""
    first, *rest = word.encode("utf-8", "surrogatepass")
    return [1 + first, *(257 + b for b in rest)]


class Classes:
    """The vocabulary: the tokens of a word, the class of each token, and its log probability within the class.

    Token 0 is the edge, then come the bytes, then the words in the order given, the most frequent first.
    """

    def __init__(self, words: list[str], counts: np.ndarray, byte_counts: np.ndarray):
        self.own = {w: 1 + BYTES + i for i, w in enumerate(words)}
        self.of = np.zeros(1 + BYTES + len(words), np.int32)
        self.of[1 : 1 + BYTES] = 1 + ENDINGS + np.arange(BYTES) // 16
        alone = CLASSES - 1 - ENDINGS - NIBBLES
        self.of[1 + BYTES :] = [1 + ENDINGS + NIBBLES + i if i < alone else 1 + zlib.crc32(w[-2:].encode("utf-8", "surrogatepass")) % ENDINGS for i, w in enumerate(words)]
        # a byte may be missing in the corpus and stand in another text
        found = np.concatenate(([1.0], byte_counts + 1.0, counts))
        self.logs = np.log(found / np.bincount(self.of, found, CLASSES)[self.of])
        self.known: dict[str, int] = {}
        self.spelt: list[int] = []
        self.ends = [0]

    def ids(self, words: list[str]) -> list[int]:
        """The token of each word, or -1 - k for the k-th of the words remembered as spelt."""
        known = self.known
        if len(known) > REMEMBERED or len(self.spelt) > REMEMBERED_BYTES:
            known.clear()
            self.spelt, self.ends = [], [0]
        for w in set(words).difference(known):
            if (token := self.own.get(w)) is None:
                token = -len(self.ends)
                self.spelt += spelt(w)
                self.ends.append(len(self.spelt))
            known[w] = token
        return list(map(known.__getitem__, words))

    def windows(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(left, right, middle class as one number for every token, the tokens, tokens of each text, words of each text)."""
        words = [tokens(t) for t in texts]
        sizes = np.array([len(x) for x in words], np.int64)
        found = iter(self.ids([w for x in words for w in x]))
        flat = np.array([c for n in sizes.tolist() for c in (EDGE, *islice(found, n))] + [EDGE], np.int64)
        ends, pieces = np.array(self.ends, np.int64), np.array(self.spelt, np.int32)
        rare = np.flatnonzero(flat < 0)
        begin, length = ends[-1 - flat[rare]], ends[-flat[rare]] - ends[-1 - flat[rare]]
        each = np.ones(len(flat), np.int64)
        each[rare] = length
        start = np.cumsum(each) - each
        all_tokens = np.repeat(np.maximum(flat, 0), each).astype(np.int32)
        nth = np.arange(int(length.sum())) - np.repeat(np.cumsum(length) - length, length)
        all_tokens[np.repeat(start[rare], length) + nth] = pieces[np.repeat(begin, length) + nth]
        edges = start[np.append(np.cumsum(sizes + 1) - sizes - 1, len(flat) - 1)]  # of each text, and the last
        of = self.of[all_tokens]
        inside = np.flatnonzero(all_tokens != EDGE)
        codes = (of[inside - 1] * CLASSES + of[inside + 1]) * CLASSES + of[inside]
        return codes, all_tokens[inside], np.diff(edges) - 1, sizes


def count_words(df: DataFrame, text: str) -> DataFrame:
    """(word, n) over all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 0):
                counts = Counter(w for t in part.column(0).to_pylist() for w in tokens(t))
                yield pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], names=["word", "n"])

    return df.select(quoted(text).cast("string").alias("text")).mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def count_bytes(words: DataFrame) -> np.ndarray:
    """How often each byte token stands in the words that are no tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 + BYTES, np.int64)
        for batch in batches:
            for w, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for token, times in Counter(spelt(w)).items():
                    total[token] += n * times
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int32()), pa.array(total[seen], pa.int64())], names=["token", "n"])

    found = words.where(F.col("n") < LEAST).mapInArrow(run, "token int, n long").groupBy("token").agg(F.sum("n").alias("n")).collect()
    total = np.zeros(1 + BYTES)
    for r in found:
        total[r.token] = r.n
    return total[1:]


def count_triples(df: DataFrame, text: str, classes: Classes) -> DataFrame:
    """(code, n): how often each class stands between each two."""
    shared = df.sparkSession.sparkContext.broadcast(classes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CLASSES**3, np.int64)
        for batch in batches:
            for part in slices(batch, 0):
                total += np.bincount(shared.value.windows(part.column(0).to_pylist())[0], minlength=CLASSES**3)
        seen = np.flatnonzero(total)
        for k in range(0, len(seen), 1 << 18):
            own = seen[k : k + (1 << 18)]
            yield pa.RecordBatch.from_arrays([pa.array(own, pa.int32()), pa.array(total[own], pa.int64())], names=["code", "n"])

    return df.select(quoted(text).cast("string").alias("text")).mapInArrow(run, "code int, n long").groupBy("code").agg(F.sum("n").alias("n"))


@dataclass
class WindowNetwork:
    """Embeddings of the left and the right class, a hidden layer, and a softmax over the middle class."""

    left: np.ndarray
    right: np.ndarray
    hidden_bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray

    @classmethod
    def train(cls, codes: np.ndarray, counts: np.ndarray, size: int = 24, rounds: int = 150, rate: float = 0.05, seed: int = 7) -> WindowNetwork:
        """Maximum pseudo-likelihood over the counts, by Adam over all contexts at once."""
        random = np.random.default_rng(seed)
        table = np.zeros((CLASSES * CLASSES, CLASSES), np.float32)
        table.ravel()[codes] = counts
        seen = np.flatnonzero(table.any(axis=1))
        table = table[seen] / max(1.0, float(counts.sum()))
        weight, left_of, right_of = table.sum(axis=1, keepdims=True), seen // CLASSES, seen % CLASSES
        middle = np.log(table.sum(axis=0) + 1e-7).astype(np.float32)
        net = cls(*(random.normal(0, 0.3, s).astype(np.float32) for s in ((CLASSES, size), (CLASSES, size), (size,))), random.normal(0, 0.1, (size, CLASSES)).astype(np.float32), middle)
        params = [net.left, net.right, net.hidden_bias, net.out, net.out_bias]
        first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
        by_left, by_right = (np.eye(CLASSES, dtype=np.float32)[x] for x in (left_of, right_of))
        for step in range(1, rounds + 1 if len(seen) else 1):
            hidden = np.tanh(net.left[left_of] + net.right[right_of] + net.hidden_bias)
            logits = hidden @ net.out + net.out_bias
            p = np.exp(logits - logits.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            error = table - p * weight
            back = (error @ net.out.T) * (1 - hidden**2)
            grads = [by_left.T @ back, by_right.T @ back, back.sum(axis=0), hidden.T @ error, error.sum(axis=0)]
            for p_, g, m, v in zip(params, grads, first, second):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                p_ += rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        return net

    def log_probabilities(self) -> np.ndarray:
        """Of every middle class between every two, by the number of the triple."""
        pairs = np.arange(CLASSES * CLASSES)
        logits = np.tanh(self.left[pairs // CLASSES] + self.right[pairs % CLASSES] + self.hidden_bias) @ self.out + self.out_bias
        logits -= logits.max(axis=1, keepdims=True)
        return (logits - np.log(np.exp(logits).sum(axis=1, keepdims=True))).ravel()


def fit(df: DataFrame, text: str = "text") -> tuple[Classes, np.ndarray]:
    """The classes and the table of log probabilities that the whole of df gives."""
    folder = scratch_folder(df.sparkSession)
    words = written(count_words(df, text), folder, "words")
    frequent = words.where(F.col("n") >= LEAST).toArrow().sort_by([("n", "descending"), ("word", "ascending")])
    classes = Classes(frequent["word"].to_pylist(), frequent["n"].to_numpy().astype(np.float64), count_bytes(words))
    del frequent
    counts = written(count_triples(df, text, classes), folder, "triples").toPandas()  # at most 160^3 rows
    counts = counts.sort_values("code")
    return classes, WindowNetwork.train(counts["code"].to_numpy(), counts["n"].to_numpy()).log_probabilities()


def score(df: DataFrame, classes: Classes, table: np.ndarray, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """df with n_tokens, log_likelihood (the sum over all tokens) and mean_log_likelihood.

    n_tokens counts words and marks, spelt ones too, and the mean is over these, so it does not hang on what is spelt.
    Texts without tokens, null or empty, have 0, 0.0 and null.  Input columns of these names are replaced.
    """
    shared = df.sparkSession.sparkContext.broadcast((classes, table))  # a table of 16 MB, and the vocabulary

    def make():
        own, logs = shared.value

        def work(texts: list[str | None]) -> list[list]:
            codes, found, lengths, sizes = own.windows(texts)
            sums = np.zeros(len(texts))
            some = np.flatnonzero(sizes)
            if len(some):
                sums[some] = np.add.reduceat(logs[codes] + own.logs[found], (np.cumsum(lengths) - lengths)[some])
            return [sizes.tolist(), sums.tolist(), [s / n if n else None for s, n in zip(sums.tolist(), sizes.tolist())]]

        return work

    return append_columns(df, text, "n_tokens long, log_likelihood double, mean_log_likelihood double", make, keep)
