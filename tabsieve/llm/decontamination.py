"""Benchmark decontamination: which documents hold which test items.

The test items are indexed, the documents are the queries: each passage of a document asks for all items whose BM25
score is above a threshold.  A score is divided by what the item itself would get, so the threshold is a share of an
item's weight.  Since it is fixed, weak AND with block maxima becomes a filter over arrays, batch by batch:

* the terms of an item that hold half of its weight, the rarest first, are its essential terms; the rest together
  can't reach the threshold, so only passages with essential terms are looked at;
* items lie in blocks; a block whose maxima, summed over the passage's essential terms, and whose largest rest don't
  reach the threshold is skipped whole; then the same with the weights of each item left;
* what is left is scored over all its terms, and items above the threshold are verified: shared five-word shingles
  over the whole item, and over its question and its answer apart.

Passages overlap: they are two strides long, and a stride is as long as the longest item of a class of lengths, so any
copy of an item lies whole within one passage.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabsieve.llm.common import append_columns, quoted

WORD = re.compile(r"\w+")
SENTENCE = re.compile(r"(?<=[.?!])\s+")
K1, B = 1.2, 0.75
BLOCK = 16
SHORTEST_STRIDE = 32
#: Characters of test items in one index; more items make more indexes, each held against all documents in turn.
INDEX_CHARS = 4_000_000


def words(text: str | None) -> list[str]:
    return WORD.findall(text.lower()) if text else []


def question_and_answer(text: str) -> tuple[list[str], list[str]]:
    """The words before and in the last sentence; of a single sentence, the last third counts as the answer."""
    parts = [w for s in SENTENCE.split(text) if (w := words(s))]
    if len(parts) > 1:
        return [w for p in parts[:-1] for w in p], parts[-1]
    own = parts[0] if parts else []
    cut = len(own) - max(1, len(own) // 3)
    return own[:cut], own[cut:]


def shingles(own: list[str], size: int) -> set[tuple[str, ...]]:
    return set(zip(*(own[k:] for k in range(size)))) if len(own) >= size else set()


def overlap(part: list[str], passage: list[str], size: int = 5) -> float:
    """Share of the part's shingles that the passage has; of a shorter part, the whole; 1 for no words."""
    if not part:
        return 1.0
    own = shingles(part, min(size, len(part)))
    return len(own & shingles(passage, min(size, len(part)))) / len(own)


def _ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """start, start + 1, … for each pair of a start and a count, one after the other."""
    before = np.cumsum(counts) - counts
    return np.arange(int(counts.sum())) - np.repeat(before - starts, counts)


def _sums(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    unique, at = np.unique(keys, return_inverse=True)
    return unique, np.bincount(at, values, len(unique))


@dataclass
class _Class:
    """Items of similar length, with the postings of their essential terms; a term's postings are items start … end."""

    stride: int
    items: np.ndarray  # numbers of the items, in order of length
    rest: np.ndarray  # weight of each item's other terms
    first: np.ndarray  # by term, into posted
    posted: np.ndarray  # place of an item within the class
    weight: np.ndarray
    block_first: np.ndarray  # by term, into blocks
    blocks: np.ndarray
    block_max: np.ndarray
    block_rest: np.ndarray


@dataclass
class TestIndex:
    """BM25 index of test items (id, text), with counts over all test items."""

    items: list[tuple]
    frequency: dict[str, int]  # items with a term
    n_items: int
    mean_words: float
    threshold: float = 0.7
    vocabulary: dict[str, int] = field(init=False)

    def __post_init__(self) -> None:
        tokens = [words(text) for _, text in self.items]
        self.vocabulary = {w: i for i, w in enumerate(sorted({w for own in tokens for w in own}))}
        self.terms: list[np.ndarray] = []
        self.weights: list[np.ndarray] = []
        for own in tokens:
            tf = Counter(own)
            ids = np.array(sorted(self.vocabulary[w] for w in tf), np.int64)
            names = sorted(tf, key=self.vocabulary.__getitem__)
            count = np.array([tf[w] for w in names], float)
            df = np.array([self.frequency.get(w, 1) for w in names], float)
            impact = np.log1p((self.n_items - df + 0.5) / (df + 0.5)) * count * (K1 + 1) / (count + K1 * (1 - B + B * len(own) / max(self.mean_words, 1)))
            self.terms.append(ids)
            self.weights.append(impact / impact.sum() if len(own) else impact)
        self.length = np.array([len(own) for own in tokens], np.int64)
        strides: dict[int, list[int]] = {}
        for i in sorted(range(len(tokens)), key=lambda i: (self.length[i], i)):
            if self.length[i]:
                strides.setdefault(max(SHORTEST_STRIDE, 1 << int(self.length[i] - 1).bit_length()), []).append(i)
        self.classes = [self._class(stride, members) for stride, members in sorted(strides.items())]

    def _class(self, stride: int, members: list[int]) -> _Class:
        rest, terms, places, weights = [], [], [], []
        for place, i in enumerate(members):
            order = np.argsort(-self.weights[i], kind="stable")
            # essential: at least half of the weight, and so much that the rest alone stays below the threshold
            total = np.cumsum(self.weights[i][order])
            n = 1 + int(np.searchsorted(total, max(0.5, 1 - self.threshold) + 1e-9))
            own = order[:n]
            rest.append(max(0.0, 1 - float(self.weights[i][own].sum())))
            terms.append(self.terms[i][own])
            weights.append(self.weights[i][own])
            places.append(np.full(len(own), place))
        t, p, w = np.concatenate(terms), np.concatenate(places), np.concatenate(weights)
        order = np.lexsort((p, t))
        t, p, w = t[order], p[order], w[order]
        first = np.searchsorted(t, np.arange(len(self.vocabulary) + 1))
        new = np.flatnonzero(np.diff(t * (len(members) + 1) + p // BLOCK, prepend=-1))
        n_blocks = -(-len(members) // BLOCK)
        block_rest = np.maximum.reduceat(np.array(rest), np.arange(0, len(rest), BLOCK))
        assert len(block_rest) == n_blocks
        return _Class(stride, np.array(members), np.array(rest), first, p, w, np.searchsorted(t[new], np.arange(len(self.vocabulary) + 1)), p[new] // BLOCK, np.maximum.reduceat(w, new), block_rest)

    def search(self, texts: list[str | None]) -> list[list[tuple[int, float, float, float]]]:
        """For each text its items: (number, best score, question overlap, answer overlap), in order of number."""
        found: list[dict[int, tuple[float, float, float]]] = [{} for _ in texts]
        get = self.vocabulary.get
        tokens = [words(t) for t in texts]
        lengths = np.array([len(own) for own in tokens], np.int64)
        ids = np.fromiter((get(w, -1) for own in tokens for w in own), np.int64, int(lengths.sum()))
        begin = np.cumsum(lengths) - lengths
        for c in self.classes:
            for passage, item, doc, start, score in self._candidates(c, ids, lengths, begin):
                own = tokens[doc][start : start + 2 * c.stride]
                verified = self._verify(item, own)
                if verified and score > found[doc].get(item, (-1.0,))[0]:
                    found[doc][item] = (score, *verified)
        return [[(item, *x) for item, x in sorted(own.items())] for own in found]

    def _candidates(self, c: _Class, ids: np.ndarray, lengths: np.ndarray, begin: np.ndarray) -> Iterator[tuple[int, int, int, int, float]]:
        slots = np.maximum(1, -(-lengths // c.stride))
        slot_begin = np.cumsum(slots) - slots
        essential = np.append(np.diff(c.first) > 0, False)
        at = np.flatnonzero(essential[ids])  # -1 takes the last
        doc = np.searchsorted(begin, at, side="right") - 1
        slot = (at - begin[doc]) // c.stride
        passage = slot_begin[doc] + slot
        size = len(self.vocabulary)
        # a word lies in the passages that begin with its slot and with the one before
        keys = np.unique(np.concatenate((passage * size + ids[at], ((passage - 1) * size + ids[at])[slot > 0])))
        passage, term = keys // size, keys % size
        # blocks: the maxima of the essential terms and the largest rest
        n = c.block_first[term + 1] - c.block_first[term]
        pick = _ranges(c.block_first[term], n)
        n_blocks = len(c.block_rest)
        block_keys, bound = _sums(np.repeat(passage, n) * n_blocks + c.blocks[pick], c.block_max[pick])
        alive = block_keys[bound + c.block_rest[block_keys % n_blocks] >= self.threshold]
        if not len(alive):
            return
        # items of the blocks left
        some = np.isin(passage, alive // n_blocks)
        passage, term = passage[some], term[some]
        n = c.first[term + 1] - c.first[term]
        pick = _ranges(c.first[term], n)
        spread, place = np.repeat(passage, n), c.posted[pick]
        there = np.isin(spread * n_blocks + place // BLOCK, alive)
        n_items = len(c.items)
        pairs, score = _sums(spread[there] * n_items + place[there], c.weight[pick][there])
        pairs = pairs[score + c.rest[pairs % n_items] >= self.threshold]
        if not len(pairs):
            return
        owner = np.searchsorted(slot_begin, pairs // n_items, side="right") - 1
        last, have = -1, np.zeros(0, np.int64)
        for pair, d in zip(pairs.tolist(), owner.tolist()):
            p, item = pair // n_items, int(c.items[pair % n_items])
            start = (p - int(slot_begin[d])) * c.stride
            if p != last:
                have, last = np.unique(ids[begin[d] + start : begin[d] + min(lengths[d], start + 2 * c.stride)]), p
            full = float(self.weights[item][np.isin(self.terms[item], have)].sum())
            if full >= self.threshold - 1e-9:
                yield p, item, d, start, min(1.0, full)

    def _verify(self, item: int, passage: list[str], similar: float = 0.8, part: float = 0.5) -> tuple[float, float] | None:
        text = self.items[item][1]
        question, answer = question_and_answer(text)
        if overlap(words(text), passage) < similar:
            return None
        found = overlap(question, passage), overlap(answer, passage)
        return found if min(found) >= part else None


def _indexes(items: DataFrame, item: str, text: str, threshold: float) -> list[TestIndex]:
    """Indexes of at most about INDEX_CHARS characters, with counts over all items."""
    rows = items.select(quoted(item).alias("item"), quoted(text).cast("string").alias("text"))
    rows = append_columns(rows, "text", "words array<string>", lambda: lambda texts: [[words(t) for t in texts]]).where("size(words) > 0")
    total = rows.agg(F.count(F.lit(1)).alias("n"), F.avg(F.size("words")).alias("mean"), F.sum(F.length("text")).alias("chars")).first()
    if not total.n:
        return []
    parts = -(-total.chars // INDEX_CHARS)
    placed = rows.withColumn("part", F.pmod(F.xxhash64("item", "text"), F.lit(parts)))
    terms = placed.select("part", F.explode(F.array_distinct("words")).alias("term"))
    counts = terms.groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    found = []
    for k in range(parts):
        here = placed.where(F.col("part") == k).select("item", "text").collect()
        frequency = counts.join(terms.where(F.col("part") == k).select("term").distinct(), "term").collect() if parts > 1 else counts.collect()
        found.append(TestIndex(sorted(((r.item, r.text) for r in here), key=lambda x: (str(x[0]), x[1])), {r.term: r.n for r in frequency}, total.n, total.mean, threshold))
    return found


def leaked_items(df: DataFrame, items: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text", threshold: float = 0.7, keep: list[str] | None = None) -> DataFrame:
    """df with `leaks`: an array of (item_id, score, question_overlap, answer_overlap), empty for a clean document.

    Null and empty texts, on either side, and empty tables give no leaks; repeated items and rows are each reported.
    An input column named leaks is replaced.
    """
    kind = items.schema[item].dataType
    kind = kind if isinstance(kind, T.StringType) else T.LongType()
    items = items.withColumn(item, quoted(item).cast(kind))
    leak = T.StructType([T.StructField("item_id", kind), *(T.StructField(n, T.DoubleType()) for n in ("score", "question_overlap", "answer_overlap"))])
    names = [c for c in (df.columns if keep is None else keep) if c.lower() != "leaks"]
    parts: list[str] = []
    work = df if text in names else df.select(*map(quoted, names), quoted(text).alias(text))
    indexes = _indexes(items, item, item_text, threshold)
    for k, index in enumerate(indexes):
        shared = df.sparkSession.sparkContext.broadcast(index)

        def make(shared=shared):
            index = shared.value
            return lambda texts: [[[{"item_id": index.items[i][0], "score": s, "question_overlap": q, "answer_overlap": a} for i, s, q, a in own] for own in index.search(texts)]]

        parts.append(f"__leaks_{k}")
        work = append_columns(work, text, T.StructType([T.StructField(parts[-1], T.ArrayType(leak))]), make)
    every = F.concat(*map(quoted, parts)) if parts else F.array().cast(T.ArrayType(leak))
    return work.select(*map(quoted, names), every.alias("leaks"))
