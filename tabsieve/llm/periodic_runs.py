"""Runs of words that repeat with a period, found by longest common extensions over a difference cover.

The words of a slice of texts become one array of numbers, each text closed by a number of its own, so no repeat goes
from one text into the next.  A difference cover modulo v holds, for every distance, two members that far apart: only
suffixes at positions in the cover are sorted (by their first v words, then by doubling, which stays within the cover),
with a sparse table of minima over their common prefixes.  How far two suffixes agree is then known after comparing the
fewer than v words up to the next place where both are in the cover, and one look-up.

A run of period p and at least 4 p words is a stretch of at least 3 p places where a word equals the one p further on,
so it holds a multiple of 3 p.  Asking how far the words agree to either side of these places, for all p up to a quarter
of the text, takes n + n/2 + n/3 + … questions and finds every run.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from tabsieve.llm.common import append_columns

WORD = re.compile("[^\x20\x09-\x0d]+")
#: A run has at least this many periods, and this many words.
PERIODS, LEAST = 4, 6
#: Questions asked at a time.
QUESTIONS = 1 << 20
#: UTF-8 bytes of text looked at together.
TEXT_BYTES = 4_000_000
FIELDS = "n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"


def difference_cover(r: int) -> tuple[int, np.ndarray]:
    """(v, members): v = 24 r² + 36 r + 13, and 6 r + 4 numbers among whose differences modulo v is every number.

    The steps between the members are, in this order: r times 1, once r + 1, r times 2 r + 1, 2 r + 1 times 4 r + 3,
    r + 1 times 2 r + 2, and r times 1.
    """
    steps = [1] * r + [r + 1] + [2 * r + 1] * r + [4 * r + 3] * (2 * r + 1) + [2 * r + 2] * (r + 1) + [1] * r
    return 24 * r * r + 36 * r + 13, np.cumsum([0, *steps])


class Extensions:
    """How many words two suffixes of an array of non-negative numbers have in common."""

    def __init__(self, words: np.ndarray, r: int = 1):
        self.v, cover = difference_cover(r)
        self.size = len(words)
        v, member = self.v, np.zeros(self.v, bool)
        member[cover] = True
        #: By distance modulo v: a member of the cover such that so much further on there is another.
        self.anchor = np.empty(v, np.int64)
        for a in cover:
            self.anchor[(cover - a) % v] = a
        # behind the end stand v numbers that differ from all others and, by place, from each other
        behind = int(words.max(initial=-1)) + 1
        self.words = np.concatenate((words, np.arange(behind, behind + 2 * v))).astype(np.int32)
        blocks = np.arange(0, self.size + v, v)
        sample = (blocks[:, None] + np.sort(cover)).ravel()
        sample = sample[sample < self.size + v]  # any place before the end reaches a sampled one that is in the array
        self.number = np.full(self.size + 2 * v, -1, np.int64)
        self.number[sample] = np.arange(len(sample))
        self._sort(sample)

    def _sort(self, sample: np.ndarray) -> None:
        """Order of the sampled suffixes, and minima over the common prefixes of neighbours in it."""
        v, words, number = self.v, self.words, self.number
        m = len(sample)
        window = np.lib.stride_tricks.sliding_window_view(words, v)
        heads = np.ascontiguousarray(window[sample].astype(">i4")).view(f"V{4 * v}").ravel()
        order = np.argsort(heads, kind="stable")
        rank = np.empty(m, np.int64)
        rank[order] = np.cumsum(np.concatenate(([0], heads[order][1:] != heads[order][:-1])))
        levels, reach = [rank], v  # levels[k]: names of the first v 2^k words
        del heads
        while m and rank[order[-1]] < m - 1:
            after = sample + reach
            follow = np.where(after < self.size + v, number[np.minimum(after, self.size + v - 1)], -1)
            nxt = np.where(follow >= 0, rank[follow], -1)
            key = rank * (m + 1) + nxt + 1
            order = np.argsort(key, kind="stable")
            ordered = key[order]
            rank = np.empty(m, np.int64)
            rank[order] = np.cumsum(np.concatenate(([0], ordered[1:] != ordered[:-1])))
            levels.append(rank)
            reach *= 2
        self.rank = rank.astype(np.int32)
        a, b = sample[order[:-1]], sample[order[1:]]
        common = np.zeros(max(m - 1, 0), np.int64)
        for k in reversed(range(len(levels))):
            step, names = v << k, levels[k]
            x, y = a + common, b + common
            inside = np.maximum(x, y) < self.size + v
            at = np.flatnonzero(inside)
            same = names[number[x[at]]] == names[number[y[at]]]
            common[at[same]] += step
        common += self._compared(a + common, b + common, np.full(len(a), v))
        self.least = [common.astype(np.int32)]
        width = 1
        while 2 * width <= len(common):
            last = self.least[-1]
            self.least.append(np.minimum(last[: len(last) - width], last[width:]))
            width *= 2

    def _compared(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        """How many words from a and b on are equal, up to `most`, each less than v."""
        found = np.zeros(len(a), np.int64)
        live = np.flatnonzero(most > 0)
        step = 0
        while len(live):
            live = live[self.words[np.minimum(a[live] + step, len(self.words) - 1)] == self.words[np.minimum(b[live] + step, len(self.words) - 1)]]
            step += 1
            found[live] = step
            live = live[most[live] > step]
        return found

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words the suffixes at a and b have in common; a and b differ and lie in the array."""
        v = self.v
        until = (self.anchor[(b - a) % v] - a) % v
        found = self._compared(a, b, until)
        at = np.flatnonzero(found == until)
        x, y = self.rank[self.number[a[at] + until[at]]], self.rank[self.number[b[at] + until[at]]]
        low, high = np.minimum(x, y).astype(np.int64), np.maximum(x, y).astype(np.int64)
        power = np.frexp((high - low).astype(np.float64))[1] - 1  # high > low: the places differ
        for k in np.unique(power):
            own = np.flatnonzero(power == k)
            table = self.least[k]
            found[at[own]] += np.minimum(table[low[own]], table[high[own] - (1 << int(k))])
        return found


def grid(sizes: np.ndarray, begins: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, periods) to ask at, in parts: for every text and period p, every 3 p-th place with another p further on."""
    top = sizes // PERIODS
    texts = np.flatnonzero(top)
    ends = np.cumsum(top[texts])
    total = int(ends[-1]) if len(ends) else 0
    for first in range(0, total, QUESTIONS):  # (text, period) pairs, numbered through
        pair = np.arange(first, min(total, first + QUESTIONS))
        which = np.searchsorted(ends, pair, side="right")
        text = texts[which]
        period = pair - (ends[which] - top[text]) + 1
        stride = (PERIODS - 1) * period
        asked = (sizes[text] - period + stride - 1) // stride
        so_far = np.cumsum(asked)
        cut = 0
        while cut < len(pair):
            stop = max(cut + 1, int(np.searchsorted(so_far, (so_far[cut - 1] if cut else 0) + QUESTIONS, side="right")))
            n = asked[cut:stop]
            k = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
            p = np.repeat(period[cut:stop], n)
            yield np.repeat(begins[text[cut:stop]], n) + k * (PERIODS - 1) * p, p
            cut = stop


def runs_of(words: np.ndarray, sizes: np.ndarray, r: int = 1) -> np.ndarray:
    """All runs of some texts, one row (text, start, length, period) each, by text, start, period.

    words: the words of all texts one after the other, as numbers from 0 on; sizes: the number of words of each text.
    """
    sizes = np.asarray(sizes, np.int64)
    closed = np.cumsum(sizes) + np.arange(len(sizes))  # where each text's closing number stands
    begins = closed - sizes
    size = int(sizes.sum()) + len(sizes)
    line = np.empty(size, np.int64)
    inside = np.ones(size, bool)
    inside[closed] = False
    line[inside] = words
    line[closed] = int(words.max(initial=-1)) + 1 + np.arange(len(sizes))
    forward = backward = None
    found = [np.empty((0, 3), np.int64)]
    for place, period in grid(sizes, begins):
        equal = line[place] == line[place + period]
        place, period = place[equal], period[equal]
        # most agreements are of single words: a run has at least two more on one side
        near = np.zeros(len(place), bool)
        for side in (-1, 1):
            near |= line[np.clip(place + side, 0, size - 1)] == line[np.clip(place + period + side, 0, size - 1)]
        place, period = place[near], period[near]
        if not len(place):
            continue
        if forward is None:
            forward, backward = Extensions(line, r), Extensions(line[::-1], r)
        right = forward.common(place, place + period)
        left = backward.common(size - 1 - place, size - 1 - place - period) - 1
        length = left + right + period
        good = length >= np.maximum(LEAST, PERIODS * period)
        rows = np.stack((place - left, length, period), axis=1)[good]
        found.append(np.unique(rows, axis=0) if len(rows) else rows)
    rows = np.unique(np.concatenate(found), axis=0)
    # a stretch is found under its smallest period and under multiples of that: the smallest comes first
    keep = np.ones(len(rows), bool)
    keep[1:] = (rows[1:, :2] != rows[:-1, :2]).any(axis=1)
    rows = rows[keep]
    text = np.searchsorted(closed, rows[:, 0], side="left")
    rows = np.column_stack((text, rows[:, 0] - begins[text] if len(rows) else rows[:, 0], rows[:, 1:]))
    return rows[np.lexsort((rows[:, 3], rows[:, 1], rows[:, 0]))]


def numbered(lists: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
    """(a number for each word of all texts, the number of words of each text)."""
    sizes = np.fromiter(map(len, lists), np.int64, len(lists))
    flat = pa.array([w for words in lists for w in words], pa.large_string())
    return pc.dictionary_encode(flat).indices.to_numpy().astype(np.int64), sizes


def digests(words: list[str], runs: list[tuple[int, int, int]]) -> tuple:
    """One row of FIELDS for a text and its runs (start, length, period) by start, then period."""
    best = min(runs, key=lambda x: (-x[1], x[0], x[2]), default=None)
    largest = (None,) * 4 if best is None else (*best, 1000 * best[1] // best[2])
    listed = "".join(f"{start},{length},{period}\n" for start, length, period in runs)
    return (len(runs), *largest, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(collapsed(words, runs).encode()).hexdigest())


def _by_text(rows: np.ndarray, texts: int) -> list[list[tuple[int, int, int]]]:
    cuts = np.searchsorted(rows[:, 0], np.arange(texts + 1))
    return [[tuple(x) for x in rows[a:b, 1:].tolist()] for a, b in zip(cuts, cuts[1:])]


def find_runs(df: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """df with `runs`, the (start, length, period) of every run of a text by start and period, and `collapsed`.

    A run is a stretch of words with smallest period q that no neighbouring word extends, of at least max(6, 4 q) words.
    collapsed: the words joined by blanks, without those that a run holds after its first q words.  Null, empty and
    blank texts have no runs and collapse to the empty text; every row is looked at as a whole and by itself, an empty
    table gives an empty one, columns of the two names are replaced.  Memory grows with the longest text, not with the
    table: about 100 bytes a word.
    """

    def make() -> Callable:
        def work(texts: list[str | None]) -> list[list]:
            lists = [WORD.findall(t) if t else [] for t in texts]
            found = _by_text(runs_of(*numbered(lists)), len(lists))
            return [[[dict(zip(("start", "length", "period"), x)) for x in runs] for runs in found], [collapsed(w, runs) for w, runs in zip(lists, found)]]

        return work

    return append_columns(df, text, "runs array<struct<start: long, length: long, period: long>>, collapsed string", make, keep, most=TEXT_BYTES)


def collapsed(words: list[str], runs: list[tuple[int, int, int]]) -> str:
    """The words without those that a run holds after its first period, joined by blanks."""
    if not runs:
        return " ".join(words)
    drop = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        drop[start + period] += 1
        drop[start + length] -= 1
    return " ".join([w for w, d in zip(words, np.cumsum(drop).tolist()) if not d])


def run_digests(df: DataFrame, text: str = "text", keep: list[str] | None = None, key: str | None = None, rearranged: Callable | None = None) -> DataFrame:
    """df with FIELDS: the number of runs, the longest of them (ties: smallest start, then period), and digests.

    runs_sha256 is over a line `start,length,period` for each run, collapsed_sha256 over the collapsed text; both are
    never null, the four numbers of the longest run are null without one.  rearranged(value of the column `key`, number
    of words) may give the numbers of the words to take instead, in their order, or None for the words as they are.
    Other cases are as in find_runs.
    """

    def make() -> Callable:
        def work(texts: list[str | None], keys: list | None = None) -> list[list]:
            lists = [WORD.findall(t) if t else [] for t in texts]
            for i, value in enumerate(keys or ()):
                if rearranged and (order := rearranged(value, len(lists[i]))) is not None:
                    lists[i] = list(map(lists[i].__getitem__, order))
            found = _by_text(runs_of(*numbered(lists)), len(lists))
            return [list(x) for x in zip(*map(digests, lists, found))]

        return work

    return append_columns(df, text, FIELDS, make, keep, beside=key, most=TEXT_BYTES)
