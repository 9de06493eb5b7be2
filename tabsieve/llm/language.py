"""Language identification by cross-parsing entropy.

A suffix automaton of a sample of each language gives, from any place of a text, the longest match with that sample.
A text is parsed greedily into such longest matches; the language whose sample needs the fewest phrases wins.  Phrases
are normalised to bits per character, phrases * log2(sample length) / text length, so samples may differ in length.

All languages lie in one table of transitions, and all texts of a batch are walked side by side, one character a step.
Every letter of the samples has a symbol of its own: the most frequent ones a column of the table, the others sorted
pairs of state and symbol.  A long text is walked as pieces of SEGMENT characters at once, each as if a phrase began with
it; then the parse that truly arrives at a piece is followed until both are in one state, from where on they are one.  So
the counts are those of whole texts, however long.
"""

from __future__ import annotations

import uuid
from array import array
from collections import Counter
from functools import lru_cache

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabsieve.llm.common import append_columns, quoted, resident

UNKNOWN = "und"
SEGMENT = 512
GAP, BREAK, UNSEEN = 0, 1, 2  # between words; between sampled texts; letters of no sample
COLUMNS = 64  # symbols below have a column of the table, all but the last of them
END = -1  # marks the ends of texts within a batch


@lru_cache(maxsize=1)
def _letters() -> tuple[np.ndarray, np.ndarray]:
    """For each code point: whether it is a letter, and its lower case where that is one code point."""
    lower = np.arange(0x110000, dtype=np.uint32)
    letter = np.zeros(0x110000, bool)
    for i in range(0x110000):
        c = chr(i)
        if c.isalpha():
            letter[i] = True
            if len(x := c.lower()) == 1:
                lower[i] = ord(x)
    return letter, lower


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def suffix_automaton(symbols: list[int]) -> list[dict[int, int]]:
    """The transitions of each state; state 0 is the root, no transition leads to it."""
    moves: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in symbols:
        new, p = len(moves), last
        moves.append({})
        length.append(length[last] + 1)
        link.append(0)
        while p >= 0 and c not in moves[p]:
            moves[p][c] = new
            p = link[p]
        if p >= 0:
            q = moves[p][c]
            if length[p] + 1 == length[q]:
                link[new] = q
            else:
                twin = len(moves)
                moves.append(dict(moves[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and moves[p].get(c) == q:
                    moves[p][c] = twin
                    p = link[p]
                link[q] = link[new] = twin
        last = new
    return moves


class CrossParser:
    """Counts the phrases that texts need under each language's sample."""

    def __init__(self, samples: dict[str, list[str]]):
        self.languages = sorted(samples)
        letter, lower = _letters()
        points = {name: [_points(t) for t in sorted(samples[name])] for name in self.languages}
        seen: Counter[int] = Counter()
        for texts in points.values():
            for x in texts:
                values, counts = np.unique(lower[x[letter[x]]], return_counts=True)
                seen.update(dict(zip(values.tolist(), counts.tolist())))
        own = sorted(sorted(seen), key=lambda c: -seen[c])
        self.symbols = 3 + len(own)
        by_letter = np.full(0x110000, UNSEEN, np.int32)
        by_letter[own] = 3 + np.arange(len(own))
        self.symbol = np.where(letter, by_letter[lower], GAP).astype(np.int32)
        self.root, self.dead, self.bits, offset = [], [], [], 1
        # an automaton has at most two states a symbol; rows that stay empty take no memory
        rows = sum(2 + sum(2 * len(x) + 2 for x in texts) for texts in points.values())
        moves_of = np.zeros((1 + rows, COLUMNS), np.int32)
        rare, rare_to = array("q"), array("q")
        for name in self.languages:
            symbols: list[int] = []
            for x in points[name]:
                symbols += [*self._squeezed(self.symbol[x]).tolist(), BREAK]
            moves = suffix_automaton(symbols)
            part = moves_of[offset : offset + len(moves) + 1]  # the last state has no way on: a phrase of one unseen letter
            for state, to in enumerate(moves):
                for c, target in to.items():
                    if c >= COLUMNS - 1:
                        rare.append((offset + state) * self.symbols + c)
                        rare_to.append(offset + target)
                    elif c != BREAK:
                        part[state, c] = offset + target
            self.root.append(offset)
            self.dead.append(offset + len(moves))
            self.bits.append(np.log2(max(2, len(symbols))))
            offset += len(part)
        self.moves = moves_of[:offset].ravel()
        keys = np.array(rare, np.int64)
        order = np.argsort(keys)
        # a last entry that no key reaches
        self.rare = np.append(keys[order], np.iinfo(np.int64).max)
        self.rare_to = np.append(np.array(rare_to, np.int64)[order], 0)
        every = np.arange(self.symbols)
        start = np.stack([self._step(np.full(self.symbols, root), every) for root in self.root]) if self.languages else np.zeros((0, self.symbols), np.int64)
        self.start = np.where(start == 0, np.array(self.dead, np.int64).reshape(-1, 1), start).astype(np.int32)

    def _step(self, state: np.ndarray, c: np.ndarray) -> np.ndarray:
        """The state that symbol c leads to, 0 for none; the last axis is that of c."""
        to = self.moves.take(state * COLUMNS + np.minimum(c, COLUMNS - 1)).astype(np.int64)
        at = np.flatnonzero(c >= COLUMNS - 1)
        if len(at):
            keys = state[..., at] * self.symbols + c[at]
            near = np.searchsorted(self.rare, keys)
            to[..., at] = np.where(self.rare[near] == keys, self.rare_to[near], 0)
        return to

    @staticmethod
    def _squeezed(x: np.ndarray) -> np.ndarray:
        """One gap for a run of gaps, none at the ends."""
        gap = x == GAP
        x = x[~(gap & np.concatenate(([True], gap[:-1])))]
        return x[:-1] if len(x) and x[-1] == GAP else x

    def phrases(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(phrases by text and language, characters by text); characters are letters and single gaps."""
        joined = _points("\0".join(t.replace("\0", " ") if t else "" for t in texts) + "\0")
        x = np.where(joined == 0, END, self.symbol[joined]).astype(np.int32)
        before = np.concatenate(([END], x[:-1]))
        after = np.concatenate((x[1:], [END]))
        x = x[~((x == GAP) & ((before == GAP) | (before == END)))]
        ends = np.flatnonzero(x == END)
        del before, after
        begins = np.concatenate(([0], ends[:-1] + 1))
        ends = ends - ((ends > begins) & (x[np.maximum(ends - 1, 0)] == GAP))
        length = ends - begins
        pieces = -(-length // SEGMENT)
        owner = np.repeat(np.arange(len(texts)), pieces)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        first = begins[owner] + nth * SEGMENT
        size = np.minimum(SEGMENT, ends[owner] - first)
        counts = np.zeros((len(self.languages), len(owner)), np.int32)
        last = np.zeros((len(self.languages), len(owner)), np.int32)
        order = np.argsort(-size, kind="stable")
        for k in range(0, len(order), 20_000):
            some = order[k : k + 20_000]
            counts[:, some], last[:, some] = self._walk(x, first[some], size[some])
        self._rejoin(x, first, size, nth > 0, counts, last)
        total = np.zeros((len(texts), len(self.languages)), np.int64)
        for lang in range(len(self.languages)):
            total[:, lang] = np.bincount(owner, counts[lang], len(texts)).astype(np.int64)
        return total, length

    def _walk(self, x: np.ndarray, first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Phrases and last state by language and piece, the first phrase beginning with the piece; longest pieces first."""
        counts = np.ones((len(self.languages), len(first)), np.int64)
        state = self.start[:, x[first]].astype(np.int64)
        active = np.searchsorted(-size, -np.arange(int(size[0])), side="left")  # pieces longer than t
        for t in range(1, int(size[0])):
            n = active[t]
            c = x[first[:n] + t]
            to = self._step(state[:, :n], c)
            stuck = to == 0
            counts[:, :n] += stuck
            state[:, :n] = np.where(stuck, self.start[:, c], to)
        return counts, state

    def _rejoin(self, x: np.ndarray, first: np.ndarray, size: np.ndarray, continued: np.ndarray, counts: np.ndarray, last: np.ndarray) -> None:
        """Turns counts of pieces that each begin a phrase into those of the texts' own parses.

        A piece is done again when the state changes that the piece before it ends in, so the last round changes none.
        """
        alone, alone_last = counts.copy(), last.copy()
        lang, piece = (i.ravel() for i in np.meshgrid(np.arange(len(self.languages)), np.flatnonzero(continued), indexing="ij"))
        while len(piece):
            more, end, met = self._follow(x, first[piece], size[piece], lang, last[lang, piece - 1].astype(np.int64))
            counts[lang, piece] = alone[lang, piece] + more
            end = np.where(met, alone_last[lang, piece], end)
            changed = end != last[lang, piece]
            last[lang, piece] = end
            lang, piece = lang[changed], piece[changed] + 1
            inside = piece < len(continued)
            lang, piece = lang[inside], piece[inside]
            lang, piece = lang[continued[piece]], piece[continued[piece]]

    def _follow(self, x: np.ndarray, first: np.ndarray, size: np.ndarray, lang: np.ndarray, state: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Walks pieces from the states that arrive at them, beside walks that begin a phrase, until both are in one state.

        By piece: phrases begun by the first walk less those of the second, its last state, whether they met.
        """
        more, end, met = np.zeros(len(first), np.int64), state.copy(), np.zeros(len(first), bool)
        at, other = np.arange(len(first)), np.zeros(len(first), np.int64)  # state 0 leads nowhere: a phrase begins
        for t in range(int(size.max())):
            c = x[first[at] + t]
            fresh = self.start[lang[at], c]
            to, beside = self._step(state, c), self._step(other, c)
            more[at] += (to == 0).astype(np.int64) - (beside == 0)
            state, other = np.where(to == 0, fresh, to), np.where(beside == 0, fresh, beside)
            same, over = state == other, size[at] == t + 1
            met[at[same]] = True
            end[at[over]] = state[over]
            on = ~(same | over)
            at, state, other = at[on], state[on], other[on]
            if not len(at):
                break
        return more, end, met

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """Language and margin: by how much the best needs fewer bits than the second, 0 (as many) to 1 (or no second)."""
        if not self.languages:
            return [UNKNOWN] * len(texts), [0.0] * len(texts)
        phrases, length = self.phrases(texts)
        bits = phrases * np.array(self.bits) / np.maximum(length, 1)[:, None]
        best = bits.argmin(axis=1)
        ordered = np.sort(bits, axis=1)
        margin = 1 - ordered[:, 0] / np.maximum(ordered[:, 1], 1e-12) if len(self.languages) > 1 else np.ones(len(texts))
        return [self.languages[b] if n else UNKNOWN for b, n in zip(best.tolist(), length.tolist())], np.where(length > 0, np.clip(margin, 0, 1), 0.0).tolist()


def language_samples(df: DataFrame, text: str = "text", lang: str = "lang", rows: int = 24, longest: int = 4_000, total: int = 600_000) -> dict[str, list[str]]:
    """The sample that the automata are built of: at most `rows` texts a language, each of at most `longest` characters.

    One text for each of `rows` hash buckets: that of the smallest hash, texts of 200 to `longest` characters before
    others, of which an excerpt is taken.  Rows without text, letters or language are left out.  With many languages
    each gets total / languages characters at most, so the whole sample is bounded whatever the input.
    """
    known = df.select(quoted(text).cast("string").alias("t"), quoted(lang).cast("string").alias("l")).where("l IS NOT NULL AND t RLIKE '\\\\p{L}'")
    h = F.xxhash64("t")
    fits = F.length("t").between(200, longest)
    keyed = known.select("t", "l", F.pmod(h, F.lit(rows)).alias("b"), F.shiftrightunsigned(h, 2).alias("h"), fits.alias("fits"))
    keyed = keyed.withColumn("v", F.col("h") + F.when(F.col("fits"), 0).otherwise(F.lit(1 << 62))).select("t", "l", "b", "v")
    chosen = keyed.groupBy("l", "b").agg(F.min("v").alias("v"))
    # as many rows as buckets and languages, like the texts read below: so the texts need no shuffle
    found = keyed.join(F.broadcast(chosen), ["l", "b", "v"]).groupBy("l", "b").agg(F.min(F.substring("t", 1, longest)).alias("t")).collect()
    texts: dict[str, list[str]] = {}
    for r in sorted(found, key=lambda r: (r.l, r.b)):
        texts.setdefault(r.l, []).append(r.t)
    for own in texts.values():
        room = total // len(texts)
        for i, t in enumerate(own):
            own[i], room = t[:room], room - len(t[:room])
    return {name: [t for t in own if t] for name, own in texts.items()}


def identify_language(df: DataFrame, samples: dict[str, list[str]], text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """df with lang_pred and score.

    lang_pred is a language of the samples, `und` for a null, empty or letterless text (score 0.0) or without samples;
    ties go to the language first in order.  Equal texts get equal answers; an input column of these names is replaced.
    """
    shared = df.sparkSession.sparkContext.broadcast(samples)  # bounded, see language_samples
    key = ("language", uuid.uuid4().hex)

    def make():
        return resident(key, lambda: CrossParser(shared.value)).predict

    return append_columns(df, text, "lang_pred string, score double", make, keep)


def held_out(key: Column, folds: int = 5) -> Column:
    """Whether a row is held out from learning; a null key is not."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % folds == 0, F.lit(False))
