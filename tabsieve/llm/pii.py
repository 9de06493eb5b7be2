"""Personal data: fixed patterns, and a linear-chain conditional random field over word shapes.

The patterns give the base spans.  The model adds what patterns miss: addresses written out, national phone numbers,
identity numbers and names behind a cue.  It knows a word by its shape (or as one of a few cue words) and the shapes of
three neighbours to either side; weights and transitions are trained by maximum likelihood on the small table of
pii_examples.  Texts are decoded by Viterbi, all sequences of a batch side by side.

A sequence is a line; one of more than LONGEST words is walked in pieces, whose best chain is that of the whole line.
"""

from __future__ import annotations

import hashlib
import re
import string
import uuid
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame

from tabsieve.llm.common import append_columns, resident
from tabsieve.llm.pii_examples import examples

#: The order of spans.
KINDS = ("email", "ip", "card", "phone", "name", "id")
FOUND = ("email", "phone", "name", "id")  # by the model
LABELS = ("O", *(f"{at}-{kind}" for kind in FOUND for at in "BI"))
LONGEST = 512
REACH = 3
REMEMBERED = 300_000

DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
WORD = re.compile(r"\n|[^\W\d_]+|\d+|[^\w\s]|_")
LOCAL = frozenset(string.ascii_letters + string.digits + "._%+-")
DIGITS = re.compile("[0-9]")
NOT_DIGITS = str.maketrans("", "", " ().+-")

# Words that a label may hang on.
CUES = frozenset("""at dot call phone tel telephone fax mobile ring whatsapp telefon handy rufnummer erreichbar unter teléfono tfno móvil
téléphone tél portable appelez llame rufen number nummer número numéro no nr ssn iban passport pasaporte passeport reisepass ausweis dni nif
steuernummer social security tax license licence insurance account name named nom nombre llamo heiße signed patient customer dear
mr mrs ms miss dr prof herr herrn frau sr sra señor señora don doña m mme mlle monsieur madame mail email correo contact reach write
is ist es est me us on my""".split())


ABBREVIATED = frozenset("mr mrs ms dr prof sr sra m tel tfno tél".split())


def luhn(digits: str) -> bool:
    total = sum(int(d) if i % 2 == 0 else (2 * int(d) - 9 if d > "4" else 2 * int(d)) for i, d in enumerate(reversed(digits)))
    return total % 10 == 0


def base_spans(text: str | None) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points: leftmost, not overlapping within a kind, in order of kind and start.

    Every match of the email pattern holds one @, so it is enough to look to either side of each; a run of characters
    is looked at once.
    """
    found: list[tuple[str, int, int]] = []
    if not text:
        return found
    at, free = text.find("@"), 0
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        if start < at and (m := DOMAIN.match(text, at)):
            found.append(("email", start, m.end()))
            free = m.end()
        at = text.find("@", max(at + 1, free))
    if DIGITS.search(text):
        if "." in text:
            found += [("ip", *m.span()) for m in IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split("."))]
        for m in CARD.finditer(text):
            if 13 <= m.end() - m.start():
                digits = m[0].translate(NOT_DIGITS)
                if 13 <= len(digits) <= 19 and luhn(digits):
                    found.append(("card", *m.span()))
        if "+" in text:
            found += [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= len(m[0].translate(NOT_DIGITS)) <= 15]
    return found


def shape(word: str) -> str:
    if word.isdecimal():
        return f"9{min(len(word), 12)}"
    if word[0].isalpha():
        low = word.lower()
        if low in CUES:
            return low + ("^" if word[0] != low[0] else "")
        if word.islower():
            return "a" if len(word) > 1 else "a1"
        if word.isupper():
            return f"A{min(len(word), 3)}"
        return "x" if word == low else "Aa" if word[0].isupper() and word[1:].islower() else "aA"
    return word if word in string.punctuation or word == "\n" else "?"


@lru_cache(maxsize=1)
def _shapes() -> dict[str, int]:
    known = ["\n", "cue.", "cue:", "?", "x", "a", "a1", "A1", "A2", "A3", "Aa", "aA", *(f"9{n}" for n in range(1, 13)), *string.punctuation, *sorted(CUES), *(c + "^" for c in sorted(CUES))]
    return {s: i for i, s in enumerate(dict.fromkeys(known))}


@lru_cache(maxsize=1)
def _marks() -> list[tuple[int, int, np.ndarray]]:
    """(mark, its shape behind such a cue, whether a shape is such a cue)."""
    known = _shapes()
    return [(known[mark], known["cue" + mark], np.array([s.rstrip("^") in cues for s in known])) for mark, cues in ((".", ABBREVIATED), (":", CUES))]


def linked(ids: np.ndarray) -> np.ndarray:
    """The shapes of words in their order; a stop behind an abbreviation and a colon behind a cue have their own."""
    out = ids.copy()
    for mark, own, cues in _marks():
        out[(ids == mark) & np.concatenate(([False], cues[ids[:-1]]))] = own
    return out


def trimmed_span(kind: str, span: str) -> str:
    """Without marks at the end; a name does not end with a word in small letters either."""
    span = span.rstrip(" .,;:!?")
    while kind == "name" and (m := re.search(r"\s+[^\W\d_]+$", span)) and m[0].strip().islower():
        span = span[: m.start()].rstrip(" .,;:!?")
    return span


def plausible(kind: str, text: str, start: int, end: int) -> bool:
    """What a span of the model must have besides, judged by its own characters; no span begins or ends within a word."""
    span, digits = text[start:end], sum(c.isdigit() for c in text[start:end])
    if (start and text[start - 1].isalnum() and span[0].isalnum()) or (span[-1].isalnum() and text[end : end + 1].isalnum()):
        return False
    if kind == "phone":
        return 7 <= digits <= 15 and not re.search(r"[^\d\s()./+-]", span)
    if kind == "id":
        return digits >= 6 and not re.search(r"[^\w \-/.]", span)
    if kind == "email":
        return bool(re.search(r"@|\bat\b", span, re.I) and (re.search(r"\bdot\b", span, re.I) or re.search(r"\w\.\w", span)) and not re.search(r"\.\s", span))
    return len(span.split()) <= 5 and span[0].isupper() and not re.search(r"\w\w\.\s|[^\w .'-]", span)


class Crf:
    """Weights by offset and shape, transitions and starts; labels are LABELS."""

    def __init__(self, weights: np.ndarray, moves: np.ndarray, start: np.ndarray):
        self.weights, self.moves, self.start = weights, moves, start
        self.known: dict[str, int] = {}

    def ids(self, words: list[str]) -> list[int]:
        known = self.known
        if len(known) > REMEMBERED:
            known.clear()
        shapes = _shapes()
        for w in set(words).difference(known):
            known[w] = shapes[shape(w)]
        return list(map(known.__getitem__, words))

    def scores(self, ids: np.ndarray) -> np.ndarray:
        """One row of label scores for each word; what lies outside counts as a line end."""
        wide = np.concatenate((np.zeros(REACH, ids.dtype), ids, np.zeros(REACH, ids.dtype)))
        total = self.weights[0].take(wide[: len(ids)], axis=0)
        for k in range(1, 2 * REACH + 1):
            total += self.weights[k].take(wide[k : k + len(ids)], axis=0)
        return total

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """The best label of each word; line ends part the sequences.

        A later piece of a long line is walked once from each label that the piece before may end with; the best chain
        of pieces is then that of the whole line.
        """
        labels = np.zeros(len(ids), np.uint8)
        edges = np.flatnonzero(ids == 0)
        begin = np.concatenate(([0], edges + 1))
        size = np.concatenate((edges, [len(ids)])) - begin
        pieces = -(-size // LONGEST)
        nth = np.arange(int(pieces.sum())) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        begin, size = np.repeat(begin, pieces) + nth * LONGEST, np.minimum(LONGEST, np.repeat(size, pieces) - nth * LONGEST)
        if not len(begin):
            return labels
        n_labels = len(LABELS)
        walks = np.where(nth > 0, n_labels, 1)
        head = np.cumsum(walks) - walks  # the first walk of each piece
        entry = np.arange(int(walks.sum())) - np.repeat(head, walks)
        piece = np.repeat(np.arange(len(begin)), walks)
        order = np.argsort(-size[piece], kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        first, length = begin[piece][order], size[piece][order]
        scores = self.scores(ids)
        best = scores[first] + np.where((nth[piece] > 0)[order, None], self.moves[entry[order]], self.start)
        active = np.searchsorted(-length, -np.arange(int(length[0])), side="left")
        back = [np.zeros((0, n_labels), np.uint8)]
        for t in range(1, int(length[0])):
            n = active[t]
            last, top = np.zeros((n, n_labels), np.uint8), best[:n, :1] + self.moves[0]
            for k in range(1, n_labels):
                other = best[:n, k : k + 1] + self.moves[k]
                better = other > top
                last[better] = k
                np.maximum(top, other, out=top)
            back.append(last)
            best[:n] = top + scores[first[:n] + t]
        final = best.argmax(axis=1)
        chosen, state = place[head], final[place[head]].astype(np.int64)
        for i in np.flatnonzero((nth == 0) & (np.append(nth[1:], 0) == 1)).tolist():
            row, came, j = best[chosen[i]].astype(np.float64), [], i + 1
            while j < len(nth) and nth[j]:
                ways = row[:, None] + best[place[head[j] : head[j] + n_labels]]
                came.append(ways.argmax(axis=0))
                row, j = ways.max(axis=0), j + 1
            label = int(row.argmax())
            for j in range(j - 1, i, -1):
                state[j], label = label, int(came[j - i - 1][label])
                chosen[j] = place[head[j] + label]
            state[i] = label
        by_size = np.argsort(chosen)
        chosen, state = chosen[by_size], state[by_size]
        first, length = first[chosen], length[chosen]
        active = np.searchsorted(-length, -np.arange(int(length[0])), side="left")
        for t in range(int(length[0]) - 1, -1, -1):
            n = active[t]
            labels[first[:n] + t] = state[:n]
            if t:
                state[:n] = back[t][chosen[:n], state[:n]]
        return labels

    def spans(self, texts: list[str | None]) -> list[list[tuple[str, int, int]]]:
        words = [[*WORD.findall(t), "\n"] if t else ["\n"] for t in texts]
        sizes = np.array([len(w) for w in words])
        ids = np.concatenate([np.array(self.ids(w), np.int64) for w in words]) if words else np.zeros(0, np.int64)
        labels = self.decode(linked(ids))
        first = np.cumsum(sizes) - sizes
        found: list[list[tuple[str, int, int]]] = [[] for _ in texts]
        for i in np.unique(np.searchsorted(first, np.flatnonzero(labels), side="right") - 1).tolist():
            open_kind, start, end = "", 0, 0
            for m, label in zip(WORD.finditer(texts[i]), labels[first[i] : first[i] + sizes[i] - 1].tolist()):
                at, _, kind = LABELS[label].partition("-")
                if open_kind and (at != "I" or kind != open_kind):
                    found[i].append((open_kind, start, end))
                    open_kind = ""
                if at != "O":
                    if not open_kind:
                        open_kind, start = kind, m.start()
                    end = m.end()
            if open_kind:
                found[i].append((open_kind, start, end))
        trimmed = [[(k, a, a + len(trimmed_span(k, t[a:b]))) for k, a, b in own] if own else own for t, own in zip(texts, found)]
        return [[x for x in own if x[1] < x[2] and plausible(x[0], t, x[1], x[2])] if own else own for t, own in zip(texts, trimmed)]


def marked(line: str) -> tuple[list[str], list[int]]:
    """Words and label numbers of a line of pii_examples."""
    words, labels = [], []
    for part in re.split(r"(\[(?:%s) (?:\[ \w+ \]|[^\[\]])*\])" % "|".join(FOUND), line):
        m = re.fullmatch(r"\[(\w+) (.*)\]", part)
        kind = m[1] if m and m[1] in FOUND else ""
        own = WORD.findall(m[2] if kind else part)
        words += own
        labels += [LABELS.index(f"{'I' if i else 'B'}-{kind}") if kind else 0 for i in range(len(own))]
    return words, labels


def train(lines: list[str], rounds: int = 90, rate: float = 0.15, penalty: float = 1e-4, caution: float = 0.0) -> Crf:
    """Maximum likelihood by Adam over all lines at once; the gradient by forward and backward sums.

    caution: what a word outside gets on top, in nats, so that doubtful words stay outside.
    """
    shapes, n = _shapes(), len(LABELS)
    pairs = sorted((p for p in map(marked, lines) if p[0]), key=lambda p: -len(p[0]))
    size = np.array([len(w) for w, _ in pairs])
    steps, count = int(size[0]), len(pairs)
    wide = np.zeros((count, steps + 2 * REACH), np.int64)
    gold_of = np.zeros((count, steps), np.int64)
    for i, (words, labels) in enumerate(pairs):
        wide[i, REACH : REACH + len(words)] = linked(np.array([shapes[shape(w)] for w in words]))
        gold_of[i, : len(labels)] = labels
    # word by word: step t of all lines that have one, the longest line first
    active = np.array([int((size > t).sum()) for t in range(steps)])
    begin = np.cumsum(active) - active
    line, step_of = np.concatenate([np.arange(a) for a in active]), np.repeat(np.arange(steps), active)
    near = [wide[line, step_of + k] for k in range(2 * REACH + 1)]
    gold = np.eye(n)[gold_of[line, step_of]]
    last = begin[size - 1] + np.arange(count)
    weights, moves, start = np.zeros((2 * REACH + 1, len(shapes), n)), np.zeros((n, n)), np.zeros(n)
    moved = sum((gold[begin[t - 1] : begin[t - 1] + active[t]].T @ gold[begin[t] : begin[t] + active[t]] for t in range(1, steps)), np.zeros((n, n)))
    params, m1, m2 = [weights, moves, start], [0.0] * 3, [0.0] * 3

    def summed(x: np.ndarray, axis: int) -> np.ndarray:
        top = x.max(axis=axis, keepdims=True)
        return np.log(np.exp(x - top).sum(axis=axis)) + top.squeeze(axis)

    for step in range(1, rounds + 1):
        score = sum(weights[k].take(near[k], axis=0) for k in range(2 * REACH + 1))
        ahead, behind, met = score.copy(), np.zeros_like(score), np.zeros((n, n))
        ahead[:count] += start
        for t in range(1, steps):
            own = slice(begin[t], begin[t] + active[t])
            ahead[own] += summed(ahead[begin[t - 1] : begin[t - 1] + active[t], :, None] + moves, 1)
        whole = summed(ahead[last], 1)
        for t in range(steps - 1, 0, -1):
            own, before = slice(begin[t], begin[t] + active[t]), slice(begin[t - 1], begin[t - 1] + active[t])
            x = moves + (score[own] + behind[own])[:, None, :]
            behind[before] = summed(x, 2)
            met += np.exp(x + ahead[before, :, None] - whole[: active[t], None, None]).sum(axis=0)
        share = np.exp(ahead + behind - whole[line, None])
        error = gold - share
        grads = [np.zeros_like(weights), moved - met, error[:count].sum(axis=0)]
        for k in range(2 * REACH + 1):
            for label in range(n):
                grads[0][k][:, label] = np.bincount(near[k], error[:, label], len(shapes))
        for i, (p, g) in enumerate(zip(params, grads)):
            g = g / count - penalty * p
            m1[i], m2[i] = 0.9 * m1[i] + 0.1 * g, 0.999 * m2[i] + 0.001 * g * g
            p += rate * (m1[i] / (1 - 0.9**step)) / (np.sqrt(m2[i] / (1 - 0.999**step)) + 1e-8)
    moves = moves.copy()
    for kind in FOUND:  # an inside needs its own beginning
        allowed = {LABELS.index(f"B-{kind}"), LABELS.index(f"I-{kind}")}
        moves[[i for i in range(n) if i not in allowed], LABELS.index(f"I-{kind}")] = -1e6
        start[LABELS.index(f"I-{kind}")] = -1e6
    weights[REACH][:, 0] += caution
    return Crf(weights.astype(np.float32), moves.astype(np.float32), start.astype(np.float32))


@lru_cache(maxsize=1)
def default_model() -> Crf:
    return train(examples())


def all_spans(base: list[tuple[str, int, int]], added: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """The base spans and those of the model that overlap none of them, by kind and start."""
    order = sorted((s, e) for _, s, e in base)
    free, at, reach = [], 0, 0
    for kind, start, end in sorted(added, key=lambda x: x[1:]):
        while at < len(order) and order[at][0] < end:
            reach, at = max(reach, order[at][1]), at + 1
        if reach <= start:
            free.append((kind, start, end))
    return sorted([*base, *free], key=lambda x: (KINDS.index(x[0]), x[1], x[2]))


def written_spans(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def masked(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with [KIND] in the place of each span; overlapping spans become one, of the kind that starts first."""
    parts, at = [], 0
    for kind, start, end in sorted(spans, key=lambda x: (x[1], -x[2])):
        if start >= at:
            parts += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join(parts) + text[at:]


def find_personal_data(df: DataFrame, text: str = "text", keep: list[str] | None = None, mask: bool = False) -> DataFrame:
    """df with n_email, n_ip, n_card, n_phone, base_sha256, spans, n_spans and, with `mask`, masked.

    The counts and base_sha256 are of the base spans, spans of all.  Null and empty texts have no spans; a null stays
    null when masked.  An input column of these names is replaced.
    """
    shared = df.sparkSession.sparkContext.broadcast(default_model())  # some 100 shapes by 9 labels
    key = ("crf", uuid.uuid4().hex)

    def make():
        model = resident(key, lambda: Crf(shared.value.weights, shared.value.moves, shared.value.start))

        def work(texts: list[str | None]) -> list[list]:
            rows = []
            for t, added in zip(texts, model.spans(texts)):
                base = base_spans(t)
                spans = all_spans(base, added)
                counts = [sum(k == kind for k, _, _ in base) for kind in KINDS[:4]]
                rows.append((*counts, hashlib.sha256(written_spans(base).encode()).hexdigest(), written_spans(spans), len(spans), masked(t, spans) if mask and t is not None else None))
            return [list(x) for x in zip(*rows)][: None if mask else 7]

        return work

    fields = "n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_spans long" + ", masked string" * mask
    return append_columns(df, text, fields, make, keep)
