"""BPE with word ends, encoded over a trie of distinct words and decoded again.

Two facts make this exact: an encoding is right if and only if every two neighbours in it stay apart when merged on their
own, and every prefix of a word has exactly one right encoding.  So a node of the trie needs one state, the last token
of its prefix, and each of its words needs one more step for the end.  The distinct words of a slice of texts are sorted,
which is the trie in depth-first order: a word begins with as many nodes as it shares with the word before it, and their
states are still on the stack; only the nodes below are computed.  No prefix is computed twice.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from array import array
from collections.abc import Callable, Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tabsieve.llm.common import append_columns, quoted, resident

#: Encodings of words, and answers on pairs of tokens, that a worker keeps at a time; longer words are not kept.
REMEMBERED, LONGEST_KEPT = 1_000_000, 40
#: UTF-8 bytes of text encoded at a time.
TEXT_BYTES = 6_000_000
#: Not of the letters up to U+024F, which no normal form changes and which Python takes to lower case as the library does.
BEYOND = re.compile("[^\x00-\u024f]")


class WordBpe:
    """A BPE vocabulary whose tokens at the end of a word carry a suffix, and its merges, the first to be done first."""

    def __init__(self, vocab: dict[str, int], merges: Iterable[tuple[str, str]], suffix: str):
        self.vocab, self.suffix = vocab, suffix
        #: (left, right) to (when it is merged, what it makes), and for each token the merge that makes it.
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        self.made: dict[int, tuple[int, int, int]] = {}
        for time, (a, b) in enumerate(merges):
            left, right, whole = vocab[a], vocab[b], vocab[a + b]
            self.merges[left, right] = time, whole
            if self.made.setdefault(whole, (time, left, right))[0] != time:
                raise ValueError(f"two merges make the token {a + b!r}")
        for time, left, right in self.made.values():
            if any(self.made.get(part, (-1,))[0] >= time for part in (left, right)):
                raise ValueError("a merge comes before the merges that make its parts")
        self.apart: dict[tuple[int, int], bool] = {}
        sound = {t for t in vocab.values() if self._stays(t)}
        cut = len(suffix)
        self.final = {word[:-cut]: t for word, t in vocab.items() if t in sound and word.endswith(suffix)}
        #: Every beginning of a token, and which token it is itself, or -1.
        self.begun: dict[str, int] = {}
        for word, token in vocab.items():
            ends = word.endswith(suffix)
            word = word[:-cut] if ends else word
            for end in range(1, len(word)):
                self.begun.setdefault(word[:end], -1)
            if token in sound and not ends:
                self.begun[word] = token
            else:
                self.begun.setdefault(word, -1)

    def _spine(self, token: int, side: int) -> Iterator[tuple[int, int]]:
        """What stands at that border (1 left, 2 right) of the token while it is being made, and until when."""
        until = len(self.merges)
        yield token, until
        while token in self.made:
            until, token = self.made[token][0], self.made[token][side]
            yield token, until

    def _meets(self, left: int, right: int, before: int) -> bool:
        """Whether something merges across the border of two neighbours before that time.

        Of equal pairs in a row the left one is merged first: so one inside the left token comes before the border, one
        inside the right token after it.
        """
        for a, until_a in self._spine(left, 2):
            for b, until_b in self._spine(right, 1):
                time = self.merges.get((a, b), (before,))[0]
                if time < before and time < until_a and time <= until_b:
                    return True
        return False

    def _stays(self, token: int) -> bool:
        """Whether merging the bytes of a token gives this token."""
        todo = [token]
        while todo:
            if (made := self.made.get(todo.pop())) is not None:
                time, left, right = made
                if self._meets(left, right, time):
                    return False
                todo += left, right
        return True

    def stay_apart(self, left: int, right: int) -> bool:
        known = self.apart.get((left, right))
        if known is None:
            if len(self.apart) > REMEMBERED:
                self.apart.clear()
            known = self.apart[left, right] = not self._meets(left, right, len(self.merges))
        return known

    def encode_words(self, words: Iterable[str]) -> dict[str, list[int]]:
        """The ids of each distinct word, by one depth-first walk over the trie of all.

        A node keeps the last token of its prefix, where that starts, and the first place from where on the prefix can
        be the beginning of a token; that place never moves back on the way down, so tokens are sought from there on.
        """
        begun, final, apart, stay = self.begun, self.final, self.apart, self.stay_apart
        last: list[int] = []
        starts: list[int] = []
        firsts: list[int] = []
        found, path = {}, ""
        for word in sorted(words):
            size = len(word)
            shared, most = 0, min(len(path), size - 1)
            while shared < most and path[shared] == word[shared]:
                shared += 1
            del last[shared:], starts[shared:], firsts[shared:]
            first = firsts[-1] if shared else 0
            for end in range(shared + 1, size):
                while word[first:end] not in begun:
                    first += 1
                    if first == end:
                        raise ValueError(f"no token for {word[end - 1]!r}")
                start = first
                while (token := begun.get(word[start:end], -2)) < 0 or start and not (apart.get((last[start - 1], token)) or stay(last[start - 1], token)):
                    if token == -2 and start >= end:
                        raise ValueError(f"no token for {word[end - 1]!r}")
                    start += 1
                last.append(token)
                starts.append(start)
                firsts.append(first)
            at = first
            while (token := final.get(word[at:])) is None or at and not (apart.get((last[at - 1], token)) or stay(last[at - 1], token)):
                at += 1
                if at >= size:
                    raise ValueError(f"no token for {word[-1]!r} at the end")
            ids = [token]
            while at:
                ids.append(last[at - 1])
                at = starts[at - 1]
            found[word], path = ids[::-1], word[:-1]
        return found


def visible_bytes() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary: a visible one for itself, others from 256 on."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = iter(range(256, 512))
    return [chr(b) if b in visible else chr(next(hidden)) for b in range(256)]


class Encoder:
    """Texts to ids, by a file of the tokenizers library.

    Takes files with a byte-level BPE without dropout, unknown token, byte fallback or post-processor, whose steps
    before it change no blank into anything but a parting of words (NFC, white space to blanks, lower case, a split that
    drops the blanks); another file is an error.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs the tasks side by side
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            said = json.load(file)
        model, steps = said["model"], said["pre_tokenizer"].get("pretokenizers", [])
        pattern = steps[0].get("pattern", {}).get("Regex", "") if steps else ""
        expected = [
            model["type"] == "BPE" and bool(model.get("end_of_word_suffix")),
            not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges")),
            said["post_processor"] is None and said["decoder"] is None,
            [n["type"] for n in (said["normalizer"] or {}).get("normalizers", [])] == ["NFC", "Replace", "Lowercase"],
            [s["type"] for s in steps] == ["Split", "ByteLevel"] and steps[0].get("behavior") == "Removed" and steps[0].get("invert") is True,
            "\\s" in pattern and "\\p" not in re.sub(r"\[[^]]*\]", "", pattern),
            not any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in said["added_tokens"]),
        ]
        if not all(expected):
            raise ValueError(f"{path} is not a vocabulary of the kind this operator takes")
        library = Tokenizer.from_file(path)
        self.normalize, self.split = library.normalizer.normalize_str, library.pre_tokenizer.pre_tokenize_str
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.bpe = WordBpe(model["vocab"], merges, model["end_of_word_suffix"])
        for name in set(re.findall(r"\\p\{\w+\}", pattern)):  # the same classes, written out for the letters it is used on here
            pattern = pattern.replace(name, "".join(re.escape(chr(c)) for c in range(0x250) if regex.match(name, chr(c))))
        self.find = re.compile(pattern.replace("\\s", "\\t-\\r \x85\xa0")).findall
        added = {t["content"]: t["id"] for t in said["added_tokens"]}
        self.added = re.compile("(" + "|".join(map(re.escape, sorted(added, key=len, reverse=True))) + ")") if added else re.compile("(?!)()")
        names = [""] * (max([*model["vocab"].values(), *added.values()]) + 1)
        for name, i in (*model["vocab"].items(), *added.items()):
            names[i] = name
        self.names = pa.array(names, pa.large_string())
        self.visible = visible_bytes()
        self.bytes = {c: b for b, c in enumerate(self.visible)}
        #: Added tokens begin with a line break here, which no word has.
        self.fixed = {"\n" + name: array("I", [i]).tobytes() for name, i in added.items()}
        self.known = dict(self.fixed)

    def prepared(self, text: str | None) -> str:
        """The text with blanks for line breaks, in lower case if that is all that is done to it before it is split."""
        if not text:
            return ""
        low = text.lower()
        return (text if BEYOND.search(text) or self.added.search(low) else low).replace("\n", " ")

    def words(self, chunk: str) -> list[str]:
        """What of a chunk is encoded apart."""
        out: list[str] = []
        for part in self.added.split(chunk):
            if "\n" + part in self.fixed:
                out.append("\n" + part)
            elif BEYOND.search(part):
                out += [bytes(map(self.bytes.__getitem__, w)).decode() for w, _ in self.split(self.normalize(part))]
            else:
                out += self.find(part.lower())
        return out

    def encode_chunks(self, chunks: list[str]) -> list[bytes]:
        """The ids of each of some distinct chunks without blanks; the words in them not met before are one trie."""
        if len(self.known) > REMEMBERED:
            self.known = dict(self.fixed)
        known, visible = self.known, self.visible
        parts = {c: [c] if c.isalpha() and c.isascii() and c.islower() else self.words(c) for c in chunks if c not in known}
        new = {w: w if w.isascii() and w.isprintable() else "".join(map(visible.__getitem__, w.encode())) for ws in parts.values() for w in ws if w not in known}
        ids = self.bpe.encode_words(set(new.values()))
        fresh = {w: array("I", ids[seen]).tobytes() for w, seen in new.items()}
        for c, ws in parts.items():
            if c not in fresh:
                fresh[c] = b"".join([fresh[w] if w in fresh else known[w] for w in ws])
        own = [fresh[c] if c in fresh else known[c] for c in chunks]
        known.update((w, v) for w, v in fresh.items() if len(w) <= LONGEST_KEPT)
        return own

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(the ids of all texts, the borders of the texts in them)."""
        parts = pc.split_pattern(pa.array(map(self.prepared, texts), pa.large_string()), " ")
        coded = pc.dictionary_encode(parts.flatten())
        own = self.encode_chunks(coded.dictionary.to_pylist())
        size = np.fromiter(map(len, own), np.int64, len(own)) // 4
        which = coded.indices.to_numpy()
        counts = size[which]
        ends = np.cumsum(counts)
        begin = (np.cumsum(size) - size)[which]
        ids = np.frombuffer(b"".join(own), "<u4")[np.arange(int(counts.sum())) + np.repeat(begin - ends + counts, counts)]
        offsets = parts.offsets.to_numpy()
        return ids, np.concatenate(([0], ends))[offsets - offsets[0]]

    def decode(self, ids: np.ndarray, borders: np.ndarray) -> list[str]:
        """The text of each stretch of ids; without a decoder in the file, the tokens joined by blanks."""
        tokens = self.names.take(pa.array(ids.astype(np.int64)))
        return pc.binary_join(pa.LargeListArray.from_arrays(pa.array(borders, pa.int64()), tokens), pa.scalar(" ", pa.large_string())).to_pylist()


def _worker(path: str) -> Encoder:
    return resident(("word trie", path), lambda: Encoder(path))


def encode(df: DataFrame, path: str, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """df with `ids`, the ids of each text as little-endian 32-bit words; null and empty texts have none.

    path: a file of the tokenizers library that every executor has.  Special tokens that stand in a text are found, none
    are added; truncation and padding are not used.  A column named ids is replaced.
    """

    def make() -> Callable:
        encoder = _worker(path)

        def work(texts: list[str | None]) -> list[list]:
            ids, borders = encoder.encode(texts)
            return [[ids[a:b].tobytes() for a, b in zip(borders, borders[1:])]]

        return work

    return append_columns(df, text, "ids binary", make, keep, most=TEXT_BYTES)


def decode(df: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """df with `decoded`, the text of the ids that `encode` made; null ids have none (empty)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _worker(path)
        for batch in batches:
            own = [np.frombuffer(b or b"", "<u4") for b in batch.column(at).to_pylist()]
            borders = np.concatenate(([0], np.cumsum([len(x) for x in own]))).astype(np.int64)
            text = encoder.decode(np.concatenate([*own, np.empty(0, "<u4")]), borders)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(text, pa.string())], names=out.names)

    stay = [c for c in df.columns if c.lower() != "decoded"]
    at, out = stay.index(ids), T.StructType([*(df.schema[c] for c in stay), T.StructField("decoded", T.StringType())])
    return df.select(*(quoted(c).alias(f"c{i}") for i, c in enumerate(stay))).mapInArrow(run, out)


def round_trip(df: DataFrame, path: str, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """df with n_tokens, ids_sha256 and decoded_sha256 of each text, encoded and decoded again.

    Null and empty texts have no ids and decode to the empty text; repeated rows are encoded alike, an empty table gives
    an empty table, and input columns of the three names are replaced.  A text of any length is encoded as a whole.
    """

    def make() -> Callable:
        encoder = _worker(path)

        def work(texts: list[str | None]) -> list[list]:
            ids, borders = encoder.encode(texts)
            own = [ids[a:b].tobytes() for a, b in zip(borders, borders[1:])]
            back = encoder.decode(ids, borders)
            return [np.diff(borders).tolist(), [hashlib.sha256(x).hexdigest() for x in own], [hashlib.sha256(x.encode()).hexdigest() for x in back]]

        return work

    return append_columns(df, text, "n_tokens long, ids_sha256 string, decoded_sha256 string", make, keep, most=TEXT_BYTES)
