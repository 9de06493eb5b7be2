"""Byte-level BPE by dynamic programming over prefixes.

Two facts about byte pair encoding make this exact: an encoding is right if and only if every two neighbours in it are
right on their own, and every prefix of a text has exactly one right encoding.  So for each byte prefix one token is
enough, the last of its encoding: of the tokens that end the prefix, the one that goes with the last token of what is
left.  Appending extends the table and never changes it; an edit keeps the table before it, and after it only computes
until the old last tokens come back.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Callable, Iterable, Iterator
from struct import pack

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from tabsieve.llm.common import append_columns, resident

#: Encodings of pieces that a worker keeps at a time.
REMEMBERED = 250_000


class ByteBpe:
    """A vocabulary of ranks: rank files in the format of one base64 token and its rank a line."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = [b""] * (max(ranks.values()) + 1 if ranks else 0)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.longest = max(map(len, ranks), default=0)
        self.words: pa.Array | None = None
        self.pairs: dict[tuple[int, int], bool] = {}
        self.halves: dict[int, tuple[int, int] | None] = {}
        #: What tokens begin with, by number: the states of a walk over bytes.
        self.begun = [b"", *dict.fromkeys(token[:n] for token in sorted(ranks) for n in range(1, len(token) + 1))]
        self.state = {part: n for n, part in enumerate(self.begun)}
        self.moves: dict[int, int] = {}
        #: By state: the tokens it ends with, the longest first, and their lengths.
        self.ends: list[list[tuple[int, int]] | None] = [None] * len(self.begun)

    @classmethod
    def load(cls, path: str) -> ByteBpe:
        with open(path, "rb") as lines:
            return cls({base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)})

    def _merge(self, piece: bytes, stop: int) -> list[bytes]:
        """Merge the pair of lowest rank, leftmost first, until `stop` parts are left or no pair is a token."""
        parts = [piece[i : i + 1] for i in range(len(piece))]
        while len(parts) > stop:
            rank, at = min((self.ranks.get(a + b, len(self.tokens)), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if rank == len(self.tokens):
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def merged(self, piece: bytes) -> list[int]:
        """The definition of the encoding, in quadratic time."""
        return [self.ranks[p] for p in self._merge(piece, 1)]

    def half(self, token: int) -> tuple[int, int] | None:
        """The two tokens of the merge that makes this one: () for a single byte, None if merging its bytes never does."""
        if token not in self.halves:
            own = self.tokens[token]
            parts = self._merge(own, 2) if len(own) > 1 else []
            self.halves[token] = None if len(parts) > 2 else tuple(self.ranks[p] for p in parts)
        return self.halves[token]

    def step(self, state: int, byte: int) -> int:
        """The state behind one more byte: the longest end of what was read that some token begins with."""
        part = self.begun[state] + bytes((byte,))
        while part not in self.state:
            part = part[1:]
        if len(self.moves) > REMEMBERED:
            self.moves.clear()
        found = self.moves[state << 8 | byte] = self.state[part]
        if self.ends[found] is None:
            tokens = [(self.ranks.get(part[n:]), len(part) - n) for n in range(len(part))]
            self.ends[found] = [(t, size) for t, size in tokens if t is not None and self.half(t) is not None]
        return found

    def goes(self, left: int, right: int) -> bool:
        """Whether merging gives the right token behind the left one.

        The two tokens are taken apart again at their border, the later merge first: they stay apart unless the two
        parts at the border make a token that is merged before the merge just undone.
        """
        if len(self.pairs) > REMEMBERED:
            self.pairs.clear()
        key, until, tokens, good = (left, right), len(self.tokens) + 1, self.tokens, self.half(right) is not None
        while good:
            if self.ranks.get(tokens[left] + tokens[right], until) < until:
                good = False
                break
            of_left, of_right = self.half(left), self.half(right)
            if of_left and (left > right or not of_right):
                until, left = left, of_left[1]
            elif of_right:
                until, right = right + 1, of_right[0]
            else:
                break
        self.pairs[key] = good
        return good

    def encode_piece(self, piece: bytes) -> list[int]:
        """The ids of a piece; a piece that is itself a token is that token."""
        if (whole := self.ranks.get(piece)) is not None:
            return [whole]
        return PrefixTable(self, piece).ids()

    def encode_pieces(self, pieces: Iterable[bytes]) -> Iterator[list[int]]:
        """The ids of each piece, in one table: of a piece that begins like the one before, only the rest is computed."""
        table = PrefixTable(self)
        for piece in pieces:
            if (whole := self.ranks.get(piece)) is not None:
                yield [whole]
            else:
                table.turn_into(piece)
                yield table.ids()

    def decode(self, ids: np.ndarray) -> bytes:
        if self.words is None:
            self.words = pa.array(self.tokens, pa.binary())
        _, ends, data = self.words.take(pa.array(ids)).buffers()  # the tokens lie one behind the other
        return data[: int(np.frombuffer(ends, np.int32)[len(ids)])].to_pybytes() if len(ids) else b""


class PrefixTable:
    """The last token of every prefix of one piece of bytes, and the state of the walk behind it."""

    def __init__(self, bpe: ByteBpe, piece: bytes = b""):
        self.bpe, self.bytes, self.last, self.states = bpe, bytearray(), [], []
        self.append(piece)

    def _fill(self, first: int, stop: int) -> None:
        """Find the last tokens of the prefixes that end with the bytes first … stop - 1; those before have theirs.

        Of the tokens that end there, exactly one goes with the last token before it.
        """
        data, last, states = self.bytes, self.last, self.states
        step, moves, ends, goes, known = self.bpe.step, self.bpe.moves, self.bpe.ends, self.bpe.goes, self.bpe.pairs
        state = states[first - 1] if first else 0
        for end in range(first, stop):
            byte = data[end]
            found = moves.get(state << 8 | byte)
            state = states[end] = step(state, byte) if found is None else found
            for token, length in ends[state]:
                if length > end:
                    break
                left = last[end - length]
                good = known.get((left, token))
                if good or good is None and goes(left, token):
                    break
            else:
                raise ValueError(f"no token for the byte {byte}")
            last[end] = token

    def append(self, more: bytes) -> None:
        first, blank = len(self.bytes), [-1] * len(more)
        self.bytes += more
        self.last += blank
        self.states += blank
        self._fill(first, len(self.bytes))

    def turn_into(self, piece: bytes) -> None:
        """Become the table of another piece; the prefixes that both have are kept."""
        same = 0
        for a, b in zip(self.bytes, piece):
            if a != b:
                break
            same += 1
        del self.bytes[same:], self.last[same:], self.states[same:]
        self.append(piece[same:])

    def replace(self, start: int, end: int, new: bytes) -> int:
        """Put new bytes in the place of start … end; returns how many prefixes had to be computed.

        Behind the edit a last token depends on the bytes and last tokens of one token's length before it: when that
        many prefixes in a row have their old tokens again, all further ones have.
        """
        old, old_states, behind, block = self.last[end:], self.states[end:], start + len(new), self.bpe.longest
        self.bytes[start:end] = new
        size = len(self.bytes)
        self.last[start:] = self.states[start:] = [-1] * (size - start)
        at = behind
        self._fill(start, at)
        while at < size:
            stop = min(size, at + block)
            self._fill(at, stop)
            if self.last[at:stop] == old[at - behind : stop - behind]:
                self.last[stop:], self.states[stop:] = old[stop - behind :], old_states[stop - behind :]
                return stop - start
            at = stop
        return size - start

    def ids(self) -> list[int]:
        end, found = len(self.bytes), []
        while end:
            found.append(self.last[end - 1])
            end -= len(self.bpe.tokens[found[-1]])
        return found[::-1]


class Encoder:
    """Texts to ids as little-endian 32-bit words, piece by piece; remembers pieces it has seen."""

    def __init__(self, bpe: ByteBpe, pattern: str):
        self.bpe, self.find, self.known = bpe, regex.compile(pattern).findall, {}

    def encode(self, text: str | None) -> bytes:
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text; the new pieces of all of them are encoded in order, as neighbours begin alike."""
        known, found = self.known, [self.find(t) if t else [] for t in texts]
        if len(known) > REMEMBERED:
            known.clear()
        new = sorted((piece.encode("utf-8", "surrogatepass"), piece) for piece in set().union(*found).difference(known))
        for (_, piece), ids in zip(new, self.bpe.encode_pieces(data for data, _ in new)):
            known[piece] = pack(f"<{len(ids)}I", *ids)
        return [b"".join(map(known.__getitem__, pieces)) for pieces in found]


def _worker(path: str, pattern: str) -> Encoder:
    return resident(("bpe", path, pattern), lambda: Encoder(ByteBpe.load(path), pattern))


def encode(df: DataFrame, path: str, pattern: str, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """df with `ids`, the ids of each text as little-endian 32-bit words; null and empty texts have none.

    path: a rank file that every executor has; pattern: what matches is encoded apart.  Special tokens are ordinary
    text.  An input column named ids is replaced.
    """

    def make() -> Callable:
        encoder = _worker(path, pattern)
        return lambda texts: [encoder.encode_all(texts)]

    return append_columns(df, text, "ids binary", make, keep)


def round_trip(df: DataFrame, path: str, pattern: str, text: str = "text", keep: list[str] | None = None, decoded: bool = False) -> DataFrame:
    """df with n_tokens, ids_sha256, decoded_sha256 and n_bytes of each text, encoded and decoded again.

    With `decoded` the decoded text takes the place of the text.  Null counts as empty.
    """

    def make() -> Callable:
        encoder = _worker(path, pattern)

        def work(texts: list[str | None]) -> list[list]:
            rows = []
            for t, ids in zip(texts, encoder.encode_all(texts)):
                back = encoder.bpe.decode(np.frombuffer(ids, "<u4"))
                rows.append((len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(back).hexdigest(), len(back), back.decode("utf-8", "surrogatepass") if decoded and t is not None else None))
            columns = [list(x) for x in zip(*rows)]
            return columns if decoded else columns[:4]

        return work

    fields = "n_tokens long, ids_sha256 string, decoded_sha256 string, n_bytes long" + ", decoded string" * decoded
    return append_columns(df, text, fields, make, keep)
