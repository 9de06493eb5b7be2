"""Periodic runs, the word trie and collocations, each against brute force or the library."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tabsieve.llm import collocations, periodic_runs, word_trie
from tabsieve.llm.queries import QUERIES, with_repeats

WORDS = public_tokenizers.path("word_bpe_49k.json")
PROSE = "The quick brown fox jumps over the lazy dog while seven wizards quietly mix strange potions by the river. "
EDGE = [(1, None), (2, ""), (3, " \n\t "), (4, "Hello"), (4, "Hello"), (None, "no key here"), (5, "word " * 30_000), (6, PROSE * 4), (7, PROSE * 4), (8, "漢字 ñandú 🙂 \x1c x")]


@pytest.fixture(scope="module")
def edge(spark):
    rows = [(i, t, None if i == 8 else "en", "x", "y", 1, 7, "z") for i, t in EDGE]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, runs string, DIGEST string, rank int, n_tokens int, `a.b` string")


# ---------------------------------------------------------------------------------------------------- periodic runs


def runs_by_hand(words):
    found = {}
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i < len(words) - q:
            j = i
            while j < len(words) - q and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(6, 4 * q):
                found.setdefault((i, j - i + q), q)
            i = j + 1
    return sorted((s, n, q) for (s, n), q in found.items())


def test_every_difference_has_two_members_of_the_cover():
    for r in range(6):
        v, cover = periodic_runs.difference_cover(r)
        assert len(cover) == 6 * r + 4 and {(a - b) % v for a in cover for b in cover} == set(range(v))


@pytest.mark.parametrize("r", [0, 1, 2])
def test_extensions_equal_comparing_word_by_word(r):
    rng = random.Random(r)
    for size in (2, 3, 50, 300, 700):
        line = np.resize([rng.randrange(3) for _ in range(rng.choice([1, 7, size]))], size)
        line[rng.randrange(size)] = 5
        known = periodic_runs.Extensions(line, r)
        a, b = np.array([(i, j) for i, j in ((rng.randrange(size), rng.randrange(size)) for _ in range(200)) if i != j]).T
        by_hand = [next((d for d in range(size) if max(i, j) + d == size or line[i + d] != line[j + d]), 0) for i, j in zip(a, b)]
        assert known.common(a, b).tolist() == by_hand


def test_runs_equal_brute_force():
    rng = random.Random(7)
    for _ in range(150):
        texts = []
        for _ in range(rng.randint(1, 6)):
            words = [rng.randrange(rng.choice([1, 2, 10])) for _ in range(rng.choice([0, 1, 5, 6, 30, 150]))]
            if words and rng.random() < 0.6:
                a = rng.randrange(len(words))
                p = 1 + (len(words) - a) // (3 + rng.randrange(8))
                words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
            texts.append(words)
        rows = periodic_runs.runs_of(np.array([w for t in texts for w in t], np.int64), np.array([len(t) for t in texts]), rng.choice([0, 1]))
        for k, words in enumerate(texts):
            assert [tuple(x) for x in rows[rows[:, 0] == k, 1:].tolist()] == runs_by_hand(words)


def test_questions_in_small_parts_give_the_same_runs(monkeypatch):
    rng = random.Random(1)
    words = np.array([rng.randrange(2) for _ in range(600)])
    sizes = np.array([200, 0, 399, 1])
    whole = periodic_runs.runs_of(words, sizes)
    monkeypatch.setattr(periodic_runs, "QUESTIONS", 37)
    assert len(whole) and (periodic_runs.runs_of(words, sizes) == whole).all()


def test_run_digests_of_a_table(spark, edge):
    found = periodic_runs.run_digests(edge, keep=["doc_id", "text", "a.b"]).collect()
    assert len(found) == len(EDGE)
    for row in found:
        words = re.findall("[^\x20\x09-\x0d]+", row.text or "")
        runs = runs_by_hand(words) if len(words) < 10_000 else [(0, 30_000, 1)]
        drop = {i for s, n, q in runs for i in range(s + q, s + n)}
        best = min(runs, key=lambda x: (-x[1], x[0], x[2]), default=(None,) * 3)
        assert (row.n_runs, row.start, row.length, row.period) == (len(runs), *best)
        assert row.exponent_milli == (1000 * best[1] // best[2] if runs else None)
        assert row.runs_sha256 == hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest()
        assert row.collapsed_sha256 == hashlib.sha256(" ".join(w for i, w in enumerate(words) if i not in drop).encode()).hexdigest()
    plain = {r.doc_id: r for r in periodic_runs.find_runs(edge).collect()}
    assert plain[5].collapsed == "word" and [tuple(x) for x in plain[5].runs] == [(0, 30_000, 1)] and plain[1].runs == []
    assert periodic_runs.find_runs(edge.limit(0)).count() == 0 == periodic_runs.run_digests(edge.limit(0)).count()


def test_the_query_on_repeats_equals_brute_force_over_whole_documents(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    planted = 0
    for row in QUERIES["op11_periodic_runs"](spark, "/root/testdata/sf0.001").collect():
        words = re.findall("[^\x20\x09-\x0d]+", texts[row.doc_id])
        if len(words) > 2_000:
            continue
        order = with_repeats(row.doc_id, len(words))
        words = words if order is None else [words[i] for i in order]
        runs = runs_by_hand(words)
        planted += bool(order is not None and runs)
        assert row.n_runs == len(runs)
        assert row.runs_sha256 == hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest()
    assert planted > 3 and with_repeats(None, 9) is None and with_repeats(17, 0) is None


# -------------------------------------------------------------------------------------------------------- word trie


def test_word_trie_equals_the_library():
    encoder, library, rng = word_trie.Encoder(WORDS), Tokenizer.from_file(WORDS), random.Random(4)
    alphabet = ["a", "e", " ", "  ", "\n", "é", "É", "ñ", "1", "23", "\t", "漢", "🙂", "ing", "the", "'s", "'", "A", "__", "\x1c", "\x85", "\xa0", "İ", "ß", "Σ", "ΑΣ", "é", "́", "<|endoftext|>", "<|ENDOFTEXT|>", "<|", "|>", "ﬁ", "½", " ", "한", "\x00", "aaaa", "!!!!", "...", "​", "THE", "ŉ", "\xad", "<|startoftext|>"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 30))) for _ in range(3_000)]
    texts += ["".join(rng.choice("theinga") for _ in range(3_000)), "a" * 5_000, "", None]
    ids, borders = encoder.encode(texts)
    for text, a, b, back in zip(texts, borders, borders[1:], encoder.decode(ids, borders)):
        expected = library.encode(text or "", add_special_tokens=False).ids
        assert ids[a:b].tolist() == expected and back == library.decode(expected, skip_special_tokens=False)


def test_a_vocabulary_with_ties_and_idle_merges_equals_plain_merging():
    """Merges in the order of the file, leftmost first, on random small vocabularies."""
    rng = random.Random(8)
    for _ in range(60):
        vocab, merges = {c: i for i, c in enumerate(["a", "b", "c", "a_", "b_", "c_"])}, []
        for _ in range(25):
            left, right = rng.choice([t for t in vocab if not t.endswith("_")]), rng.choice(list(vocab))
            if left + right not in vocab and len(left + right) < 9:
                vocab[left + right] = len(vocab)
                merges.append((left, right))
        words = {"".join(rng.choice("abc") for _ in range(rng.randint(1, 14))) for _ in range(60)}
        found = word_trie.WordBpe(vocab, merges, "_").encode_words(words)
        for word in words:
            parts = [*word[:-1], word[-1] + "_"]
            while True:
                order = [(merges.index(p), i) for i, p in enumerate(zip(parts, parts[1:])) if p in merges]
                if not order:
                    break
                i = min(order)[1]
                parts[i : i + 2] = [parts[i] + parts[i + 1]]
            assert found[word] == [vocab[p] for p in parts], (word, parts)


def test_the_walk_over_the_trie_computes_a_shared_prefix_once():
    encoder = word_trie.Encoder(WORDS)
    asked = []

    class Counted(dict):
        def get(self, key, default=None):
            asked.append(key)
            return super().get(key, default)

    encoder.bpe.begun = Counted(encoder.bpe.begun)
    encoder.bpe.encode_words(["internationalization"])
    alone = len(asked)
    asked.clear()
    encoder.bpe.encode_words([f"internationalization{c}" for c in "abcdefghij"])
    assert len(asked) < 2 * alone


def test_round_trip_of_a_table(spark, edge):
    library = Tokenizer.from_file(WORDS)
    found = word_trie.round_trip(edge, WORDS).collect()
    assert len(found) == len(EDGE) and found[0].__fields__[:8] == ["doc_id", "text", "lang", "runs", "DIGEST", "rank", "a.b", "n_tokens"]
    for row in found:
        ids = library.encode(row.text or "", add_special_tokens=False).ids
        assert (row.n_tokens, row.ids_sha256) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
        assert row.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    again = word_trie.decode(word_trie.encode(edge, WORDS, keep=["doc_id"]), WORDS).collect()
    assert {hashlib.sha256(r.decoded.encode()).hexdigest() for r in again} == {r.decoded_sha256 for r in found}
    assert word_trie.round_trip(edge.limit(0), WORDS).count() == 0


def test_another_kind_of_vocabulary_is_refused():
    with pytest.raises(ValueError):
        word_trie.Encoder(public_tokenizers.path("byte_bpe_50k.json"))


# ----------------------------------------------------------------------------------------------------- collocations


def collocations_by_hand(rows, least, longest, top):
    count, total = defaultdict(Counter), Counter()
    for lang, text in rows:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n-\r]", low):
            words = re.findall("[^\x20\x09]+", piece)
            total[lang or "und"] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    count[lang or "und"][tuple(words[i : i + k])] += 1
    out = []
    for lang, f in count.items():
        often = {p: a for p, a in f.items() if a >= least}
        inside = {q for p, a in often.items() for k in range(2, len(p)) for i in range(len(p) - k + 1) if often[q := p[i : i + k]] <= a}
        scored = []
        for p, a in often.items():
            if len(p) > 1 and p not in inside:
                score, _, left, right = min((1000 * a * total[lang] // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
                scored.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, total[lang], -score))
    return sorted(out)


@pytest.mark.parametrize("least,longest,top,words", [(2, 5, 2_000, 1 << 22), (1, 4, 7, 1 << 22), (3, 5, 30, 60), (2, 1, 5, 60)])
def test_collocations_equal_brute_force(spark, monkeypatch, least, longest, top, words):
    monkeypatch.setattr(collocations, "SHARD_WORDS", words)
    rng = random.Random(least)
    rows = [(rng.choice(["en", "fr", None]), "".join(rng.choice(["Aa", "b", "c", "é", "d e", " ", "  ", ". ", "\t", "\x0b", "the dog"]) + rng.choice([" ", " ", ""]) for _ in range(rng.randint(0, 60)))) for _ in range(60)]
    rows += [("en", None), ("en", ""), ("xx", " .\n")] + [("fr", "zwei mal zwei mal zwei")] * 40
    frame = spark.createDataFrame([(lang, text, "x") for lang, text in rows], "lang string, text string, phrase string").repartition(7)
    found = collocations.collocations(frame, least, longest, top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    assert sorted(map(tuple, found.collect())) == collocations_by_hand(rows, least, longest, top)


def test_a_full_filter_changes_no_count(spark, monkeypatch):
    """Wrong bits, here all of them, cost work only."""
    rows = [("en", PROSE * 3), ("en", "the quick brown fox. the lazy dog")] * 5
    frame = spark.createDataFrame(rows, "lang string, text string")
    monkeypatch.setattr(collocations, "frequent_bits", lambda counted, least, bits: np.full(1 << (collocations.FILTER_BITS - 6), 2**64 - 1, np.uint64))
    found = collocations.collocations(frame, 4, 5, 50).select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()
    assert sorted(map(tuple, found)) == collocations_by_hand(rows, 4, 5, 50)


def test_collocations_of_many_parts_equal_brute_force(spark, monkeypatch):
    for name, value in (("SHARD_WORDS", 60), ("PART_ROWS", 7), ("PACKED", 20), ("MERGED", 10), ("BATCH_BYTES", 100)):
        monkeypatch.setattr(collocations, name, value)
    rng = random.Random(14)
    rows = [(rng.choice(["en", "fr"]), " ".join(rng.choice(["a", "b", "c d", "c d e.", "é"]) for _ in range(rng.randint(0, 60)))) for _ in range(80)]
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    found = collocations.collocations(spark.createDataFrame(rows, "lang string, text string").repartition(3), 3, 5, 50).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    assert sorted(map(tuple, found.collect())) == collocations_by_hand(rows, 3, 5, 50)
    assert spark.conf.get(key) == before


class Rows:
    """A frame of these batches that runs a function where it is."""

    def __init__(self, batches):
        self.batches = batches

    def mapInArrow(self, run, schema):
        return run(iter(self.batches))

    def repartition(self, *names):
        return self

    sortWithinPartitions = repartition


@pytest.fixture
def arrow_memory():
    """A memory pool that tells the most that Arrow held during the test."""
    own = pa.proxy_memory_pool(before := pa.default_memory_pool())
    pa.set_memory_pool(own)
    yield own
    pa.set_memory_pool(before)


def test_packing_all_phrases_of_a_shard_takes_bounded_memory(arrow_memory):
    """In a large corpus nearly all phrases pass the filter; before, all of them were held at once as text."""
    n, words = 1 << 20, 20_000
    line = np.append(np.random.default_rng(1).integers(1, words + 1, n), 0).astype(np.int32)
    index = collocations.FmIndex.of(line, words)
    vocab = pa.array([f"word{k}" for k in range(words)])
    binary = [pa.array([collocations.planes(x)]) for x in (index.counts[1:].astype("<i8"), index.before.astype("<i4"), index.behind.astype("<i4"))]
    batch = pa.RecordBatch.from_arrays([pa.array(["en"]), pa.ListArray.from_arrays([0, words], vocab), *binary], names=["lang", "vocab", "counts", "forward", "backward"])

    class All:
        value = np.full(1 << (collocations.FILTER_BITS - 6), 2**64 - 1, np.uint64)

    rows = sum(pa.ipc.open_stream(x.as_buffer()).read_all().num_rows for made in collocations._shard_phrases(Rows([batch]), All, 5, 4) for x in made.column("data"))
    assert rows > 3 * n
    assert arrow_memory.max_memory() < 250e6


def test_adding_up_many_parts_of_a_block_takes_bounded_memory(arrow_memory):
    """Before, the phrases of all shards in a block were held at once."""
    n, shards = 100_000, 40
    texts = pa.array([f"some words {k}" for k in range(n)])
    data = [collocations._packed(pa.RecordBatch.from_arrays([pa.array(np.full(n, 3, np.int32)), texts, pa.array(np.full(n, 3, np.int64)), pa.array(["x"] * n), pa.array(["y" if k else None] * n)], schema=collocations.PHRASES)) for k in range(shards)]
    batches = [pa.RecordBatch.from_arrays([pa.array(["en"]), pa.array([0], pa.int32()), pa.array([x], pa.binary())], names=["lang", "block", "data"]) for x in data]
    made = pa.Table.from_batches(collocations._summed_phrases(Rows(batches), 100))
    assert len(made) == n and set(made["n"].to_pylist()) == {3 * shards} and set(made["closed"].to_pylist()) == {False}
    assert arrow_memory.max_memory() < 150e6


def test_phrases_have_more_blocks_in_a_larger_corpus():
    assert [collocations.phrase_bits(n) for n in (0, 140_000_000, 1_700_000_000, 17_000_000_000)] == [4, 4, 7, 10]


def test_products_beyond_64_bits_are_exact(spark):
    score = "CAST(1000 AS DECIMAL(4, 0)) * (CAST(a AS DECIMAL(17, 0)) * CAST(n AS DECIMAL(17, 0))) div (CAST(l AS DECIMAL(17, 0)) * CAST(r AS DECIMAL(17, 0)))"
    a, n, left, right = 123_456_789_012_345, 987_654_321_098_765, 123_456_789_012_346, 99_999_999_977
    row = spark.createDataFrame([(a, n, left, right)], "a long, n long, l long, r long").selectExpr(f"{score} AS score").first()
    assert row.score == 1000 * a * n // (left * right)


def test_collocations_of_edge_rows(spark, edge):
    found = collocations.collocations(edge, least=4).select("lang", "phrase", "a", "n").collect()
    assert {r.lang for r in found} == {"en"} and ("word word word word word", 29_996) in {(r.phrase, r.a) for r in found}
    assert collocations.collocations(edge.limit(0)).count() == 0


def test_the_index_extends_to_both_sides():
    rng = random.Random(3)
    for _ in range(60):
        line = [w for _ in range(rng.randint(1, 12)) for w in [*(rng.randint(1, 4) for _ in range(rng.randint(1, 8))), 0]]
        index = collocations.FmIndex.of(np.array(line, np.int32), 4)
        phrases = index.single()
        for k in range(1, 6):
            by_hand = Counter(tuple(line[i : i + k]) for i in range(len(line) - k + 1) if 0 not in line[i : i + k])
            assert dict(zip(map(tuple, phrases[0].tolist()), phrases[3].tolist())) == by_hand
            _, phrases = index.extend(phrases, right=rng.random() < 0.5)


def test_words_of_texts_keep_to_pieces_and_texts():
    words, piece = collocations.words_of(pa.array(["a b.C", None, "", "d", "e\x85f\tg"]))
    assert words.to_pylist() == ["a", "b", "c", "d", "e\x85f", "g"] and (np.diff(piece) != 0).tolist() == [False, True, True, True, False]
