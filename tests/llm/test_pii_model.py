"""The trained field on sentences held out, on clean documents, and on documents with data written out."""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow.parquet as pq

from tabsieve.llm import pii, pii_examples

MARKED = re.compile(r"(\[(?:%s) (?:\[ \w+ \]|[^\[\]])*\])" % "|".join(pii.FOUND))


def told(line):
    """A marked line as text and spans."""
    text, spans = "", []
    for part in MARKED.split(line):
        m = re.fullmatch(r"\[(\w+) (.*)\]", part)
        if m and m[1] in pii.FOUND:
            spans.append((m[1], len(text), len(text) + len(m[2])))
            part = m[2]
        text += part
    return text, spans


def test_recall_and_precision_on_sentences_held_out():
    lines = [told(x) for x in pii_examples.held_out()]
    seen = {" ".join(told(x)[0].lower().split()) for x in pii_examples.examples()}
    assert not seen & {" ".join(t.lower().split()) for t, _ in lines}  # none is a training sentence
    wanted, right, given = Counter(), Counter(), Counter()
    for (_, spans), found in zip(lines, pii.default_model().spans([t for t, _ in lines])):
        wanted.update(k for k, _, _ in spans)
        given.update(k for k, _, _ in found)
        right.update(k for k, _, _ in set(spans) & set(found))
    print({k: (right[k], wanted[k], given[k]) for k in pii.FOUND})
    for kind in pii.FOUND:
        assert wanted[kind] >= 10 and right[kind] >= 0.9 * wanted[kind] and right[kind] >= 0.9 * given[kind], kind


def test_clean_documents_are_left_alone():
    texts = pq.read_table("/root/testdata/sf0.01/documents.parquet").column("text").to_pylist()
    added = sum(bool(set(pii.all_spans(base := pii.base_spans(t), f)) - set(base)) for t, f in zip(texts, pii.default_model().spans(texts)))
    assert added <= 0.02 * len(texts)


def test_data_written_out_is_found_in_whole_documents(spark):
    """The model adds what the patterns miss, in the middle of prose, and the mask covers it."""
    prose = pq.read_table("/root/testdata/sf0.001/documents.parquet").column("text").to_pylist()[:40]
    planted = [told(x) for x in pii_examples.held_out() if MARKED.search(x)]
    rows = [(i, f"{prose[i % 40]}\n{t}\n{prose[(i + 1) % 40]}") for i, (t, _) in enumerate(planted)]
    found = pii.find_personal_data(spark.createDataFrame(rows, "doc_id long, text string"), mask=True).collect()
    hit = 0
    for r in found:
        t, spans = planted[r.doc_id]
        kind, start, end = spans[0]
        at = rows[r.doc_id][1].index(f"\n{t}\n") + 1
        inside = f"{kind}:{at + start}:{at + end}" in r.spans.split(",")
        hit += inside
        assert not inside or t not in r.masked
    assert hit >= 0.9 * len(planted)


def test_training_follows_the_likelihood():
    """The gradient that training climbs is the one of the summed log likelihood, counted over all label sequences."""
    lines = ["call [phone 12 34] now", "[name Ann] is", "no data"]
    before, after = pii.train(lines, rounds=1, rate=0.0), pii.train(lines, rounds=40)

    def likelihood(model):
        total = 0.0
        for words, labels in map(pii.marked, lines):
            ids = pii.linked(np.array([pii._shapes()[pii.shape(w)] for w in words]))
            scores = model.scores(ids).astype(float)
            rows = model.start + scores[0]
            own = rows[labels[0]]
            for t in range(1, len(words)):
                own += model.moves[labels[t - 1], labels[t]] + scores[t, labels[t]]
                rows = np.logaddexp.reduce(rows[:, None] + model.moves, axis=0) + scores[t]
            total += own - np.logaddexp.reduce(rows)
        return total

    assert likelihood(after) > likelihood(before) + 3 and likelihood(after) > -1


def test_marks_behind_cues_have_a_shape_of_their_own():
    known = pii._shapes()
    ids = np.array([known[pii.shape(w)] for w in ["Dr", ".", "is", ".", "phone", ":", "x", ":"]])
    assert [known["cue."], known["."], known["cue:"], known[":"]] == pii.linked(ids)[1::2].tolist()
    assert pii.trimmed_span("name", "Ann Brown will.") == "Ann Brown" and pii.trimmed_span("id", "12 ab.") == "12 ab"
