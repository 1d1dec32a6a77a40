import math
import random

import pytest
import regex
import public_tokenizers

from penmark.llm import token_counts as tc
from penmark.llm.byte_bpe import RANKS

SCORES = tc.unigram_scores(RANKS)


def best(word):
    """Score and piece count of the best segmentation, without sharing anything."""
    found = [(0.0, 0)]
    for end in range(1, len(word) + 1):
        found.append(max((found[s][0] + SCORES[word[s:end]], found[s][1] - 1) for s in range(end) if word[s:end] in SCORES))
    return -found[-1][1], found[-1][0]


def test_scores_are_probabilities():
    assert math.fsum(math.exp(s) for s in SCORES.values()) == pytest.approx(1)


def test_shared_prefixes_change_nothing():
    rng = random.Random(2)
    words = sorted({"".join(rng.choices("ab the ing é中", k=rng.randint(1, 12))).encode() for _ in range(400)})
    trie = tc.TrieWalk(SCORES)
    for w in words:
        n, score = trie.visit(w)
        assert (n, pytest.approx(score)) == best(w)


def test_counts_per_document(docs, tricky, nothing):
    rows = docs.where("doc_id < 60").select("doc_id", "text").union(tricky.where("doc_id != 9 and doc_id != 10").select("doc_id", "text"))
    pattern = regex.compile(public_tokenizers.PATTERN)
    known = {}

    def expected(text):
        words = [w.encode() for w in pattern.findall(text or "")]
        for w in words:
            known.setdefault(w, best(w))
        return len(words), sum(known[w][0] for w in words), sum(known[w][1] for w in words)

    want = sorted(((r.doc_id, *expected(r.text)) for r in rows.collect()), key=str)
    got = sorted((tuple(r) for r in tc.count_tokens(rows).collect()), key=str)
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert [g[3] for g in got] == pytest.approx([w[3] for w in want])
    assert tc.count_tokens(nothing).count() == 0
