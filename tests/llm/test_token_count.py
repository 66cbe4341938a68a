import json
import random

import pytest

from starling.llm import token_count as C
from starling.llm.queries import tokenizer_file
from tests.llm import cases


def greedy(word, vocabulary, ends):
    """Longest match by trying every length: the number of pieces, or None."""
    at, n = 0, 0
    while at < len(word):
        for stop in range(len(word), at, -1):
            if (word[at:stop] in ends) if stop == len(word) else (word[at:stop] in vocabulary):
                break
        else:
            return None
        at, n = stop, n + 1
    return n


@pytest.mark.parametrize("seed", range(6))
def test_automaton_counts_greedy_pieces_of_random_vocabularies(seed):
    rng = random.Random(seed)
    pick = lambda: "".join(rng.choice("abc") for _ in range(rng.randint(1, 5)))
    inside, ends = {pick() for _ in range(12)}, {pick() for _ in range(12)}
    automaton = C.Automaton([*inside, *map(C.mark, ends)])
    for _ in range(1500):
        word = "".join(rng.choice("abcd") for _ in range(rng.randint(1, 14)))
        assert automaton.count(C.mark(word)) == greedy(word, inside, ends)


def test_counts_match_greedy_longest_match(spark):
    counter = C.PieceCounter(tokenizer_file())
    with open(tokenizer_file(), encoding="utf-8") as f:
        vocabulary = set(json.load(f)["model"]["vocab"])
    ends = {v.removesuffix("</w>") for v in vocabulary if v.endswith("</w>")}
    want = []
    for i, text, *_ in cases.rows():
        pieces = [greedy(w, vocabulary, ends) for w in counter.words(text or "")] if len(text or "") < 40_000 or " " in text else None
        if pieces is not None:
            want.append((i, sum(p or 1 for p in pieces), len(pieces), pieces.count(None)))
    got = [tuple(r) for r in C.token_counts(cases.documents(spark, extra=True), tokenizer_file()).collect()]
    assert len(got) == len(cases.rows())
    assert sorted((r for r in got if r[0] != 29), key=repr) == sorted(want, key=repr)
    assert C.token_counts(cases.empty(spark), tokenizer_file()).count() == 0


def test_a_very_long_word_takes_linear_time():
    counter = C.PieceCounter(tokenizer_file())
    assert counter.counts("ab" * 300_000)[1] == 1


def test_a_full_cache_starts_anew(monkeypatch):
    monkeypatch.setattr(C, "CACHE_PIECES", 3)
    counter = C.PieceCounter(tokenizer_file())
    text = cases.prose(1, 200)
    assert counter.counts(text) == counter.counts(text) == C.PieceCounter(tokenizer_file()).counts(text)
