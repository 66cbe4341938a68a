import re

import pytest

from starling.llm import license_scan as ls
from starling.llm.license_templates import PHRASES, TEMPLATES
from tests.llm import cases

SCANNER = ls.scanner(TEMPLATES, PHRASES, ls.MIN_MATCH)


def plain_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", cases.lower_ascii(text))


def plain_matches(text, templates, min_match):
    """(template, start, template start, length) by comparing every place of the text with every place of the templates."""
    w, ts = plain_words(text), [plain_words(t) for _, t in templates]
    longest = []  # per end: the longest run that some template holds
    for end in range(1, len(w) + 1):
        best = 0
        for t in ts:
            for stop in range(1, len(t) + 1):
                n = 0
                while n < min(end, stop) and w[end - 1 - n] == t[stop - 1 - n]:
                    n += 1
                best = max(best, n)
        longest.append(best)
    out = []
    for end, n in enumerate(longest, 1):
        if n >= min_match and (end == len(w) or longest[end] <= n):
            for k, t in enumerate(ts):
                out += [(k, end - n, stop - n, n) for stop in range(n, len(t) + 1) if t[stop - n:stop] == w[end - n:end]]
    return sorted(out)


TEXTS = [
    "Released under the MIT License.", "the the the of the software is provided as is and provided as is without any",
    TEMPLATES[0][1][:400] + " and quite other words here " + TEMPLATES[3][1][200:420],
    "redistribution and use in source and binary forms must retain the above copyright notice this list of conditions and",
    "a b c a b c a b x a b c", "", "license",
]


@pytest.mark.parametrize("text", TEXTS)
@pytest.mark.parametrize("templates", [TEMPLATES, (("x", "a b c a b c a b"), ("y", "b c a b x"), ("z", "c"))])
def test_matches_against_brute_force(text, templates):
    s = ls.scanner(tuple(templates), PHRASES, 2)
    assert sorted(s.template_matches(s.ids(text.encode()))) == plain_matches(text, templates, 2)


def test_automaton_knows_every_run_and_no_other():
    seqs = [[0, 1, 0, 1, 2], [1, 0, 1, 1], [2, 2, 2]]
    a = ls.Automaton(seqs, 1)
    runs = {tuple(s[i:j]) for s in seqs for i in range(len(s)) for j in range(i + 1, len(s) + 1)}
    import itertools
    for n in range(1, 5):
        for run in itertools.product(range(3), repeat=n):
            state, ok = 0, True
            for x in run:
                ok = ok and x in a.step[state]
                state = a.step[state].get(x, 0)
            assert ok == (run in runs)
            if ok:
                assert a.ends[state] == [(k, j) for k, s in enumerate(seqs) for j in range(n, len(s) + 1) if tuple(s[j - n:j]) == run]


def spans(text):
    ids = SCANNER.ids(text.encode())
    return [(SCANNER.labels[t], a, b, round(c / SCANNER.sizes[t], 2)) for t, a, b, _, _, c in
            ls.best_spans(ls.chains(SCANNER.template_matches(ids)), SCANNER.sizes)]


@pytest.mark.parametrize("k", range(len(TEMPLATES)))
def test_a_whole_text_is_one_span(k):
    label, text = TEMPLATES[k]
    n = len(plain_words(text))
    assert spans("some words before. " + text.upper() + " and behind") == [(label, 3, 3 + n, 1.0)]


def test_an_edited_text_is_one_chained_span():
    label, text = TEMPLATES[0]
    w = plain_words(text)
    w[30], w[80:82] = "changed", ["x", "y", "z", "z"]
    del w[120]
    (got,) = spans(" ".join(w))
    assert got[:2] == ("mit", 0) and got[2] == len(w) and 0.95 < got[3] < 1


def test_copies_are_spans_of_their_own():
    text = TEMPLATES[3][1]
    assert [s[0] for s in spans("\n\n".join([text] * 50))] == ["isc"] * 50


def test_far_parts_are_not_chained():
    w = plain_words(TEMPLATES[0][1])
    assert len(spans(" ".join(w[:60] + ["other"] * 40 + w[100:]))) == 2


def expected(text):
    w = plain_words(text)
    places, labels = [], set()
    for phrase, label in PHRASES:
        p = phrase.split()
        at = [i for i in range(len(w) - len(p) + 1) if w[i:i + len(p)] == p]
        places += at
        labels |= {label} if at else set()
    return len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def data():
    texts = ["MIT license, mit License; Apache-License CC\nBY cc by", "gnu general public license" * 2, "xmit license mit licenses",
             "word " * 30_000 + TEMPLATES[4][1], "É mit license", "mit\u0000license"] + [t for _, t in TEMPLATES]
    return cases.rows() + [(500 + i, t, "en", "s", 1) for i, t in enumerate(texts)]


@pytest.mark.parametrize("extra", [False, True])
def test_base_columns(spark, extra, monkeypatch):
    got = ls.labelled(ls.scan(cases.documents(spark, extra, data()))).collect()
    assert sorted(((r.doc_id, *tuple(r)[1:6]) for r in got), key=repr) == sorted(
        ((i, *expected(t)) for i, t, *_ in data()), key=repr)
    for r in got:
        assert 0 <= r.score <= 1 and set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(",")))
    labels = {r.doc_id: (r.labels, r.score) for r in got}
    assert labels[503] == ("apache", 1.0) and labels[20] == ("", 0.0)
    assert labels[506 + 1] == ("bsd-2-clause", 1.0) and labels[506 + 20] == ("cc-by,cc-by-nc", 1.0)


def test_segments_change_nothing(monkeypatch):
    text = cases.prose(3, 3000) + TEMPLATES[1][1] + cases.prose(4, 3000)
    whole = SCANNER.ids(text.encode()).tolist()
    monkeypatch.setattr(ls, "SEGMENT", 7)
    assert SCANNER.ids(text.encode()).tolist() == whole


def test_empty(spark):
    assert ls.labelled(ls.scan(cases.empty(spark))).count() == 0
