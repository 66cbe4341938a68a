import math
import random
import re
from collections import Counter

import pytest

from starling.llm import quality
from tests.conftest import SMOKE_DIR, plan_text
from tests.llm import cases

NAMES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def base(text):
    w = cases.words(text)
    seen = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    covered = {j for i in range(len(w) - 4) if seen[tuple(w[i:i + 5])] > 1 for j in range(i, i + 5)}
    lines = [x for x in (text or "").split("\n") if cases.words(x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)),
            len(covered), len(w) < 10 or 100 * len(covered) > 20 * len(w))


def test_base_measures(spark):
    data = cases.rows() + [
        (40, "a b c d e a b c d e", "en", "s", 1), (41, "a a a a a a a", "en", "s", 1), (42, "x\nx\n\n \n\nx\ny", "en", "s", 1),
        (43, "a b c d e f a b c d e f a b c d e f " + cases.prose(3, 200), "en", "s", 1), (44, "# * $ %% &|<>", "en", "s", 1)]
    got = quality.verdicts(cases.documents(spark, data=data)).select(
        "doc_id", *[quality.measure(n).alias(n) for n in NAMES]).collect()
    assert sorted(((r.doc_id, *r[1:]) for r in got), key=repr) == sorted(
        ((i, *base(t)) for i, t, *_ in data), key=repr)


def shares(counts):
    return [c / sum(counts) for c in counts]


def distance(p, q):
    def h(x):
        return -sum(v * math.log2(v) for v in x if v > 0)
    m = [(a + b) / 2 for a, b in zip(p, q)]
    return math.sqrt(max(0.0, h(m) - (h(p) + h(q)) / 2))


def test_distances_and_verdict_match_a_plain_computation(spark):
    good = [(i, cases.prose(i, 120), "en", "s", 1) for i in range(30)]
    bad = [(100, " | ".join(f"Cell{i}" for i in range(80)), "en", "s", 1),
           (101, "%%% ".join(cases.prose(101, 100).split()), "en", "s", 1)]
    short = [(200, "a| b# c$ d% e& f< g> h* i| j# k$ l%", "en", "s", 1)]  # too short to be judged
    rows = quality.verdicts(cases.documents(spark, data=good + bad + short)).collect()
    kept = {r.doc_id: r["__quality_kept"] for r in rows}
    assert all(kept[i] for i in range(30)) and not kept[100] and not kept[101] and kept[200]
    prose = [r for r in rows if r["__quality_n_words"] >= 10
             and r["__quality_n_symbols"] <= quality.LIMITS.max_reference_symbols * r["__quality_word_chars"]]
    for cells, name in (("chars", "char_distance"), ("common_counts", "word_distance")):
        ref = shares([sum(x) for x in zip(*[r[f"__quality_{cells}"] for r in prose])])
        for r in rows:
            if sum(r[f"__quality_{cells}"]):
                assert r[f"__quality_{name}"] == pytest.approx(distance(shares(r[f"__quality_{cells}"]), ref), abs=1e-9)


def test_histograms(spark):
    text = "The cat and THE dog, of 12 (é) | the"
    r = quality.features(cases.documents(spark, data=[(1, text, "en", "s", 1)])).first()
    words = dict(zip([*quality.VOCABULARY, "other"], r["__quality_common_counts"]))
    assert {k: v for k, v in words.items() if v} == {"the": 3, "and": 1, "of": 1, "other": 5}
    upper, digit, point, symbol, other, wide, small = r["__quality_chars"]
    assert (upper, digit, point, symbol, other, wide) == (4, 2, 3, 1, 0, 1)
    assert upper + digit + point + symbol + other + wide + small == r["__quality_word_chars"]


def test_keep_rows_agrees_with_verdicts_and_carries_columns(spark):
    df = cases.documents(spark, extra=True)
    out = quality.keep_rows(df)
    assert out.columns == df.columns
    want = quality.verdicts(cases.documents(spark)).where(quality.measure("kept")).select("doc_id").collect()
    assert Counter(r.doc_id for r in out.collect()) == Counter(r.doc_id for r in want)


def test_native_plan_and_empty(spark):
    assert not re.search("Python|Pandas|Arrow", plan_text(quality.keep_rows(spark.read.parquet(f"{SMOKE_DIR}/documents.parquet"))))
    assert quality.verdicts(cases.empty(spark)).count() == 0
    assert quality.keep_rows(cases.empty(spark)).count() == 0


def test_word_distance_rejects_alone(spark):
    """Ordinary letters in the wrong language, or without common words, go; clean and short texts stay."""
    def text(seed, lang, n, plain=0.3):
        rng = random.Random(seed)
        return " ".join(rng.choice(quality.COMMON_WORDS[lang]) if rng.random() < plain
                        else "".join(rng.choices("eratonis", k=5)) for _ in range(n))
    data = [(100 * k + i, text(100 * k + i, lang, 120), lang, "s", 1)
            for k, lang in enumerate(quality.COMMON_WORDS) for i in range(20)]
    wrong = [(1000, text(1, "en", 150), "de", "s", 1), (1001, text(2, "de", 150), "en", "s", 1),
             (1002, text(3, "en", 150, 0), "en", "s", 1)]
    short = [(2000, text(4, "de", 30), "en", "s", 1)]
    rows = {r.doc_id: r for r in quality.verdicts(cases.documents(spark, data=data + wrong + short)).collect()}
    assert all(rows[i]["__quality_kept"] for i, *_ in data + short)
    for i, *_ in wrong:
        assert not rows[i]["__quality_base_failed"] and rows[i]["__quality_char_distance"] < 0.2
        assert not rows[i]["__quality_kept"]
