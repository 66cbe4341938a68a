import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from starling.llm import paragraph_dedup as P
from starling.llm import text_bytes
from tests.llm import cases


def plain_cuts(words):
    """First words of the paragraphs: the start, and the least (leftmost) value of every ``SPREAD`` neighbours."""
    data = np.frombuffer(" ".join(words).encode(), dtype=np.uint8)
    begin, end, _ = text_bytes.spans(data, np.array([0, len(data)]), P.WORD_BYTES)
    h = text_bytes.word_hashes(data, begin, end)
    value = [0] + [int(x) | 1 for x in text_bytes.mix(h[:-1] * P._PLACE[0] + h[1:] * P._PLACE[1])]
    chosen = {0}
    for i in range(len(words) - P.SPREAD + 1):
        part = value[i:i + P.SPREAD]
        chosen.add(i + part.index(min(part)))
    return sorted(chosen)


def paragraphs_of(data):
    out = []
    for row, (doc_id, text, *_) in enumerate(data):
        words = cases.WORD.findall(cases.lower_ascii(text))
        if words:
            at = plain_cuts(words)
            out += [(doc_id is None, doc_id, a, row, words[a:b]) for a, b in zip(at, [*at[1:], len(words)])]
    return out


def expected(data):
    """(doc_id, start, kept id, kept start) of every paragraph of a passage, by comparing all pairs."""
    paras = paragraphs_of(data)
    sets = [frozenset(tuple(p[4][i:i + 5]) for i in range(max(1, len(p[4]) - 4))) for p in paras]
    groups = cases.Groups()
    by_set = defaultdict(list)
    for i, p in enumerate(paras):
        groups.find(i)
        by_set[tuple(p[4])].append(i)
    kinds = list(by_set.values())
    for same in kinds:
        for i in same[1:]:
            groups.join(same[0], i)
    for x, (i, *_) in enumerate(kinds):
        for j, *_ in kinds[:x]:
            a, b = sets[i], sets[j]
            if min(len(a), len(b)) >= P.SIMILARITY * max(len(a), len(b)):
                both = len(a & b)
                if both >= P.SIMILARITY * (len(a) + len(b) - both):
                    groups.join(i, j)
    classes = defaultdict(list)
    for i, p in enumerate(paras):
        classes[groups.find(i)].append(p)

    def order(p):
        return p[0], p[1] if p[1] is not None else 0, p[2], p[3]

    words = [cases.WORD.findall(cases.lower_ascii(t)) for _, t, *_ in data]
    runs, last = [], (None, False)
    for i, p in enumerate(paras):
        members = classes[groups.find(i)]
        if len(members) > 1:
            if last != (p[3], True):
                runs.append([])
            runs[-1].append((p, sorted(members, key=order)))
        last = (p[3], len(members) > 1)
    out = []
    for run in runs:
        n = sum(len(p[4]) for p, _ in run)
        if n < P.MIN_PASSAGE_WORDS:
            seed, members = max(run, key=lambda x: (len(x[0][4]), x[0][2]))
            if len(seed[4]) < P.SHINGLE:
                continue
            other = members[-1] if members[0] is seed else members[0]
            x, y, i, j = words[seed[3]], words[other[3]], seed[2], other[2]
            right = left = 0
            while i + right < len(x) and j + right < len(y) and x[i + right] == y[j + right]:
                right += 1
            while left < min(i, j) and x[i - left - 1] == y[j - left - 1]:
                left += 1
            n = left + right
        if n >= P.MIN_PASSAGE_WORDS:
            out += [(p[1], p[2], m[0][1], m[0][2]) for p, m in run]
    return Counter(out)


def got(df, **kw):
    return Counter((r.doc_id, r.start_word, r.keep_doc_id, r.keep_start_word) for r in P.passages(df, **kw).collect())


def corpus():
    passage, multi = cases.prose(500, 80), [cases.prose(501, 24), cases.prose(502, 20), cases.prose(503, 18)]
    data = []
    for i in range(30):
        lines = [cases.prose(1000 + 10 * i + k, 15 + 7 * k) for k in range(5)]
        if i % 3 == 0:
            words = passage.split()
            words[i % len(words)] = f"edit{i}"        # near copies, no two alike
            lines.insert(i % 4, " ".join(words))
        if i % 7 == 0:
            lines[2:2] = multi
        if i % 5 == 0:
            lines.insert(1, "a short line of ten words that many documents share too")
        data.append((i, "\n".join(lines), "en", "s", 1))
    return data


@pytest.mark.parametrize("crowd", [32, 1])  # pairs, and the way of crowded bands
def test_passages_match_all_pairs(spark, crowd):
    data = corpus() + cases.rows()
    want = expected(data)
    assert want and got(cases.documents(spark, data=data), miss=1e-9, crowd=crowd) == want


def test_full_hash_set_changes_nothing(spark, monkeypatch):
    monkeypatch.setattr(P, "hash_set", lambda hashes, column: np.full(4, 2**64 - 1, dtype=np.uint64))
    data = corpus()
    assert got(cases.documents(spark, data=data), miss=1e-9) == expected(data)


def test_every_pasted_passage_is_found(spark):
    """Passages of 51 words and more, pasted anywhere inside lines of other words: no document is missed, no other named."""
    data, pasted = [], set()
    for i in range(120):
        words = cases.prose(3000 + i, 150 + i % 60).split()
        if i % 4:
            k = i % 20
            passage = cases.prose(9000 + k, 51 + 3 * k).split()
            at = 1 + i * 7 % 140
            words[at:at] = passage
            pasted.add(i)
        data.append((i, " ".join(words), "en", "s", 1))
    rows = P.passages(cases.documents(spark, data=data)).collect()
    assert {r.doc_id for r in rows} == pasted
    assert min(r.passage_words for r in rows) >= 50


def test_shorter_repeats_are_no_passage(spark):
    data = [(i, " ".join([cases.prose(100 + i, 60), cases.prose(7, 45), cases.prose(200 + i, 60)]), "en", "s", 1) for i in range(8)]
    assert P.passages(cases.documents(spark, data=data)).count() == 0


def test_removed_is_every_place_but_the_first(spark):
    rows = P.passages(cases.documents(spark, data=corpus())).collect()
    for r in rows:
        assert r.removed == ((r.doc_id, r.start_word) != (r.keep_doc_id, r.keep_start_word))
    clean = {i for i in range(30) if i % 3 and i % 7}
    assert not clean & {r.doc_id for r in rows}


def test_remove_passages(spark):
    from pyspark.sql import functions as F
    df = spark.sql("select 'a  b\\nc d e' as t, array(named_struct('start_word', 1L, 'n_words', 2)) as r")
    assert df.select(P.remove_passages(F.col("t"), F.col("r"))).first()[0] == "a d e"


def test_bands_reach_the_recall():
    assert P.tuned_bands(0.8, 2e-2) == 4 and P.tuned_bands(0.8, 1e-4) == 10
    rng = np.random.default_rng(3)
    missed, tries = 0, 2000
    for _ in range(tries):
        h = rng.integers(0, 1 << 62, 12, dtype=np.uint64)   # 8 shingles; the other has two more words: 8 of 10
        other = np.append(h, rng.integers(0, 1 << 62, 2, dtype=np.uint64))
        keys = [P.band_values(x, np.array([0]), x[:1], 4)[0] for x in (h, other)]
        missed += not (keys[0] == keys[1]).any()
    assert missed <= 1.3 * tries * P.MISS


def test_many_rows_without_id_are_spread(spark):
    data = [(None, cases.prose(i % 300, 70), "en", "s", 1) for i in range(900)]
    assert sum(got(cases.documents(spark, data=data)).values()) == sum(
        len(plain_cuts(t.split())) for _, t, *_ in data)


def test_empty_and_clashing(spark):
    assert P.passages(cases.empty(spark)).count() == 0
    data = corpus()[:10]
    assert got(cases.documents(spark, True, data)) == got(cases.documents(spark, False, data))


def test_only_repeated_paragraphs_are_placed(spark, monkeypatch):
    """Paragraphs that share band values but are not alike go no further, and a broadcast list needs no hash set."""
    kept, sets = [], []

    def written(df, purpose, put=P.written):
        out = put(df, purpose)
        if purpose == "paragraph-classes":
            kept.extend(r["count"] for r in out.groupBy("class").count().collect())
        return out

    monkeypatch.setattr(P, "written", written)
    monkeypatch.setattr(P, "hash_set", lambda hashes, column, make=P.hash_set: sets.append(column) or make(hashes, column))
    data = corpus()
    for i in range(40):
        words = cases.prose(7000 + i, 200).split()
        data += [(100 + i, " ".join(words), "en", "s", 1),
                 (200 + i, " ".join(w if k % 9 else f"new{k}" for k, w in enumerate(words)), "en", "s", 1)]
    assert got(cases.documents(spark, data=data), miss=1e-9) == expected(data)
    assert kept and min(kept) > 1
    assert "content" not in sets


def test_list_of_runs_too_large_to_broadcast(spark, monkeypatch):
    monkeypatch.setattr(P, "bounded_broadcast", lambda table: table)
    data = corpus()
    assert got(cases.documents(spark, data=data), miss=1e-9) == expected(data)


def peak_mb(batches):
    tracemalloc.start()
    try:
        n = sum(b.num_rows for b in batches)
        return n, tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def test_memory_of_a_task(spark):
    """Neither a batch of many texts nor a text with many runs takes more than a piece of it takes."""
    texts = pa.RecordBatch.from_arrays([pa.array([cases.prose(i % 50, 600) for i in range(2500)])], names=["text"])
    assert texts.nbytes > 6e6
    n, mb = peak_mb(P._node_rows(texts, 4, P.SPREAD))
    assert n > 2500 and mb < 120
    words = cases.prose(1, 600).split()
    places = [{"first": i % 400, "stop": i % 400 + 100 + i // 400} for i in range(40_000)]
    kind = pa.list_(pa.struct([("first", pa.int64()), ("stop", pa.int64())]))
    one = pa.RecordBatch.from_arrays([pa.array([7, 8]), pa.array([" ".join(words), "none here"]), pa.array([places, []], kind)],
                                     names=["content", "text", "places"])
    n, mb = peak_mb(P._cut_runs(one))
    assert n == 40_000 and mb < 120
    rows = [r for b in P._cut_runs(one) for r in b.to_pylist()]
    assert [(r["first"], r["stop"]) for r in rows] == [(p["first"], p["stop"]) for p in places]
    assert all(r["content"] == 7 and r["words"] == " ".join(words[r["first"]:r["stop"]]).lower() for r in rows[::97])
