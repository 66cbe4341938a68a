import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from starling.llm import source_audit
from tests.llm import cases


def plain(data, min_documents=30, top=50):
    """(lang, source, part, item, value, rank) with terms counted straight from the texts."""
    docs, counts = defaultdict(Counter), defaultdict(Counter)
    for _, text, lang, source, *_ in data:
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", cases.lower_ascii(text))
        docs[lang or ""].update(set(terms))
        counts[lang or "", source or ""].update(terms)
    out = []
    for lang in docs:
        kept = [t for t, n in docs[lang].items() if n >= min_documents]
        groups = {s: c for (at, s), c in counts.items() if at == lang}

        def shares(c):
            n = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 5) // (n + 5 * len(kept)) for t in kept}

        p = {s: shares(c) for s, c in groups.items()}
        q = shares(sum(groups.values(), Counter()))
        for s in groups:
            pairs = [(-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode()) for o in groups if o != s]
            terms = [(q[t] - p[s][t], t.encode()) for t in kept if groups[s][t] and p[s][t] > q[t]]
            for part, items in ("pair", sorted(pairs)), ("term", sorted(terms)[:top]):
                out += [(lang, s, part, i.decode(), -v, r) for r, (v, i) in enumerate(items, 1)]
    return sorted(out)


def rows():
    """Terms whose documents lie on either side of the limit only when their chunks are put together."""
    data = cases.rows()
    for i in range(40):
        word = f"w{'abcdefghij'[i % 10]}"
        text = f"{word}, {word}. ({word}) x{word}\t{word};{word} Common common's thing{i} über-{word}"
        data.append((100 + i, text * (1 + i % 3), ["en", "de", "en", None][i % 4], ["s1", "s2", None, "É", "s4"][i % 5], 1))
    return data + [(400, "12 34 !!", "xx", "only", 1), (401, None, "yy", "a", 1), (402, "", "yy", "b", 1)]


def result(df, **more):
    return sorted(map(tuple, source_audit.audit(df, **more).collect()))


@pytest.mark.parametrize("min_documents", [1, 2, 3, 4, 30])
def test_against_plain_counts(spark, min_documents):
    assert result(cases.documents(spark, data=rows()), min_documents=min_documents) == plain(rows(), min_documents)


def test_clashing_names_and_small_blocks(spark, monkeypatch):
    from starling.llm import text_bytes
    monkeypatch.setattr(source_audit, "blocks", lambda b, c, n=0: text_bytes.blocks(b, c, 50))
    assert result(cases.documents(spark, True, rows()), min_documents=3, top_terms=2) == plain(rows(), 3, 2)


def test_pairs_in_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(source_audit.pair_differences, "__defaults__", (4,))
    assert result(cases.documents(spark, data=rows()), min_documents=2) == plain(rows(), 2)


def test_each_distinct_chunk_is_cut_once(spark):
    """One row per (language, chunk, term), whatever the number of documents."""
    data = [(i, "Tree, tree. a-a", ["en", "de"][i % 2], f"s{i % 2}", 1) for i in range(50)]
    got = sorted(map(tuple, source_audit.term_parts(cases.documents(spark, data=data)).collect()))
    assert got == sorted((x, c, t, k, 25) for x in ("de", "en") for c, t, k in (("tree,", "tree", 1), ("tree.", "tree", 1), ("a-a", "a", 2)))


def test_full_hash_sets_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(source_audit, "hash_set", lambda hashes, column, bits=0: np.full(4, 2**64 - 1, dtype=np.uint64))
    assert result(cases.documents(spark, data=rows()), min_documents=3) == plain(rows(), 3)


def test_chunks_with_one_hash_are_told_apart_by_text(monkeypatch):
    from starling.llm.text_bytes import LOWER
    text, every = "Tree, tree. 12 tree, über", np.full(4, 2**64 - 1, dtype=np.uint64)
    data = LOWER[np.frombuffer(text.encode(), dtype=np.uint8)]
    monkeypatch.setattr(source_audit, "word_hashes", lambda data, start, end: np.full(len(start), 9, dtype=np.uint64))
    row, code, count, hashes, names, _ = source_audit._hashes_of(data, np.array([0, 13, len(data)]), every, every, every)
    assert sorted(zip(row.tolist(), names.take(code).to_pylist(), count.tolist())) == [
        (0, "tree,", 1), (0, "tree.", 1), (1, "tree,", 1), (1, "über", 1)]
    assert set(hashes.tolist()) == {9}


def test_many_sources(spark):
    data = [(i, cases.prose(i % 7, 30), "en", f"site{i}.org", 1) for i in range(300)]
    assert result(cases.documents(spark, data=data), min_documents=20) == plain(data, 20)


def test_products_beyond_64_bits(spark):
    from pyspark.sql import functions as F
    big = 9 * 10**12
    row = spark.range(1).select(source_audit._share(F.lit(big), F.lit(3 * big), F.lit(7).cast("long"), 5, 10**9).alias("p")).first()
    assert row.p == 1 + 10**9 * (big + 5) // (3 * big + 35)


def test_empty(spark):
    assert result(cases.empty(spark)) == []


def test_sums_of_several_blocks_are_added_up():
    sums = source_audit._Sums()
    h = np.array([5, 6], dtype=np.uint64)
    sums.add([("en", "a"), ("en", "b")], np.array([0, 1]), h, np.array([2, 3]))
    sums.add([("en", "b"), ("de", "a")], np.array([0, 1]), h[[1, 0]], np.array([4, 1]))
    rows = [r for b in sums.taken() for r in b.to_pylist()]
    assert sorted((r["lang"], r["source"], r["h"], r["chunk"], r["occ"], r["row"]) for r in rows) == [
        ("de", "a", 5, "", 1, None), ("en", "a", 5, "", 2, None), ("en", "b", 6, "", 7, None)]
    assert list(sums.taken()) == []
