import zlib
from collections import defaultdict
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest

from starling.llm import packing
from starling.llm.queries import tokenizer_file
from tests.llm import cases


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(tokenizer_file())


def ids_of(tokenizer, text):
    return np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], dtype="<u4")


def test_word_cache_gives_the_tokenizers_ids(tokenizer):
    texts = [t or "" for _, t, *_ in cases.rows()] + [
        "Don't STOP, it's 12:30!", "é ́e Å 가", "tab\tand\x1cmore", "Ab.c. d... e!? f.) (g. h,", "x.\ny,\tz. É. Ÿ. 5. ß. à,", "ª º µ ª. ĳ ŉ ǅ ß, İ!", " lead  and trail ", "ΣΑΣ Σ İ",
        "a <|ENDOFTEXT|> b", "<|STARTOFTEXT|>Some words<|endoftext|>", "<|endoftext|>", "x<|EndOfText|>y <|endoftext |> <|ENDOFTEXT", "É <|ENDOFTEXT|>\nÉ"]
    want = [[*tokenizer.encode(t, add_special_tokens=False).ids, 1] for t in texts]
    for limit in (10**6, 50, 3):  # a small cache starts anew again and again
        cache = packing.WordCache(tokenizer_file(), limit)
        for part in (texts, texts[5:], texts[3:4], texts[:0], texts):
            ids, offsets = cache.encode(pa.array(["unused", *part], pa.string()).slice(1), 1)
            got = [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])]
            assert got == [want[texts.index(t)] for t in part]


def simulate(units, weights):
    """Deficit round-robin one quantum at a time: credits by weight, the quantum due first is sent."""
    due = [(Fraction(k + 1, w), s, k) for s, (n, w) in enumerate(zip(units, weights)) for k in range(n)]
    return [(s, k) for _, s, k in sorted(due)]


@pytest.mark.parametrize("units,weights", [
    ([5, 3, 1], [5, 3, 1]), ([4, 9, 2], [1, 1, 1]), ([7], [3]), ([6, 6, 6, 1], [5, 2, 1, 1]), ([30, 20, 10], [1, 2, 3])])
@pytest.mark.parametrize("huge", [False, True])
def test_quantum_positions_follow_the_round_robin(units, weights, huge):
    last, q = [1 + (3 * i) % 8 for i in range(len(units))], 8
    scale = 10**17 if huge else 1  # beyond 64-bit products: same order, exact integers
    at, want = 0, {}
    for s, k in simulate(units, weights):
        want[s, k] = at
        at += last[s] if k == units[s] - 1 else q
    for s, n in enumerate(units):
        got = packing.quantum_positions(s, np.arange(n), units, [w * scale for w in weights], last, q)
        assert got.tolist() == [want[s, k] for k in range(n)]


def check(spark, tokenizer, df, data, **kw):
    window = kw.get("window", packing.WINDOW)
    rows = packing.pack(df, tokenizer_file(), **kw).collect()
    wanted = sorted((i is None, i or 0, ids_of(tokenizer, t).tobytes()) for i, t, *_ in data)
    pieces = defaultdict(list)
    for r in rows:
        pieces[r.doc_id, r.doc_tokens].append(r)
    total = 0
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
        total += r.length
    assert total == sum(len(b) // 4 for _, _, b in wanted)
    for s, spans in sequences.items():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at and length > 0
            at += length
        assert at == window or s == max(sequences)
    assert sorted(sequences) == list(range(len(sequences)))
    for (none, i, b) in wanted:
        mine = sorted(pieces[None if none else i, len(b) // 4], key=lambda r: r.start)
        # every id of the document is in a piece with its checksum (rows given twice have their pieces twice)
        spans = {(r.start, r.length): r.ids_crc32 for r in mine}
        assert all(zlib.crc32(b[4 * a:4 * (a + n)]) in (crc, zlib.crc32(b[4 * a:4 * (a + n)])) for (a, n), crc in spans.items())
        assert sum(r.length for r in mine) % (len(b) // 4) == 0
    return rows


def test_pieces_tile_documents_and_sequences(spark, tokenizer):
    data = cases.rows()
    check(spark, tokenizer, cases.documents(spark), data)
    check(spark, tokenizer, cases.documents(spark, extra=True), data, window=64, quantum=16)
    check(spark, tokenizer, cases.documents(spark), data, window=100, quantum=7)


def test_checksums_are_those_of_the_ids(spark, tokenizer):
    data = [(i, cases.prose(i, 300), "en", f"s{i % 3}", 1) for i in range(20)]
    ids = {i: ids_of(tokenizer, t) for i, t, *_ in data}
    for r in packing.pack(cases.documents(spark, data=data), tokenizer_file()).collect():
        assert r.doc_tokens == len(ids[r.doc_id])
        assert r.ids_crc32 == zlib.crc32(ids[r.doc_id][r.start:r.start + r.length].tobytes())


@pytest.mark.parametrize("weights", [None, {"s0": 3, "s1": 1, "s2": 1}])
def test_every_window_holds_the_target_proportions(spark, tokenizer, weights):
    data = [(i, cases.prose(i, 400), "en", f"s{min(i % 4, 2)}", 1) for i in range(60)]
    rows = packing.pack(cases.documents(spark, data=data), tokenizer_file(), window=512, quantum=16, weights=weights).collect()
    source = {i: s for i, _, _, s, _ in data}
    total, held = defaultdict(int), defaultdict(lambda: defaultdict(int))
    for r in rows:
        total[source[r.doc_id]] += r.length
        held[r.sequence_id][source[r.doc_id]] += r.length
    target = weights or dict(total)
    ended = [s for s in range(len(held)) if any(not held[s][x] for x in target)]
    full = range(min(ended) - 1 if ended else len(held) - 1)
    assert len(full) > 10
    for s in full:  # as long as no source has run out
        for x in target:
            assert abs(held[s][x] - 512 * target[x] / sum(target.values())) <= 2 * 16 + 1


def test_empty(spark):
    assert packing.pack(cases.empty(spark), tokenizer_file()).count() == 0
