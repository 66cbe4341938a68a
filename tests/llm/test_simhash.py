from collections import defaultdict

import numpy as np
import pytest
import xxhash

from starling.llm import simhash as S
from tests.llm import cases


def plain_fingerprint(text, k=3):
    w = cases.words(cases.lower_ascii(text))
    if not w:
        return 0
    shingles = [" ".join(w[i:i + k]) for i in range(max(1, len(w) - k + 1))]
    count = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for b in range(64):
            count[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * count[b] > len(shingles))


def expected(data, max_bits):
    fps = [(i, plain_fingerprint(t)) for i, t, *_ in data]
    groups = cases.Groups()
    distinct = sorted({f for _, f in fps})
    for i, a in enumerate(distinct):
        groups.find(a)
        for b in distinct[:i]:
            if (a ^ b).bit_count() <= max_bits:
                groups.join(a, b)
    least = defaultdict(list)
    for i, f in fps:
        least[groups.find(f)].append(i)
    low = {g: min((i for i in ids if i is not None), default=None) for g, ids in least.items()}
    return sorted(((i, format(f, "016x"), low[groups.find(f)]) for i, f in fps), key=repr)


@pytest.mark.parametrize("max_bits", [0, 1, 2])
def test_groups_match_all_pairs(spark, max_bits):
    got = S.near_duplicates(cases.documents(spark, extra=True), max_bits=max_bits).collect()
    assert sorted(map(tuple, got), key=repr) == expected(cases.rows(), max_bits)


def clouds(seed, centres, each):
    """Fingerprints in crowded clouds around a few centres, and some far apart."""
    rng = np.random.default_rng(seed)
    out = []
    for c in rng.integers(0, 1 << 63, centres, dtype=np.uint64):
        for _ in range(each):
            flips = sum(1 << int(b) for b in set(rng.integers(0, 64, rng.integers(0, 5)).tolist()))
            out.append(int(c) ^ flips)
    return out + [int(x) for x in rng.integers(0, 1 << 63, 60, dtype=np.uint64)]


@pytest.mark.parametrize("max_bits", [1, 2])
@pytest.mark.parametrize("crowd", [1, 4, 10_000])
@pytest.mark.parametrize("parts", [2, 3, 4])
def test_components_of_crowded_fingerprints(spark, max_bits, crowd, parts):
    values = clouds(parts, 4, 60)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    got = S.components(spark.createDataFrame([(v,) for v in signed], "fp long"), max_bits, parts, crowd).collect()
    groups = cases.Groups()
    distinct = sorted(set(values))
    for i, a in enumerate(distinct):
        groups.find(a)
        for b in distinct[:i]:
            if (a ^ b).bit_count() <= max_bits:
                groups.join(a, b)
    ours = {r.fp & (1 << 64) - 1: r.component for r in got}
    assert len(got) == len(distinct)
    pairs = {(ours[v], groups.find(v)) for v in distinct}
    assert len(pairs) == len({a for a, _ in pairs}) == len({b for _, b in pairs})


def test_thresholds_satisfy_the_generalised_pigeonhole():
    rng = np.random.default_rng(2)
    for max_bits in (0, 1, 2):
        for parts in (1, 2, 3, 5):
            cost = [[0.0, *np.sort(rng.random(max_bits + 1) * 100)] for _ in range(parts)]
            picks = S.allocate(cost, max_bits)
            assert sum(picks) == max_bits - parts + 1 and min(picks) >= -1
            best = min((sum(c[t + 1] for c, t in zip(cost, p)) for p in _allocations(parts, max_bits)))
            assert sum(c[t + 1] for c, t in zip(cost, picks)) == pytest.approx(best)


def _allocations(parts, max_bits):
    from itertools import product
    return [p for p in product(range(-1, max_bits + 1), repeat=parts) if sum(p) == max_bits - parts + 1]


def test_correlated_bits_share_a_part():
    rng = np.random.default_rng(4)
    x = rng.integers(0, 2, (2000, 64)).astype(float)
    twins = [(0, 40), (5, 63), (17, 30)]
    for a, b in twins:
        x[:, b] = x[:, a]
    parts = S.correlated_parts(len(x), x.T @ x, 3)
    assert sorted(b for p in parts for b in p) == list(range(64))
    assert all(any(a in p and b in p for p in parts) for a, b in twins)


def test_keep_rows_keeps_one_of_each_group(spark):
    df = cases.documents(spark, extra=True)
    out = S.keep_rows(df)
    assert out.columns == df.columns
    groups = defaultdict(set)
    for i, _, g in expected(cases.rows(), 2):
        groups[g].add(i)
    kept = [r.doc_id for r in out.collect()]
    assert {g for g in groups if g is not None} == {i for i in kept if i is not None}


def test_empty(spark):
    assert S.near_duplicates(cases.empty(spark)).count() == 0
    assert S.keep_rows(cases.empty(spark)).count() == 0
