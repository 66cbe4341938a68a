import random

import numpy as np
import pytest

from starling.llm import line_dedup as L
from tests.llm import cases

SPACE = " \t\n\x0b\x0c\r"


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1:
        return False
    if len(a) > len(b):
        a, b = b, a
    i = next((k for k in range(len(a)) if a[k] != b[k]), len(a))
    return a[i + (len(a) == len(b)):] == b[i + 1:]


def expected(data):
    """Dropped lines per document, comparing every line with every earlier one."""
    first, out = {}, {}
    for i, text, *_ in sorted(data, key=lambda r: (r[0] is None, r[0] or 0)):
        dropped, n = [], 0
        for no, line in enumerate((text or "").split("\n")):
            line = line.strip(SPACE)
            if not line:
                continue
            n += 1
            if line in first:
                dropped.append(no)
                continue
            near = len(line) >= L.MIN_NEAR and any(len(x) >= L.MIN_NEAR and one_edit(line, x) for x in first)
            first[line] = near
            if near:
                dropped.append(no)
        out[i] = (n, dropped)
    return out


def edits(seed, docs=50):
    rng = random.Random(seed)
    base = ["".join(rng.choice("abcd é") for _ in range(rng.randint(17, 34))).strip() for _ in range(10)]
    data = []
    for i in range(docs):
        lines = []
        for _ in range(rng.randint(0, 7)):
            s = rng.choice(base)
            for _ in range(rng.randint(0, 3)):
                p = rng.randrange(len(s) + 1)
                s = rng.choice([s[:p] + "x" + s[p:], s[:p] + s[p + 1:], s[:p] + "y" + s[p + 1:]])
            lines.append(s)
        data.append((i, "\n".join(lines), "en", "s", 1))
    return data


@pytest.mark.parametrize("seed", [1, 2])
def test_dropped_lines_match_all_pairs(spark, seed):
    data = edits(seed)
    got = {r.doc_id: (r.n_lines, r.dropped) for r in L.document_decisions(cases.documents(spark, data=data)).collect()}
    assert got == expected(data)


def test_awkward_rows(spark):
    data = [r for r in cases.rows() if r[0] is not None]
    unique = list({r[0]: r for r in data}.values())
    got = {r.doc_id: (r.n_lines, r.dropped) for r in L.document_decisions(cases.documents(spark, data=unique)).collect()}
    assert got == expected(unique)
    rows = L.document_decisions(cases.documents(spark, extra=True)).collect()
    assert len(rows) == len({r[0] for r in cases.rows()})
    assert L.document_decisions(cases.empty(spark)).count() == 0


def test_rows_without_an_id_or_with_the_same_one_stay_apart(spark):
    a, b, c, d = (f"line {x} of some length {x * 9}" for x in "pqrs")
    data = [(1, a, "en", "s", 1), (None, f"{b}\n{a}", "en", "s", 1), (None, f"{a}\n{c}", "en", "s", 1),
            (7, d, "en", "s", 1), (7, d, "en", "s", 1), (8, None, "en", "s", 0), (None, "", "en", "s", 0)]
    df = cases.documents(spark, data=data)
    got = sorted(((r.doc_id, r.n_lines, r.n_exact, r.dropped) for r in L.row_decisions(df).collect()), key=repr)
    assert got == sorted([(1, 1, 0, []), (None, 2, 1, [1]), (None, 2, 1, [0]), (7, 1, 0, []), (7, 1, 1, [0]),
                          (8, 0, 0, []), (None, 0, 0, [])], key=repr)
    by_id = {r.doc_id: r.dropped for r in L.document_decisions(df).collect()}
    assert by_id == {1: [], None: [], 7: [], 8: []}  # no line number that another row keeps


def whole(s):
    return L.variants(s, [0], 1)[0][-1]


def test_variant_hashes_are_those_of_the_shorter_lines():
    rng = random.Random(3)
    for _ in range(50):
        s = "".join(rng.choice("abé\U0001F600") for _ in range(rng.randint(2, 40)))
        hashes, places = L.variants(s, [0], 1)
        assert places.tolist() == [*range(len(s)), -1]
        for h, p in zip(hashes[:-1], places):
            assert h == whole(s[:p] + s[p + 1:])


@pytest.mark.parametrize("segments", [L.SEGMENTS, L.FINE])
def test_partners_share_a_context_and_a_variant(segments):
    rng = random.Random(9)
    for _ in range(400):
        a = "".join(rng.choice("ab") for _ in range(rng.randint(20, 40)))
        p = rng.randrange(len(a) + 1)
        b = rng.choice([a[:p] + "c" + a[p:], a[:p] + a[p + 1:], a[:p] + "c" + a[p + 1:]])
        kx, ky = L.context_keys([a, b], segments)
        assert (kx == L.context_keys([a], segments)[0]).all()  # a line's keys do not depend on its batch
        sx, sy = ([i for i in range(len(u)) if u[i] in set(w)] for u, w in ((kx, ky), (ky, kx)))
        assert sx and sy
        vx, vy = (set(zip(*[z.tolist() for z in L.variants(s, k, segments)])) for s, k in ((a, sx), (b, sy)))
        same = {(v, q) for v, q in vx & vy if q >= 0}
        less = {v for v, q in vx if q < 0} & {v for v, q in vy if q >= 0} | {v for v, q in vy if q < 0} & {v for v, q in vx if q >= 0}
        assert a == b or same or less


def test_drop_lines(spark):
    from pyspark.sql import functions as F
    df = spark.createDataFrame([("a\nb\n\nc", [1, 3])], "t string, d array<int>")
    assert df.select(L.drop_lines(F.col("t"), F.col("d"))).first()[0] == "a\n"
