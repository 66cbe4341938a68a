import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from starling.llm import exact_dedup
from tests.llm import cases


def expected(data, pick=max):
    groups = defaultdict(list)
    for doc_id, text, *_ in data:
        groups[cases.lower_ascii(text)].append(doc_id)
    out = set()
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = pick(known) if known else None
        for i in ids:
            out.add((i, keep, len(ids), i == keep, hashlib.sha256(text.encode()).hexdigest()))
    return out


@pytest.mark.parametrize("keep,pick", [("largest", max), ("smallest", min)])
@pytest.mark.parametrize("extra", [False, True])
def test_decisions(spark, keep, pick, extra):
    rows = exact_dedup.decisions(cases.documents(spark, extra), keep=keep).collect()
    got = {(r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in rows}
    assert got == expected(cases.rows(), pick) and len(rows) == len(got)


@pytest.mark.parametrize("keep,pick", [("largest", max), ("smallest", min)])
def test_keep_rows(spark, keep, pick):
    df = cases.documents(spark, extra=True)
    out = exact_dedup.keep_rows(df, keep=keep)
    assert out.columns == df.columns and out.schema["doc_id"].dataType == df.schema["doc_id"].dataType
    texts = [cases.lower_ascii(r.text) for r in out.collect()]
    assert len(texts) == len(set(texts)) == len({cases.lower_ascii(t) for _, t, *_ in cases.rows()})
    kept = {(i, h) for i, k, _, stays, h in expected(cases.rows(), pick) if stays}
    got = {(r.doc_id, hashlib.sha256(cases.lower_ascii(r.text).encode()).hexdigest()) for r in out.collect()}
    assert {(i, h) for i, h in got if i is not None} == {(i, h) for i, h in kept if i is not None}


def test_hash_collisions_are_told_apart(spark, monkeypatch):
    """With a hash that collides for all texts, the byte comparison still finds the groups."""
    monkeypatch.setattr(exact_dedup, "content_hash", lambda text: F.unhex(F.lit("00" * 16)))
    rows = exact_dedup.decisions(cases.documents(spark)).collect()
    assert {(r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in rows} == expected(cases.rows())
    assert exact_dedup.keep_rows(cases.documents(spark)).count() == len({cases.lower_ascii(t) for _, t, *_ in cases.rows()})


def test_empty(spark):
    assert exact_dedup.decisions(cases.empty(spark)).count() == 0
    assert exact_dedup.keep_rows(cases.empty(spark)).count() == 0
