"""The pipeline stage by stage against plain Python, and the registered queries against their SQL."""

import hashlib
import os
from collections import Counter, defaultdict

import duckdb
import pytest

import corpus_pipeline
from starling.llm.oracle import ORACLE
from starling.llm.queries import QUERIES
from starling.sources.testdata import TABLES
from tests.compare import duck_rows, spark_rows
from tests.conftest import SMOKE_DIR
from tests.llm import cases
from tests.llm.test_simhash import plain_fingerprint


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        if os.path.exists(p := f"{SMOKE_DIR}/{t}.parquet"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_its_sql(spark, duck, name):
    cols, rows = spark_rows(QUERIES[name](spark, SMOKE_DIR))
    want_cols, want = duck_rows(duck, ORACLE[name])
    assert cols == want_cols and rows == want


def test_every_operator_has_one_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_stages_follow_each_other(spark):
    docs = spark.read.parquet(f"{SMOKE_DIR}/documents.parquet")
    stage = dict(corpus_pipeline.STAGES)
    names = list(stage)
    kept = stage[names[0]](spark, docs, SMOKE_DIR)
    verdicts = QUERIES["op3_quality_rules"](spark, SMOKE_DIR).where("kept").select("doc_id").collect()
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in verdicts)

    groups = defaultdict(list)
    for r in kept.collect():
        groups[hashlib.md5(cases.lower_ascii(r.text).encode()).digest()].append(r.doc_id)
    unique = stage[names[1]](spark, kept, SMOKE_DIR)
    assert sorted(r.doc_id for r in unique.collect()) == sorted(max(v) for v in groups.values())

    rows = unique.collect()
    union = cases.Groups()
    fps = [(r.doc_id, plain_fingerprint(r.text)) for r in rows]
    for i, (a, x) in enumerate(fps):
        union.find(a)
        for b, y in fps[:i]:
            if (x ^ y).bit_count() <= 2:
                union.join(a, b)
    least = defaultdict(list)
    for a, _ in fps:
        least[union.find(a)].append(a)
    apart = stage[names[2]](spark, unique, SMOKE_DIR)
    assert sorted(r.doc_id for r in apart.collect()) == sorted(min(v) for v in least.values())

    mixed = stage[names[3]](spark, apart, SMOKE_DIR)
    n = sum(len(cases.words(r.text)) for r in apart.collect())
    assert sum(len(cases.words(r.text)) for r in mixed.collect()) == pytest.approx(1.5 * n, abs=21)
    for df in (kept, unique, apart, mixed):
        assert df.columns == docs.columns
    packed = stage[names[4]](spark, mixed, SMOKE_DIR).collect()
    ends = Counter(r.doc_id for r in packed if r.start + r.length == r.doc_tokens)
    assert ends == Counter(r.doc_id for r in mixed.collect())


def test_awkward_rows_pass_every_stage(spark):
    for docs in (cases.documents(spark, extra=True), cases.empty(spark)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, SMOKE_DIR)
            assert out.columns == corpus_pipeline.COLUMNS
            out.count()
        corpus_pipeline.STAGES[-1][1](spark, docs, SMOKE_DIR).count()


def test_run(spark):
    assert corpus_pipeline.run(spark, SMOKE_DIR).count() > 0
