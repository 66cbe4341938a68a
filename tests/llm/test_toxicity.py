import zlib

import numpy as np
import pytest

from starling.llm import toxicity
from tests.conftest import SMOKE_DIR
from tests.llm import cases


def test_scores_match_the_factorization_machine_formula():
    rng = np.random.default_rng(0)
    model = toxicity.Model(0.3, np.arange(10, dtype=np.uint32) * 7, rng.normal(size=10), rng.normal(size=(10, 3)))
    at = np.array([1, 4, 9])
    z = model.bias + model.weights[at].sum() + sum(
        model.factors[i] @ model.factors[j] for a, i in enumerate(at) for j in at[a + 1:])
    assert model.raw(at) == pytest.approx(z)
    assert model.active(np.array([0, 1, 7, 63, 70], dtype=np.uint32)).tolist() == [0, 1, 9]


def test_a_pair_counts_beyond_its_parts():
    """Toxic only when an insult meets a group: the parts alone say little."""
    rng = np.random.default_rng(1)
    rows, labels = [], []
    for i in range(1200):
        a, b = rng.random() < 0.5, rng.random() < 0.5
        text = " ".join(["insult"] * a + ["group"] * b + [f"word{rng.integers(300)}" for _ in range(12)])
        rows.append(toxicity.text_terms(text))
        labels.append(int(a and b))
    model = toxicity.fit(rows[:900], np.array(labels[:900]))
    got = np.array([model.score(model.active(r)) for r in rows[900:]]) >= toxicity.DECISION
    assert (got == np.array(labels[900:])).mean() > 0.97


def test_held_out_accuracy(spark):
    from starling.llm.queries import op5_toxicity
    sf = SMOKE_DIR.replace("0.001", "0.1")
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = op5_toxicity(spark, sf).collect()
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)
    held = [(r.score, labels[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in labels]
    pos, neg = [s for s, y, _ in held if y], [s for s, y, _ in held if not y]
    assert np.mean([p > n for p in pos for n in neg]) > 0.9
    # some labels of the small tables follow no text feature; clean documents are left alone all the same
    assert sum(p and not y for _, y, p in held) <= 0.01 * len(neg)
    assert sum(p and y for _, y, p in held) >= 0.8 * len(pos)


def test_awkward_rows(spark):
    model = toxicity.fit([toxicity.text_terms("bad idiot"), toxicity.text_terms("good day")] * 20, np.array([1, 0] * 20))
    rows = toxicity.scores(cases.documents(spark, extra=True), model).collect()
    assert len(rows) == len(cases.rows()) and all(0 <= r.score <= 1 for r in rows)
    same = {r.score for r in rows if r.doc_id in (20, 21, 22)}
    assert len(same) == 1  # no terms: the bias
    assert toxicity.scores(cases.empty(spark), model).count() == 0


def test_training_without_both_labels_and_with_nulls(spark):
    from pyspark.sql import functions as F
    labels = spark.createDataFrame([(1, 1), (2, None), (None, 1), (99, 0)], "doc_id long, toxic int")
    rows, y = toxicity.training_rows(cases.documents(spark), labels, F.lit(True))
    assert len(rows) == 1 and y.tolist() == [1.0]
    assert toxicity.fit(rows, y).score(np.empty(0, dtype=np.int64)) > 0.99
    assert toxicity.fit([], np.array([])).score(np.empty(0, dtype=np.int64)) == pytest.approx(0.5)
