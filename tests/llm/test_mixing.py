from collections import defaultdict

import pytest

from starling.llm import mixing
from tests.llm import cases


def brute_targets(sizes, weights, budget, epochs):
    """Raise the water level in small steps of the closed form: the level where the capped shares meet the budget."""
    lo, hi = 0.0, max(epochs * s / w for s, w in zip(sizes, weights)) if sizes else 0.0
    for _ in range(200):
        mid = (lo + hi) / 2
        if sum(min(epochs * s, mid * w) for s, w in zip(sizes, weights)) < budget:
            lo = mid
        else:
            hi = mid
    return [min(epochs * s, hi * w) for s, w in zip(sizes, weights)]


@pytest.mark.parametrize("sizes", [[10, 10, 10], [1000, 1, 1], [0, 5, 7, 900, 3], [1], [3, 0, 0, 0],
                                   [3 ** i for i in range(25)]])
def test_water_fill_meets_the_budget_below_every_cap(spark, sizes):
    weights = [(5, 2, 1)[i % 3] for i in range(len(sizes))]
    budget = 1.5 * sum(sizes)
    sources = spark.createDataFrame([(i, s, float(w)) for i, (s, w) in enumerate(zip(sizes, weights))], "i int, size long, weight double")
    got = [r.target for r in mixing.water_fill(sources, budget, 2).orderBy("i").collect()]
    assert got == pytest.approx(brute_targets(sizes, weights, budget, 2), rel=1e-9, abs=1e-9)
    assert sum(got) == pytest.approx(budget)
    assert all(t <= 2 * s for t, s in zip(got, sizes))


def test_any_number_of_sources(spark, monkeypatch):
    """A source per web domain, with the plan too large to broadcast."""
    from pyspark.sql import functions as F
    monkeypatch.setattr(mixing, "bounded_broadcast", lambda df: df)
    n = 50_000
    df = spark.range(n + 1).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") < n, F.format_string("d%06d.com", "id")).alias("source"),
        F.repeat(F.lit("w "), (F.col("id") % 9 + 1).cast("int")).alias("text"))
    plan = mixing.plan(df)
    rows = mixing.taken(df, plan).collect()
    sizes = [i % 9 + 1 for i in range(n + 1)]
    want = brute_targets(sizes, [(5, 2, 1)[i % 3] for i in range(n + 1)], 1.5 * sum(sizes), 2)
    assert len(rows) == n + 1
    for r in rows:
        assert r["__mix_target"] == pytest.approx(want[r.doc_id], rel=1e-9)
        assert r["__mix_whole"] * r["__mix_size"] + r["__mix_extra"] == pytest.approx(want[r.doc_id], abs=1.0)


def taken(df):
    rows = mixing.taken(df, mixing.plan(df)).collect()
    return sorted(((r["doc_id"], r["source"], r["__mix_size"], r["__mix_total"], r["__mix_target"],
                    r["__mix_whole"] * r["__mix_size"] + r["__mix_extra"]) for r in rows), key=repr)


def test_each_source_is_taken_to_its_target(spark):
    data = cases.rows()
    got = taken(cases.documents(spark).select("doc_id", "source", "text"))
    assert len(got) == len(data)
    by_source = defaultdict(list)
    for r in got:
        by_source[r[1]].append(r)
    sizes = {s: sum(len(cases.words(t)) for _, t, _, src, _ in data if src == s) for s in by_source}
    order = sorted(by_source, key=lambda s: (s is None, (s or "").encode()))
    targets = brute_targets([sizes[s] for s in order], [(5, 2, 1)[i % 3] for i in range(len(order))],
                            1.5 * sum(sizes.values()), 2)
    for s, target in zip(order, targets):
        assert {r[3] for r in by_source[s]} == {sizes[s]}
        assert [r[4] for r in by_source[s]] == pytest.approx([target] * len(by_source[s]))
        assert sum(r[5] for r in by_source[s]) == pytest.approx(target, abs=1.0)
    assert all(0 <= r[5] <= 2 * r[2] for r in got)


def test_reruns_and_other_partitions_agree(spark):
    df = cases.documents(spark).select("doc_id", "source", "text")
    assert taken(df) == taken(df.repartition(7))


def test_mixed_rows_hold_the_words_taken(spark):
    df = cases.documents(spark)
    plan = mixing.plan(df)
    out = mixing.mixed_rows(df, plan)
    assert out.columns == df.columns
    words = defaultdict(int)
    for r in out.collect():
        words[r.source] += len(cases.words(r.text))
    want = defaultdict(int)
    for _, source, _, _, _, n in taken(df.select("doc_id", "source", "text")):
        want[source] += n
    assert {k: v for k, v in words.items() if v} == {k: v for k, v in want.items() if v}


def test_a_cut_copy_is_the_start_of_its_text(spark):
    from pyspark.sql import functions as F
    df = spark.createDataFrame([("  a b\n c  d ",)], "t string")
    assert [df.select(mixing.first_words(F.col("t"), F.lit(n))).first()[0] for n in range(5)] == [
        "", "  a", "  a b", "  a b\n c", "  a b\n c  d"]


def test_empty_and_clashing(spark):
    empty = cases.empty(spark)
    assert mixing.taken(empty, mixing.plan(empty)).count() == 0
    df = cases.documents(spark, extra=True)
    out = mixing.mixed_rows(df, mixing.plan(df))
    assert out.columns == df.columns and out.count() > 0
