import random

import pytest
from pyspark.sql import functions as F

from starling.llm import common
from tests.llm import cases


@pytest.mark.parametrize("edges", [
    [], [(1, 1)], [(i, i + 1) for i in range(40)], [(0, i) for i in range(1, 60)], [(5, 3), (3, 5), (9, 3), (-4, 9)],
    [(random.Random(1).randrange(60), random.Random(i).randrange(60)) for i in range(50)]])
def test_components(spark, edges):
    groups, least = cases.Groups(), {}
    for a, b in edges:
        groups.join(a, b)
    for n in list(groups.up):
        least[groups.find(n)] = min(n, least.get(groups.find(n), n))
    got = common.edges_to_components(spark.createDataFrame(edges, "src long, dst long")).collect()
    linked = {n for a, b in edges if a != b for n in (a, b)}
    assert len(got) == len(linked)
    assert {r.node: r.component for r in got} == {n: least[groups.find(n)] for n in linked}


def test_lower_ascii_and_words(spark):
    texts = ["AbC", "ÉÀ AZ", "", "\U0001F600 X\tY\x0bZ\x85W\xa0V", "İΣ"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(
        "t", common.lower_ascii(F.col("t")).alias("low"), common.n_words(F.col("t")).alias("n")).collect()
    for r in rows:
        assert r.low == cases.lower_ascii(r.t) and r.n == len(cases.words(r.t))


def test_a_broadcast_needs_a_measured_size(spark):
    table = common.written(spark.range(1000).select("id", F.repeat(F.lit("x"), 100).alias("s"),
                                                    F.array(F.lit(1), F.lit(2)).alias("a")), "test")
    assert "broadcast" in common.bounded_broadcast(table)._jdf.queryExecution().logical().toString().lower()
    assert "broadcast" not in common.bounded_broadcast(table, 1000)._jdf.queryExecution().logical().toString().lower()


def test_a_small_table_has_an_enforced_bound(spark):
    assert len(common.small_table(spark.range(5), 5, "rows")) == 5
    with pytest.raises(ValueError, match="more than 4"):
        common.small_table(spark.range(5), 4, "rows")
