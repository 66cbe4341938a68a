"""The micro-batch log: atomic commits, replay, compaction and merge on read."""

from __future__ import annotations

import os
import random

import pytest
from pyspark.sql import functions as F

from starling.operators.keep import keep_last
from starling.plans import build as P
from starling.streaming import feed_stream
from starling.streaming.batch_log import BatchLog
from tests.conftest import SMOKE_DIR, plan_text
from tests.test_stream_and_files import _stream_result

SCHEMA = "k long, at int, v string"


def rows(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def log_of(spark, path):
    return BatchLog(spark, path, rows(spark, []).schema)


def test_a_writer_killed_between_files_shows_nothing(spark, tmp_dir):
    log = log_of(spark, tmp_dir + "/log")
    log.append(rows(spark, [(1, 1, "a")]), 0)
    attempt = log.write(rows(spark, [(2, 1, "b"), (3, 1, "c")]).repartition(2), 1)  # dies before its commit
    files = [f for f in os.listdir(f"{tmp_dir}/log/batch_id=1/attempt={attempt}") if f.endswith(".parquet")]
    os.remove(f"{tmp_dir}/log/batch_id=1/attempt={attempt}/{files[0]}")             # and between its files
    assert log.read().count() == 1
    assert log.append(rows(spark, [(2, 1, "b"), (3, 1, "c")]), 1)                   # the replay
    assert sorted(tuple(r) for r in log.read().collect()) == [(1, 1, "a", 0), (2, 1, "b", 1), (3, 1, "c", 1)]
    assert not log.append(rows(spark, [(9, 9, "late")]), 1)                         # replayed once more
    assert log.read().count() == 3


def test_two_commits_of_a_batch_are_read_once(spark, tmp_dir):
    log = log_of(spark, tmp_dir + "/log")
    for _ in range(2):  # a writer that was thought dead commits too
        log.commit(0, log.write(rows(spark, [(1, 1, "a")]), 0))
    assert log.read().count() == 1


def test_an_empty_log(spark, tmp_dir):
    log = log_of(spark, tmp_dir + "/log")
    assert log.read().count() == 0 and log.latest("k", ["at"]).count() == 0
    assert log.compact("k", ["at"]) is None and log.vacuum() == []


@pytest.mark.parametrize("vacuum", [False, True])
def test_compaction_changes_no_answer(spark, tmp_dir, vacuum):
    rng, log, want, n = random.Random(3), log_of(spark, tmp_dir + "/log"), {}, 0

    def check():
        got = {r.k: (r.at, r.v) for r in log.latest("k", ["at"]).collect()}
        assert got == want

    for batch in range(9):
        data = [(rng.randrange(40), rng.randrange(1000), f"v{n + i}") for i in range(60)]  # out of order, with ties
        n += len(data)
        log.append(rows(spark, data), batch)
        for k, at, v in data:
            want[k] = max(want.get(k, (-1, "")), (at, v))
        check()
        if batch % 3 == 1:
            # a compaction that dies before its commit changes nothing
            log.latest("k", ["at"]).write.parquet(f"{tmp_dir}/log/_snapshots/dead-{batch}")
            check()
            assert log.compact("k", ["at"], through=batch - 1) == batch - 1  # a tail of one batch stays
            check()
            assert log.compact("k", ["at"], through=batch - 1) == batch - 1
            if vacuum:
                assert batch - 1 in log.vacuum()
                check()
                assert not log.append(rows(spark, [(1, 10_000, "replayed")]), batch - 1)
    assert log.committed().keys() == (set(range(7, 9)) if vacuum else set(range(9)))
    log.close()


def test_the_snapshot_is_not_shuffled(spark, tmp_dir):
    log = log_of(spark, tmp_dir + "/log")
    log.append(rows(spark, [(i, i, "old") for i in range(100)]), 0)
    log.compact("k", ["at"])
    log.append(rows(spark, [(5, 500, "new"), (100, 1, "new")]), 1)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_text(log.latest("k", ["at"]))
        assert plan.count("Bucketed: true") == 1
        # the only shuffle is that of the tail's grouping
        body = plan.split("== Physical Plan ==")[1]
        assert body.split("\n\n")[0].count("Exchange") == 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        log.close()


def test_compacted_stream_equals_batch(spark, tmp_dir):
    """Before, during and after compaction, the last lines are those of the batch build."""
    want = sorted(P.warehouse(spark, SMOKE_DIR).table("staging").collect())
    log = _stream_result(spark, SMOKE_DIR, 5, tmp_dir)
    assert sorted(feed_stream.latest_compacted(spark, log).collect()) == want
    for through in (1, 3, None):
        feed_stream.compact_log(spark, log, through)
        assert sorted(feed_stream.latest_compacted(spark, log).collect()) == want
    assert feed_stream.enriched_from_log(spark, log).count() == P.enriched_lines(spark, SMOKE_DIR).count()


def test_a_bucketed_log_reduces_and_meets_batches_without_a_shuffle(spark, tmp_dir):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    log = BatchLog(spark, f"{tmp_dir}/log", rows(spark, []).schema, bucket_by="k")
    try:
        log.append(rows(spark, [(k % 50, k, str(k)) for k in range(500)]), 0)
        log.append(rows(spark, [(k % 30, k, str(k)) for k in range(500, 600)]), 1)
        newest = keep_last(log.read(0).select("k", "at", "v"), "k", ["at"])
        assert "Exchange" not in plan_text(newest)
        both = newest.select("k", "at").join(log.latest("k", ["at"], 0, of=newest.select("k")).select("k", "v"), "k")
        assert "Exchange" not in plan_text(both)
        assert sorted(map(tuple, both.collect())) == [(k, max(o for o in range(500, 600) if o % 30 == k), str(max(
            o for o in range(500) if o % 50 == k))) for k in range(30)]
        assert log.read().count() == 600
        every = keep_last(log.read().select("k", "at", "v"), "k", ["at"]).select("k", "at").collect()
        assert sorted(map(tuple, every)) == [(k, max(o for o in range(600) if (o % 50 if o < 500 else o % 30) == k))
                                             for k in range(50)]
    finally:
        log.close()
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
