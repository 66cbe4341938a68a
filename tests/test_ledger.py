"""The ledger of delivered files: copies load once, repeats get what they got."""

from __future__ import annotations

import os
import shutil

from starling.sources import feed_csv
from starling.sources.ledger import FeedLedger


def deliver(folder, **files):
    os.makedirs(folder, exist_ok=True)
    for name, text in files.items():
        with open(f"{folder}/{name}.csv", "w") as f:
            f.write(text)
    return folder


def line(order):
    return f"{order},1997-01-05 00:00:00,1,2,3,4,1\n"


def names(paths):
    return sorted(p.rsplit("/", 1)[1] for p in paths)


def test_a_file_delivered_twice_loads_once(spark, tmp_dir):
    book, feed = FeedLedger(spark, tmp_dir + "/ledger"), tmp_dir + "/feed"
    deliver(feed, a=line(1) + line(2), b=line(3), copy_of_b=line(3))
    assert names(book.claim(feed, 0)) == ["a.csv", "b.csv"]
    assert names(book.claim(feed, 0)) == ["a.csv", "b.csv"]             # a repeated batch
    assert book.claim(feed, 1) == []                                    # nothing new
    deliver(feed, c=line(4))
    shutil.copy(feed + "/a.csv", feed + "/late_copy_of_a.csv")
    assert names(book.claim(feed, 2)) == ["c.csv"]
    assert book.files().count() == 5                                    # copies are on record


def test_near_copies_are_other_files(spark, tmp_dir):
    book = FeedLedger(spark, tmp_dir + "/ledger")
    feed = deliver(tmp_dir + "/feed", a=line(1) + line(1), b=line(1), c=line(2), d=line(1) + line(2))
    assert names(book.claim(feed, 0)) == ["a.csv", "b.csv", "c.csv", "d.csv"]


def test_a_batch_that_died_before_its_commit(spark, tmp_dir):
    book = FeedLedger(spark, tmp_dir + "/ledger")
    feed = deliver(tmp_dir + "/feed", a=line(1))
    book.log.write(book._decide(feed), 0)
    assert names(book.claim(feed, 0)) == ["a.csv"]


def test_odd_names_empty_files_and_folders(spark, tmp_dir):
    book = FeedLedger(spark, tmp_dir + "/ledger")
    feed = deliver(tmp_dir + "/feed", **{"with space": line(1), "per%20cent+plus": line(2), "empty": ""})
    assert names(book.claim(feed, 0)) == ["per%20cent+plus.csv", "with space.csv"]
    rows = feed_csv.clean_feed(book.read_feed(feed, 0))
    assert sorted(r.order_id for r in rows.collect()) == [1, 2]
    nothing = book.read_feed(deliver(tmp_dir + "/none"), 1)
    assert feed_csv.clean_feed(nothing).count() == 0
