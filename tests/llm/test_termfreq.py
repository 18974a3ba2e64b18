import os

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from vicinage.llm.termfreq import TermCounts, signed

SCHEMA = "rec string, term bigint"


def frame(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def test_deltas_equal_one_count(spark):
    all_rows = [(f"r{i % 17}", i % 5) for i in range(60)] + [(None, 1), ("r1", None)]
    gone = [("r3", 3), ("r9", 4)]
    left = list(all_rows)
    for g in gone:
        left.remove(g)
    one = TermCounts(spark, rows=20)
    one.apply(signed(added=frame(spark, left)))
    more = TermCounts(spark, rows=20)
    more.apply(signed(added=frame(spark, all_rows[:30])))
    more.apply(signed(added=frame(spark, [])))
    more.apply(signed(added=frame(spark, all_rows[30:]), deleted=frame(spark, gone)))
    again = TermCounts.load(spark, more.path)
    assert rows(again.counts()) == rows(one.counts()) and again.n_records() == one.n_records()


def test_a_delta_writes_its_changes_only(spark):
    c = TermCounts(spark, rows=50)
    c.apply(signed(added=frame(spark, [(f"r{i}", i) for i in range(200)])))
    assert c.buckets["pair"] == 4
    before = {k: list(v) for k, v in c.live.items()}
    c.apply(signed(added=frame(spark, [("new", 7)])))
    assert all(c.live[k][:-1] == before[k] for k in before) and c.sizes["pair"] == [200, 1]
    assert c._read("term", c.live["term"][-1:]).count() == 1


def test_log_is_summed_up_and_old_folders_go(spark):
    c = TermCounts(spark, rows=50)
    for g in range(4):
        c.apply(signed(added=frame(spark, [(f"r{i}", i + 10 * g) for i in range(60)])))
    want = rows(c.counts())
    folders = [f for fs in c.live.values() for f in fs]
    root = c.path.removeprefix("file://")
    assert {f"{c.path}/{k}/{d}" for k in os.listdir(root) if k.startswith("kind=") for d in os.listdir(f"{root}/{k}")} == set(folders)
    assert rows(TermCounts.load(spark, c.path).counts()) == want


def test_a_delta_that_fails_changes_nothing(spark):
    c = TermCounts(spark)
    c.apply(signed(added=frame(spark, [("a", 1), ("b", 2)])))
    with pytest.raises(Exception, match="more deleted"):
        c.apply(signed(added=frame(spark, [("x", 9)]), deleted=frame(spark, [("a", 1), ("a", 1)])))
    assert rows(c.counts()) == rows(TermCounts.load(spark, c.path).counts()) == [(1, 1, 1), (2, 1, 1)]


def test_term_goes_and_comes_back(spark):
    c = TermCounts(spark)
    c.apply(signed(added=frame(spark, [("a", 1)])))
    c.apply(signed(deleted=frame(spark, [("a", 1)])))
    assert c.counts().count() == 0 and c.n_records() == 0
    c.apply(signed(added=frame(spark, [("b", 1)])))
    assert rows(c.counts()) == [(1, 1, 1)]


def test_too_many_deleted(spark):
    c = TermCounts(spark)
    with pytest.raises(Exception, match="more deleted"):
        c.apply(signed(deleted=frame(spark, [("a", 1)])))


def test_marks(spark):
    data = [(f"r{i}", 1) for i in range(10)] + [(f"r{i}", 2) for i in range(3)] + [("r0", 3), ("r1", 3)] + [("r0", 3)]
    c = TermCounts(spark)
    c.apply(signed(added=frame(spark, data).withColumn("sign", F.lit(5)).withColumn("n", F.lit(0))))
    assert rows(c.marked().select("term", "n_rows", "n_records", "mark")) == [(1, 10, 10, "common"), (2, 3, 3, "common"), (3, 3, 2, "rare")]


def test_empty(spark):
    c = TermCounts(spark)
    c.apply(signed(added=frame(spark, [])))
    assert c.marked().count() == 0
