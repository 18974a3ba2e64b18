import itertools
import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from vicinage.llm.setjoin import match_tables, similar_classes, similar_pairs

SCHEMA = "rec string, token bigint"


def brute(data, t, least=1):
    sets = {}
    for r, x in data:
        if r is not None and x is not None:
            sets.setdefault(r, set()).add(x)
    keep = sorted(r for r, s in sets.items() if len(s) >= least)
    return [(a, b) for a, b in itertools.combinations(keep, 2) if len(sets[a] & sets[b]) >= t * len(sets[a] | sets[b]) - 1e-9]


def data(seed):
    rnd = random.Random(seed)
    out = []
    for g in range(12):
        base = [rnd.randrange(60) for _ in range(rnd.randrange(1, 14))]
        for k in range(4):
            out += [(f"g{g}.{k}", x) for x in base if rnd.random() > 0.15 * (k > 1)]
    return out + out[:9] + [(None, 1), ("x", None)]


@pytest.mark.parametrize("t", [0.5, 0.6, 0.8, 1.0])
@pytest.mark.parametrize("inline", [2048, 6])
def test_against_all_pairs(spark, t, inline):
    d = data(3)
    df = spark.createDataFrame(d, SCHEMA).withColumn("toks", F.lit(1)).withColumn("n", F.lit(1)).withColumn("pos", F.lit(1))
    assert rows(similar_pairs(df, "rec", "token", t, 3, inline).select("rec_a", "rec_b")) == brute(d, t, 3)


def test_just_at_the_threshold(spark):
    d = [("a", x) for x in range(1, 5)] + [("b", x) for x in (2, 3, 4, 5)]  # 3 of 5
    assert rows(similar_pairs(spark.createDataFrame(d, SCHEMA), "rec", "token", 0.6, 1).select("rec_a", "rec_b")) == [("a", "b")]


def test_copies_are_one_class(spark):
    d = [(f"c{i:03d}", x) for i in range(300) for x in (1, 2, 3)] + [("d", 1), ("d", 2), ("d", 3), ("d", 4)]
    members, pairs = similar_classes(spark.createDataFrame(d, SCHEMA), "rec", "token", 0.7)
    assert members.count() == 301 and rows(pairs.select("class_a", "class_b")) == [("c000", "d")]


def test_two_tables(spark):
    a = spark.createDataFrame([("a", 1), ("a", 2), ("b", 9)], SCHEMA)
    b = spark.createDataFrame([("a", 1), ("a", 2), ("c", 1)], SCHEMA)
    assert rows(match_tables(a, b, "rec", "token", 0.5).select("rec_a", "rec_b")) == [("a", "a"), ("a", "c")]


def test_empty(spark):
    assert similar_pairs(spark.createDataFrame([], SCHEMA), "rec", "token", 0.6).count() == 0
