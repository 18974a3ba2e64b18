import itertools
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from vicinage.llm import cooccur
from vicinage.llm.cooccur import cooccurrence

SCHEMA = "rec string, item bigint"


def brute(data, least, lift):
    sets = {}
    for r, i in data:
        if r is not None and i is not None:
            sets.setdefault(r, set()).add(i)
    n, ab = Counter(i for s in sets.values() for i in s), Counter(p for s in sets.values() for p in itertools.combinations(sorted(s), 2))
    return sorted((a, b, n[a], n[b], k, len(sets)) for (a, b), k in ab.items() if k >= least and k * len(sets) >= lift * n[a] * n[b])


def data(seed, records=150):
    rnd = random.Random(seed)
    out = [(f"r{r}", int(rnd.paretovariate(0.7)) % 90) for r in range(records) for _ in range(rnd.randrange(1, 12))]
    out += [(f"wide{w}", i) for w in range(4) for i in range(w, 70)]
    return out + out[:20] + [(None, 1), ("r1", None)]


@pytest.mark.parametrize("least,lift", [(1, 0), (3, 1.5), (8, 3)])
@pytest.mark.parametrize("wide", [3, 20, 256])
def test_against_all_pairs(spark, least, lift, wide, monkeypatch):
    monkeypatch.setattr(cooccur, "BLOCK", 40)
    monkeypatch.setattr(cooccur, "DENSITY", 8)
    d = data(7)
    df = spark.createDataFrame(d, SCHEMA).withColumn("heavy", F.lit(1)).withColumn("n", F.lit("x"))
    got = rows(cooccurrence(df, "rec", "item", least, lift, wide).drop("lift"))
    assert got == brute(d, least, lift)


def test_pairs_only_in_wide_records(spark):
    d = [(f"w{w}", i) for w in range(5) for i in range(30)] + [(f"s{k}", 100 + k) for k in range(400)]
    got = rows(cooccurrence(spark.createDataFrame(d, SCHEMA), "rec", "item", 5, 1, wide=10).drop("lift"))
    assert got == brute(d, 5, 1)


def test_empty_and_single(spark):
    assert cooccurrence(spark.createDataFrame([], SCHEMA), "rec", "item").count() == 0
    assert cooccurrence(spark.createDataFrame([("a", 1), ("b", 2)], SCHEMA), "rec", "item").count() == 0
