import random

import pytest
from pyspark.sql import functions as F

from vicinage.llm.packing import Bins, fill_report, pack

SCHEMA = "doc_id bigint, text string"


def check(p, capacity):
    assert p.n_tokens.min() > 0 and p.groupby("bin_id").n_tokens.sum().max() <= capacity
    for _, g in p.sort_values("piece_no").groupby("doc_id"):
        assert list(g.piece_no) == list(range(len(g))) and g.tok_from.iloc[0] == 0
        assert (g.tok_from.iloc[1:].values == g.tok_to.iloc[:-1].values).all() and (g.n_tokens.iloc[:-1] == capacity).all()


@pytest.mark.parametrize("capacity,left", [(64, 10**6), (64, 7), (7, 50), (1, 10**6)])
def test_containers(spark, capacity, left):
    rnd = random.Random(5)
    data = [(i, " ".join("word" for _ in range(rnd.randrange(0, 90)))) for i in range(200)] + [(900, None), (901, "")]
    df = spark.createDataFrame(data, SCHEMA).repartition(6).withColumn("key", F.lit(1)).withColumn("bin_id", F.lit("x"))
    p = pack(df, capacity=capacity, left=left).toPandas()
    check(p, capacity)
    assert set(p.doc_id) == {i for i, t in data if t}


def test_little_room_left(spark, sf):
    r = fill_report(pack(spark.read.parquet(f"{sf.replace('0.001', '0.01')}/documents.parquet"))).first()
    assert r.fill > 0.95 and r.fullest <= 2048


def test_very_long_text(spark):
    p = pack(spark.createDataFrame([(1, "word " * 50_000), (2, "x")], SCHEMA), capacity=1000).toPandas()
    check(p, 1000)
    assert p[p.doc_id == 1].n_tokens.sum() >= 50_000


def test_empty(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert pack(df).count() == 0 and fill_report(pack(df)).first().n_bins == 0


def test_fixed_count_of_a_class():
    b = Bins(100, 0)
    for i in range(9):
        b.put(i, 30)  # class 3
    assert [len(t) for _, t in b.fill()] == [3, 3, 3] and b.held == 0


def test_many_leftovers_never_gather(spark):
    """More leftovers than a closing task takes: each class packs its own."""
    data = [(i, " ".join(["w"] * (1 + i % 9))) for i in range(6000)]
    p = pack(spark.createDataFrame(data, SCHEMA).repartition(300), capacity=10, left=1).toPandas()
    check(p, 10)
    assert len(p) == 6000 and p.groupby("bin_id").n_tokens.sum().mean() > 7
