import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from vicinage.llm.components import connected_components, hit_edges


def brute(edges):
    up = {}

    def find(x):
        up.setdefault(x, x)
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return sorted((x, find(x)) for x in up)


def found(spark, edges, **kw):
    return rows(connected_components(spark.createDataFrame(edges, "a string, b string").repartition(5), **kw))


@pytest.mark.parametrize("bound", [4, 50, 10**6])
@pytest.mark.parametrize("shape", ["chain", "star", "random", "turned chain"])
def test_shapes_and_levels(spark, shape, bound):
    rnd = random.Random(1)
    n = 60 if bound < 50 else 300
    edges = {
        "chain": [(f"{i:04d}", f"{i + 1:04d}") for i in range(n)],
        "turned chain": [(f"{i + 1:04d}", f"{i:04d}") for i in range(n)],
        "star": [("m", f"x{i}") for i in range(n)],
        "random": [(f"v{rnd.randrange(n)}", f"v{rnd.randrange(n)}") for _ in range(n // 2)],
    }[shape]
    assert found(spark, edges, bound=bound) == brute(edges)


def test_repeats_directions_self_and_nulls(spark):
    edges = [("b", "a"), ("a", "b"), ("a", "b"), ("s", "s"), (None, "a"), ("a", None), ("ü", "z")]
    assert found(spark, edges) == [("a", "a"), ("b", "a"), ("s", "s"), ("z", "z"), ("ü", "z")]


def test_empty(spark):
    assert found(spark, []) == []


def test_hits_that_count(spark):
    h = [("gnl|x|A ", " B", 50.0, 1e-9), ("A", "lcl|A", 99.0, 0.0), ("C", "D", None, 1e-9), ("C", "D", 50.0, None), ("C", "D", 29.9, 1e-9), ("C", "D", 30.0, 1.1e-5), ("D", "E", 30.0, 1e-5)]
    df = spark.createDataFrame(h, "qseqid string, sseqid string, pident double, evalue double").withColumn("node", F.lit(1)).withColumn("a", F.lit("q"))
    assert rows(hit_edges(df)) == [("A", "B"), ("D", "E")]
