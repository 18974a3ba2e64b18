from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.conftest import rows
from vicinage.operators.coverage import coverage
from vicinage.plans.queries import p6_found


def brute(data):
    by = {}
    for k, a, b in data:
        if None not in (k, a, b):
            by.setdefault(k, []).append((min(a, b), max(a, b)))
    out = []
    for k, spans in by.items():
        merged = []
        for a, b in sorted(spans):
            if merged and a <= merged[-1][1] + 1:
                merged[-1][1] = max(merged[-1][1], b)
            else:
                merged.append([a, b])
        out += [(k, "period", a, b) for a, b in merged] + [(k, "gap", x[1] + 1, y[0] - 1) for x, y in zip(merged, merged[1:])]
    return sorted(out)


SCHEMA = "k string, x bigint, y bigint"


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("ab"), st.integers(-40, 80), st.integers(0, 30)), max_size=25), st.sampled_from([3, 8, 64]))
def test_any_intervals_and_shards(spark, data, shard):
    data = [(k, a, a + n) for k, a, n in data]
    assert rows(coverage(spark.createDataFrame(data, SCHEMA), ["k"], "x", "y", shard)) == brute(data)


def test_nulls_repeats_turned_and_clashing_columns(spark):
    data = [("a", 1, 5), ("a", 1, 5), ("a", 9, 6), ("a", 20, 20), (None, 1, 2), ("a", None, 3), ("a", 3, None)]
    df = spark.createDataFrame(data, SCHEMA).select("*", F.lit(0).alias("s"), F.lit(0).alias("e"), F.lit("z").alias("kind"), F.lit(1).alias("n"))
    assert rows(coverage(df, ["k"], "x", "y")) == [("a", "gap", 10, 19), ("a", "period", 1, 9), ("a", "period", 20, 20)]


def test_interval_over_many_shards(spark):
    data = [("a", 0, 10**9), ("a", 5, 6), ("a", 10**9 + 5, 10**9 + 6)]
    assert rows(coverage(spark.createDataFrame(data, SCHEMA), ["k"], "x", "y", 1000)) == brute(data)


def test_empty(spark):
    assert coverage(spark.createDataFrame([], SCHEMA), ["k"], "x", "y").count() == 0


def test_whole_table(spark, sf):
    assert p6_found(spark, sf).where("first_pos > last_pos").count() == 0
