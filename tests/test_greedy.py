import random

from tests.conftest import rows
from vicinage.operators.greedy import greedy


def test_against_brute_force(spark):
    rnd = random.Random(4)
    data = [(rnd.choice("ab"), i, a, a + rnd.randrange(0, 40), rnd.randrange(50)) for i in range(400) for a in [rnd.randrange(600)]]
    for slack in (0, 3):
        want = []
        for k in "ab":
            kept = []
            for r in sorted((r for r in data if r[0] == k), key=lambda r: (-r[4], r[1])):
                if all(min(r[3], x[3]) - max(r[2], x[2]) + 1 <= slack for x in kept):
                    kept.append(r)
            want += kept
        df = spark.createDataFrame(data, "k string, i int, s bigint, e bigint, score int")
        assert rows(greedy(df, ["k"], [("score", False), ("i", True)], "s", "e", slack)) == sorted(want)
    assert greedy(df.where("false"), ["k"], [("i", True)], "s", "e").count() == 0
