import random
import time

import pyarrow as pa
from pyspark.sql import functions as F

from tests.conftest import rows
from vicinage.operators import packed
from vicinage.operators.packed import Frequent, Model, count_pieces, fit, pieces, shape, split_packed, unquoted, viterbi


def split(spark, data, **kw):
    df = spark.createDataFrame([(str(i), t) for i, t in enumerate(data)], "id string, f string")
    return rows(split_packed(df, "id", "f", **kw))


def test_separators_quotes_and_lists(spark):
    data = [
        'ID=a1 ; product="x; y, z" ;; Dbxref=K:1,,"P:2" , K:3|',
        'ID "a2"; Note "p q"; Note "r";',
        "ID=a3",
        None,
        "",
        ";;,",
        'ID=a4;product="say ""no"" now"',
        "[ID=a5;product=5'-end]",
    ]
    got = split(spark, data)
    assert [r[1:] for r in got if r[0] == "0"] == [(1, "ID", "a1"), (2, "product", "x; y, z"), (3, "Dbxref", "K:1"), (4, "Dbxref", "P:2"), (5, "Dbxref", "K:3")]
    assert [r[1:] for r in got if r[0] == "1"] == [(1, "ID", "a2"), (2, "Note", "p q"), (3, "Note", "r")]
    assert [r[1:] for r in got if r[0] == "6"] == [(1, "ID", "a4"), (2, "product", 'say "no" now')]
    assert [r[1:] for r in got if r[0] == "7"] == [(1, "ID", "a5"), (2, "product", "5'-end")]
    assert {r[0] for r in got} == {"0", "1", "6", "7"}


def test_bar_learned_as_part_of_values(spark):
    data = [f"{c}{i}@{i}|Clade{s}{c}{i + 1}@{i}|Other" for i in range(20) for c, s in (("A", ","), ("B", ";"), ("C", "\t"))]
    got = split(spark, data, name="ogs", keyed=False)
    assert len(got) == 2 * len(data) and all("|" in r[3] and r[2] == "ogs" for r in got)


def test_bar_learned_as_separator(spark):
    data = [f"ab{i}|cd{i}" if i % 2 else f"ab{i}|cd{i},ef{i}" for i in range(30)] + [f"gh{i}" for i in range(30)]
    assert {r[3] for r in split(spark, data, name="v", keyed=False) if r[0] == "1"} == {"ab1", "cd1"}


def test_repeats_and_clashing_columns(spark):
    df = spark.createDataFrame([("1", "a=1;b=2"), ("1", "a=1;b=2"), (None, "a=1;b=2")], "id string, field string").withColumn("pos", F.lit(9)).withColumn("rec_key", F.lit("x"))
    assert rows(split_packed(df, "id", "field")) == [("1", 1, "a", "1"), ("1", 2, "b", "2")]


def test_empty_table(spark):
    assert split_packed(spark.createDataFrame([], "id string, f string"), "id", "f").count() == 0


def test_very_long_field(spark):
    data = [";".join(f"k{i}=v{i}" for i in range(20_000))]
    assert len(split(spark, data)) == 20_000


def test_pieces_keep_quoted_spans():
    assert [p[2] for p in pieces("\"a, b\" , c;'d|e'", False)] == ['"a, b"', "c", "'d|e'"]
    assert unquoted("'it''s'") == "it's" and unquoted("5'-x") == "5'-x"


def learned(column, keyed=True):
    batch = pa.record_batch({"f": pa.array(column)})
    counts, values = {}, {}
    for b in count_pieces([batch], keyed):
        for k, d, behind, text, n in zip(*(c.to_pylist() for c in b.columns), strict=True):
            (counts if behind is None else values)[(k, d, text) if behind is None else (k, d, behind, text)] = n
    return Model(counts, values)


def test_a_frequent_value_with_a_delimiter_stays_one():
    """Each comma parts, looked at alone; the lattice keeps the value that the column holds quoted so often."""
    column = [f"a{i}x,b{i}y,c{i}z" for i in range(400)] + ['"Smith, John",d1' for _ in range(300)]
    m = learned(column, keyed=False)
    found = pieces("q7x,Smith, John,r8y", False)
    assert [v for _, v, _ in viterbi(found, m)] == ["q7x", "Smith, John", "r8y"]
    alone = [i == 0 or (w := m.weights(None, f[0], f[2]))[0] >= w[1] for i, f in enumerate(found)]
    assert alone == [True] * 4
    assert [v for _, v, _ in viterbi(pieces("q7x,Smith, Jane", False), m)] == ["q7x", "Smith", "Jane"]


def test_a_repeated_list_is_no_value():
    m = learned(["K:1,K:2,K:3"] * 500 + [f"K:{i},P:{i}" for i in range(100)], keyed=False)
    assert len(viterbi(pieces("K:1,K:2,K:3", False), m)) == 3


def test_keys_don_t_share_a_model(spark):
    """Keys of one hash: the bar parts the values of one and belongs to those of the other."""
    import zlib

    one = "key0"
    two = next(k for k in (f"key{i}" for i in range(1, 5000)) if zlib.crc32(k.encode()) % 256 == zlib.crc32(one.encode()) % 256)
    data = [f"ID=x{i};{one}=a{i}|b{i}" for i in range(60)] + [f"ID=x{i};{one}=c{i}" for i in range(60)]
    data += [f"ID=x{i};{two}=A{i}@{i}|Clade" for i in range(120)]
    got = split(spark, data)
    assert {len([r for r in got if r[0] == str(i) and r[2] == one]) for i in range(60)} == {2}
    assert {len([r for r in got if r[0] == str(i) and r[2] == two]) for i in range(120, 240)} == {1}


def test_shapes_of_long_pieces_differ_at_their_end():
    long = "+".join(["ab"] * 400)
    assert shape(long + "+1") != shape(long + "+b") and len(shape(long)) <= 48


def test_summary_of_frequent_values():
    f = Frequent(10)
    for i in range(3000):
        f.update([f"v{i}", "often", f"w{i}"])
    f.trim()
    assert len(f.counts) <= 10 and f.counts["often"] >= 3000 - 9000 / 10


def test_many_pieces_without_a_stop():
    m = learned([f"a{i}|b{i}" for i in range(50)], keyed=False)
    began = time.perf_counter()
    found = pieces("|".join(f"p{i}" for i in range(100_000)), False)
    assert sum(v.count("|") + 1 for _, v, _ in viterbi(found, m)) == 100_000
    assert time.perf_counter() - began < 20


def mixed():
    """Lists of rare values, names with a comma that recur, quoted or not, titles of six pieces, and rare keys."""
    r = random.Random(5)
    names = [f"Smith{chr(97 + i)}, John" for i in range(6)]
    out = []
    for i in range(600):
        n = r.choice(names)
        v = [r.choice([n, f'"{n}"', f"k{r.randrange(400)}x", f"{r.randrange(90)}@{r.randrange(9)}|Clade", "a, b; c, d; e, f"]) for _ in range(r.randrange(1, 6))]
        out.append(f"ID=x{i};Note={','.join(v)};rare{i % 90}={','.join(v[:2])}")
    return out


def test_a_model_too_large_for_one_place_gives_the_same(spark, monkeypatch):
    for keyed in (True, False):
        monkeypatch.setattr(packed, "LOCAL", 200_000)
        one = split(spark, mixed(), keyed=keyed)
        monkeypatch.setattr(packed, "LOCAL", -1)
        monkeypatch.setattr(packed, "GROUP", 300)
        assert len(one) > 1000 and split(spark, mixed(), keyed=keyed) == one


def test_every_value_that_recurs_is_known(spark):
    """However rare it is in the column, and however many pieces it has."""
    data = [f"a{i}x,b{i}y,c{i}z" for i in range(20_000)] + ['"Smith, John",d1', '"Smith, John",d2', "q7x,Smith, John,r8y"]
    got = split(spark, data, keyed=False, name="v")
    assert [r[3] for r in got if r[0] == "20002"] == ["q7x", "Smith, John", "r8y"]


def test_every_span_that_recurs_is_counted(spark):
    """Brute force over spans of any length."""
    data = [t.split(";rare")[0] for t in mixed()] + ["p1, p2, p3, p4, p5, p6, p7"] * 3
    want = {}
    for t in data:
        found = pieces(t, True)
        for begun, end, key in packed.segments(found):
            for i in range(begun, end):
                for j in range(i + 1, end + 1):
                    at = key, unquoted(packed.written(found, i, j))
                    want[at] = want.get(at, 0) + 1
    got = {}
    for values in packed.count(spark.createDataFrame([(t,) for t in data], "f string"), True)[1]:
        for r in values.collect():
            at = r["key"], unquoted(r["text"])
            got[at] = got.get(at, 0) + r["n"]
    assert (None, "p1, p2, p3, p4, p5, p6, p7") in got and got == {v: n for v, n in want.items() if n > 1}


def test_every_key_has_a_model(spark):
    """A key of a few fields in many: the bar parts its values, though it belongs to those of other rare keys."""
    data = [f"ID=x{i};Name=n{i}" for i in range(70_000)]
    data += [f"one=a{i}|b{i}" if i % 2 else f"one=c{i}" for i in range(2)] + [f"k{k}=A{i}@{i}|Clade" for k in range(30) for i in range(1)]
    got = split(spark, data)
    assert [r[3] for r in got if r[2] == "one"] == ["a1", "b1"]


def test_only_keys_with_an_open_place_are_counted(spark):
    """Values of the others are never asked for: neither shapes nor values of ID and Name reach the model, and the rows are
    those of a model that counts all keys."""
    data = [f"ID=i{i % 50};Name=n{i % 7};Note=a{i % 9}x,b{i % 5}y" for i in range(200)] + [f"ID=i{i};Note=a{i % 9}x" for i in range(40)]
    df = spark.createDataFrame([(str(i), t) for i, t in enumerate(data)], "rec string, text string")
    found = packed.parsed(df, True)
    shapes, passes = packed.count(found, True)
    assert {r["key"] for part in (shapes, *passes) for r in part.collect()} == {"Note"}
    assert found.agg(F.sum("n")).first()[0] == sum(len(pieces(t, True)) for t in data)
    m = learned(data)
    want = [(str(i), j, k, v) for i, t in enumerate(data) for j, (k, v, _) in enumerate(viterbi(pieces(t, True), m), 1)]
    assert split(spark, data) == sorted(want)


def test_sums_of_one_hash_meet_across_batches(spark):
    """Values alike but for quotes are one; different values may have one hash; shapes are all kept."""
    r = random.Random(3)
    sums = [("k", ";", "$", r.choice(["v{0}", '"v{0}"']).format(r.randrange(300)), 1) for _ in range(400)] + [("k", ";", None, f"s{i}", 1) for i in range(20)]
    at = lambda s: (s[0], unquoted(s[3]), s[2] is None)
    occurs = {}
    for s in sums:
        occurs[at(s)] = occurs.get(at(s), 0) + s[4]
    want = {}
    for s in sums:
        if s[2] is None or occurs[at(s)] > 1:
            want[s[:4]] = want.get(s[:4], 0) + s[4]
    df = spark.createDataFrame([(*s, sum(map(ord, unquoted(s[3]))) % 11) for s in sums], "key string, delimiter string, behind string, text string, n bigint, h int")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = packed._recurring(df, True).collect()  # noqa: SLF001
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert {tuple(x)[:4]: x["n"] for x in got} == want and len(got) == len(want) and {x["pieces"] for x in got} == {1}
