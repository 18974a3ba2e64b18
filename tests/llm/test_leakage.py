import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.conftest import rows
from vicinage.llm.leakage import PER_WORDS, Tables, WuManber, code_points, leaks, words

ITEM = "item_id bigint, lang string, text string"
DOC = "doc_id bigint, text string, lang string"


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("abc", min_size=0, max_size=12), max_size=6), st.text("abc", max_size=60))
def test_search_finds_every_window(patterns, text):
    m = WuManber(5, 2, [(i, code_points(p)) for i, p in enumerate(patterns)])
    want = set()
    for i, p in enumerate(patterns):
        want |= {(at, i) for k in range(len(p) - 4) for at in range(len(text) - 4) if text[at : at + 5] == p[k : k + 5]}
    places, ids = m.search(code_points(text))
    assert set(zip(places.tolist(), ids.tolist())) == want


def found(spark, docs, items, **kw):
    d = spark.createDataFrame(docs, DOC).withColumn("item_id", F.lit(0)).withColumn("first_at", F.lit("x"))
    return rows(leaks(d, spark.createDataFrame(items, ITEM).withColumn("doc_id", F.lit(3)), **kw).select("doc_id", "item_id"))


TEXT = "the quick brown fox jumps over one lazy dog while nine cats watch from the wall"


def test_whole_part_and_too_short(spark):
    w = TEXT.split()
    docs = [(1, f"so {TEXT} ok", None), (2, " ".join(w[2:15]), None), (3, " ".join(w[2:14]), None), (4, None, None), (5, "", None), (6, " ".join(w[:7] + ["not"] + w[7:]), None)]
    assert found(spark, docs, [(7, "en", TEXT), (8, "en", None), (9, None, "short one")]) == [(1, 7), (2, 7)]


def test_forms_that_dont_count(spark):
    loud = TEXT.upper().replace(" ", ",\n- ")
    wide = "".join(chr(ord(c) + 0xFEE0) if c.isalpha() else c for c in TEXT)
    unseen = TEXT.replace("quick", "qu​i­ck").replace("dog", "d⁠og")
    assert found(spark, [(1, loud, None), (2, wide, None), (3, unseen, None)], [(7, "en", TEXT)]) == [(1, 7), (2, 7), (3, 7)]
    assert words("Ａ１­b_c") == ["a1b", "c"]


def test_unspaced_languages(spark):
    zh = "在编号61368的翎沐澜菌株里位于煊澜岛左侧的溯煊璟酶基因"
    docs = [(1, f"旧记录：{zh[:10]}，{zh[10:20]}。", None), (2, zh[:19], None)]
    assert found(spark, docs, [(7, "zh-Hans", zh), (8, "JA", zh[5:])]) == [(1, 7)]
    assert found(spark, docs, [(7, "en", zh)]) == []


def test_passes_over_parts(spark):
    rnd = random.Random(2)
    items = [(i, "en", " ".join(f"w{rnd.randrange(400)}" for _ in range(30))) for i in range(40)]
    docs = [(i, "x " + " ".join(t.split()[5:25]), None) for i, _, t in items]
    one = found(spark, docs, items)
    assert one == found(spark, docs, items, part=1500) and {(i, i) for i in range(40)} <= set(one)


def test_empty_tables(spark):
    assert found(spark, [], [(7, "en", TEXT)]) == [] and found(spark, [(1, TEXT, None)], []) == []


def test_tables_are_small():
    rnd = random.Random(4)
    words_ = [f"w{i}" for i in range(30_000)]
    items = [(i, "en", " ".join(rnd.choice(words_) for _ in range(1000))) for i in range(200)]
    t = Tables(items)
    held = sum(x.nbytes for x in (t.by_word.symbols, t.by_word.suffix, t.by_word.prefix, t.by_word.end, t.by_word.ids)) + len(t.by_word.shift)
    assert held <= PER_WORDS * sum(len(x) for *_, x in items) * 1.5
    part = " ".join(items[7][2].split()[100:113])
    assert t.search(["x y", "so " + part, part[:-9], part]) == [(1, 7, 1, 1), (3, 7, 0, 1)]
