from pyspark.sql import functions as F

from tests.conftest import rows
from vicinage.llm.consensus import CHUNK, align, consensus, profile_text, sequence, survivors, text_consensus, token, word_distance, words_of
from vicinage.llm.records import record_survivors

SCHEMA = "ipg_id bigint, unique_id string, assembly_id string, assembly_level string, is_refseq_query boolean, sequence_length bigint, failed boolean"


def best(spark, data):
    df = spark.createDataFrame(data, SCHEMA)
    return rows(record_survivors(df.withColumn("key", F.lit(0)).withColumn("grp", F.lit("x"))))


def test_order_of_the_votes(spark):
    full, chrom, contig = " complete GENOME ", "Chromosome", "Contig"
    data = [
        (1, "1", "GCA_1", full, True, 900, None), (1, "2", "gcf_1", chrom, False, 5, None),  # rank first
        (2, "3", "GCF_1", full, False, 900, None), (2, "4", "GCF_2", full, True, 5, False),  # then the query
        (3, "5", "GCA_1", contig, None, 7, None), (3, "6", "GCA_1", contig, None, 8, None), (3, "7", "GCF_9", full, None, 1, True),  # then length; failed is out
        (4, "10", None, None, None, None, None), (4, "9", None, "na", None, -1, None),  # then the smaller number
        (5, "11", "GCA_1", full, True, 9, None), (5, "11", "GCA_1", full, True, 9, None),  # one record, twice
        (6, "12", "GCA_1", full, True, 9, None), (6, "13", "GCF_1", full, True, 9, True),  # one sound record
        (None, "14", None, None, None, None, None), (None, "15", None, None, None, None, None),
        (7, "16", None, full, None, 0, None), (7, "17", "GCA_7", contig, True, 50, None),
    ]
    assert best(spark, data) == [(1, "2"), (2, "4"), (3, "6"), (4, "9"), (7, "16")]


def test_empty(spark):
    assert best(spark, []) == []


def test_huge_group(spark):
    df = spark.range(20_000).select(F.lit(1).cast("bigint").alias("ipg_id"), F.col("id").cast("string").alias("unique_id"), F.lit("GCA_1").alias("assembly_id"), F.lit("Contig").alias("assembly_level"), F.lit(False).alias("is_refseq_query"), (F.col("id") % 500).alias("sequence_length"), F.lit(None).cast("boolean").alias("failed"))
    assert rows(record_survivors(df)) == [(1, "499")]


def test_alignment():
    p = []
    for s in ("a b c", "a x c", "b c"):
        p = align(p, words_of(s), 1)
    assert [max(c, key=c.get) for c in p if c.get(None, 0) < 2][-1] == (0, "c", 0)
    assert profile_text([("alpha beta gamma", 3), ("alpha gamma", 1), ("alpha beta delta", 1)]) == "alpha beta gamma"
    assert word_distance("a b c".split(), "a c d".split()) == 2 and word_distance([], ["x"]) == 1


def test_text_consensus(spark):
    data = [("g", t) for t in ["kinase subunit D"] * 3 + ["kinase  subunit", "big kinase subunit D", "kinase subunit E", None, " "]] + [("h", "one")] + [(None, "x")]
    df = spark.createDataFrame(data, "fam string, t string").withColumn("value", F.lit(1))
    for chunk in (2, 256):
        assert rows(text_consensus(df, "fam", "t", chunk).select("fam", "value", "n_rows")) == [("g", "kinase subunit D", 3), ("h", "one", 1)]
    assert text_consensus(df.where("false"), "fam", "t").count() == 0


def test_kinds_keep_their_order():
    """Values of one field share a column, and columns stand in the order of kinds whatever came first."""
    seqs = [((1, "finished", 1), (4, "7", 7)), ((2, "any", 1), (4, "9", 9)), ((3, "query", 1),), ((1, "finished", 1), (2, "GCF", 2))]
    for turn in range(4):
        agreed = consensus([(s, 1) for s in seqs[turn:] + seqs[:turn]], -1)
        assert agreed == [(1, "finished", 1), (2, "GCF", 2), (3, "query", 1), (4, "9", 9)]


def test_alignment_decides_who_survives(spark):
    """Compared place by place the first record would agree with nobody; aligned, it holds what the others hold."""
    data = [(1, 1, "new kinase subunit D"), (1, 2, "kinase subunit D"), (1, 3, "kinase subunit"), (1, 4, "kinase chain D"), (1, 5, "subunit kinase D")]
    df = spark.createDataFrame(data, "g int, k bigint, t string")
    words = F.transform(F.split("t", " "), lambda w: F.struct(F.lit(0).alias("kind"), w.alias("tok"), F.lit(0).cast("bigint").alias("trust")))
    assert profile_text([(t, 1) for *_, t in data]) == "kinase subunit D"
    assert rows(survivors(df, "g", F.col("k"), words, gap_trust=0)) == [(1, 2)]


def test_more_votes_decide_among_equal_trust(spark):
    data = [(1, k, t) for k, t in enumerate(["red", "blue", "blue", "green"])] + [(2, 1, None), (2, 2, None), (3, 5, "x"), (3, 5, "x")]
    df = spark.createDataFrame(data, "g int, k bigint, t string").withColumn("seq", F.lit(1)).withColumn("grp", F.lit(2))
    assert rows(survivors(df, "g", F.col("k"), sequence(token(1, F.col("t"), F.lit(1))))) == [(1, 1), (2, 1)]


def test_a_huge_group_changes_no_other(spark):
    small = [("s", t) for t in ["alpha beta gamma"] * 3 + ["alpha beta gamma delta", "alpha beta", "theta beta gamma delta", "alpha gamma"]]
    alone = rows(text_consensus(spark.createDataFrame(small, "fam string, t string"), "fam", "t"))
    huge = spark.range(CHUNK * 5).select(F.lit("h").alias("fam"), F.concat(F.lit("kinase w"), F.col("id").cast("string")).alias("t"))
    both = text_consensus(spark.createDataFrame(small, "fam string, t string").unionByName(huge), "fam", "t")
    assert rows(both.where("fam = 's'")) == alone == [("s", "alpha beta gamma", "alpha beta gamma", 3)]
    assert both.where("fam = 'h'").first().value.startswith("kinase")


def test_parts_and_levels_of_a_huge_group(spark):
    df = spark.range(3000).select(F.lit(1).alias("ipg_id"), F.col("id").alias("k"), F.concat(F.lit("n"), F.col("id") % 700).alias("t"), (F.col("id") % 700).alias("w"))
    for chunk in (4, 64):
        got = rows(survivors(df, "ipg_id", F.col("k"), sequence(token(1, F.col("t"), F.col("w"))), chunk))
        assert got == [(1, 699)]
