import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from vicinage.functions import ids, links, stats
from vicinage.operators import families, greedy, sweep, taxonomy, trees
from vicinage.sources import readers


@pytest.mark.parametrize("width", [7, 65_536])
def test_islands_and_numbers_bin_by_bin(spark, width):
    rnd = random.Random(3)
    data = [(rnd.choice(["a", "b", None]), s, s + rnd.randrange(12), i) for i in range(120) for s in [rnd.randrange(-50, 300)]]
    df = spark.createDataFrame(data, "k string, s bigint, e bigint, i int")
    want, place = {}, {}
    for key in ("a", "b", None):
        reach = start = None
        for n, (_, s, e, i) in enumerate(sorted((d for d in data if d[0] == key), key=lambda d: (d[1], d[2], d[3]))):
            if reach is None or s - reach > 2:
                start = s
            reach = e if reach is None else max(reach, e)
            want[i], place[i] = start, n
    got = sweep.islands(df, ["k"], "s", "e", 2, "island", width)
    assert {r.i: r.island for r in got.collect()} == want and set(got.columns) == {"k", "s", "e", "i", "island"}
    assert {r.i: r.n for r in sweep.numbered(df, ["k"], ["s", "e", "i"], "n", width).collect()} == place


def test_rows_alike_are_one_island(spark):
    df = spark.createDataFrame([("a", 5, 9, i) for i in range(50)] + [("a", 11, 12, 99)], "k string, s bigint, e bigint, i int").repartition(7)
    got = sweep.islands(df, ["k"], "s", "e", 0, "island")
    assert got.where("island = 5").count() == 50 and got.where("island = 11").count() == 1


def test_lookup_splits_a_hot_key(spark):
    df = spark.range(30_000).select(F.when(F.col("id") < 20_000, 0).otherwise(F.col("id")).alias("k"), "id")
    sizes = df.groupBy("k").agg(F.count(F.lit(1)).alias("n")).withColumn("v", F.col("k") + 1)
    got = sweep.lookup(df, sizes, ["k"], "n")
    assert got.count() == 30_000 and got.where("v <> k + 1").count() == 0
    assert sweep.lookup(df, sizes.where("k <> 25000"), ["k"], "n", "left").where("v is null").count() == 1
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan


def test_lineages_of_any_depth(spark):
    chain = spark.createDataFrame([(i, max(0, i - 1)) for i in range(200)], "taxid bigint, parent bigint")
    got = {r.taxid: r.lineage for r in taxonomy.lineages(chain).collect()}
    assert got[199] == list(range(200)) and got[0] == [0]
    ring = spark.createDataFrame([(i, (i + 1) % 100) for i in range(100)], "taxid bigint, parent bigint")
    with pytest.raises(ValueError, match="cycle"):
        taxonomy.lineages(ring)


@pytest.mark.parametrize(("start", "n"), [(60, 1), (61, 2), (62, 2)])
def test_gap_of_domains(spark, start, n):
    """A start is at most ten beyond the end before it."""
    df = spark.createDataFrame([("p", "d", "x", 1, 50, 9.0, 50, 1e-9), ("p", "d", "x", start, 90, 7.0, 0, 1e-9)], "protein_id string, database string, domain_id string, start bigint, end bigint, bit_score double, alignment_length bigint, e_value double")
    assert greedy.merge_domains(df).count() == n


def test_domains_without_length_keep_their_score(spark):
    df = spark.createDataFrame([("p", d, "x", 1, 9, 4.0, 0, None) for d in ("d", "e")], "protein_id string, database string, domain_id string, start bigint, end bigint, bit_score double, alignment_length bigint, e_value double")
    assert [r.bit_score for r in greedy.deduplicate_domains(df).collect()] == [4.0, 4.0]  # one a database
    assert greedy.deduplicate_domains(df, group_cols=("protein_id",)).count() == 1


def test_lengths_of_predictions(spark):
    known = spark.createDataFrame([("c", 1, 100)], "seqid string, start bigint, end bigint")
    p = spark.createDataFrame([("c", "in", 20, 60), ("c", "short", 200, 220), ("c", "good", 300, 400), ("c", "late", 350, 460), ("c", "far", 200_000, 200_100)], "seqid string, id string, start bigint, end bigint")
    assert [r.id for r in greedy.accept_predicted(known, p, 10, 50, 200).orderBy("start").collect()] == ["good", "far"]


def test_links_to_the_byte():
    import base64
    import zlib

    def told(url):
        tail = url.rsplit("/", 1)[1]
        return zlib.decompress(base64.urlsafe_b64decode(tail + "=" * (-len(tail) % 4)))

    assert told(links.report_url("GCF_1.1")) == b"\x0a\x07GCF_1.1"
    address = b"ncbi+ftp://genomes/GCF_1.1_ASM/GCF_1.1_ASM_protein.faa.gz"
    inner = b"\x0a" + bytes([len(address)]) + address
    assert told(links.file_url("https://ftp.ncbi.nlm.nih.gov/genomes/GCF_1.1_ASM/", "GCF_1.1", "faa")) == b"\x1a" + bytes([len(inner)]) + inner + b"\x30\x01\x38\x01"
    assert links.file_url("https://elsewhere/x", "GCF_1.1", "faa") is None


def test_link_table(spark):
    df = spark.createDataFrame([("GCF_1.1", "https://ftp.ncbi.nlm.nih.gov/genomes/GCF_1.1_A"), ("GCF_2.1", "na"), (" ", None), (None, "x"), ("GCF_1.1", "https://ftp.ncbi.nlm.nih.gov/genomes/GCF_1.1_A")], "assembly_id string, ftp_path string")
    got = rows(links.link_table(df, ("faa", links.REPORT)).select("assembly_id", "filetype"))
    assert got == [("GCF_1.1", "faa"), ("GCF_1.1", links.REPORT), ("GCF_2.1", links.REPORT)]
    assert links.link_table(df.drop("ftp_path")).count() == 2
    with pytest.raises(ValueError):
        links.link_table(df, ("exe",))


def test_id_classes(spark):
    cases = {"UPI001ce3ca0a": "uniparc", "AB12345": "nucleotide", "AAA123456": "protein", "AP_000001.1": "nucleotide", "KX_12": "nucleotide", "WP_1": "unmatched", "WP_000000001.1": "protein", "P12345": "uniprot", "JABC01000001": "nucleotide", "x": "unmatched"}
    df = spark.createDataFrame([(k,) for k in cases], "t string")
    assert {r.t: r.c for r in df.select("t", ids.id_class(F.col("t")).alias("c")).collect()} == cases


def test_lines_of_errors_and_rows_like_the_header(spark, tmp_path):
    p = tmp_path / "t.tsv"
    p.write_text("#id\tn\na\t1\nid\t2\n\nb\tx\n")
    with pytest.raises(Exception, match="line 5"):
        readers.typed_tsv(spark, str(p), {"n": "long"}, "id").collect()
    p.write_text("id\tn\nid\tna\nb\t2\n")
    assert rows(readers.typed_tsv(spark, str(p), {"n": "long"}, "id")) == [("b", 2), ("id", None)]


def test_monotone_correction(spark, monkeypatch):
    monkeypatch.setattr(stats, "RANKS", 3)
    p = [0.01, 0.02, 0.022, 0.04, 0.041, 0.3, 0.9, None]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(p)], "i int, p double")
    got = {r.i: r.p_adj for r in stats.adjusted(df, "p", ["i"], "BH_MONOTONE").collect()}
    raw = [x * 7 / (i + 1) for i, x in enumerate(p[:-1])]
    assert got[7] is None and all(abs(got[i] - min(1.0, *raw[i:])) < 1e-12 if i < 6 else abs(got[i] - 0.9) < 1e-12 for i in range(7))


@pytest.mark.parametrize("bound", [5, 10**6])
def test_components_with_and_without_stars(spark, bound):
    edges = [(f"n{i:03d}", f"n{i + 1:03d}") for i in range(60)] + [("hub", f"x{i}") for i in range(40)] + [("s", "s"), ("n000", None)]
    got = rows(families.components(spark.createDataFrame(edges, "a string, b string").repartition(4), bound=bound))
    want = [(f"n{i:03d}", "n000") for i in range(61)] + [("hub", "hub")] + [(f"x{i}", "hub") for i in range(40)] + [("s", "s")]
    assert got == sorted(want)


def test_tree_methods_differ_where_they_should():
    import numpy as np

    d = np.array([[0, 5, 9, 9, 8], [5, 0, 10, 10, 9], [9, 10, 0, 8, 7], [9, 10, 8, 0, 3], [8, 9, 7, 3, 0]], float)
    leaves = list("abcde")
    way = lambda how: {(a, b): p for a, b, _, p in trees.meetings(trees.tree(how, leaves, d))}
    for how in ("nj", "bionj", "unj", "rapidnj"):
        assert all(abs(way(how)[(a, b)] - d[leaves.index(a), leaves.index(b)]) < 1e-4 for a, b in way(how))
    rough = d + np.array([[0, 2, 0, 1, 0], [2, 0, 3, 0, 1], [0, 3, 0, 0, 2], [1, 0, 0, 0, 0], [0, 1, 2, 0, 0]])
    assert len({trees.tree(how, leaves, rough) for how in ("nj", "bionj", "unj", "upgma")}) == 4
    with pytest.raises(ValueError):
        trees.tree("guess", leaves, d)
