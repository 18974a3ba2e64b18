"""Hand-computed cases of the reference's operators."""

import time

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from vicinage import schemas
from vicinage.functions import ids, links, stats, text
from vicinage.operators import annotate, enrich, families, greedy, similarity, taxonomy, trees, windows
from vicinage.operators.coverage import merged


def test_id_classes(spark):
    want = {"UPI001CE3CA0A": "uniparc", "P12345": "uniprot", "NC_000913.3": "nucleotide", "U12345": "nucleotide", "WP_000000001.1": "protein", "AAA12345": "protein", "hello": "unmatched", "NC_000913.3:5000-1000": "nucleotide"}
    df = spark.createDataFrame([(k,) for k in want], "t string")
    assert dict(tuple(r) for r in df.select("t", ids.id_class(F.col("t"))).collect()) == want
    r = df.where("t like '%:%'").select(ids.region(F.col("t")).alias("r")).first().r
    assert (r.id, r.start, r.end, r.strand) == ("NC_000913.3", 1000, 5000, "-")


FEATS = [("c", "f1", 100, 200), ("c", "f2", 300, 400), ("c", "f3", 500, 600), ("c", "f4", 700, 800)]


def test_windows(spark):
    f = spark.createDataFrame(FEATS, "seqid string, id string, start bigint, end bigint")
    t = spark.createDataFrame([("u", "c", "f2", 300, 400, 650)], "uid string, seqid string, target_id string, start bigint, end bigint, sequence_length bigint")
    w = windows.windows_by_distance(t, 150)
    assert rows(w.select("start_win", "end_win")) == [(150, 550)]
    assert rows(windows.contained(f, w, 64).select("id")) == [("f2",)]
    assert rows(windows.windows_by_rows(f, t, 1)) == [("u", "c", 100, 600, 3)]
    named = w.withColumnRenamed("start", "start_target").withColumnRenamed("end", "end_target")
    assert named.select(*[windows.too_small(m, 200, F.lit(False)) for m in ("total", "upstream", "downstream", "both")]).first()[:] == (False, True, True, True)


def test_contig_resolution(spark):
    f = spark.createDataFrame([("s", "ctg1", "p1"), ("s", "ctg2", "p2"), ("s", "ctg2", "px"), ("s", "ctg1", "px"), ("o", "only", "q")], "source string, seqid string, protein_id string")
    q = spark.createDataFrame([("a", "s", "ctg1", None), ("b", "s", None, "p2"), ("c", "s", "missing", None), ("d", "s", None, None), ("e", "s", None, "px"), ("f", "o", None, None)], "uid string, source string, seqid string, protein_id string")
    got = {r.uid: (r.seqid, r.error) for r in windows.resolve_contigs(f, q).collect()}
    assert got["a"] == ("ctg1", None) and got["b"] == ("ctg2", None) and got["f"] == ("only", None)
    assert "contig" in got["c"][1] and "contig" in got["d"][1] and "unique contig" in got["e"][1]


def test_islands_gaps_and_coverage(spark):
    c = spark.createDataFrame([("c", 10, 20), ("c", 15, 30), ("c", 31, 40), ("c", 60, 70)], "k string, s bigint, e bigint")
    assert rows(merged(c, ["k"])) == [("c", 10, 40), ("c", 60, 70)]
    lengths = spark.createDataFrame([("c", 100), ("d", 100)], "k string, length bigint")
    assert rows(windows.gaps_within(c, ["k"], lengths)) == [("c", 1, 9), ("c", 41, 59), ("c", 71, 100), ("d", 1, 100)]
    h = spark.createDataFrame([("c", 0, 10), ("c", 5, 15), ("c", 15, 20), ("c", 30, 35)], "k string, s bigint, e bigint")
    assert rows(windows.covered_length(h, ["k"], "s", "e")) == [("c", 25)]


HSPS = [("q", "r", 90.0, 50, 100.0, 1, 50), ("q", "r", 85.0, 41, 90.0, 40, 80), ("q", "r", 80.0, 31, 80.0, 60, 90)]


def test_greedy_and_ani(spark):
    h = spark.createDataFrame(HSPS, "query string, ref string, pident double, length bigint, bitscore double, q_start bigint, q_end bigint")
    kept = greedy.greedy(h, ["query", "ref"], [("bitscore", False)], "q_start", "q_end")
    assert rows(kept.select("bitscore")) == [(80.0,), (100.0,)]
    a = greedy.ani_from_hsps(h, spark.createDataFrame([("q", 100)], "id string, length bigint"))
    assert rows(a) == [("q", "r", 86.42, 81.0)]


def test_domain_deduplication(spark):
    d = [("p", "db", "D1", 1, 50, 20.0, 50.0, 1e-5), ("p", "db", "D1", 55, 100, 30.0, 46.0, 1e-9), ("p", "db", "D2", 90, 150, 10.0, 61.0, 1e-3), ("p", "db", "D3", 97, 150, 10.0, 54.0, 1e-3)]
    df = spark.createDataFrame(d, "protein_id string, database string, domain_id string, start bigint, end bigint, bit_score double, alignment_length double, e_value double")
    got = {r.domain_id: (r.start, r.end, r.alignment_length, round(r.bit_score, 4)) for r in greedy.deduplicate_domains(df).collect()}
    assert got == {"D1": (1, 100, 96.0, 24.7917), "D3": (97, 150, 54.0, 10.0)}


def test_candidates(spark):
    c = [(0, 7, "P1", "GCA_1.1", "Complete Genome", 500, 900, 5000, "n1", True, "1"), (0, 7, "P1", "GCF_1.1", "Complete Genome", 100, 500, 5000, "n2", True, "2"), (0, 7, "P2", "GCF_2.1", "Complete Genome", 1000, 1400, 5000, "n3", False, "3"), (0, 7, "P1", "GCF_3.1", "Contig", 2000, 2400, 5000, "n4", True, "4"), (1, None, None, None, None, None, None, None, None, None, "5")]
    df = spark.createDataFrame(c, "og_index bigint, ipg_id bigint, protein_id string, assembly_id string, assembly_level string, start bigint, end bigint, sequence_length bigint, nucleotide_id string, is_query boolean, uid string")
    pick = lambda m: [r[0] for r in rows(enrich.candidates(df, m).select("uid"))]
    assert pick("best_ipg") == ["3", "5"] and pick("best_id") == ["2", "5"] and pick("same_id") == ["1", "2", "4", "5"] and pick("one_id") == ["1", "5"]
    with pytest.raises(ValueError):
        enrich.candidates(df, "other")


def test_reciprocal_best(spark):
    h = spark.createDataFrame([("a1", "b1", 90.0), ("a1", "b2", 50.0), ("a2", "b2", 60.0), ("b1", "a1", 88.0), ("b2", "a2", 61.0), ("b3", "a1", 40.0)], "qseqid string, sseqid string, pident double")
    g = spark.createDataFrame([(x, x[0].upper()) for x in ("a1", "a2", "b1", "b2", "b3")], "id string, genome string")
    rbh = similarity.reciprocal_best(similarity.annotate_hits(h, g))
    assert rows(rbh.select("qseqid", "sseqid")) == [("a1", "b1"), ("a2", "b2"), ("b1", "a1"), ("b2", "a2")]
    s = {r.q_genome: r for r in similarity.repertoire_similarity(rbh, similarity.proteome_sizes(g)).collect()}
    assert round(s["A"].wgrr, 6) == 0.75 and s["A"].aai == 75.0 and s["A"].n_rbh == 2 and s["A"].rbh_frac_min == 1.0
    assert round(s["B"].wgrr, 6) == 0.745 and s["B"].aai == 74.5


def test_hypergeometric_and_corrections(spark):
    df = spark.createDataFrame([(10, 4, 5, 3)], "m bigint, a bigint, b bigint, k bigint")
    assert round(df.select(stats.hypergeometric_tail("m", "a", "b", "k")).first()[0], 6) == 0.261905
    p = spark.createDataFrame([("x", 0.01), ("y", 0.04), ("z", 0.03)], "t string, p double")
    get = lambda m: {r.t: round(r.p_adj, 6) for r in stats.adjusted(p, "p", ["t"], m).collect()}
    assert get("BH") == {"x": 0.03, "y": 0.04, "z": 0.045} and get("BH_MONOTONE") == {"x": 0.03, "y": 0.04, "z": 0.04} and get("BONFERRONI") == {"x": 0.03, "y": 0.12, "z": 0.09}


def test_running_minimum_takes_time_in_proportion(spark):
    """Half a block of ranks: a frame worked out anew for each row would take 10**10 steps."""
    n = 150_000
    p = spark.range(n).select(F.col("id").alias("t"), ((F.col("id") * 7919 % n + 1) / (4 * n)).alias("p"))
    began = time.perf_counter()
    got = stats.adjusted(p, "p", ["t"], "BH_MONOTONE").agg(F.min("p_adj"), F.max("p_adj"), F.count("p_adj")).first()
    assert time.perf_counter() - began < 20
    assert [round(x, 9) for x in got] == [0.25, 0.25, n]


def test_families(spark):
    e = spark.createDataFrame([("x", "y"), ("y", "z"), ("p", "q"), ("s", "s")], "a string, b string")
    got = {r.id: (r.rep, r.family) for r in families.numbered_families(families.components(e)).collect()}
    assert got == {"x": ("x", 1), "y": ("x", 1), "z": ("x", 1), "p": ("p", 2), "q": ("p", 2), "s": ("s", None)}


def test_long_chain(spark):
    e = spark.createDataFrame([(f"{i:04d}", f"{i + 1:04d}") for i in range(200)], "a string, b string")
    assert {r.rep for r in families.components(e).collect()} == {"0000"}


def test_lca(spark):
    df = spark.createDataFrame([([1, 2, 5, 9], [1, 2, 6]), ([1, 2], [1, 2]), ([3], [4]), (None, [1])], "a array<bigint>, b array<bigint>")
    assert [r[0] for r in df.select(taxonomy.lca_distance(F.col("a"), F.col("b"))).collect()] == [3.0, 0.0, 2.0, 1e6]


def test_leaf_distances_once_for_what_leaves_hang_on(spark):
    above = {1: [1, 2], 2: [1, 2], 3: [1, 2, 5], 4: [7], 5: [], 100: [1, 2], 200: [1], 300: []}
    df = spark.createDataFrame([(k, [*v, 1000 + k]) for k, v in above.items()], "id bigint, lineage array<bigint>")
    lin = df.alias("a").where("id % 100 = 0").crossJoin(df.alias("b"))
    want = lin.select("a.id", F.col("b.id"), taxonomy.lca_distance(F.col("a.lineage"), F.col("b.lineage")))
    got = taxonomy.leaf_distances(df, F.col("id") % 100 == 0)
    assert rows(got) == rows(want) and len(rows(got)) == 3 * len(above)
    plan = got._jdf.queryExecution().optimizedPlan().toString()  # noqa: SLF001
    assert -1 < plan.index("collect_list") < plan.index("array_intersect")  # distances are made below the lists, not for each pair
    assert taxonomy.leaf_distances(df, F.lit(False)).count() == 0


def test_rank_precedence(spark):
    ranks = spark.createDataFrame([(1, "domain", "modern"), (1, "superkingdom", "legacy"), (2, "domain", "Archaea"), (3, "acellular root", "Viruses")], "taxid bigint, rank string, name string")
    recs = spark.createDataFrame([("a", 1, None), ("b", 2, None), ("c", 3, None), ("d", None, None), ("e", 1, True)], "unique_id string, taxid bigint, failed boolean")
    got = {r.unique_id: (r.superkingdom, r.species) for r in taxonomy.leaf_metadata(recs, ranks).collect()}
    assert got == {"a": ("legacy", "unclassified"), "b": ("Archaea", "unclassified"), "c": ("unclassified", "unclassified"), "d": ("unclassified", "unclassified")}


def test_distances_and_trees(spark):
    p = spark.createDataFrame([("a", "b", 90.0), ("c", "a", 70.0)], "a string, b string, identity double")
    ids_ = spark.createDataFrame([(x,) for x in "abc"], "id string")
    d = trees.fill_distances(trees.identity_distance(p), ids_)
    assert rows(d) == [("a", "b", 10.0), ("a", "c", 30.0), ("b", "c", 50.0)]
    assert trees.single_linkage(list("abc"), trees.minimum_forest(d)) == "((a:10.000000,b:10.000000):20.000000,c:30.000000);"
    m = trees.matrix(list("abc"), d)
    assert trees.average_linkage(list("abc"), m) == "((a:5.000000,b:5.000000):15.000000,c:20.000000);"
    assert trees.neighbour_joining(list("abc"), m).count(",") == 2
    assert trees.phylip(list("abc"), m).splitlines()[0] == "3"


def test_forward_fill_and_upsert(spark):
    df = spark.createDataFrame([(0, "1", "A"), (1, "", "B"), (2, "2", "")], "at int, x string, y string")
    assert [(r.x, r.y) for r in windows.forward_fill(df, [], ["at"], ["x", "y"]).orderBy("at").collect()] == [("1", "A"), ("1", "B"), ("2", "B")]
    remote, local = (spark.createDataFrame(v, "k string, v int") for v in ([("X", 1), ("Y", 2)], [("Y", 9), ("Z", 3)]))
    assert rows(enrich.upsert(remote, local, ["k"])) == [("X", 1), ("Y", 9), ("Z", 3)]


def test_text_functions(spark):
    df = spark.createDataFrame([("ATGAAATAG", "AAA" * 30, "['x', 'y']")], "cds string, long string, lit string")
    r = df.select(text.translate_cds(F.col("cds")).alias("p"), text.reverse_complement(F.col("cds")).alias("rc"), text.wrapped(F.col("long"), 40).alias("w"), text.python_list(F.col("lit")).alias("l")).first()
    assert r.p == "MK" and r.rc == "CTATTTCAT" and [len(x) for x in r.w.split("\n")] == [40, 40, 10] and r.l == ["x", "y"]


def test_tokens_and_structures():
    assert links.varint(300) == b"\xac\x02" and "=" not in links.token(links.field(1, b"GCF_1.1"), links.field(2, 7))
    assert links.find_key('{"a": [{"b": 1}, {"c": "x"}]}', "c") == "x" and links.find_key("no json", "c") is None
    model = "[ ROOT 0 ]\n[ MATP 1 ]\n[ MATL 2 ]\n[ MATP 3 ]\n[ MATL 4 ]\n[ END 5 ]"
    assert links.pairs_from_model(model) == "(.(.))"
    assert links.slice_structure("(.(.))", "AAAAAA", 1) == "(.(.))" and links.slice_structure("(.(.))", "AaA-", 3) == "..."


def test_schema(spark):
    df = spark.createDataFrame([("1", "protein", "yes", "x", 5)], "og_index string, input_type string, premade string, taxid string, more int")
    r = schemas.RECORDS.enforce(df).first()
    assert (r.og_index, r.premade, r.taxid, r.more) == (1, True, None, 5)
    with pytest.raises(ValueError):
        schemas.GFF.enforce(df)


def test_operons(spark):
    ops = spark.createDataFrame([("o", "c", "[1, 2]", "['cas1', 'cas2']")], "operon string, contig string, positions string, genes string")
    genes = spark.createDataFrame([("c", 1, "p1")], "contig string, position int, protein_id string")
    assert rows(annotate.operon_members(ops, genes)) == [("c", 1, "o", "cas1", "p1"), ("c", 2, "o", "cas2", None)]
