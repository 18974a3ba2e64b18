import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from vicinage import cli
from vicinage.operators import enrich, trees
from vicinage.plans import config


def test_precedence(tmp_path):
    p = tmp_path / "c.toml"
    p.write_text('unknown = 1\nwindow = 5\n[candidates]\ncand-mode = "one_id"\n')
    s = config.load(str(p), window=None, min_win=7)
    assert (s.window, s.cand_mode, s.min_win, s.win_mode) == (5, "one_id", 7, "win_nts")
    with pytest.raises(ValueError):
        config.load(cand_mode="no")


def test_lengths(spark):
    ids = spark.createDataFrame([(0, "GB1"), (1, "XX_2"), (2, "missing")], "og_index bigint, id string")
    contigs = spark.createDataFrame([("GB1", None, "GCA_1", 100), ("GB2", "XX_2", "GCF_2", 200), ("GB1", "XX_1", "GCF_9", 5)], "genbankAccession string, refseqAccession string, assemblyAccession string, length bigint")
    assert [tuple(r) for r in cli.nucleotide_lengths(ids, contigs).collect()] == [("GB1", "GCA_1", 100), ("XX_2", "GCF_2", 200), ("missing", None, None)]


@pytest.mark.parametrize("mode,tree", [("wgrr", "aai_tree"), ("hyper", "neighborhood"), ("aai", "taxonomy")])
def test_run(spark, sf, mode, tree):
    from vicinage.plans import pipeline
    from vicinage.plans.reference import feat, hit, rec
    from vicinage.functions.clean import label

    proteins = spark.read.parquet(f"{sf}/proteins.parquet").withColumn("id", label("id"))
    done = pipeline.run(rec(spark, sf), feat(spark, sf), proteins, hit(spark, sf), config.load(window=2000, aai_mode=mode, tree_mode=tree))
    assert done.proteins.count() > 0 and (done.tree is None) == (tree == "taxonomy")
    assert rows(done.neighbourhoods.where("start_win > start_target")) == []


def pipeline_tables(spark):
    """Three targets: u1 and u2 share p1 and p2 on contig c, u3 has p3 and p4 on contig d."""
    records = spark.createDataFrame([("u1", 0, "c", "p1", 100, 200), ("u2", 1, "c", "p2", 300, 400), ("u3", 2, "d", "p3", 100, 200)], "uid string, og_index bigint, nucleotide_id string, protein_id string, start bigint, end bigint")
    rest = {"input_type": "'protein'", "ipg_id": "cast(og_index as bigint)", "assembly_id": "'GCF_1.1'", "assembly_level": "'Contig'", "is_query": "true", "sequence_length": "cast(1000 as bigint)", "taxid": "cast(og_index + 1 as bigint)", "failed": "cast(null as boolean)", "failed_reason": "cast(null as string)"}
    records = records.selectExpr("*", *[f"{v} as {k}" for k, v in rest.items()])
    features = spark.createDataFrame([(f"f{p}", s, "CDS", a, a + 100, f"p{p}") for p, s, a in ((1, "c", 100), (2, "c", 300), (3, "d", 100), (4, "d", 300))], "id string, seqid string, type string, start bigint, end bigint, protein_id string")
    proteins = spark.createDataFrame([(f"p{p}", "M") for p in range(1, 5)], "id string, sequence string")
    both = [(q, s, v, 1e-9) for a, b, v in (("p1", "p3", 90.0), ("p2", "p4", 70.0)) for q, s in ((a, b), (b, a))]
    return records, features, proteins, spark.createDataFrame(both, "qseqid string, sseqid string, pident double, evalue double")


def test_all_tables_of_a_run(spark, tmp_path):
    from vicinage.plans import output, pipeline
    from vicinage.sources import sinks

    tables = pipeline_tables(spark)
    done = pipeline.run(*tables, config.load(window=500, tree_mode="neighborhood"))
    out = str(tmp_path / "out")
    domains = spark.createDataFrame([("p1", "d"), ("p9", "d")], "protein_id string, domain_id string")
    output.write(done, tables[3], out, {"domains": domains})
    n = {t: spark.read.parquet(f"{out}/{t}.parquet").count() for t in sinks.BUNDLE}
    assert n == {"gff": 6, "hoods": 3, "protein_metadata": 6, "tree_metadata": 0, "domains": 1, "domains_metadata": 0, "ncrna_metadata": 0, "nucleotide_links": 0, "protein_links": 4}
    assert spark.read.option("sep", "\t").option("header", True).csv(f"{out}/records.tsv").count() == 3
    assert spark.read.text(f"{out}/tree.nwk").first()[0] == done.tree
    with pytest.raises(ValueError):
        output.bundle(done, tables[3], {"no": domains})


def test_shared_proteins_count_in_each_neighbourhood(spark):
    from vicinage.plans import pipeline

    sim = pipeline.run(*pipeline_tables(spark), config.load(window=500)).similarity
    got = {(r.q_genome, r.s_genome): (round(r.wgrr, 6), r.aai, r.n_rbh) for r in sim.collect()}
    assert got == {k: (0.8, 80.0, 2) for k in (("u1", "u3"), ("u3", "u1"), ("u2", "u3"), ("u3", "u2"))}


def test_every_tree_mode(spark):
    from vicinage.plans import pipeline

    tables = pipeline_tables(spark)
    lineages = spark.createDataFrame([(1, [1]), (2, [1, 4, 5, 2]), (3, [1, 4, 5, 3])], "taxid bigint, lineage array<bigint>")
    ani = spark.createDataFrame([("c_0_700", "d", 98.0), ("d", "c_0_700", 96.0), ("c_0_900", "d", 80.0)], "query string, ref string, ani double")
    tree = lambda mode, **more: pipeline.run(*tables, config.load(window=500, tree_mode=mode, tree_method="upgma"), **more).tree
    assert tree("taxonomy", lineages=lineages) == "(u1:3.000000,(u2:2.000000,u3:2.000000):1.000000);"
    assert tree("ani_tree", ani=ani) == "((u1:1.500000,u3:1.500000):12.750000,u2:14.250000);"
    assert tree("use_input_tree", newick="(a,b);") == "(a,b);"
    # p2 of u1 and p4 of u3 are one family at one distance from their targets; u2 has only p1 beside its target
    assert tree("neighborhood_phylo") == "((u1:0.000000,u3:0.000000):1.000000,u2:1.000000);"
    for mode in ("ani_tree", "use_input_tree"):
        with pytest.raises(ValueError, match=mode):
            tree(mode)


def test_similarity_of_targets_only(spark):
    from vicinage.plans import pipeline

    sim = pipeline.run(*pipeline_tables(spark), config.load(window=500, aai_subset_mode="target_prot")).similarity
    # p4 is no target; p1 and p2 are targets, and in the windows of both u1 and u2
    assert {(r.q_genome, r.s_genome, round(r.wgrr, 6)) for r in sim.collect()} == {(a, b, 0.9) for a, b in (("u1", "u3"), ("u3", "u1"), ("u2", "u3"), ("u3", "u2"))}


def test_long_single_linkage():
    from vicinage.operators import trees

    names = [f"{i:05d}" for i in range(20_000)]
    text = trees.single_linkage(names, [(names[0], x, float(i)) for i, x in enumerate(names[1:])])
    assert text.count(",") == len(names) - 1 and text.startswith("(" * 19_999 + "00000:0.000000,00001:0.000000)")


def test_pipeline_query_reads_every_stage(spark, sf):
    from vicinage.plans import more, pipeline
    from vicinage.plans.reference import feat, rec

    got = more.run_pipeline(spark, sf).collect()
    whole, (tree,) = [r for r in got if r.uid], [r for r in got if not r.uid]
    r = rec(spark, sf)
    hoods = pipeline.neighbourhoods(enrich.candidates(r, "best_id"), feat(spark, sf), config.Settings())
    want = {x.uid: (x.start_win, x.end_win) for x in hoods.collect()}
    assert {x.uid: (x.start_win, x.end_win) for x in whole if x.end_win} == want
    assert tree.newick.count(",") == sum(x.end_win is not None and x.failed is None for x in whole) - 1 and sum(x.n_similar or 0 for x in whole) > 0
    assert {x.species is None for x in whole if x.end_win} == {False}


def test_pairs_by_position_of_all_proteins(spark, sf):
    from vicinage.plans import more
    from vicinage.plans.reference import hit, prot

    ids = {r.id for r in prot(spark, sf).collect()}
    want = {tuple(sorted((r.qseqid, r.sseqid))) for r in hit(spark, sf).collect() if {r.qseqid, r.sseqid} <= ids and r.qseqid != r.sseqid}
    assert want and rows(more.QUERIES["flt12_all_pairs_by_position"](spark, sf)) == sorted(want)


def test_neighbourhood_tree_has_every_contig(spark, sf, monkeypatch):
    from vicinage.operators import trees
    from vicinage.plans import more
    from vicinage.plans.reference import prot

    sets: dict = {}
    for r in prot(spark, sf).where("genome is not null and family is not null").collect():
        sets.setdefault(r.genome, set()).add(r.family)
    far = sorted((1 - len(sets[a] & sets[b]) / len(sets[a] | sets[b]), a, b) for a in sets for b in sets if a < b)
    at, want = {x: x for x in sets}, []
    for d, a, b in far:
        if at[a] != at[b]:
            want.append(round(d, 9))
            at = {x: at[a] if v == at[b] else v for x, v in at.items()}
    members = prot(spark, sf).where("genome is not null and family is not null").selectExpr("genome as id", "family as item")
    for block in (4096, 7):  # one block, and pairs of several
        monkeypatch.setattr(trees, "BLOCK", block)
        assert [round(d, 9) for _, _, d in trees.jaccard_forest(members)] == want
    (tree,) = more.QUERIES["alg26_neighbourhood_tree"](spark, sf).collect()
    assert tree.n == len(sets) and tree.newick.count(",") == len(sets) - 1


def test_operon_blocks_list_every_feature(spark, sf):
    from vicinage.plans import more
    from vicinage.plans.reference import feat

    got = more.QUERIES["jn19_operon_blocks"](spark, sf).select("contig", "gene", "protein_id")
    assert rows(got) == rows(feat(spark, sf).select("seqid", "id", "protein_id"))


def test_neighbourhood_tree_is_made_in_a_task(spark, sf, monkeypatch):
    """No leaf and no edge comes to the driver, and the tree is that of all leaves' edges merged there."""
    from vicinage.plans import more
    from vicinage.plans.reference import prot

    members = prot(spark, sf).where("genome is not null and family is not null").selectExpr("genome as id", "family as item")
    names = sorted(r[0] for r in members.select("id").distinct().collect())
    want = trees.single_linkage(names, trees.minimum_forest(trees.fill_distances(trees.presence_jaccard(members), members, "one")))
    monkeypatch.setattr(trees, "BLOCK", 9)
    monkeypatch.setattr(trees, "MERGED", 2)
    with monkeypatch.context() as m:
        m.setattr(type(members), "collect", lambda _: pytest.fail("rows on the driver"))
        tree = more.QUERIES["alg26_neighbourhood_tree"](spark, sf)
    got = tree.collect()
    assert [r.n for r in got] == [len(names)]
    heights = lambda text: sorted((a, b, round(h, 4)) for a, b, h, _ in trees.meetings(text))
    assert heights(got[0].newick) == heights(want)
    assert trees.jaccard_tree(members.where("id = 'none'")).first()[:] == (0, ";")
    assert trees.jaccard_tree(members.where(F.col("id") == names[0])).first()[:] == (1, f"{names[0]};")


def test_spanning_keeps_the_first_edges():
    import numpy as np

    rng = np.random.default_rng(1)
    a, b, d = rng.integers(0, 60, 900), rng.integers(0, 60, 900), rng.integers(0, 5, 900) / 4
    at, want = list(range(60)), []
    for w, x, y in sorted(zip(d.tolist(), a.tolist(), b.tolist(), strict=True)):
        if at[x] != at[y]:
            want.append((x, y, w))
            at = [at[x] if v == at[y] else v for v in at]
    assert list(zip(*(v.tolist() for v in trees.spanning(a, b, d)), strict=True)) == want


def test_every_leaf_meets_every_leaf(spark, sf):
    """alg24 takes no part of the customers: each has a distance to all, itself included."""
    from vicinage.plans import reference

    ids = [r[0] for r in spark.read.parquet(f"{sf}/customer.parquet").select("c_custkey").collect()]
    got = reference.alg24_lca_distance(spark, sf).collect()
    assert sorted((r["cust"], r["other"]) for r in got) == sorted((a, b) for a in ids for b in ids)
    assert all((r["dist"] == 0) == (r["cust"] == r["other"]) for r in got)
