"""More of the inventory as queries with SQL: the ids reference.py has no query of their own for."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vicinage.functions import ids, text
from vicinage.functions.clean import bare_id, label
from vicinage.operators import annotate, enrich, families, greedy, similarity, taxonomy, trees, windows
from vicinage.plans import config, pipeline
from vicinage.plans.queries import table
from vicinage.plans.reference import QUERIES, SQL, _FEAT, _GENOME, _HIT, _PROT, _RBH, _REC, _SHARE, _WIN, _bare, _chosen, _rbh, _tree_nodes, _trim, _windows, dom, feat, genomes, hit, prot, query, rec
from vicinage.session import cut

__all__ = ["QUERIES", "SQL"]


@query(f"{_RBH} select q_genome, s_genome, count(*) as n, round(sum(pident) + 1e-9, 4) as total, round(avg(pident) + 1e-9, 4) as mean from rbh group by 1, 2")
def agg03_pair_sums(spark: SparkSession, sf: str) -> DataFrame:
    return _rbh(spark, sf).groupBy("q_genome", "s_genome").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("pident") + 1e-9, 4).alias("total"), F.round(F.avg("pident") + 1e-9, 4).alias("mean"))


@query(f"with {_PROT} select family, count(distinct genome) as df from prot where family is not null and genome is not null group by family having count(distinct genome) <= (select (count(distinct genome) + 4) // 5 from prot where family is not null and genome is not null)")
def agg04_family_frequency(spark: SparkSession, sf: str) -> DataFrame:
    once = prot(spark, sf).where("family is not null and genome is not null").select("genome", "family").distinct()
    n = once.select("genome").distinct().count()
    return once.groupBy("family").agg(F.count(F.lit(1)).alias("df")).where(F.col("df") <= -(-n // 5))


@query(f"with {_FEAT}, r as (select *, row_number() over (partition by seqid, type order by start, \"end\", id) as k from feat) select seqid, type, id from r where k = 1")
def agg08_first_of_each(spark: SparkSession, sf: str) -> DataFrame:
    return enrich.first_by(feat(spark, sf), ["seqid", "type"], [F.col("start"), F.col("end"), F.col("id")]).select("seqid", "type", "id")


@query("select count(*) as n, count(distinct seqid) as contigs, count(distinct cast(start as varchar)) as starts from gff")
def agg12_distinct_counts(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "gff").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("seqid").alias("contigs"), F.countDistinct(F.col("start").cast("string")).alias("starts"))


@query("select qseqid, sseqid, case when length is not null then round(least(1.0, greatest(0.0, length / 200.0)) + 1e-10, 6) end as share from hits")
def agg14_clipped_share(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "hits").select("qseqid", "sseqid", F.when(F.col("length").isNotNull(), F.round(F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.col("length") / 200)) + 1e-10, 6)).alias("share"))


@query(f"with {_HIT}, {_GENOME}, b as (select qseqid, sseqid, max(pident) as pident from hit where qseqid <> sseqid and pident is not null group by 1, 2) select b.*, q.genome as q_genome, s.genome as s_genome from b join genomes q on q.id = qseqid join genomes s on s.id = sseqid where q.genome <> s.genome")
def jn11_annotated_hits(spark: SparkSession, sf: str) -> DataFrame:
    return similarity.annotate_hits(hit(spark, sf), genomes(spark, sf)).select("qseqid", "sseqid", "pident", "q_genome", "s_genome")


@query(f"{_SHARE.replace('having count(*) >= 2', '')} select a, b, k from full_pairs")
def jn13_family_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return similarity.shared_families(prot(spark, sf).select("genome", "family"), min_shared=1, method=None, sizes=False)


@query(f"with {_PROT}, {_HIT}, e as (select {_trim('name')} as id, min(kegg_ko) as ko from eggnog_prots group by 1), b as (select qseqid as id, max(bitscore) as bits from hit group by 1) select p.id, e.ko, b.bits from (select distinct id from prot) p left join e on e.id = p.id left join b on b.id = p.id")
def jn16_annotations(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "eggnog_prots").groupBy(label("name").alias("id")).agg(F.min("kegg_ko").alias("ko"))
    b = hit(spark, sf).groupBy(F.col("qseqid").alias("id")).agg(F.max("bitscore").alias("bits"))
    return prot(spark, sf).select("id").distinct().join(e, "id", "left").join(b, "id", "left")


@query(f"""with {_FEAT}, g as (select seqid, id, protein_id, row_number() over (partition by seqid order by start, "end", id) as pos from feat) select seqid || '_op' || ((pos - 1) // 4) as operon, seqid as contig, pos as position, id as gene, protein_id from g""")
def jn19_operon_blocks(spark: SparkSession, sf: str) -> DataFrame:
    g = windows.gene_index(feat(spark, sf), name="i").select("seqid", "id", "protein_id", (F.col("i") + 1).alias("position"), F.expr("i div 4").alias("block"))
    return _operons(g, g, ["seqid", "block"], F.concat("seqid", F.lit("_op"), F.col("block").cast("string")))


def _operons(members: DataFrame, g: DataFrame, keys: list[str], name: Column) -> DataFrame:
    """Operons that the keys make of members, as lists in text, looked up in the features g (seqid, id, protein_id, position)."""
    listed = members.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("position", "id"))).alias("m"))
    as_text = lambda f: F.concat(F.lit("["), F.array_join(F.transform("m", f), ", "), F.lit("]"))
    ops = listed.select(name.alias("operon"), F.col("seqid").alias("contig"), as_text(lambda x: x["position"].cast("string")).alias("positions"), as_text(lambda x: F.concat(F.lit("'"), x["id"], F.lit("'"))).alias("genes"))
    return annotate.operon_members(ops, g.select(F.col("seqid").alias("contig"), "position", "protein_id"))


@query(f"with {_REC}, {_PROT}, t as (select uid, protein_id as target_prot, case when input_type = 'uniprot' then uniprot_id end as uniprot from rec) select t.uid, t.target_prot, t.uniprot, g.genome as target_nuc from t left join (select id, min(genome) as genome from prot where genome is not null group by id) g on g.id = t.target_prot")
def jn23_target_metadata(spark: SparkSession, sf: str) -> DataFrame:
    t = rec(spark, sf).select("uid", F.col("protein_id").alias("target_prot"), F.when(F.col("input_type") == "uniprot", F.col("uniprot_id")).alias("uniprot"))
    return t.join(genomes(spark, sf).select(F.col("id").alias("target_prot"), F.col("genome").alias("target_nuc")), "target_prot", "left")


@query(f"with {_REC}{_WIN} select r.uid, r.og_index, r.taxid, w.start_win, w.end_win from rec r left join win w on w.uid = r.uid")
def jn24_output_joins(spark: SparkSession, sf: str) -> DataFrame:
    w = _windows(spark, sf, 900).select("uid", "start_win", "end_win")
    return rec(spark, sf).select("uid", "og_index", "taxid").join(w, "uid", "left")


@query(f"with {_FEAT} select id, seqid, count(*) over (partition by seqid) as size, sum(case when type = 'CDS' then 1 else 0 end) over (partition by seqid) as coding from feat")
def win03_group_sizes(spark: SparkSession, sf: str) -> DataFrame:
    w = W.partitionBy("seqid")
    return feat(spark, sf).select("id", "seqid", F.count(F.lit(1)).over(w).alias("size"), F.sum(F.when(F.col("type") == "CDS", 1).otherwise(0)).over(w).alias("coding"))


@query(f"""with {_REC}{_WIN}, t as (select w.uid, r.nucleotide_id as seqid, start_win, end_win from win w join rec r on r.uid = w.uid) select t.uid, f.id, coalesce(f.protein_id, f.id) as name from (select * from feat where type = 'CDS') f join t on t.seqid = f.seqid and f.start >= start_win and f."end" <= end_win""".replace(f"with {_REC}", f"with {_FEAT}, {_REC}"))
def alg02_features_in_window(spark: SparkSession, sf: str) -> DataFrame:
    w = _windows(spark, sf, 900).withColumnRenamed("nucleotide_id", "seqid").where("start_win <= end_win")
    return windows.contained(feat(spark, sf).where("type = 'CDS'"), w).select("uid", "id", F.coalesce("protein_id", "id").alias("name"))


_FREE = f"""{_FEAT}, f as (select distinct seqid, start as s, "end" as e from feat where type = 'CDS' and start <= "end"), p as (select distinct seqid, id, start as s, "end" as e from feat where type <> 'CDS' and start <= "end" and "end" - start + 1 between 30 and 5000),
    free as (select * from p where not exists (select 1 from f where f.seqid = p.seqid and f.s <= p.e and f.e >= p.s and (least(p.e, f.e) - greatest(p.s, f.s) + 1) * 100 > 10 * (p.e - p.s + 1)))"""


@query(f"""with recursive {_FREE}, {_chosen("free", "seqid", "s, e, id", 0)} select seqid, id, s as start, e as "end" from taken""")
def alg04_accept_predicted(spark: SparkSession, sf: str) -> DataFrame:
    """Features that aren't coding, of 30 to 5,000 positions, as if they were predicted, beside the coding ones."""
    f = feat(spark, sf).where("start <= end")
    coding, other = f.where("type = 'CDS'").select("seqid", "start", "end"), f.where("type <> 'CDS'").select("seqid", "id", "start", "end")
    return greedy.accept_predicted(coding.distinct(), other.distinct(), 10, 30, 5000)


@query(f"""with {_HIT}, {_GENOME}, m as (select q.genome as a, s.genome as b, pident from hit join genomes q on q.id = qseqid join genomes s on s.id = sseqid where q.genome <> s.genome and pident is not null)
    select least(a, b) as a, greatest(a, b) as b, round(avg(pident) + 1e-9, 4) as ani from m group by 1, 2""")
def alg10_unit_ani(spark: SparkSession, sf: str) -> DataFrame:
    g = genomes(spark, sf)
    none = spark.createDataFrame([], "temp_seqid string, uid string")
    owner = g.select(F.col("id").alias("seqid"), F.col("genome").alias("uid"))
    h = similarity.owned_by(hit(spark, sf).where("pident is not null"), "qseqid", none, owner, "qg")
    h = similarity.owned_by(h, "sseqid", none, owner, "sg").where("qg is not null and sg is not null")
    return similarity.unordered_mean(h, "qg", "sg", ["pident"]).select("a", "b", F.round(F.col("pident") + 1e-9, 4).alias("ani"))


@query(f"""with {_REC}, {_HIT}, w as (select protein_id, min(nucleotide_id) as seqid, min(start) as start_win from rec where protein_id is not null and start is not null group by protein_id)
    select h.qseqid, a.seqid as q_contig, a.start_win + coalesce(length, 0) as q_end, b.seqid as s_contig, b.start_win + coalesce(length, 0) as s_end from hit h left join w a on a.protein_id = h.qseqid left join w b on b.protein_id = h.sseqid""")
def alg11_lifted_links(spark: SparkSession, sf: str) -> DataFrame:
    w = rec(spark, sf).where("protein_id is not null and start is not null").groupBy("protein_id").agg(F.min("nucleotide_id").alias("seqid"), F.min("start").alias("start_win"))
    a, b = (w.select(F.col("protein_id").alias(f"{x}seqid"), F.col("seqid").alias(f"{x}_contig"), F.col("start_win").alias(f"{x}_win")) for x in "qs")
    n = F.coalesce("length", F.lit(0))
    return hit(spark, sf).join(a, "qseqid", "left").join(b, "sseqid", "left").select("qseqid", "q_contig", (F.col("q_win") + n).alias("q_end"), "s_contig", (F.col("s_win") + n).alias("s_end"))


@query(f"""with recursive {_HIT}, h as (select qseqid as a, sseqid as b from hit where qseqid <> sseqid and evalue <= 1e-10), edge as (select a, b from h union select b, a from h),
    reach(id, rep) as (select a, least(a, min(b)) from edge group by a union select e.b, r.rep from reach r join edge e on e.a = r.id where r.rep < e.b) select id, min(rep) as rep from reach group by id""")
def alg21_components(spark: SparkSession, sf: str) -> DataFrame:
    return families.components(hit(spark, sf).where("qseqid <> sseqid and evalue <= 1e-10"), "qseqid", "sseqid")


@query()
def alg26_neighbourhood_tree(spark: SparkSession, sf: str) -> DataFrame:
    """Single linkage of all contigs that hold a protein with a family, by the families they hold."""
    p = prot(spark, sf).where("genome is not null and family is not null").select(F.col("genome").alias("id"), F.col("family").alias("item"))
    return trees.jaccard_tree(p)


@query(f"""with {_FEAT} select distinct seqid, label, start, "end" from (select regexp_replace(seqid || '|p_' || id, '\\|.*$', '') as seqid, type as label, min(start) as start, max("end") as "end" from feat where type = 'mobile_element' group by 1, 2)""")
def alg33_mobile_spans(spark: SparkSession, sf: str) -> DataFrame:
    f = feat(spark, sf).where("type = 'mobile_element'")
    return annotate.mobile_spans(f.select(F.concat("seqid", F.lit("|p_"), "id").alias("gene"), F.col("type").alias("label"), "start", "end"))


@query(f"""with {_REC}, present as (select distinct nucleotide_id as id from rec where sequence_length is not null), wanted as (select distinct {_trim('seqid')} as id from documents where seqid is not null and cast(created_at as date) > date '2024-01-15') select id from wanted where id not in (select id from present)""")
def alg38_refresh_list(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "documents").where("seqid is not null and created_at is not null").select(label("seqid").alias("id"), F.date_format("created_at", "yyyy-MM-dd").alias("day"))
    wanted = enrich.newer(d, "day", "2024-01-15").select("id").distinct()
    return enrich.missing(wanted, rec(spark, sf).where("sequence_length is not null"), "id", "nucleotide_id")


@query(f"""select distinct {_bare('qseqid')} as id, regexp_replace({_bare('qseqid')}, '\\.[0-9]+$', '') as bare, regexp_replace({_bare('qseqid')}, '_[^_]+$', '') as element, split_part({_bare('qseqid')}, '_', 1) as first, regexp_matches({_bare('qseqid')}, '^HWP_') as is_wp, lower(trim(qseqid)) as low from hits""")
def str02_id_parts(spark: SparkSession, sf: str) -> DataFrame:
    q = F.col("id")
    h = table(spark, sf, "hits").select("qseqid", bare_id("qseqid").alias("id"))
    return h.select("id", ids.unversioned(q).alias("bare"), F.regexp_replace(q, r"_[^_]+$", "").alias("element"), text.nth(q, "_", 1).alias("first"), q.rlike("^HWP_").alias("is_wp"), F.lower(F.trim("qseqid")).alias("low")).distinct()


@query("select l_orderkey, l_linenumber, l_partkey, abs(l_discount - 0.05) as away, ceil(l_quantity / 7.0) as packs, round(log10(l_extendedprice) + 1e-9, 6) as mag, least(1.0, greatest(0.0, l_quantity / 50 - 0.1)) as clipped from lineitem")
def mth01_arithmetic(spark: SparkSession, sf: str) -> DataFrame:
    c = F.col
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.abs(c("l_discount") - 0.05).alias("away"), F.ceil(c("l_quantity") / 7).alias("packs"), F.round(F.log10("l_extendedprice") + 1e-9, 6).alias("mag"), F.least(F.lit(1.0), F.greatest(F.lit(0.0), c("l_quantity") / 50 - 0.1)).alias("clipped"))


@query("select doc_id, try_cast(lang as date) as as_date, cast(created_at as date) > date '2024-02-01' as late from documents")
def dat01_try_date(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", F.col("lang").try_cast("date").alias("as_date"), (F.to_date("created_at") > F.lit("2024-02-01").cast("date")).alias("late"))


@query("select doc_id, coalesce(nullif(trim(lang), ''), 'unknown') as lang, case when n_chars < 200 then 'short' when n_chars < 2000 then 'middle' else 'long' end as size from documents")
def cnd01_case_chains(spark: SparkSession, sf: str) -> DataFrame:
    n = F.col("n_chars")
    return table(spark, sf, "documents").select("doc_id", F.coalesce(F.nullif(F.trim("lang"), F.lit("")), F.lit("unknown")).alias("lang"), F.when(n < 200, "short").when(n < 2000, "middle").otherwise("long").alias("size"))


@query(f"with d as (select protein_id, domain_id, s, e from (select distinct {_trim('protein_id')} as protein_id, split_part({_trim('domain_id')}, '.', 1) as domain_id, least(start, \"end\") as s, greatest(start, \"end\") as e from domain_hits where protein_id is not null and start is not null and \"end\" is not null)) select protein_id, count(*) as n, count(distinct domain_id) as domains, min(s) as first, max(e) as last from d group by protein_id")
def agg05_domain_spans(spark: SparkSession, sf: str) -> DataFrame:
    d = dom(spark, sf).select("protein_id", "domain_id", "start", "end").distinct()
    return d.groupBy("protein_id").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("domain_id").alias("domains"), F.min("start").alias("first"), F.max("end").alias("last"))


@query()
def run_pipeline(spark: SparkSession, sf: str) -> DataFrame:
    """The whole run at default settings: a row per record chosen with what each stage has of it, and a row with the tree.

    The taxonomy is nation and region: taxid % 30 + 100, and no lineage where there is no such nation.
    """
    n = table(spark, sf, "nation").join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select((F.col("n_nationkey") + 100).cast("bigint").alias("taxid"), "n_name", "r_name")
    ranks = n.select("taxid", F.explode(F.create_map(F.lit("species"), "n_name", F.lit("domain"), "r_name")).alias("rank", "name"))
    tree_nodes = _tree_nodes(spark, sf).where("taxid < 1000000000")
    r = rec(spark, sf).withColumn("taxid", F.col("taxid") % 30 + 100)
    done = pipeline.run(r, feat(spark, sf), table(spark, sf, "proteins").withColumn("id", label("id")), hit(spark, sf), config.load(), ranks, taxonomy.lineages(tree_nodes))
    features = done.gff.groupBy("uid").agg(F.count(F.lit(1)).alias("n_features"))
    prots = done.proteins.groupBy("uid").agg(F.count(F.lit(1)).alias("n_proteins"), F.countDistinct("fam_cluster").alias("n_families"))
    similar = done.similarity.groupBy(F.col("q_genome").alias("uid")).agg(F.count(F.lit(1)).alias("n_similar"), F.sum("n_rbh").alias("n_rbh"), F.round(F.max("wgrr") + 1e-9, 6).alias("max_wgrr"))
    meta = done.tree_metadata.select(F.col("unique_id").alias("uid"), "taxid", "superkingdom", "species")
    out = done.records.select("uid").join(done.neighbourhoods.select("uid", "start_win", "end_win", "failed"), "uid", "left")
    for part in (features, prots, similar, meta):
        out = out.join(part, "uid", "left")
    return out.unionByName(spark.createDataFrame([(done.tree,)], "newick string"), allowMissingColumns=True)
