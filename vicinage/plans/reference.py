"""Each operator of the survey's inventory as a query over the test tables, with its SQL. Names begin with survey ids."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vicinage import schemas
from vicinage.functions import ids, links, stats, text
from vicinage.functions.clean import bare_id, label, whole_number
from vicinage.operators import annotate, enrich, families, greedy, similarity, taxonomy, trees, windows
from vicinage.operators.coverage import coverage
from vicinage.plans.queries import table
from vicinage.session import cut, table_path
from vicinage.sources import readers, sinks
from vicinage.streaming import ingest

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _trim(c: str) -> str:
    return rf"trim({c}, e' \t\n\r')"


def _bare(c: str) -> str:
    return _trim(rf"regexp_replace({c}, '^.*\|', '')")


# Views that several queries read, in both languages.
_PROT = f"""prot as (select distinct {_trim("id")} as id, nullif({_trim("target_nuc")}, '') as genome,
    case when regexp_matches({_trim("fam_cluster")}, '^[+-]?[0-9]+(\\.0*)?$') then cast(split_part({_trim("fam_cluster")}, '.', 1) as bigint) end as family from proteins)"""
_GENOME = f"{_PROT}, genomes as (select id, min(genome) as genome from prot where genome is not null group by id)"
_HIT = f"hit as (select {_bare('qseqid')} as qseqid, {_bare('sseqid')} as sseqid, pident, length, evalue, bitscore from hits)"
_FEAT = f"""feat as (select distinct {_trim("id")} as id, {_trim("seqid")} as seqid, type, start, "end", nullif({_trim("protein_id")}, '') as protein_id from gff where seqid is not null)"""
_REC = f"""rec as (select distinct {_trim("unique_id")} as uid, og_index, input_type, {_trim("protein_id")} as protein_id, {_trim("nucleotide_id")} as nucleotide_id, uniprot_id, ipg_id,
    {_trim("assembly_id")} as assembly_id, {_trim("assembly_level")} as assembly_level, coalesce(is_refseq_query, false) as is_query, sequence_length, strand, start, "end", taxid, failed, failed_reason from records)"""


def prot(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "proteins").select(label("id").alias("id"), label("target_nuc").alias("genome"), whole_number("fam_cluster").alias("family")).distinct()


def genomes(spark: SparkSession, sf: str) -> DataFrame:
    return prot(spark, sf).where("genome is not null").groupBy("id").agg(F.min("genome").alias("genome"))


def hit(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "hits").select(bare_id("qseqid").alias("qseqid"), bare_id("sseqid").alias("sseqid"), "pident", "length", "evalue", "bitscore")


def feat(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "gff").where("seqid is not null").select(label("id").alias("id"), label("seqid").alias("seqid"), "type", "start", "end", label("protein_id").alias("protein_id")).distinct()


def rec(spark: SparkSession, sf: str) -> DataFrame:
    r = table(spark, sf, "records")
    return r.select(label("unique_id").alias("uid"), "og_index", "input_type", label("protein_id").alias("protein_id"), label("nucleotide_id").alias("nucleotide_id"), "uniprot_id", "ipg_id", label("assembly_id").alias("assembly_id"), F.btrim("assembly_level").alias("assembly_level"), F.coalesce("is_refseq_query", F.lit(False)).alias("is_query"), "sequence_length", "strand", "start", "end", "taxid", "failed", "failed_reason").distinct()


# ---- identifiers, predicates, projections -------------------------------------------------------------------------

_CLASS = r"""case when t is null then null when regexp_matches(t, '^UPI[0-9A-Fa-f]{10}$') then 'uniparc'
    when regexp_matches(t, '^[OPQ][0-9][A-Z0-9][A-Z0-9][A-Z0-9][0-9]$') or regexp_matches(t, '^[A-NR-Z][0-9][A-Z][A-Z0-9][A-Z0-9][0-9]([A-Z][A-Z0-9][A-Z0-9][0-9])?$') then 'uniprot'
    when split_part(t, '_', 1) in ('NC', 'NG', 'NM', 'NR', 'NT', 'NW', 'NZ', 'AC', 'AP', 'MT', 'PP', 'OR', 'OZ', 'LR', 'LN', 'KX') and regexp_matches(t, '^[A-Z]{2}_[A-Z]*[0-9]+(\.[0-9]+)?$') then 'nucleotide'
    when regexp_matches(t, '^[A-Z][A-Z]?[0-9]{5,8}(\.[0-9]+)?$') or regexp_matches(t, '^[A-Z]{4,6}[0-9]{8,}(\.[0-9]+)?$') then 'nucleotide'
    when regexp_matches(t, '^WP_[0-9]{9}(\.[0-9]+)?$') or regexp_matches(t, '^(NP|XP|YP|ZP)_[0-9]{6,9}(\.[0-9]+)?$') or regexp_matches(t, '^[A-Z]{3}[0-9]{5,8}(\.[0-9]+)?$') then 'protein'
    else 'unmatched' end"""


@query(f"""with {_REC}, all_ids as (select substr(protein_id, 2) as t from rec union all select substr(nucleotide_id, 2) from rec union all select replace(uniprot_id, 'ZZ', 'P') from rec)
    select {_CLASS} as kind, count(*) as n from all_ids group by 1""")
def flt01_id_class(spark: SparkSession, sf: str) -> DataFrame:
    r = rec(spark, sf)
    parts = [F.substr("protein_id", F.lit(2)), F.substr("nucleotide_id", F.lit(2)), F.replace("uniprot_id", F.lit("ZZ"), F.lit("P"))]
    return r.select(F.explode(F.array(*parts)).alias("t")).groupBy(ids.id_class(F.col("t")).alias("kind")).agg(F.count(F.lit(1)).alias("n"))


@query(f"""with {_REC}, x as (select uid, assembly_id as a, substr(nucleotide_id, 2) as n from rec where assembly_id is not null)
    select uid, case when regexp_matches(n, '^[A-Z]{{2}}_') then 'GCF_' else 'GCA_' end || substr(a, 5) as fixed, regexp_replace(a, '^GC[AF]_', '') as core, regexp_replace(n, '\\.[0-9]+$', '') as bare from x""")
def flt02_prefix_fix(spark: SparkSession, sf: str) -> DataFrame:
    n = F.substr("nucleotide_id", F.lit(2))
    return rec(spark, sf).where("assembly_id is not null").select("uid", ids.fit_prefix(F.col("assembly_id"), n).alias("fixed"), ids.assembly_core(F.col("assembly_id")).alias("core"), ids.unversioned(n).alias("bare"))


@query(f"""with {_REC} select uid, case when sequence_length <= 0 then true else failed end as failed, case when sequence_length <= 0 then 'no length' else failed_reason end as failed_reason from rec""")
def flt03_mark_failed(spark: SparkSession, sf: str) -> DataFrame:
    return enrich.mark_failed(rec(spark, sf), F.col("sequence_length") <= 0, "no length").select("uid", "failed", "failed_reason")


@query(f"""with {_REC} select uid, case when not (assembly_level in ('Chromosome', 'Complete Genome')) then true else failed end as failed, cast(coalesce(taxid, 32644) as varchar) as taxid from rec""")
def flt04_group_whitelist(spark: SparkSession, sf: str) -> DataFrame:
    r = enrich.mark_failed(rec(spark, sf), ~F.col("assembly_level").isin("Chromosome", "Complete Genome"), "group not wanted")
    return r.select("uid", "failed", F.coalesce("taxid", F.lit(32644)).cast("string").alias("taxid"))


@query(f"""with {_REC}, x as (select uid, strand, 'nucleotide' as input_type, case when strand is null then null else start end as start, case when strand is null then null else "end" end as "end", sequence_length from rec),
    y as (select *, start is null and "end" is null and sequence_length is not null as is_full from x)
    select uid, is_full as is_full_contig, case when is_full then 0 else start end as start, case when is_full then sequence_length else "end" end as "end" from y""")
def flt07_full_contigs(spark: SparkSession, sf: str) -> DataFrame:
    r = rec(spark, sf).select("uid", F.lit("nucleotide").alias("input_type"), F.when(F.col("strand").isNotNull(), F.col("start")).alias("start"), F.when(F.col("strand").isNotNull(), F.col("end")).alias("end"), "sequence_length")
    return windows.fill_full_contigs(r).select("uid", "is_full_contig", "start", "end")


_WIN = """, win as (select uid, start as start_target, "end" as end_target, greatest(0, start - 900) as start_win,
    case when sequence_length is null then "end" + 900 else least("end" + 900, sequence_length) end as end_win from rec where start is not null and "end" is not null)"""


@query(f"""with {_REC}{_WIN} select uid, end_win - start_win < 1500 as total, start_target - start_win < 700 as upstream, end_win - end_target < 700 as downstream,
    start_target - start_win < 700 or end_win - end_target < 700 as both_sides from win""")
def flt09_min_window(spark: SparkSession, sf: str) -> DataFrame:
    w = _windows(spark, sf, 900)
    no = F.lit(False)
    return w.select("uid", windows.too_small("total", 1500, no).alias("total"), windows.too_small("upstream", 700, no).alias("upstream"), windows.too_small("downstream", 700, no).alias("downstream"), windows.too_small("both", 700, no).alias("both_sides"))


def _windows(spark: SparkSession, sf: str, width: int) -> DataFrame:
    t = rec(spark, sf).where("start is not null and end is not null")
    return windows.windows_by_distance(t, width).withColumnRenamed("start", "start_target").withColumnRenamed("end", "end_target")


@query(f"""with {_PROT}, x as (select id, family, count(*) over (partition by family) as n, sum(case when id like '%orfipy%' then 1 else 0 end) over (partition by family) as o from prot)
    select id, family from x where not (family is not null and n = o) and not (family is null and id like '%sORF%')""")
def flt10_sorf_discard(spark: SparkSession, sf: str) -> DataFrame:
    p = prot(spark, sf).withColumn("source", F.when(F.col("id").contains("orfipy"), "orfipy").otherwise("other"))
    return families.drop_unsupported(p, "family").select("id", "family")


@query(f"with {_HIT} select qseqid, sseqid, pident, bitscore from hit where qseqid <> sseqid and evalue <= 1e-5 and pident >= 30")
def flt11_hit_thresholds(spark: SparkSession, sf: str) -> DataFrame:
    return families.filtered_hits(hit(spark, sf)).select("qseqid", "sseqid", "pident", "bitscore")


@query(f"""with {_HIT}, {_PROT}, pos as (select id, row_number() over (order by id) as p from (select distinct id from prot where id is not null)) select distinct least(q.id, s.id) as a, greatest(q.id, s.id) as b from hit join pos q on q.id = qseqid join pos s on s.id = sseqid where q.p <> s.p""")
def flt12_all_pairs_by_position(spark: SparkSession, sf: str) -> DataFrame:
    return _pairs_by_position(spark, sf, prot(spark, sf).where("id is not null").select("id").distinct())


def _pairs_by_position(spark: SparkSession, sf: str, named: DataFrame) -> DataFrame:
    """Each unordered pair of hits between the named ids once, the one with the smaller position first."""
    pos = stats.global_rank(named, [F.col("id")], "p")
    q, s = pos.select(F.col("id").alias("qseqid"), F.col("p").alias("qp")), pos.select(F.col("id").alias("sseqid"), F.col("p").alias("sp"))
    h = hit(spark, sf).join(q, "qseqid").join(s, "sseqid").where("qp <> sp")
    first = F.col("qp") < F.col("sp")
    return h.select(F.when(first, F.col("qseqid")).otherwise(F.col("sseqid")).alias("a"), F.when(first, F.col("sseqid")).otherwise(F.col("qseqid")).alias("b")).distinct()


@query("""select try_cast(unique_id as bigint) as og_index, input_type, case when lower(cast(premade as varchar)) = 'true' then true else false end as premade, try_cast(assembly_level as bigint) as taxid from records""")
def flt13_enforce_schema(spark: SparkSession, sf: str) -> DataFrame:
    raw = table(spark, sf, "records").select(F.col("unique_id").alias("og_index"), "input_type", F.col("premade").cast("string").alias("premade"), F.col("assembly_level").alias("taxid"), F.lit(1).alias("more"))
    return schemas.RECORDS.enforce(raw, allow_extra=False)


@query(f"""with {_FEAT}, {_REC}, kept as (select distinct nucleotide_id from rec where failed is null) select count(*) as n, count(distinct seqid) as contigs from feat where seqid in (select nucleotide_id from kept)""")
def flt14_output_scope(spark: SparkSession, sf: str) -> DataFrame:
    kept = rec(spark, sf).where("failed is null").select(F.col("nucleotide_id").alias("seqid")).distinct()
    return feat(spark, sf).join(kept, "seqid", "left_semi").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("seqid").alias("contigs"))


@query(r"""select doc_id, translate(regexp_replace(text, '\r\n|[\r\n]', ' ', 'g'), '`"', '''''') as text, source from documents""")
def flt16_sanitise(spark: SparkSession, sf: str) -> DataFrame:
    return text.sanitised(table(spark, sf, "documents").select("doc_id", "text", "source"))


@query("select doc_id, doc_kind, seqid from documents")
def flt17_extra_columns(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "documents")
    extra = schemas.extra_columns(d, {"doc_id", "text", "lang", "source", "n_chars", "created_at"})
    return d.select("doc_id", *extra)


# ---- joins, set operations, candidate choice ----------------------------------------------------------------------


@query(f"with {_FEAT}, {_REC} select seqid, count(*) as n from feat where seqid in (select nucleotide_id from rec where ipg_id is not null) group by seqid")
def jn01_semi_lookup(spark: SparkSession, sf: str) -> DataFrame:
    wanted = rec(spark, sf).where("ipg_id is not null")
    return enrich.semi_lookup(feat(spark, sf), wanted, "seqid", "nucleotide_id").groupBy("seqid").agg(F.count(F.lit(1)).alias("n"))


@query(f"""with {_REC}, m as (select protein_id, min(uniprot_id) as u from rec where uniprot_id is not null and protein_id is not null group by protein_id)
    select e.id, m.u as uniprot from (select distinct id, {_trim("name")} as name from eggnog_prots) e join m on m.protein_id = e.name""")
def jn02_mapped_accession(spark: SparkSession, sf: str) -> DataFrame:
    m = rec(spark, sf).where("uniprot_id is not null and protein_id is not null").groupBy(F.col("protein_id").alias("name")).agg(F.min("uniprot_id").alias("uniprot"))
    return table(spark, sf, "eggnog_prots").select("id", label("name").alias("name")).distinct().join(m, "name").select("id", "uniprot")


@query(f"""with {_REC}, dim as (select nucleotide_id, max(sequence_length) as l, min(taxid) as t from rec group by nucleotide_id)
    select uid, coalesce(sequence_length, l) as sequence_length, coalesce(taxid, t) as taxid from rec left join dim using (nucleotide_id)""")
def jn03_left_fill(spark: SparkSession, sf: str) -> DataFrame:
    r = rec(spark, sf)
    dim = r.groupBy("nucleotide_id").agg(F.max("sequence_length").alias("sequence_length"), F.min("taxid").alias("taxid"))
    return enrich.left_fill(r, dim, ["nucleotide_id"], ["sequence_length", "taxid"]).select("uid", "sequence_length", "taxid")


@query(f"""with {_HIT}, two as (select s.id, h.* from hit h join seed_proteins s on s.id = h.qseqid union select s.id, h.* from hit h join seed_proteins s on s.id = h.sseqid),
    r as (select *, row_number() over (partition by id order by bitscore desc nulls last, qseqid, sseqid, pident, length, evalue) as k from two) select id, qseqid, sseqid, bitscore from r where k = 1""")
def jn04_or_lookup(spark: SparkSession, sf: str) -> DataFrame:
    order = [F.col("bitscore").desc_nulls_last(), *[F.col(c).asc_nulls_last() for c in ("qseqid", "sseqid", "pident", "length", "evalue")]]
    return enrich.or_lookup(hit(spark, sf), table(spark, sf, "seed_proteins"), ["qseqid", "sseqid"], "id", order, ["qseqid", "sseqid", "bitscore"])


@query(f"""with {_REC}, q as (select distinct nucleotide_id as id from rec), c as (select nucleotide_id as id, assembly_id, max(sequence_length) as length from rec where assembly_id is not null group by 1, 2),
    f as (select id, min(assembly_id) as assembly_id from c where (assembly_id like 'GCF%') = (id like 'HNZ%') group by id) select q.id, f.assembly_id, c.length from q left join f on f.id = q.id left join c on c.id = f.id and c.assembly_id = f.assembly_id""")
def jn05_assembly_by_class(spark: SparkSession, sf: str) -> DataFrame:
    r = rec(spark, sf)
    c = r.where("assembly_id is not null").groupBy(F.col("nucleotide_id").alias("id"), "assembly_id").agg(F.max("sequence_length").alias("length"))
    fits = F.col("assembly_id").startswith("GCF") == F.col("id").startswith("HNZ")
    f = c.where(fits).groupBy("id").agg(F.min(F.struct("assembly_id", "length")).alias("b")).select("id", "b.*")
    return r.select(F.col("nucleotide_id").alias("id")).distinct().join(f, "id", "left")


@query(f"""with {_REC}, m as (select uniprot_id as u, protein_id as refseq, nucleotide_id as embl from rec where uniprot_id is not null), i as (select protein_id as id from rec where protein_id is not null union select nucleotide_id from rec),
    b as (select refseq as id, u, 0 as p from m where refseq is not null union all select embl, u, 1 from m), r as (select id, u, row_number() over (partition by id order by p, u) as k from b)
    select i.id, r.u as uniprot from i left join r on r.id = i.id and k = 1""")
def jn06_disjunctive(spark: SparkSession, sf: str) -> DataFrame:
    r = rec(spark, sf)
    mapping = r.where("uniprot_id is not null").select(F.col("uniprot_id").alias("uniprot"), F.col("protein_id").alias("refseq"), F.col("nucleotide_id").alias("embl"))
    wanted = r.select(F.explode(F.array("protein_id", "nucleotide_id")).alias("id")).where("id is not null")
    return annotate.to_uniprot(wanted, spark.createDataFrame([], "id string, uniprot string"), mapping)


@query(f"with {_PROT}, {_FEAT} select distinct id from prot where id not in (select protein_id from feat where protein_id is not null)")
def jn07_missing(spark: SparkSession, sf: str) -> DataFrame:
    return enrich.missing(prot(spark, sf).select("id").distinct(), feat(spark, sf).where("protein_id is not null"), "id", "protein_id")


@query(f"""with {_REC}, l as (select uid, 'local' as origin from rec where is_query), r as (select uid, 'remote' as origin from rec)
    select * from l union all select * from r where uid not in (select uid from l)""")
def jn08_upsert(spark: SparkSession, sf: str) -> DataFrame:
    r = rec(spark, sf)
    local, remote = (df.select("uid", F.lit(o).alias("origin")) for df, o in ((r.where("is_query"), "local"), (r, "remote")))
    return enrich.upsert(remote, local, ["uid"])


@query("""select doc_id from documents where created_at is null or cast(created_at as date) > date '2024-02-01'""")
def jn09_newer(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "documents").withColumn("day", F.date_format("created_at", "yyyy-MM-dd"))
    return enrich.newer(d, "day", "2024-02-01").select("doc_id")


@query(f"""with {_REC}, i as (select distinct ipg_id, protein_id, nucleotide_id from rec where ipg_id is not null) select og_index, count(*) as n, count(distinct i.protein_id) as proteins from (select distinct og_index, ipg_id from rec) q join i on i.ipg_id = q.ipg_id group by og_index""")
def jn10_expand(spark: SparkSession, sf: str) -> DataFrame:
    r = rec(spark, sf)
    i = r.where("ipg_id is not null").select("ipg_id", "protein_id", "nucleotide_id").distinct()
    return r.select("og_index", "ipg_id").distinct().join(i, "ipg_id").groupBy("og_index").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("protein_id").alias("proteins"))


@query(f"""with {_REC}, {_FEAT}, {_WIN[2:]}, t as (select w.uid, r.nucleotide_id as seqid, start_win, end_win from win w join rec r on r.uid = w.uid)
    select t.uid, count(*) as n, min(start) as first_start, max("end") as last_end from feat f join t on t.seqid = f.seqid and f.start >= start_win and f."end" <= end_win group by t.uid""".replace("win as (select uid, start as", "win as (select uid, start as"))
def jn14_containment(spark: SparkSession, sf: str) -> DataFrame:
    w = _windows(spark, sf, 900).withColumnRenamed("nucleotide_id", "seqid").where("start_win <= end_win")
    return windows.contained(feat(spark, sf), w).groupBy("uid").agg(F.count(F.lit(1)).alias("n"), F.min("start").alias("first_start"), F.max("end").alias("last_end"))


@query(f"""with {_REC}, w as (select distinct uid as temp_seqid, nucleotide_id as seqid, start as start_win from rec where start is not null) select h.protein_id, h.s + start_win as start, h.e + start_win as "end", w.seqid
    from (select {_trim("protein_id")} as protein_id, least(start, "end") as s, greatest(start, "end") as e, cast(start * 7 % 500 as varchar) as t from domain_hits where start is not null and "end" is not null) h left join w on w.temp_seqid = h.t""")
def jn15_shift(spark: SparkSession, sf: str) -> DataFrame:
    h = table(spark, sf, "domain_hits").where("start is not null and end is not null").select(label("protein_id").alias("protein_id"), "start", "end", (F.col("start") * 7 % 500).cast("string").alias("temp_seqid"))
    w = rec(spark, sf).where("start is not null").select(F.col("uid").alias("temp_seqid"), F.col("nucleotide_id").alias("seqid"), F.col("start").alias("start_win")).distinct()
    return annotate.shift(h, w).select("protein_id", "start", "end", "seqid")


@query(f"""with d as (select {_trim("name")} as id, min(pname) as d from eggnog_prots where pname is not null group by 1) select {_trim("p.id")} as id, case when product is null or trim(product) = '' then d else product end as product from proteins p left join d on d.id = {_trim("p.id")}""")
def jn17_description_fill(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "eggnog_prots").where("pname is not null").groupBy(label("name").alias("id")).agg(F.min("pname").alias("d"))
    p = table(spark, sf, "proteins").select(label("id").alias("id"), "product")
    return p.join(d, "id", "left").select("id", F.when(F.col("product").isNull() | (F.trim("product") == ""), F.col("d")).otherwise(F.col("product")).alias("product"))


@query(f"""with {_PROT}, {_FEAT}, u as (select protein_id, min(seqid) as seqid from feat where protein_id is not null group by protein_id having count(distinct seqid) = 1) select p.id, u.seqid from (select distinct id from prot) p left join u on u.protein_id = p.id""")
def jn21_unambiguous(spark: SparkSession, sf: str) -> DataFrame:
    u = enrich.unambiguous(feat(spark, sf), "protein_id", "seqid").withColumnRenamed("protein_id", "id")
    return prot(spark, sf).select("id").distinct().join(u, "id", "left")


@query(f"""with {_HIT}, t as (select qseqid as q, sseqid as r, sum(length) as total from hit where qseqid <> sseqid group by 1, 2), x as (select q, r, case when q < r then total end as total, total as full_total from t)
    select x.q as query, x.r as ref, coalesce(x.total, y.total) as total from x left join x y on y.q = x.r and y.r = x.q""")
def jn22_reverse_total(spark: SparkSession, sf: str) -> DataFrame:
    t = hit(spark, sf).where("qseqid <> sseqid").groupBy(F.col("qseqid").alias("query"), F.col("sseqid").alias("ref")).agg(F.sum("length").alias("n"))
    t = t.select("query", "ref", F.when(F.col("query") < F.col("ref"), F.col("n")).alias("total"))
    return similarity.reverse_total(t)


@query(f"with {_HIT} select qseqid as id from hit where pident >= 60 union select sseqid from hit where pident >= 60")
def set01_union(spark: SparkSession, sf: str) -> DataFrame:
    h = hit(spark, sf).where("pident >= 60")
    return h.select(F.col("qseqid").alias("id")).union(h.select("sseqid")).distinct()


@query("""select l_orderkey, l_quantity, cast(null as double) as o_totalprice from lineitem union all select o_orderkey, null, o_totalprice from orders""")
def set03_relaxed_union(spark: SparkSession, sf: str) -> DataFrame:
    a = table(spark, sf, "lineitem").select("l_orderkey", "l_quantity")
    b = table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_totalprice")
    return enrich.relaxed_union(a, b)


@query(f"""with {_REC} select uid, assembly_id from rec union all select uid, 'GCF_' || substr(assembly_id, 5) from rec where assembly_id like 'GCA_%'""")
def set04_mirrored(spark: SparkSession, sf: str) -> DataFrame:
    r = rec(spark, sf).select("uid", "assembly_id")
    return r.unionByName(r.where(F.col("assembly_id").startswith("GCA_")).withColumn("assembly_id", F.concat(F.lit("GCF_"), F.substring("assembly_id", 5, 100))))


@query(f"""with {_FEAT} select seqid, 'tool' as source, type, least(start, "end") as start, greatest(start, "end") as "end", '.' as score, '.' as strand, '.' as phase, 'ID=' || id as attributes from feat where type <> 'CDS'""")
def set05_tool_features(spark: SparkSession, sf: str) -> DataFrame:
    f = feat(spark, sf).where("type <> 'CDS'")
    return annotate.as_features(f, "tool", F.col("type"), F.concat(F.lit("ID="), F.col("id")))


@query(f"with {_PROT}, {_HIT} select distinct id from prot except select qseqid from hit")
def set06_difference(spark: SparkSession, sf: str) -> DataFrame:
    return prot(spark, sf).select("id").distinct().subtract(hit(spark, sf).select("qseqid"))


@query("select doc_id, lang, text from documents union all select item_id, lang, text from eval_items")
def set07_shared_columns(spark: SparkSession, sf: str) -> DataFrame:
    return enrich.shared_union(table(spark, sf, "documents"), table(spark, sf, "eval_items").withColumnRenamed("item_id", "doc_id"))


_CAND = f"""with {_REC}, c as (select *, case when coalesce(assembly_level in ('Chromosome', 'Complete Genome'), false) and coalesce(assembly_id like 'GCF_%', false) then 1 when coalesce(assembly_level in ('Chromosome', 'Complete Genome'), false) then 2 when assembly_id is not null then 3 else 4 end as rank,
    coalesce(case when start is not null and "end" is not null and sequence_length is not null then least(start, sequence_length - "end") end, -1) as edge, max(is_query) over (partition by og_index) as any_query from rec where ipg_id is not null),
    free as (select uid from rec where ipg_id is null)"""


def _cand(mode: str) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return enrich.candidates(rec(spark, sf), mode).select("uid")

    run.__name__ = f"alg19_{mode}"
    return run


for _mode, _sql in {
    "best_ipg": "select uid from (select uid, row_number() over (partition by og_index order by rank, edge desc, uid) as k from c) where k = 1",
    "best_id": "select uid from (select uid, row_number() over (partition by og_index order by rank, edge desc, uid) as k from c where is_query or not any_query) where k = 1",
    "one_id": "select uid from (select uid, row_number() over (partition by og_index order by uid) as k from c) where k = 1",
    "same_id": 'select uid from (select uid, row_number() over (partition by og_index, nucleotide_id, start, "end" order by uid) as k from c where is_query or not any_query) where k = 1',
    "any_ipg": """select uid from (select uid, coalesce(assembly_id like 'GCF_%', false) as gcf, max(coalesce(assembly_id like 'GCF_%', false)) over (partition by regexp_replace(assembly_id, '^GC[AF]_', ''), start, "end") as some_gcf
        from (select *, row_number() over (partition by ipg_id, nucleotide_id, start, "end" order by uid) as k from c) where k = 1) where gcf or not some_gcf""",
}.items():
    query(f"{_CAND} {_sql} union all select uid from free")(_cand(_mode))


# ---- aggregates, windows, order -----------------------------------------------------------------------------------


@query(f"with {_PROT} select genome, count(distinct id) as n from prot where genome is not null group by genome")
def agg02_proteome_size(spark: SparkSession, sf: str) -> DataFrame:
    return similarity.proteome_sizes(prot(spark, sf))


@query(f"""with {_FEAT} select seqid, type as label, min(start) as start, max("end") as "end" from feat where type <> 'CDS' group by 1, 2""")
def agg05_spans(spark: SparkSession, sf: str) -> DataFrame:
    f = feat(spark, sf).where("type <> 'CDS'").select(F.concat("seqid", F.lit("|provirus_"), "id").alias("gene"), F.col("type").alias("label"), "start", "end")
    return annotate.mobile_spans(f)


@query(f"""with {_HIT} select least(qseqid, sseqid) as a, greatest(qseqid, sseqid) as b, round(avg(pident) + 1e-9, 4) as pident, round(avg(bitscore) + 1e-9, 4) as bitscore from hit where qseqid <> sseqid group by 1, 2""")
def agg06_unordered_mean(spark: SparkSession, sf: str) -> DataFrame:
    m = similarity.unordered_mean(hit(spark, sf), "qseqid", "sseqid", ["pident", "bitscore"])
    return m.select("a", "b", F.round(F.col("pident") + 1e-9, 4).alias("pident"), F.round(F.col("bitscore") + 1e-9, 4).alias("bitscore"))


@query(f"""with {_HIT}, r as (select *, row_number() over (partition by qseqid order by bitscore desc nulls last, sseqid) as k from hit) select qseqid, sseqid, bitscore from r where k = 1""")
def agg07_best_hit(spark: SparkSession, sf: str) -> DataFrame:
    return annotate.best_hits(hit(spark, sf)).select("qseqid", "sseqid", "bitscore")


@query("select count(*) as n, max(pident) as hi, round(stddev_pop(pident), 6) as sd, round(max(pident) + 2 * stddev_pop(pident), 6) as fill from hits")
def agg09_scalars(spark: SparkSession, sf: str) -> DataFrame:
    sd = F.stddev_pop("pident")
    return table(spark, sf, "hits").agg(F.count(F.lit(1)).alias("n"), F.max("pident").alias("hi"), F.round(sd, 6).alias("sd"), F.round(F.max("pident") + 2 * sd, 6).alias("fill"))


@query(f"""with {_FEAT} select seqid, max(case when type = 'CDS' then 1 else 0 end) as "CDS", max(case when type = 'tRNA' then 1 else 0 end) as "tRNA", max(case when type = 'ncRNA' then 1 else 0 end) as "ncRNA" from feat group by seqid""")
def agg10_pivot(spark: SparkSession, sf: str) -> DataFrame:
    return feat(spark, sf).groupBy("seqid").pivot("type", ["CDS", "tRNA", "ncRNA"]).agg(F.max(F.lit(1))).fillna(0)


_RELPOS = f"""with {_FEAT}, {_PROT}, g as (select seqid, protein_id, start, row_number() over (partition by seqid order by start, "end", id) - 1 as i, count(*) over (partition by seqid) as n from feat where protein_id is not null),
    r as (select g.seqid as id, p.family as item, g.i - g.n // 2 as rel_pos from g join (select distinct id, family from prot where family is not null) p on p.id = g.protein_id),
    w as (select id, item, sum(1.0 / (1 + abs(rel_pos))) as w from r group by 1, 2), weights as (select id, item, w / sum(w) over (partition by id) as weight from w)"""


def _weights(spark: SparkSession, sf: str) -> DataFrame:
    g = windows.gene_index(feat(spark, sf).where("protein_id is not null"), name="i").withColumn("n", F.count(F.lit(1)).over(W.partitionBy("seqid")))
    fam = prot(spark, sf).where("family is not null").select(F.col("id").alias("protein_id"), "family").distinct()
    rel = g.join(fam, "protein_id").select(F.col("seqid").alias("id"), F.col("family").alias("item"), (F.col("i") - F.floor(F.col("n") / 2)).alias("rel_pos"))
    return trees.position_weights(rel)


@query(f"{_RELPOS} select id, item, round(weight + 1e-10, 6) as weight from weights")
def agg11_position_weights(spark: SparkSession, sf: str) -> DataFrame:
    return _weights(spark, sf).select("id", "item", F.round(F.col("weight") + 1e-10, 6).alias("weight"))


@query("select id, count(*) as n from proteins group by id having count(*) > 1")
def agg13_duplicate_ids(spark: SparkSession, sf: str) -> DataFrame:
    return readers.duplicate_ids(table(spark, sf, "proteins"))


@query(f"""with {_FEAT} select id, row_number() over (partition by seqid order by start, "end", id) - 1 as gene_index from feat""")
def win02_gene_index(spark: SparkSession, sf: str) -> DataFrame:
    return windows.gene_index(feat(spark, sf)).select("id", "gene_index")


@query("""select event_id, last_value(case when event_type = 'view' then cast(event_id as varchar) end ignore nulls) over (partition by user_id order by ts, event_id rows between unbounded preceding and current row) as last_view from events""")
def win05_forward_fill(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events").withColumn("last_view", F.when(F.col("event_type") == "view", F.col("event_id").cast("string")))
    return windows.forward_fill(e, ["user_id"], ["ts", "event_id"], ["last_view"]).select("event_id", "last_view")


@query(f"""with {_FEAT}, s as (select id, min(start) over w as start_win, max("end") over w as end_win, count(*) over w as n_features from feat window w as (partition by seqid order by start, "end", id rows between 3 preceding and 3 following))
    select id as uid, start_win, end_win, n_features from s""")
def win06_rows_window(spark: SparkSession, sf: str) -> DataFrame:
    f = feat(spark, sf)
    return windows.windows_by_rows(f, f.select(F.col("id").alias("uid"), "seqid", F.col("id").alias("target_id")), 3).select("uid", "start_win", "end_win", "n_features")


_DOM = f"""dom as (select distinct {_trim("protein_id")} as protein_id, database, split_part({_trim("domain_id")}, '.', 1) as domain_id, least(start, "end") as s, greatest(start, "end") as e, bit_score, alignment_length, e_value from domain_hits where protein_id is not null and start is not null and "end" is not null)"""


def dom(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "domain_hits").where("protein_id is not null and start is not null and end is not null")
    return d.select(label("protein_id").alias("protein_id"), "database", F.substring_index(label("domain_id"), ".", 1).alias("domain_id"), F.least("start", "end").alias("start"), F.greatest("start", "end").alias("end"), "bit_score", "alignment_length", "e_value").distinct()


@query(f"""with {_DOM}, r as (select *, max(e) over (partition by protein_id, database, domain_id order by s, e, bit_score, alignment_length rows between unbounded preceding and 1 preceding) as reach from dom),
    k as (select *, sum(case when reach is null or s - reach > 10 then 1 else 0 end) over (partition by protein_id, database, domain_id order by s, e, bit_score, alignment_length rows unbounded preceding) as k from r)
    select protein_id, database, domain_id, min(s) as start, max(e) as "end", sum(alignment_length) as alignment_length, round(sum(bit_score * alignment_length) / sum(alignment_length) + 1e-9, 4) as bit_score from k group by protein_id, database, domain_id, k""")
def win08_merge_domains(spark: SparkSession, sf: str) -> DataFrame:
    return greedy.merge_domains(dom(spark, sf)).select("protein_id", "database", "domain_id", "start", "end", "alignment_length", F.round(F.col("bit_score") + 1e-9, 4).alias("bit_score"))


@query(f"""with {_HIT}, r as (select distinct qseqid, sseqid, pident from hit where pident is not null) select row_number() over (order by pident desc, qseqid, sseqid) as k, qseqid, sseqid from r""")
def win10_global_rank(spark: SparkSession, sf: str) -> DataFrame:
    h = hit(spark, sf).where("pident is not null").select("qseqid", "sseqid", "pident").distinct()
    return stats.global_rank(h, [F.col("pident").desc(), F.col("qseqid"), F.col("sseqid")], "k").select("k", "qseqid", "sseqid")


@query("select l_orderkey, l_linenumber, l_partkey, case when l_quantity <= 10 then 10 when l_quantity <= 25 then 25 when l_quantity <= 40 then 40 end as allowed from lineitem")
def srt04_nearest_allowed(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", text.nearest_allowed(F.col("l_quantity"), [40, 10, 25]).alias("allowed"))


@query(f"""with {_DOM} select protein_id, domain_id, s as start, row_number() over (partition by protein_id order by bit_score * alignment_length desc, domain_id, s, e, e_value, database) as place from dom""")
def srt02_ordered_hits(spark: SparkSession, sf: str) -> DataFrame:
    best_first = [(F.col("bit_score") * F.col("alignment_length")).desc(), *[F.col(c).asc_nulls_last() for c in ("domain_id", "start", "end", "e_value", "database")]]
    return dom(spark, sf).select("protein_id", "domain_id", "start", F.row_number().over(W.partitionBy("protein_id").orderBy(*best_first)).alias("place"))


# ---- scalar functions ---------------------------------------------------------------------------------------------


@query(r"""select distinct id, nullif(regexp_extract(attributes, '(?:^|;)\s*ID=([^;]+)', 1), '') as own_id, split_part(attributes, ';', 1) as first_part, length(attributes) as n, contains(attributes, 'product') as named,
    id || '_' || score as joined, regexp_replace(id, '[^A-Za-z0-9._-]', '_', 'g') as safe from gff""")
def str01_text_functions(spark: SparkSession, sf: str) -> DataFrame:
    a = F.col("attributes")
    return table(spark, sf, "gff").select("id", text.attribute(a, "ID").alias("own_id"), text.nth(a, ";", 1).alias("first_part"), F.length(a).alias("n"), a.contains("product").alias("named"), text.strict_concat(F.col("id"), F.lit("_"), F.col("score")).alias("joined"), text.file_safe(F.col("id")).alias("safe")).distinct()


@query("""select distinct id, length(sequence) as n, length(sequence) + (length(sequence) - 1) // 80 as wrapped_length, reverse(translate(sequence, 'ACGTU', 'TGCAA')) as turned from proteins""")
def str08_sequence_functions(spark: SparkSession, sf: str) -> DataFrame:
    s = F.col("sequence")
    plain = F.reverse(F.translate(s, "ACGTU", "TGCAA"))
    return table(spark, sf, "proteins").select("id", F.length(s).alias("n"), F.length(text.wrapped(s)).alias("wrapped_length"), plain.alias("turned")).distinct()


@query("select distinct domain_id, printf('%.2e', e_value) as shown from domain_hits")
def str09_scientific(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "domain_hits").select("domain_id", text.scientific(F.col("e_value")).alias("shown")).distinct()


@query("select id, concat_ws(';', 'kegg=' || kegg_ko, 'name=' || pname) as shown from eggnog_prots")
def str10_map_text(spark: SparkSession, sf: str) -> DataFrame:
    m = F.create_map(F.lit("name"), F.col("pname"), F.lit("kegg"), F.col("kegg_ko"))
    return table(spark, sf, "eggnog_prots").select("id", text.map_text(m).alias("shown"))


@query(f"""with {_DOM} select a.protein_id, a.domain_id as da, b.domain_id as db, a.s as sa, b.s as sb, greatest(0, least(a.e, b.e) - greatest(a.s, b.s) + 1) as shared, round(100.0 * greatest(0, least(a.e, b.e) - greatest(a.s, b.s) + 1) / (b.e - b.s + 1) + 1e-9, 4) as pct
    from (select distinct protein_id, domain_id, s, e from dom) a join (select distinct protein_id, domain_id, s, e from dom) b on a.protein_id = b.protein_id and a.domain_id < b.domain_id""")
def mth02_overlap(spark: SparkSession, sf: str) -> DataFrame:
    d = dom(spark, sf).select("protein_id", "domain_id", "start", "end").distinct()
    a, b = (d.select("protein_id", F.col("domain_id").alias(f"d{x}"), F.col("start").alias(f"s{x}"), F.col("end").alias(f"e{x}")) for x in "ab")
    shared = text.overlap(F.col("sa"), F.col("ea"), F.col("sb"), F.col("eb"))
    return a.join(b, "protein_id").where("da < db").select("protein_id", "da", "db", "sa", "sb", shared.alias("shared"), F.round(100 * shared / (F.col("eb") - F.col("sb") + 1) + 1e-9, 4).alias("pct"))


@query("select event_id, cast(json_extract(props, '$.k') as bigint) as k from events")
def jsn02_json_lines(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select("event_id", F.from_json("props", "k bigint")["k"].alias("k"))


@query("select event_id, cast(json_extract(props, '$.k') as varchar) as found from events")
def jsn01_json_search(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select("event_id", links.json_search("k")("props").alias("found"))


@query("select distinct l_returnflag, case when l_returnflag = 'A' then 'accepted' when l_returnflag = 'R' then 'returned' else l_returnflag end as meaning from lineitem")
def cnd02_dict_lookup(spark: SparkSession, sf: str) -> DataFrame:
    m = F.create_map(F.lit("A"), F.lit("accepted"), F.lit("R"), F.lit("returned"))
    return table(spark, sf, "lineitem").select("l_returnflag").distinct().select("l_returnflag", F.coalesce(m[F.col("l_returnflag")], F.col("l_returnflag")).alias("meaning"))


@query(f"""with e as (select distinct {_trim("name")} as name, unnest(string_split(coalesce(ogs, ''), ',')) as og from eggnog_prots) select name, trim(og) as og, count(*) as n from e where trim(og) <> '' group by 1, 2""")
def arr02_explode_list(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "eggnog_prots").select(label("name").alias("name"), "ogs").distinct()
    return annotate.explode_list(e, "ogs", ",", "og").groupBy("name", "og").agg(F.count(F.lit(1)).alias("n"))


SQL["arr02_explode_list"] = f"""with d as (select distinct {_trim("name")} as name, ogs from eggnog_prots), e as (select name, unnest(string_split(coalesce(ogs, ''), ',')) as og from d) select name, trim(og) as og, count(*) as n from e where trim(og) <> '' group by 1, 2"""


# ---- composite operators ------------------------------------------------------------------------------------------


@query(f"""with {_REC}{_WIN} select uid, start_win, end_win from win""")
def alg01_win_nts(spark: SparkSession, sf: str) -> DataFrame:
    return _windows(spark, sf, 900).select("uid", "start_win", "end_win")


@query(f"""with {_FEAT}, c as (select seqid, count(distinct seqid) as n from feat group by seqid), one as (select protein_id, count(distinct seqid) as n, min(seqid) as seqid from feat where protein_id is not null group by protein_id)
    select p.id as uid, case when o.n = 1 then o.seqid end as seqid, case when o.n = 1 then null when o.n > 1 then 'protein isn''t on a unique contig' else 'protein not found' end as error from (select distinct {_trim("id")} as id from proteins) p left join one o on o.protein_id = p.id""")
def alg03_resolve_contig(spark: SparkSession, sf: str) -> DataFrame:
    f = feat(spark, sf).withColumn("source", F.lit("all"))
    wanted = prot(spark, sf).select(F.col("id").alias("uid"), F.lit("all").alias("source"), F.lit(None).cast("string").alias("seqid"), F.col("id").alias("protein_id")).distinct()
    return windows.resolve_contigs(f, wanted)


_CODING = f"""with {_FEAT}, c as (select seqid, start as s, "end" as e from feat where type = 'CDS' and start <= "end"), len as (select seqid, max("end") + 50 as length from feat group by seqid),
    r as (select *, max(e) over (partition by seqid order by s, e rows between unbounded preceding and 1 preceding) as reach from c),
    k as (select *, sum(case when reach is null or s > reach + 1 then 1 else 0 end) over (partition by seqid order by s, e rows unbounded preceding) as k from r),
    island as (select seqid, min(s) as s, max(e) as e from k group by seqid, k)"""


def _coding(spark: SparkSession, sf: str) -> DataFrame:
    return feat(spark, sf).where("type = 'CDS' and start <= end").select("seqid", F.col("start").alias("s"), F.col("end").alias("e"))


@query(f"{_CODING} select seqid, s, e from island")
def alg05_islands(spark: SparkSession, sf: str) -> DataFrame:
    return coverage(_coding(spark, sf), ["seqid"], "s", "e").where("kind = 'period'").select("seqid", F.col("first_pos").alias("s"), F.col("last_pos").alias("e"))


@query(f"""{_CODING}, b as (select seqid, coalesce(lag(e) over (partition by seqid order by s), 0) + 1 as s, s - 1 as e from island), t as (select i.seqid, max(e) + 1 as s, max(length) as e from island i join len using (seqid) group by i.seqid)
    select * from b where s <= e union all select * from t where s <= e union all select seqid, 1, length from len where seqid not in (select seqid from island)""")
def alg06_gaps(spark: SparkSession, sf: str) -> DataFrame:
    lengths = feat(spark, sf).groupBy("seqid").agg((F.max("end") + 50).alias("length"))
    return windows.gaps_within(_coding(spark, sf), ["seqid"], lengths)


@query(f"{_CODING} select seqid, sum(e - s + 1) as covered from island group by seqid")
def alg08_covered_length(spark: SparkSession, sf: str) -> DataFrame:
    return windows.covered_length(_coding(spark, sf).select("seqid", (F.col("s") - 1).alias("s"), "e"), ["seqid"], "s", "e")


def _chosen(rows: str, key: str, order: str, slack: int) -> str:
    """SQL of a greedy choice, a row of each key at a time: o is rows in order, st says which are taken."""
    return f"""o as (select *, row_number() over (partition by {key} order by {order}) as k from {rows}),
    st(key, k, kept, got) as (select distinct hash({key}), cast(0 as bigint), cast([] as struct(s bigint, e bigint)[]), false from {rows}
      union all select st.key, o.k, case when len(list_filter(kept, lambda x: least(x.e, o.e) - greatest(x.s, o.s) + 1 > {slack})) = 0 then list_append(kept, {{'s': o.s, 'e': o.e}}) else kept end,
        len(list_filter(kept, lambda x: least(x.e, o.e) - greatest(x.s, o.s) + 1 > {slack})) = 0
      from st join o on hash({", ".join("o." + k for k in key.split(", "))}) = st.key and o.k = st.k + 1),
    taken as (select o.* from o join st on hash({", ".join("o." + k for k in key.split(", "))}) = st.key and o.k = st.k where st.got)"""


@query(f"""with recursive {_DOM}, {_chosen("dom", "protein_id", "bit_score desc nulls last, alignment_length desc nulls last, s, e, domain_id, e_value nulls last, database", 3)} select protein_id, database, domain_id, s as start, e as "end", bit_score from taken""")
def alg07_greedy(spark: SparkSession, sf: str) -> DataFrame:
    best = [("bit_score", False), ("alignment_length", False), ("start", True), ("end", True), ("domain_id", True), ("e_value", True), ("database", True)]
    return greedy.greedy(dom(spark, sf), ["protein_id"], best, "start", "end", 3).select("protein_id", "database", "domain_id", "start", "end", "bit_score")


@query(f"""with recursive {_DOM}, h as (select protein_id as query, domain_id as ref, least(bit_score, 100.0) as pident, alignment_length as length, bit_score as bitscore, s, e from dom),
    {_chosen("h", "query, ref", "bitscore desc nulls last, length desc nulls last, pident desc nulls last, s, e", 0)}, len as (select {_trim("id")} as query, max(length(sequence)) as n from proteins group by 1)
    select query, ref, round_even(100 * sum(round_even(pident / 100 * length, 0)) / sum(length), 3) as ani, round_even(100.0 * sum(e - s + 1) / max(n), 3) as align_fraction from taken join len using (query) group by query, ref""")
def alg09_ani(spark: SparkSession, sf: str) -> DataFrame:
    d = dom(spark, sf)
    hsps = d.select(F.col("protein_id").alias("query"), F.col("domain_id").alias("ref"), F.least(F.col("bit_score"), F.lit(100.0)).alias("pident"), "alignment_length", F.col("bit_score").alias("bitscore"), F.col("start").alias("q_start"), F.col("end").alias("q_end")).withColumnRenamed("alignment_length", "length")
    lengths = table(spark, sf, "proteins").groupBy(label("id").alias("id")).agg(F.max(F.length("sequence")).alias("length"))
    return greedy.ani_from_hsps(hsps, lengths)


@query(f"""with {_HIT} select distinct least(qseqid, sseqid) as query, greatest(qseqid, sseqid) as ref, case when qseqid > sseqid then length else 0 end as swapped_length from hit where length is not null""")
def alg12_canonical_pairs(spark: SparkSession, sf: str) -> DataFrame:
    h = hit(spark, sf).where("length is not null")
    return h.select(F.least("qseqid", "sseqid").alias("query"), F.greatest("qseqid", "sseqid").alias("ref"), F.when(F.col("qseqid") > F.col("sseqid"), F.col("length")).otherwise(0).alias("swapped_length")).distinct()


@query(f"""with recursive {_DOM}, r as (select *, max(e) over (partition by protein_id, database, domain_id order by s, e, bit_score, alignment_length rows between unbounded preceding and 1 preceding) as reach from dom),
    i as (select *, sum(case when reach is null or s - reach > 10 then 1 else 0 end) over (partition by protein_id, database, domain_id order by s, e, bit_score, alignment_length rows unbounded preceding) as island from r),
    merged as (select protein_id, database, domain_id, min(s) as s, max(e) as e, sum(alignment_length) as al, round(sum(bit_score * alignment_length) + 1e-9, 6) as weight, sum(bit_score * alignment_length) / sum(alignment_length) as score from i group by protein_id, database, domain_id, island),
    {_chosen("merged", "protein_id, database", "weight desc nulls last, domain_id, s", 5)} select protein_id, database, domain_id, s as start, e as "end", al as alignment_length, round(score + 1e-9, 4) as bit_score from taken""")
def alg13_deduplicate_domains(spark: SparkSession, sf: str) -> DataFrame:
    return greedy.deduplicate_domains(dom(spark, sf)).select("protein_id", "database", "domain_id", "start", "end", "alignment_length", F.round(F.col("bit_score") + 1e-9, 4).alias("bit_score"))


_RBH = f"""with {_HIT}, {_GENOME}, b as (select qseqid, sseqid, max(pident) as pident from hit where qseqid <> sseqid and pident is not null group by 1, 2),
    ann as (select b.*, q.genome as q_genome, s.genome as s_genome from b join genomes q on q.id = qseqid join genomes s on s.id = sseqid where q.genome <> s.genome),
    top as (select * from (select *, row_number() over (partition by qseqid, s_genome order by pident desc, sseqid) as k from ann) where k = 1),
    rbh as (select t.* from top t join top u on u.qseqid = t.sseqid and u.sseqid = t.qseqid), size as (select genome, count(distinct id) as n from genomes group by genome)"""


def _rbh(spark: SparkSession, sf: str) -> DataFrame:
    return similarity.reciprocal_best(similarity.annotate_hits(hit(spark, sf), genomes(spark, sf)))


@query(f"{_RBH} select qseqid, sseqid, pident, q_genome, s_genome from rbh")
def alg14_rbh(spark: SparkSession, sf: str) -> DataFrame:
    return _rbh(spark, sf).select("qseqid", "sseqid", "pident", "q_genome", "s_genome")


@query(f"""{_RBH} select q_genome, s_genome, round(least(1.0, sum(pident / 100) / min(least(a.n, b.n))) + 1e-9, 6) as wgrr, round(avg(pident) + 1e-9, 6) as aai, count(*) as n_rbh, round(count(*) * 1.0 / min(least(a.n, b.n)) + 1e-9, 6) as rbh_frac_min
    from rbh join size a on a.genome = q_genome join size b on b.genome = s_genome group by 1, 2""")
def alg15_wgrr_aai(spark: SparkSession, sf: str) -> DataFrame:
    s = similarity.repertoire_similarity(_rbh(spark, sf), similarity.proteome_sizes(genomes(spark, sf)))
    return s.select("q_genome", "s_genome", F.round(F.col("wgrr") + 1e-9, 6).alias("wgrr"), F.round(F.col("aai") + 1e-9, 6).alias("aai"), "n_rbh", F.round(F.col("rbh_frac_min") + 1e-9, 6).alias("rbh_frac_min"))


_SHARE = f"""with {_PROT}, once as (select distinct genome, family from prot where genome is not null and family is not null), df as (select family, count(*) as df from once group by family),
    kept_fam as (select family from df where df <= (select (count(distinct genome) + 4) // 5 from once)), kept as (select * from once where family in (select family from kept_fam)), k as (select genome, count(*) as k from kept group by genome),
    pairs as (select x.genome as a, y.genome as b, count(*) as k from kept x join kept y on x.family = y.family and x.genome < y.genome group by 1, 2 having count(*) >= 2),
    full_pairs as (select pairs.*, ka.k as k_a, kb.k as k_b, (select count(*) from kept_fam) as m from pairs join k ka on ka.genome = a join k kb on kb.genome = b)"""


def _members(spark: SparkSession, sf: str) -> DataFrame:
    return prot(spark, sf).select("genome", "family")


@query(f"{_SHARE} select a, b, k, k_a, k_b, m from full_pairs")
def alg17_shared_families(spark: SparkSession, sf: str) -> DataFrame:
    return similarity.shared_families(_members(spark, sf), method=None)


@query(f"""{_SHARE}, x as (select *, unnest(generate_series(k, least(k_a, k_b))) as i from full_pairs), lp as (select a, b, k, k_a, k_b, m, least(1.0, greatest(1e-300, sum(exp(lgamma(k_a + 1) - lgamma(i + 1) - lgamma(k_a - i + 1)
    + lgamma(m - k_a + 1) - lgamma(k_b - i + 1) - lgamma(m - k_a - k_b + i + 1) - lgamma(m + 1) + lgamma(k_b + 1) + lgamma(m - k_b + 1))))) as p from x group by all), c as (select count(*) as n from lp)
    select a, b, round(0 - log10(p), 5) as log_p, round(0 - log10(greatest(1e-300, least(1.0, p * n))), 5) as score from lp, c""")
def mth03_hypergeometric(spark: SparkSession, sf: str) -> DataFrame:
    s = similarity.shared_families(_members(spark, sf), method="BONFERRONI")
    return s.select("a", "b", F.round(0 - F.log10("pval"), 5).alias("log_p"), F.round("score", 5).alias("score"))


@query(f"""with {_HIT}, h as (select distinct qseqid, sseqid, evalue, bitscore, pident from hit), t as (select *, row_number() over (order by evalue nulls last, qseqid, sseqid, coalesce(bitscore, -1), coalesce(pident, -1)) as r, count(evalue) over () as m from h)
    select qseqid, sseqid, case when evalue is not null then round(0 - log10(greatest(1e-300, least(1.0, evalue * m / r))), 5) end as score from t""")
def mth04_bh(spark: SparkSession, sf: str) -> DataFrame:
    h = hit(spark, sf).select("qseqid", "sseqid", "evalue", "bitscore", "pident").distinct().withColumn("bs", F.coalesce("bitscore", F.lit(-1.0))).withColumn("pi", F.coalesce("pident", F.lit(-1.0)))
    adj = stats.adjusted(h, "evalue", ["qseqid", "sseqid", "bs", "pi"])
    return adj.select("qseqid", "sseqid", F.round(stats.score(F.col("p_adj")), 5).alias("score"))


@query(f"""with {_HIT}, h as (select distinct qseqid, sseqid, evalue, bitscore, pident from hit), t as (select *, row_number() over (order by evalue nulls last, qseqid, sseqid, coalesce(bitscore, -1), coalesce(pident, -1)) as r, count(evalue) over () as m from h),
    p as (select *, min(least(1.0, evalue * m / r)) over (order by r desc rows unbounded preceding) as adj from t where evalue is not null)
    select qseqid, sseqid, round(0 - log10(greatest(1e-300, adj)), 5) as score from p union all select qseqid, sseqid, null from t where evalue is null""")
def mth04_bh_monotone(spark: SparkSession, sf: str) -> DataFrame:
    h = hit(spark, sf).select("qseqid", "sseqid", "evalue", "bitscore", "pident").distinct().withColumn("bs", F.coalesce("bitscore", F.lit(-1.0))).withColumn("pi", F.coalesce("pident", F.lit(-1.0)))
    adj = stats.adjusted(h, "evalue", ["qseqid", "sseqid", "bs", "pi"], "BH_MONOTONE")
    return adj.select("qseqid", "sseqid", F.round(stats.score(F.col("p_adj")), 5).alias("score"))


@query(f"""with {_FEAT}, {_REC}, g as (select seqid, coalesce(protein_id, id) as id, start, "end", row_number() over (partition by seqid order by start, "end", id) - 1 as gi from feat),
    t as (select uid, nucleotide_id as seqid, start as st, "end" as et from rec where start is not null and "end" is not null),
    span as (select uid, min(gi) as lo, max(gi) as hi from g join t using (seqid) where g.start >= st - 500 and g."end" <= et + 500 group by uid)
    select distinct t.uid, g.id from g join t using (seqid) join span using (uid) where gi >= lo - 2 and gi <= hi + 2""")
def alg18_window_genes(spark: SparkSession, sf: str) -> DataFrame:
    t = rec(spark, sf).where("start is not null and end is not null").select("uid", F.col("nucleotide_id").alias("seqid"), (F.col("start") - 500).alias("start_target"), (F.col("end") + 500).alias("end_target"))
    g = windows.gene_index(feat(spark, sf)).select("seqid", F.coalesce("protein_id", "id").alias("id"), "start", "end", "gene_index")
    genes = g.join(t.select("uid", "seqid"), "seqid")
    return similarity.subset_ids("window", genes, t.drop("seqid"), 2, "win_genes")


@query(f"""with recursive {_HIT}, h as (select qseqid as a, sseqid as b from hit where qseqid <> sseqid and evalue <= 1e-5 and pident >= 30), edge as (select a, b from h union select b, a from h),
    reach(id, rep) as (select a, least(a, min(b)) from edge group by a union select e.b, r.rep from reach r join edge e on e.a = r.id where r.rep < e.b),
    rep as (select id, min(rep) as rep from reach group by id), size as (select rep, count(*) as n from rep group by rep having count(*) >= 2), fam as (select rep, row_number() over (order by n desc, rep) as family from size)
    select id, rep.rep, family from rep left join fam on fam.rep = rep.rep""")
def alg22_families(spark: SparkSession, sf: str) -> DataFrame:
    e = families.filtered_hits(hit(spark, sf))
    return families.numbered_families(cut(families.components(e, "qseqid", "sseqid"), "members"))


_LINEAGE = "lineage as (select c_custkey as cust, n_nationkey as nation, n_regionkey as region from customer join nation on n_nationkey = c_nationkey)"


def _tree_nodes(spark: SparkSession, sf: str) -> DataFrame:
    """A taxonomy of one root, regions, nations and customers, each in its own range of ids."""
    big = F.lit(1_000_000_000)
    root = spark.range(1).select(F.lit(1).cast("bigint").alias("taxid"), F.lit(None).cast("bigint").alias("parent"))
    regions = table(spark, sf, "region").select((F.col("r_regionkey") + 10).cast("bigint").alias("taxid"), F.lit(1).cast("bigint").alias("parent"))
    nations = table(spark, sf, "nation").select((F.col("n_nationkey") + 100).cast("bigint").alias("taxid"), (F.col("n_regionkey") + 10).cast("bigint").alias("parent"))
    leaves = table(spark, sf, "customer").select((F.col("c_custkey") + big).alias("taxid"), (F.col("c_nationkey") + 100).cast("bigint").alias("parent"))
    return root.unionByName(regions).unionByName(nations).unionByName(leaves)


@query(f"with {_LINEAGE} select cust, 1 as l1, region + 10 as l2, nation + 100 as l3, cust + 1000000000 as l4 from lineage")
def arr03_lineages(spark: SparkSession, sf: str) -> DataFrame:
    lin = taxonomy.lineages(_tree_nodes(spark, sf)).where("taxid >= 1000000000")
    return lin.select((F.col("taxid") - 1_000_000_000).alias("cust"), *[F.col("lineage")[i].alias(f"l{i + 1}") for i in range(4)])


@query(f"""with {_LINEAGE} select a.cust, b.cust as other, cast(case when a.cust = b.cust then 0 when a.nation = b.nation then 2 when a.region = b.region then 4 else 6 end as double) as dist from lineage a, lineage b""")
def alg24_lca_distance(spark: SparkSession, sf: str) -> DataFrame:
    lin = taxonomy.lineages(_tree_nodes(spark, sf)).where("taxid >= 1000000000").select((F.col("taxid") - 1_000_000_000).alias("id"), "lineage")
    return taxonomy.leaf_distances(lin, F.lit(True))


@query(f"""with {_REC}, ranks as (select n_nationkey as taxid, n_name as name, r_name as top from nation join region on r_regionkey = n_regionkey) select uid as unique_id, cast(coalesce(taxid % 30, 32644) as varchar) as taxid, coalesce(top, 'unclassified') as superkingdom, coalesce(name, 'unclassified') as species, 'unclassified' as genus
    from rec left join ranks r on r.taxid = coalesce(rec.taxid % 30, 32644) where failed is null""".replace("coalesce(taxid % 30", "coalesce(rec.taxid % 30"))
def alg23_leaf_metadata(spark: SparkSession, sf: str) -> DataFrame:
    n = table(spark, sf, "nation").join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    ranks = n.select(F.col("n_nationkey").cast("bigint").alias("taxid"), F.lit("species").alias("rank"), F.col("n_name").alias("name")).unionByName(n.select(F.col("n_nationkey").cast("bigint").alias("taxid"), F.lit("domain").alias("rank"), F.col("r_name").alias("name")))
    r = rec(spark, sf).select(F.col("uid").alias("unique_id"), (F.col("taxid") % 30).alias("taxid"), "failed")
    return taxonomy.leaf_metadata(r, ranks).select("unique_id", "taxid", "superkingdom", "species", "genus")


_NATION = "m as (select distinct s_nationkey as id, l_partkey as item from lineitem join supplier on s_suppkey = l_suppkey)"


def _nation_parts(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").join(table(spark, sf, "supplier"), F.col("l_suppkey") == F.col("s_suppkey")).select(F.col("s_nationkey").alias("id"), F.col("l_partkey").alias("item")).distinct()


@query(f"with {_NATION}, n as (select id, count(*) as n from m group by id), k as (select x.id as a, y.id as b, count(*) as k from m x join m y on x.item = y.item and x.id < y.id group by 1, 2) select a, b, round(1 - k * 1.0 / (p.n + q.n - k) + 1e-10, 6) as dist from k join n p on p.id = a join n q on q.id = b")
def mth05_jaccard(spark: SparkSession, sf: str) -> DataFrame:
    return trees.presence_jaccard(_nation_parts(spark, sf)).select("a", "b", F.round(F.col("dist") + 1e-10, 6).alias("dist"))


@query(f"""{_RELPOS}, norm as (select id, sqrt(sum(weight * weight)) as norm from weights group by id), dot as (select x.id as a, y.id as b, sum(x.weight * y.weight) as dot from weights x join weights y on x.item = y.item and x.id < y.id group by 1, 2)
    select a, b, round(1 - dot / (p.norm * q.norm) + 1e-10, 6) as dist from dot join norm p on p.id = a join norm q on q.id = b""")
def mth05_cosine(spark: SparkSession, sf: str) -> DataFrame:
    return trees.cosine_distance(_weights(spark, sf), 6)


def _seed_pairs(spark: SparkSession, sf: str) -> DataFrame:
    seeds = table(spark, sf, "seed_proteins").select("id")
    via = hit(spark, sf).where("pident is not null")
    h = via.join(seeds.withColumnRenamed("id", "sseqid"), "sseqid").select("qseqid", F.col("sseqid").alias("seed"), "pident").unionByName(via.join(seeds.withColumnRenamed("id", "qseqid"), "qseqid").select(F.col("sseqid").alias("qseqid"), F.col("qseqid").alias("seed"), "pident"))
    best = h.groupBy("qseqid", "seed").agg(F.max("pident").alias("pident"))
    return best.select("qseqid", F.col("seed").alias("a"), F.col("pident").alias("pa")).join(best.select("qseqid", F.col("seed").alias("b"), F.col("pident").alias("pb")), "qseqid").where("a < b").groupBy("a", "b").agg(F.max(F.least("pa", "pb")).alias("identity"))


_SEEDS = f"""{_HIT}, h as (select qseqid, sseqid as seed, pident from hit where sseqid in (select id from seed_proteins) and pident is not null union all select sseqid, qseqid, pident from hit where qseqid in (select id from seed_proteins) and pident is not null),
    best as (select qseqid, seed, max(pident) as p from h group by 1, 2), pairs as (select x.seed as a, y.seed as b, 100 - max(least(x.p, y.p)) as dist from best x join best y on x.qseqid = y.qseqid and x.seed < y.seed group by 1, 2),
    stat as (select max(dist) + 2 * stddev_pop(dist) as fill from pairs)"""


@query(f"with {_SEEDS} select s.id as a, t.id as b, round(coalesce(dist, fill) + 1e-10, 6) as dist from seed_proteins s join seed_proteins t on s.id < t.id left join pairs on a = s.id and b = t.id, stat")
def alg28_fill_distances(spark: SparkSession, sf: str) -> DataFrame:
    d = cut(trees.identity_distance(_seed_pairs(spark, sf)), "distances")
    return trees.fill_distances(d, table(spark, sf, "seed_proteins")).select("a", "b", F.round(F.col("dist") + 1e-10, 6).alias("dist"))


def _seed_tree(spark: SparkSession, sf: str) -> tuple[list[str], DataFrame]:
    d = cut(trees.identity_distance(_seed_pairs(spark, sf)), "distances")
    seeds = table(spark, sf, "seed_proteins")
    return sorted(r[0] for r in seeds.select("id").collect()), cut(trees.fill_distances(d, seeds), "filled")


def _nation_lineages(spark: SparkSession, sf: str) -> DataFrame:
    n = table(spark, sf, "nation")
    return n.select(F.col("n_name").alias("id"), F.array(F.lit(1).cast("bigint"), (F.col("n_regionkey") + 10).cast("bigint"), (F.col("n_nationkey") + 100).cast("bigint")).alias("lineage"), (F.col("n_nationkey") + 100).cast("bigint").alias("taxid"))


_NATION_PAIRS = "p as (select x.n_name as a, y.n_name as b, case when x.n_regionkey = y.n_regionkey then cast(2 as double) else cast(4 as double) end as d from nation x join nation y on x.n_name < y.n_name)"


@query(f"with {_NATION_PAIRS} select a, b, d as height from p")
def alg25_taxonomy_tree(spark: SparkSession, sf: str) -> DataFrame:
    """The height at which two leaves of the taxonomy tree meet."""
    lin = _nation_lineages(spark, sf)
    newick = taxonomy.taxonomy_tree(lin.select("id", "taxid"), lin.select("taxid", "lineage"))
    return spark.createDataFrame(trees.meetings(newick), "a string, b string, height double, path double").select("a", "b", F.round("height", 5).alias("height"))


@query(f"with {_NATION_PAIRS} select method, a, b, d as path from p, (select unnest(['nj', 'bionj', 'unj', 'upgma']) as method)")
def alg29_trees(spark: SparkSession, sf: str) -> DataFrame:
    """The way between two leaves in the trees of all methods, from distances that a tree can have: it is the distance."""
    lin = cut(_nation_lineages(spark, sf), "leaves")
    a, b = (lin.select(F.col("id").alias(x), F.col("lineage").alias(f"l{x}")) for x in "ab")
    dist = a.join(b, F.col("a") < F.col("b")).select("a", "b", taxonomy.lca_distance(F.col("la"), F.col("lb")).alias("dist"))
    leaves = sorted(r[0] for r in lin.select("id").collect())
    m = trees.matrix(leaves, dist)
    found = [(k, *row) for k in trees.METHODS for row in trees.meetings(trees.tree(k, leaves, m))]
    return spark.createDataFrame(found, "method string, a string, b string, height double, path double").select("method", "a", "b", F.round("path", 5).alias("path"))


def _least_barrier(pairs: str, rounds: int = 5) -> str:
    """SQL of the single linkage height of all pairs (a, b, dist): the least barrier between them."""
    first = f"m0 as (select a, b, dist from {pairs} union all select b, a, dist from {pairs})"
    step = "m{1} as (select x.a, y.b, min(greatest(x.dist, y.dist)) as dist from (select * from m{0} union all select distinct a, a, 0.0 from m{0}) x join (select * from m{0} union all select distinct a, a, 0.0 from m{0}) y on x.b = y.a where x.a <> y.b group by 1, 2)"
    return ", ".join([first, *[step.format(i, i + 1) for i in range(rounds)]]) + f" select a, b, round(dist + 1e-10, 5) as height from m{rounds} where a < b"


@query(f"with {_NATION}, n as (select id, count(*) as n from m group by id), k as (select x.id as a, y.id as b, count(*) as k from m x join m y on x.item = y.item and x.id < y.id group by 1, 2), d as (select p.id as a, q.id as b, coalesce(1 - k * 1.0 / (p.n + q.n - k), 1.0) as dist from n p join n q on p.id < q.id left join k on a = p.id and b = q.id), {_least_barrier('d')}")
def alg26_heights(spark: SparkSession, sf: str) -> DataFrame:
    """The height at which two nations meet in the tree of the parts they supply."""
    m = _nation_parts(spark, sf).select(F.col("id").cast("string").alias("id"), "item")
    return _heights(spark, trees.jaccard_forest(m))


def _heights(spark: SparkSession, edges: list[tuple[str, str, float]]) -> DataFrame:
    pairs = [(min(int(a), int(b)), max(int(a), int(b)), h) for a, b, h in trees.barriers(edges)]
    return spark.createDataFrame(pairs, "a int, b int, height double").select("a", "b", F.round(F.col("height") + 1e-10, 5).alias("height"))


@query(f"""with r as (select s_nationkey as id, l_partkey as item, l_linenumber - 4 as rel_pos from lineitem join supplier on s_suppkey = l_suppkey), w as (select id, item, sum(1.0 / (1 + abs(rel_pos))) as w from r group by 1, 2), weights as (select id, item, w / sum(w) over (partition by id) as weight from w),
    norm as (select id, sqrt(sum(weight * weight)) as norm from weights group by id), dot as (select x.id as a, y.id as b, sum(x.weight * y.weight) as dot from weights x join weights y on x.item = y.item and x.id < y.id group by 1, 2),
    d as (select p.id as a, q.id as b, coalesce(1 - dot / (p.norm * q.norm), 1.0) as dist from norm p join norm q on p.id < q.id left join dot on a = p.id and b = q.id), {_least_barrier('d')}""")
def alg27_heights(spark: SparkSession, sf: str) -> DataFrame:
    """The height at which two nations meet in the tree of parts weighted by their places on order lines."""
    r = table(spark, sf, "lineitem").join(table(spark, sf, "supplier"), F.col("l_suppkey") == F.col("s_suppkey")).select(F.col("s_nationkey").cast("string").alias("id"), F.col("l_partkey").alias("item"), (F.col("l_linenumber") - 4).alias("rel_pos"))
    weights = cut(trees.position_weights(r), "weights")
    full = cut(trees.fill_distances(cut(trees.cosine_distance(weights), "distances"), weights.select("id").distinct(), "one"), "filled")
    return _heights(spark, trees.minimum_forest(full))


@query(f"""with {_HIT}, e as (select distinct {_trim("name")} as name, ogs from eggnog_prots), b as (select * from (select qseqid, sseqid, row_number() over (partition by qseqid order by bitscore desc nulls last, sseqid) as k from hit) where k = 1),
    o as (select name, trim(og) as og from (select name, unnest(string_split(coalesce(ogs, ''), ',')) as og from e) where trim(og) <> ''),
    g as (select distinct og, length(og) % 7 as depth from o), j as (select distinct b.qseqid, o.og, depth from b join o on o.name = b.sseqid join g on g.og = o.og)
    select qseqid, og, depth from (select *, row_number() over (partition by qseqid order by depth desc, og) as k from j) where k = 1""")
def alg32_deepest_group(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "eggnog_prots").select(label("name").alias("name"), "ogs").distinct()
    g = annotate.explode_list(e.select("ogs"), "ogs", ",", "og").distinct().select("og", (F.length("og") % 7).alias("depth"), F.lit("").alias("description"))
    return annotate.deepest_group(hit(spark, sf), e, g).select("qseqid", "og", "depth")


@query("""select distinct product, case when product like 'Cas%' then split_part(product, '_', 1) when contains(product, '__') then regexp_replace(product, '^.*__', '') else product end as gene from proteins""")
def alg34_gene_names(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "proteins").select("product").distinct().select("product", annotate.defence_gene(F.col("product")).alias("gene"))


@query(f"""with {_DOM}, len as (select {_trim("id")} as protein_id, max(length(sequence)) as n from proteins group by 1), meta as (select domain_id, count(*) as hits from dom group by 1) select d.protein_id, d.domain_id, s as start, round((e - s + 1) * 1.0 / n + 1e-10, 6) as cov, hits
    from (select distinct protein_id, domain_id, s, e from dom) d left join len using (protein_id) left join meta on meta.domain_id = d.domain_id""")
def alg35_domain_metadata(spark: SparkSession, sf: str) -> DataFrame:
    d = dom(spark, sf)
    lengths = table(spark, sf, "proteins").groupBy(label("id").alias("protein_id")).agg(F.max(F.length("sequence")).alias("target_len"))
    meta = d.groupBy(F.col("domain_id").alias("domain_key")).agg(F.count(F.lit(1)).alias("hits"))
    out = annotate.domain_metadata(d.select("protein_id", "domain_id", "start", "end").distinct(), lengths, meta)
    return out.select("protein_id", "domain_id", "start", F.round(F.col("cov") + 1e-10, 6).alias("cov"), "hits")


@query("""select protein_id, coalesce(domain_id_clean, domain_id) as domain_id, start, "end", round(bit_score + 1e-9, 2) as bit_score, printf('%.2e', e_value) as e_value, round(cov + 1e-9, 2) as cov from domain_hits where protein_id is not null and start is not null and "end" is not null""")
def alg36_tidy_domains(spark: SparkSession, sf: str) -> DataFrame:
    return annotate.tidy_domains(table(spark, sf, "domain_hits"))


@query(f"""with {_FEAT} select seqid, id as name, type, start, "end", cast(null as double) as score, cast(null as varchar) as structure from feat where type in ('ncRNA', 'tRNA')""")
def alg37_ncrna(spark: SparkSession, sf: str) -> DataFrame:
    return annotate.ncrna_metadata(feat(spark, sf).where("type in ('ncRNA', 'tRNA')").withColumnRenamed("id", "name")).select("seqid", "name", "type", "start", "end", "score", "structure")


@query(f"""with {_PROT}, x as (select distinct {_trim("id")} || '-' || unique_id || '-' || length(sequence) as tool_id, sequence from proteins where unique_id is not null) select tool_id, min(sequence) as sequence from x group by tool_id""")
def alg39_tool_ids(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "proteins").select(label("id").alias("id"), F.col("unique_id").alias("uid"), F.length("sequence").alias("start"), "sequence")
    return annotate.tool_ids(p)


# ---- files and streams --------------------------------------------------------------------------------------------


@query('select seqid, source, type, start, "end", score, strand, phase from gff where seqid is not null')
def src03_gff(spark: SparkSession, sf: str) -> DataFrame:
    g = table(spark, sf, "gff")
    path = table_path(spark, "gff")
    nine = g.select("seqid", "source", "type", "start", "end", "score", "strand", "phase", F.translate("attributes", "\t", " ").alias("attributes"))
    nine.select(F.concat_ws("\t", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in nine.columns]).alias("value")).write.text(path)
    return readers.gff(spark, path).select("seqid", "source", "type", "start", "end", "score", "strand", "phase")


@query("select id, sequence from seed_proteins")
def src04_fasta(spark: SparkSession, sf: str) -> DataFrame:
    path = table_path(spark, "fasta")
    sinks.write_fasta(table(spark, sf, "seed_proteins"), path)
    return readers.fasta(spark, path)


@query("select cast(unique_id as varchar) as unique_id, taxid, nullif(trim(assembly_level), '') as assembly_level, cast(null as double) as gc_percent from records where lower(coalesce(trim(assembly_level), '')) <> 'na' union all select cast(unique_id as varchar), taxid, null, null from records where lower(trim(assembly_level)) = 'na'")
def src07_typed_tsv(spark: SparkSession, sf: str) -> DataFrame:
    path = table_path(spark, "tsv")
    r = table(spark, sf, "records").select(F.concat_ws("\t", F.col("unique_id"), F.coalesce(F.col("taxid").cast("string"), F.lit("na")), F.coalesce("assembly_level", F.lit(""))).alias("value"))
    first = spark.createDataFrame([("#unique_id\ttaxid\tassembly_level",)], "value string").withColumn("at", F.lit(0))
    first.unionByName(r.withColumn("at", F.lit(1))).repartition(1).sortWithinPartitions("at").select("value").write.text(path)
    return readers.typed_tsv(spark, path, {"taxid": "long", "gc_percent": "double"}, "unique_id", ["unique_id", "taxid", "assembly_level", "gc_percent"])


@query("select nucleotide_id as genbankAccession, cast(null as varchar) as refseqAccession, assembly_id as assemblyAccession, sequence_length as length from records")
def src08_drift_parquet(spark: SparkSession, sf: str) -> DataFrame:
    a, b = table_path(spark, "part"), table_path(spark, "part")
    r = table(spark, sf, "records")
    short = F.coalesce(F.col("sequence_length") < 100_000, F.lit(False))
    r.where(short).select(F.col("assembly_id").alias("assemblyAccession"), F.col("sequence_length").alias("length"), F.col("nucleotide_id").alias("genbankAccession")).write.parquet(a)
    r.where(~short).select(F.col("nucleotide_id").alias("genbankAccession"), F.col("sequence_length").cast("string").alias("length"), F.col("assembly_id").alias("assemblyAccession")).write.parquet(b)
    one = spark.read.parquet(a).withColumn("length", F.col("length").cast("string"))
    c = table_path(spark, "part")
    one.write.parquet(c)
    return readers.contigs(spark, c, b).select("genbankAccession", "refseqAccession", "assemblyAccession", "length")


@query("select qseqid, sseqid, pident, length, evalue, bitscore from hits")
def src11_tabular_hits(spark: SparkSession, sf: str) -> DataFrame:
    path = table_path(spark, "hits")
    h = table(spark, sf, "hits")
    h.select(F.concat_ws("\t", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in h.columns]).alias("value")).write.text(path)
    return readers.hits(spark, path, 6)


@query("select doc_id, lang, doc_kind from documents")
def snk06_publish(spark: SparkSession, sf: str) -> DataFrame:
    path = table_path(spark, "published")
    sinks.publish(table(spark, sf, "documents").select("doc_id", "lang", "doc_kind"), path)
    return spark.read.parquet(path)


@query("""with g as (select user_id, ts, value, case when lag(ts) over (partition by user_id order by ts) is null or ts - lag(ts) over (partition by user_id order by ts) >= interval 30 minutes then 1 else 0 end as f from events),
    k as (select *, sum(f) over (partition by user_id order by ts rows unbounded preceding) as k from g) select user_id, cast(floor(epoch(min(ts))) as bigint) as first_ts, count(*) as n_events, round(sum(value) + 1e-9, 4) as total from k group by user_id, k""")
def str_sessions(spark: SparkSession, sf: str) -> DataFrame:
    s = ingest.sessions(table(spark, sf, "events"))
    return s.select("user_id", F.floor(F.col("start").cast("timestamp").cast("double")).cast("bigint").alias("first_ts"), "n_events", F.round(F.col("total") + 1e-9, 4).alias("total"))


@query("select cast(floor(epoch(ts) / 3600) as bigint) as hour, event_type, count(*) as n, round(sum(value) + 1e-9, 4) as total from events group by 1, 2")
def str_hourly(spark: SparkSession, sf: str) -> DataFrame:
    h = ingest.hourly(table(spark, sf, "events"))
    return h.select(F.floor(F.col("hour").cast("timestamp").cast("double") / 3600).cast("bigint").alias("hour"), "event_type", "n", F.round(F.col("total") + 1e-9, 4).alias("total"))


