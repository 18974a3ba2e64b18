"""Readers, writers and what goes with them as queries with SQL: files are made of whole test tables and read back."""

from __future__ import annotations

import base64
import zlib

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vicinage import schemas
from vicinage.functions import links, text
from vicinage.functions.clean import label
from vicinage.operators import enrich, trees
from vicinage.plans import config
from vicinage.plans.queries import table
from vicinage.plans.reference import QUERIES, SQL, _FEAT, _HIT, _REC, _trim, feat, hit, query, rec
from vicinage.session import delete, table_path
from vicinage.sources import genbank, readers, sinks
from vicinage.streaming import ingest

__all__ = ["QUERIES", "SQL"]


def _lines(df: DataFrame, name: str, *cells: object, sep: str = "\t", header: str | None = None, footer: str | None = None) -> str:
    """A text file of one line a row, nulls being empty; with a header or footer line it is one file."""
    path = table_path(df.sparkSession, name)
    cols = [F.col(c) if isinstance(c, str) else c for c in cells]
    out = df.select(F.concat_ws(sep, *[F.coalesce(c.cast("string"), F.lit("")) for c in cols]).alias("value"))
    if header is not None:
        ends = [(header, 0)] + ([(footer, 2)] if footer else [])
        out = out.withColumn("at", F.lit(1)).unionByName(df.sparkSession.createDataFrame(ends, "value string, at int")).repartition(1).sortWithinPartitions("at").select("value")
    out.write.text(path)
    return path


@query(f"""with {_REC}, i as (select distinct nucleotide_id as id, case when "end" is not null then start end as a, case when start is not null then "end" end as b from rec where nucleotide_id is not null)
    select id, least(a, b) as start, greatest(a, b) as "end", case when a is null then null when b > a then '-' else '+' end as strand from i""")
def src01_id_list(spark: SparkSession, sf: str) -> DataFrame:
    """Each nucleotide id with its place turned round, as a list of ids."""
    r = rec(spark, sf).where("nucleotide_id is not null")
    both = F.concat("nucleotide_id", F.lit(":"), F.col("end").cast("string"), F.lit("-"), F.col("start").cast("string"))
    path = _lines(r.select(F.coalesce(both, "nucleotide_id").alias("line"), "start", "end").distinct(), "ids", "line")
    return readers.id_list(spark, path).select("id", "start", "end", "strand")



@query(f"""with {_REC} select uid as unique_id, coalesce(case when og_index % 2 = 0 then input_type end, case when nucleotide_id is not null then 'nucleotide' when protein_id is not null then 'protein' when uniprot_id is not null then 'uniprot' end) as input_type, cast(null as varchar) as strand, cast(taxid as varchar) as note from rec""")
def src02_input_sheet(spark: SparkSession, sf: str) -> DataFrame:
    r = rec(spark, sf).withColumn("input_type", F.when(F.col("og_index") % 2 == 0, F.col("input_type")))
    cells = ["uid", "nucleotide_id", "protein_id", "uniprot_id", "input_type", "taxid"]
    path = _lines(r, "sheet", *cells, header="unique_id\tnucleotide_id\tprotein_id\tuniprot_id\tinput_type\tnote")
    sheet, extra = readers.input_sheet(spark, path, ["unique_id", "nucleotide_id", "protein_id", "uniprot_id", "input_type", "strand"])
    return sheet.select("unique_id", "input_type", "strand", *extra)


@query("select id, length(sequence) as n from proteins")
def src05_whole_fasta(spark: SparkSession, sf: str) -> DataFrame:
    path = table_path(spark, "fasta")
    sinks.write_fasta(table(spark, sf, "proteins").withColumn("sequence", F.coalesce("sequence", F.lit(""))), path, width=None)
    return readers.fasta(spark, path).select("id", F.length("sequence").alias("n"))


@query(f"""with {_FEAT} select seqid, least(start, "end") as start, greatest(start, "end") as "end", case when start > "end" then '-' else '+' end as strand, protein_id, id as locus_tag from feat where type = 'CDS' and protein_id is not null""")
def src06_genbank(spark: SparkSession, sf: str) -> DataFrame:
    """Coding features as GenBank files, one record a contig, turned-round ones on the other strand."""
    f = feat(spark, sf).where("type = 'CDS' and protein_id is not null")
    span = F.concat(F.least("start", "end").cast("string"), F.lit(".."), F.greatest("start", "end").cast("string"))
    place = F.when(F.col("start") > F.col("end"), F.concat(F.lit("complement("), span, F.lit(")"))).otherwise(span)
    pad = F.lit("\n" + " " * 21)
    entry = F.concat(F.lit("     CDS             "), place, pad, F.lit('/protein_id="'), "protein_id", F.lit('"'), pad, F.lit('/locus_tag="'), "id", F.lit('"'))
    body = f.groupBy("seqid").agg(F.array_join(F.array_sort(F.collect_list(entry)), "\n").alias("body"))
    path = table_path(spark, "genbank")
    record = F.concat(F.lit("LOCUS       "), "seqid", F.lit("\nVERSION     "), "seqid", F.lit("\nFEATURES             Location/Qualifiers\n"), "body", F.lit("\nORIGIN\n//"))
    body.select(record.alias("value")).write.text(path)
    return genbank.read(spark, path + "/*.txt").select("seqid", "start", "end", "strand", "protein_id", F.col("qualifiers")["locus_tag"].alias("locus_tag"))


@query("select assembly_id as assemblyAccession, try_cast(sequence_length as bigint) as length, cast(null as varchar) as genbankAccession, nucleotide_id as refseqAccession from records")
def src09_publishing_projection(spark: SparkSession, sf: str) -> DataFrame:
    path = table_path(spark, "part")
    table(spark, sf, "records").select(F.col("assembly_id").alias("assemblyAccession"), F.col("sequence_length").cast("string").alias("length"), F.col("nucleotide_id").alias("refseqAccession"), "taxid").write.parquet(path)
    return readers.contigs(spark, path).select("assemblyAccession", "length", "genbankAccession", "refseqAccession")


@query(f"""with e as (select {_trim("name")} as name, unnest(string_split(coalesce(ogs, ''), ',')) as og from eggnog_prots) select distinct name, og from e where og <> '' and name in (select {_trim("sseqid")} from hits)""")
def src10_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """Orthologous groups of the proteins that are hit as they are written."""
    wanted = table(spark, sf, "hits").select(label("sseqid").alias("name")).distinct()
    e = table(spark, sf, "eggnog_prots").select(label("name").alias("name"), F.explode(F.split(F.coalesce("ogs", F.lit("")), ",")).alias("og")).where("og <> ''")
    return e.join(wanted, "name", "left_semi").distinct()


@query(f"""with {_HIT} select qseqid as query, sseqid as ref, length as matches, coalesce(length, 0) + 5 as block_len, case when bitscore > 200 then 3 end as edits, coalesce(pident, 0) >= 50 as is_primary from hit where qseqid is not null and sseqid is not null""")
def src12_paf(spark: SparkSession, sf: str) -> DataFrame:
    h = hit(spark, sf).where("qseqid is not null and sseqid is not null")
    zero, n = F.lit(0), F.coalesce("length", F.lit(0))
    tags = F.concat_ws("\t", F.when(F.coalesce("pident", F.lit(0.0)) >= 50, "tp:A:P").otherwise("tp:A:S"), F.when(F.col("bitscore") > 200, "NM:i:3"))
    path = _lines(h, "paf", "qseqid", zero, zero, zero, F.lit("+"), "sseqid", zero, zero, zero, "length", n + 5, F.lit(60), tags)
    return readers.paf_hits(spark, path).select("query", "ref", "matches", "block_len", "edits", "is_primary")


@query(f"""with {_FEAT}, g as (select seqid, id, row_number() over (partition by seqid order by start, "end", id) as k from feat) select seqid || '_' || ((k - 1) // 8) as operon, seqid as contig, count(*) as n, string_agg(id, ',' order by k) as genes from g group by seqid, (k - 1) // 8""")
def src13_tool_lists(spark: SparkSession, sf: str) -> DataFrame:
    """Eight features at a time as the operons of a tool's table, their lists in text, read as arrays."""
    from vicinage.operators.windows import gene_index

    g = gene_index(feat(spark, sf), name="i").withColumn("block", F.expr("i div 8")).groupBy("seqid", "block").agg(F.array_sort(F.collect_list(F.struct("i", "id"))).alias("m"))
    listed = lambda f: F.concat(F.lit("["), F.array_join(F.transform("m", f), ", "), F.lit("]"))
    path = _lines(g, "cctyper", "seqid", F.concat_ws("_", "seqid", "block"), F.lit("NA"), F.lit("x"), listed(lambda x: x["i"].cast("string")), listed(lambda x: F.concat(F.lit("'"), x["id"], F.lit("'"))), header="Contig\tOperon\tStart\tEnd\tPositions\tGenes")
    t = readers.tool_hits(spark, path, "cctyper").where("Start is null and End is null and Prediction is null")
    return t.select(F.col("Operon").alias("operon"), F.col("Contig").alias("contig"), F.size("Positions").cast("bigint").alias("n"), F.array_join("Genes", ",").alias("genes"))


def _xml(df: DataFrame, value: object) -> str:
    return _lines(df, "xml", value, header="<r>", footer="</r>")


@query(f"""with {_REC} select distinct uid, assembly_id, taxid, nullif(assembly_level, '') as assembly_level, case when is_query then 'ref/' || uid else 'gen/' || uid end as ftp_path from rec where assembly_id is not null""")
def src14_assembly_xml(spark: SparkSession, sf: str) -> DataFrame:
    r = rec(spark, sf).where("assembly_id is not null").select("uid", "assembly_id", "taxid", F.coalesce("assembly_level", F.lit("")).alias("lv"), "is_query").distinct()
    tag = lambda n, c: F.concat(F.lit(f"<{n}>"), F.coalesce(c.cast("string"), F.lit("")), F.lit(f"</{n}>"))
    value = F.concat(F.lit('<DocumentSummary uid="'), "uid", F.lit('">'), tag("AssemblyAccession", F.col("assembly_id")), F.when(F.col("taxid").isNotNull(), tag("SpeciesTaxid", F.col("taxid"))).otherwise(""), tag("AssemblyStatus", F.col("lv")), tag("FtpPath_RefSeq", F.when(F.col("is_query"), F.concat(F.lit("ref/"), "uid"))), tag("FtpPath_GenBank", F.concat(F.lit("gen/"), "uid")), F.lit("</DocumentSummary>"))
    return readers.assembly_summaries(spark, _xml(r, value)).select("uid", "assembly_id", "taxid", F.nullif("assembly_level", F.lit("")).alias("assembly_level"), "ftp_path")


@query(f"""with {_REC} select nucleotide_id as from_id, 'nuccore_assembly' as link_name, assembly_id as to_id from rec where nucleotide_id is not null and assembly_id is not null""")
def src14_link_xml(spark: SparkSession, sf: str) -> DataFrame:
    r = rec(spark, sf).where("nucleotide_id is not null and assembly_id is not null")
    value = F.concat(F.lit("<LinkSet><DbFrom>nuccore</DbFrom><IdList><Id>"), "nucleotide_id", F.lit("</Id></IdList><LinkSetDb><DbTo>assembly</DbTo><LinkName>nuccore_assembly</LinkName><Link><Id>"), "assembly_id", F.lit("</Id></Link></LinkSetDb></LinkSet>"))
    return readers.nucleotide_links(spark, _xml(r, value))


@query(f"""with {_REC} select nucleotide_id, sequence_length as length, taxid from rec where nucleotide_id is not null""")
def src14_nucleotide_xml(spark: SparkSession, sf: str) -> DataFrame:
    r = rec(spark, sf).where("nucleotide_id is not null")
    tag = lambda n, c: F.when(F.col(c).isNotNull(), F.concat(F.lit(f"<{n}>"), F.col(c).cast("string"), F.lit(f"</{n}>"))).otherwise("")
    value = F.concat(F.lit("<DocumentSummary><Caption>x</Caption>"), tag("AccessionVersion", "nucleotide_id"), tag("Slen", "sequence_length"), tag("TaxId", "taxid"), F.lit("</DocumentSummary>"))
    return readers.nucleotide_summaries(spark, _xml(r, value)).select("nucleotide_id", "length", "taxid")


@query(f"""with {_REC} select ipg_id, protein_id, nucleotide_id, start, "end" from rec where ipg_id is not null""")
def src14_ipg_xml(spark: SparkSession, sf: str) -> DataFrame:
    r = rec(spark, sf).where("ipg_id is not null")
    at = lambda n, c: F.when(F.col(c).isNotNull(), F.concat(F.lit(f' {n}="'), F.col(c).cast("string"), F.lit('"'))).otherwise("")
    value = F.concat(F.lit("<IPGReport"), at("ipg", "ipg_id"), F.lit("><ProteinList><Protein"), at("accver", "protein_id"), F.lit("><CDSList><CDS"), at("accver", "nucleotide_id"), at("start", "start"), at("stop", "end"), F.lit("/></CDSList></Protein></ProteinList></IPGReport>"))
    return readers.ipg_report(spark, _xml(r, value)).select("ipg_id", "protein_id", "nucleotide_id", "start", "end")


@query(f"""with {_REC}, i as (select distinct protein_id as id from rec where protein_id is not null), k as (select id, (row_number() over (order by id) - 1) // 100 as chunk from i) select chunk, count(*) as n, min(id) as first, max(id) as last from k group by chunk""")
def src15_chunks(spark: SparkSession, sf: str) -> DataFrame:
    c = readers.ipg_chunks(rec(spark, sf).select(F.col("protein_id").alias("id")).where("id is not null"))
    return c.select("chunk", F.size("ids").cast("bigint").alias("n"), F.element_at("ids", 1).alias("first"), F.element_at("ids", -1).alias("last"))


@query(f"""with {_REC} select uid as uniparc_id, case when is_query and protein_id is not null then protein_id || case when contains(protein_id, '.') then '' else '.1' end when nucleotide_id is not null then nucleotide_id || case when contains(nucleotide_id, '.') then '' else '.2' end end as accession from rec""")
def src16_uniparc(spark: SparkSession, sf: str) -> DataFrame:
    ref = lambda db, c, v, active: F.struct(F.lit(db).alias("database"), F.col(c).alias("id"), F.lit(v).alias("version"), active.alias("active"))
    xs = F.filter(F.array(ref("EMBL", "nucleotide_id", 2, F.lit(True)), ref("RefSeq", "protein_id", 1, F.col("is_query"))), lambda x: x["id"].isNotNull())
    path = table_path(spark, "json")
    rec(spark, sf).select(F.col("uid").alias("uniParcId"), xs.alias("uniParcCrossReferences")).write.json(path)
    return readers.uniparc_best(spark, path)


@query(f"""with {_REC}, a as (select distinct assembly_id from rec where assembly_id is not null), k as (select unnest(['gbff', 'gff', 'fna', 'faa', 'sequence_report']) as filetype)
    select assembly_id, filetype, case when filetype = 'sequence_report' then assembly_id else 'ncbi+ftp://genomes/' || assembly_id || '_ASM1/' || assembly_id || '_ASM1_' || case when filetype = 'faa' then 'protein' else 'genomic' end || '.' || filetype || '.gz' end as told from a, k""")
def src17_links(spark: SparkSession, sf: str) -> DataFrame:
    """The links of every assembly, and what their messages say when they are read again."""
    a = rec(spark, sf).where("assembly_id is not null").select("assembly_id", F.concat(F.lit(links.SERVER + "genomes/"), "assembly_id", F.lit("_ASM1/")).alias("ftp_path")).distinct()

    @F.pandas_udf("string")
    def told(urls: pd.Series) -> pd.Series:
        def one(url: str) -> str:
            tail = url.rsplit("/", 1)[1]
            raw = zlib.decompress(base64.urlsafe_b64decode(tail + "=" * (-len(tail) % 4)))
            if raw[0] == 0x1A:  # field 3 holds field 1, fields 6 and 7 are set
                head = 3 if raw[1] > 127 else 2
                inner = raw[head:-4]
                assert raw[-4:] == b"\x30\x01\x38\x01"
                return inner[(3 if inner[1] > 127 else 2) :].decode()
            return raw[2:].decode()

        return urls.map(one)

    return links.link_table(a).select("assembly_id", "filetype", told("url").alias("told"))


@query("select assembly_id as assemblyAccession, sequence_length as length, nucleotide_id as genbankAccession from records where assembly_id is not null")
def src18_sequence_reports(spark: SparkSession, sf: str) -> DataFrame:
    path = table_path(spark, "json")
    good = table(spark, sf, "records").where("assembly_id is not null").select(F.to_json(F.struct(F.col("assembly_id").alias("assemblyAccession"), F.col("sequence_length").alias("length"), F.col("nucleotide_id").alias("genbankAccession"))).alias("value"))
    good.unionByName(spark.createDataFrame([('{"assemblyAccession": "cut',)], "value string")).write.text(path)
    return readers.sequence_reports(spark, path).select("assemblyAccession", "length", "genbankAccession")


@query("select distinct id, sequence from (select s.id, k.sequence from seed_proteins s, (select unnest(['A1', 'B2']) as sequence) k)")
def src19_strain_csv(spark: SparkSession, sf: str) -> DataFrame:
    """Two lines a strain, the second with a blank id, below lines that are no header."""
    ids = [r[0] for r in table(spark, sf, "seed_proteins").select("id").orderBy("id").collect()]  # 24 rows, fixed
    body = [("made today",), ("ID,Sequence accession no,name",), *[(x,) for i in ids for x in (f"{i},A1,x", ",B2,y")]]
    path = table_path(spark, "csv")
    spark.createDataFrame(body, "value string").coalesce(1).write.text(path)
    return readers.strain_csv(spark, path + "/*.txt", "accession").select(F.col("ID").alias("id"), F.col("accession").alias("sequence"))


@query("select domain_id || '_n' as id, domain_id as accession, 'about ' || domain_id as description, cast(null as varchar) as clan from (select distinct domain_id from domain_hits where domain_id is not null)")
def src20_stockholm(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "domain_hits").where("domain_id is not null").select("domain_id").distinct()
    path = table_path(spark, "stockholm")
    d.select(F.concat(F.lit("# STOCKHOLM 1.0\n#=GF ID   "), "domain_id", F.lit("_n\n#=GF AC   "), "domain_id", F.lit("\n#=GF DE   about "), "domain_id", F.lit("\nseq  ACDE\n//")).alias("value")).write.text(path)
    trimmed = readers.stockholm_metadata(spark, path)
    return trimmed


@query("select case when name = 'KEGG.tsv' then 'kofam' else lower(split_part(name, '_', 1)) end as \"group\", count(*) as n from (select distinct database || '_' || domain_id || '.hmm' as name from domain_hits union all select 'KEGG.tsv') where name is not null group by 1")
def src21_listing(spark: SparkSession, sf: str) -> DataFrame:
    names = table(spark, sf, "domain_hits").select(F.concat("database", F.lit("_"), "domain_id", F.lit(".hmm")).alias("name")).distinct().where("name is not null")
    return readers.listing_groups(names.unionByName(spark.createDataFrame([("KEGG.tsv",)], "name string"))).groupBy("group").agg(F.count(F.lit(1)).alias("n"))


@query("select id, repeat('(', cast(length(sequence) % 9 as integer)) || repeat('.', cast(length(sequence) % 5 + 1 as integer)) || repeat(')', cast(length(sequence) % 9 as integer)) as structure from seed_proteins")
def src22_covariance(spark: SparkSession, sf: str) -> DataFrame:
    """A hairpin as the nodes of a covariance model, read as brackets."""
    s = table(spark, sf, "seed_proteins").select("id", F.length("sequence").alias("n"))
    node = lambda kind, count: F.array_join(F.transform(F.sequence(F.lit(0), count), lambda i: F.when(i < count, F.concat(F.lit(f"    [ {kind} "), i.cast("string"), F.lit(" ]\n"))).otherwise("")), "")
    model = F.concat(F.lit("CM\n    [ ROOT 0 ]\n"), node("MATP", F.col("n") % 9), node("MATL", F.col("n") % 5 + 1), F.lit("    [ END 99 ]\n//\n"))
    return s.select("id", links.structure_of(model).alias("structure"))


@query("select 'window' as name, '777' as value union all select 'min_pident', '41.5' union all select 'cand_mode', 'any_ipg' union all select 'tree_mode', 'taxonomy'")
def src23_settings(spark: SparkSession, sf: str) -> DataFrame:
    """Defaults, below a file, below what the caller gives."""
    import tempfile

    with tempfile.NamedTemporaryFile("w", suffix=".toml") as f:  # a settings file of the driver, no data
        f.write('window = 5\n[families]\nmin-pident = 41.5\nunknown = 1\n[input]\ncand_mode = "any_ipg"\n')
        f.flush()
        s = config.load(f.name, window=777, tree_mode=None)
    return spark.createDataFrame([(n, str(getattr(s, n))) for n in ("window", "min_pident", "cand_mode", "tree_mode")], "name string, value string")


@query("select a.n_name as a, b.n_name as b, cast(abs(a.n_nationkey - b.n_nationkey) as double) as dist from nation a, nation b")
def src24_distance_csv(spark: SparkSession, sf: str) -> DataFrame:
    n = sorted(tuple(r) for r in table(spark, sf, "nation").select("n_name", "n_nationkey").collect())  # 25 rows, fixed
    rows = [(",".join(["id", *[x for x, _ in n]]),), *[(",".join([x, *[str(abs(k - j)) for _, j in n]]),) for x, k in n]]
    path = table_path(spark, "csv")
    spark.createDataFrame(rows, "value string").coalesce(1).write.text(path)
    return readers.distance_csv(spark, path)


@query(f"""with {_FEAT} select 'gff' as name, count(*) as n from feat union all select 'protein_links', count(*) from hits union all select 'hoods', count(*) from records union all select unnest(['protein_metadata', 'tree_metadata', 'domains', 'domains_metadata', 'ncrna_metadata', 'nucleotide_links']), 0""")
def snk01_bundle(spark: SparkSession, sf: str) -> DataFrame:
    """The nine tables of a run, those not given being empty, as Parquet and as text of as many rows."""
    out = table_path(spark, "bundle")
    given = {"gff": feat(spark, sf), "protein_links": table(spark, sf, "hits"), "hoods": table(spark, sf, "records").select("unique_id", "nucleotide_id")}
    sinks.write_bundle(given, out, dict.fromkeys(sinks.BUNDLE, "id string"), spark)
    parts = []
    for name, header in sinks.BUNDLE.items():
        here = spark.read.parquet(f"{out}/{name}.parquet").agg(F.count(F.lit(1)).alias("n"))
        there = spark.read.option("sep", "\t").option("header", header).csv(f"{out}/{name}.tsv", schema="a string").count()
        parts.append(here.select(F.lit(name).alias("name"), F.when(F.col("n") == there, F.col("n")).alias("n")))
    out_df = parts[0]
    for p in parts[1:]:
        out_df = out_df.unionByName(p)
    return out_df


@query("select seqid, type, start, strand from gff")
def snk02_tsv(spark: SparkSession, sf: str) -> DataFrame:
    path = table_path(spark, "tsv")
    sinks.write_tsv(table(spark, sf, "gff").select("seqid", "type", "start", "strand"), path, True)
    return spark.read.option("sep", "\t").option("header", True).schema("seqid string, type string, start bigint, strand string").csv(path)


@query("select 1 as line, '25' as value union all select 2 + rank, value from (select row_number() over (order by n_name) - 1 as rank, n_name || ' ' || (select string_agg(printf('%.6f', cast(abs(a.n_nationkey - b.n_nationkey) as double)), ' ' order by b.n_name) from nation b) as value from nation a)")
def snk04_phylip(spark: SparkSession, sf: str) -> DataFrame:
    n = sorted(tuple(r) for r in table(spark, sf, "nation").select("n_name", "n_nationkey").collect())  # 25 rows, fixed
    d = spark.createDataFrame([(x, y, float(abs(k - j))) for x, k in n for y, j in n if x < y], "a string, b string, dist double")
    leaves = [x for x, _ in n]
    made = trees.phylip(leaves, trees.matrix(leaves, d)).splitlines()
    return spark.createDataFrame(list(enumerate(made, 1)), "line int, value string")


@query("select doc_id, length(text) as n, true as same from documents where text is not null")
def snk05_embedded(spark: SparkSession, sf: str) -> DataFrame:
    """Each text put into a page and taken out again."""

    @F.pandas_udf("boolean")
    def same(s: pd.Series) -> pd.Series:
        return s.map(lambda t: sinks.unembed(sinks.embed(t.encode())).decode() == t)

    return table(spark, sf, "documents").where("text is not null").select("doc_id", F.length("text").cast("bigint").alias("n"), same("text").alias("same"))


@query("select l_orderkey, l_linenumber, l_partkey, cast(null as varchar) as note from lineitem")
def snk07_rotating_parts(spark: SparkSession, sf: str) -> DataFrame:
    """Parts of at most 80,000 rows; a column without a type is text."""
    path = table_path(spark, "parts")
    sinks.write_parquet(table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.lit(None).alias("note")), path, 80_000)
    df = spark.read.parquet(path)
    per = df.groupBy(F.input_file_name().alias("f")).count().agg(F.max("count")).first()[0] or 0
    if per > 80_000:
        raise ValueError(f"a part of {per} rows")
    return df


@query("select event_id, user_id, event_type from events")
def snk08_zstd_parquet(spark: SparkSession, sf: str) -> DataFrame:
    path = table_path(spark, "parts")
    sinks.write_parquet(table(spark, sf, "events").select("event_id", "user_id", "event_type"), path)
    return spark.read.parquet(path)


@query("select unique_id, nullif(assembly_level, '') as assembly_level, 'all_neigh' as name from records union all select id, nullif(product, ''), 'proteins' from proteins")
def snk09_run_tables(spark: SparkSession, sf: str) -> DataFrame:
    """Tables of a run as headed text without sequences, quoted only where needed."""
    a, b = table_path(spark, "tsv"), table_path(spark, "tsv")
    sinks.write_run_table(table(spark, sf, "records"), a)
    sinks.write_run_table(table(spark, sf, "proteins"), b)
    read = lambda p: spark.read.option("sep", "\t").option("header", True).option("ignoreLeadingWhiteSpace", False).option("emptyValue", "").csv(p)
    one, two = read(a), read(b)
    if "sequence" in two.columns:
        raise ValueError("the sequence was written")
    return one.select("unique_id", "assembly_level", F.lit("all_neigh").alias("name")).unionByName(two.select(F.col("id").alias("unique_id"), F.col("product").alias("assembly_level"), F.lit("proteins").alias("name")))


@query("select stage, count(*) as n from (select 'first' as stage from records union all select 'second' from records where failed) group by stage")
def snk10_trace(spark: SparkSession, sf: str) -> DataFrame:
    path = table_path(spark, "trace")
    r = table(spark, sf, "records").select("unique_id", "failed")
    sinks.append_trace(r, path, "first")
    sinks.append_trace(r.where("failed"), path, "second")
    return spark.read.option("header", True).csv(path).groupBy("stage").agg(F.count(F.lit(1)).alias("n"))


@query("select unnest(['bundle', 'records.tsv']) as kept")
def snk11_clean_up(spark: SparkSession, sf: str) -> DataFrame:
    """What a run leaves when it has cleaned up: its results; staging, parts and traces go."""
    out = table_path(spark, "run")
    for name in ("bundle", "records.tsv", "parts.staging", "trace"):
        table(spark, sf, "nation").select("n_name").write.mode("overwrite").parquet(f"{out}/{name}")
    left = sinks.clean_up(spark, out, keep=("bundle", "records.tsv"))
    shown = spark.createDataFrame([(x,) for x in left], "kept string")
    delete(spark, out)
    return shown


@query(f"""with {_REC}, p as (select uid, case when og_index % 3 = 0 then 'a.gff' end as g, case when og_index % 2 = 0 then 'a.faa' else ' ' end as f, case when og_index % 5 = 0 then 'a.gbf' end as b from rec) select uid, coalesce(g is not null and trim(f) <> '', false) or b is not null as premade from p""")
def flt06_premade(spark: SparkSession, sf: str) -> DataFrame:
    i = F.col("og_index")
    r = rec(spark, sf).select("uid", F.when(i % 3 == 0, "a.gff").alias("gff_path"), F.when(i % 2 == 0, "a.faa").otherwise(" ").alias("faa_path"), F.when(i % 5 == 0, "a.gbf").alias("gbf_path"))
    return readers.premade(r).select("uid", "premade")


@query("select id as prot_id, target_nuc, fam_cluster as family from proteins")
def flt15_aliases(spark: SparkSession, sf: str) -> DataFrame:
    return schemas.by_alias(table(spark, sf, "proteins"), ["prot_id", "target_nuc", "family"])


@query(f"""with {_FEAT}, g as (select seqid, id, type, row_number() over (partition by seqid order by start, "end", id) - 1 as i from feat) select a.seqid, a.i, a.id, b.type, c.id as next_id from g a join g b on b.seqid = a.seqid and b.i = a.i left join g c on c.seqid = a.seqid and c.i = a.i + 1""")
def jn20_by_index(spark: SparkSession, sf: str) -> DataFrame:
    """Features, their kinds and their neighbours joined by place on the contig."""
    from vicinage.operators.windows import gene_index

    g = gene_index(feat(spark, sf), name="i").select("seqid", "i", "id", "type")
    return enrich.by_index(enrich.by_index(g.select("seqid", "i", "id"), g.select("seqid", "i", "type"), ["seqid"], "i"), g.select("seqid", "i", F.col("id").alias("next_id")), ["seqid"], "i", 1, "left")


@query(f"""with {_HIT}, b as (select qseqid, sseqid, max(coalesce(bitscore, -1)) as bits from hit where sseqid is not null group by 1, 2) select qseqid, sseqid from (select *, row_number() over (partition by qseqid order by bits desc, sseqid) as k from b) where k <= 3""")
def srt03_first_targets(spark: SparkSession, sf: str) -> DataFrame:
    """The three best targets of each query: the feature is the limit."""
    h = hit(spark, sf).where("sseqid is not null").groupBy("qseqid", "sseqid").agg(F.max(F.coalesce("bitscore", F.lit(-1.0))).alias("bits"))
    return enrich.best_n(h, ["qseqid"], [F.col("bits").desc(), F.col("sseqid")], 3).select("qseqid", "sseqid")


@query(f"""with {_HIT}, q as (select qseqid, sseqid, row_number() over (partition by qseqid order by evalue nulls last, sseqid) as k from hit where qseqid is not null and sseqid is not null), f as (select qseqid, sseqid, min(k) as k from q where sseqid <> qseqid group by 1, 2), l as (select qseqid, qseqid as id, 0 as k from q group by qseqid union all select qseqid, sseqid, k from f)
    select qseqid, id, row_number() over (partition by qseqid order by k) as place from l""")
def srt05_ordered_distinct(spark: SparkSession, sf: str) -> DataFrame:
    """Each query, then its hits in the order they first come."""
    h = hit(spark, sf).where("qseqid is not null and sseqid is not null")
    return enrich.ordered_distinct(h, "qseqid", "sseqid", ["evalue", "sseqid"]).select("qseqid", "id", "place")


@query("select doc_id, replace(text, 'a', '<a>') as replaced, source || '/' || lang as joined from documents")
def str03_replace_concat(spark: SparkSession, sf: str) -> DataFrame:
    """Literal replacement, and concatenation that a null ends (STR-07)."""
    return table(spark, sf, "documents").select("doc_id", F.replace("text", F.lit("a"), F.lit("<a>")).alias("replaced"), text.strict_concat(F.col("source"), F.lit("/"), F.col("lang")).alias("joined"))


@query("with s as (select id, length(sequence) % 50 as k, length(sequence) % 2 as odd from proteins where sequence is not null) select id, 'M' || repeat('AK', cast(k as integer)) as protein, case when odd = 0 then 'CCCTTA' else 'NN' end || repeat('TTTAGC', cast(k as integer)) || 'CAT' as turned from s")
def str11_translation(spark: SparkSession, sf: str) -> DataFrame:
    """A gene made of each protein's length, translated to its first stop and turned round."""
    n = F.length("sequence")
    nt = F.concat(F.lit("ATG"), F.repeat(F.lit("GCTAAA"), n % 50), F.when(n % 2 == 0, "TAAGGG").otherwise("NN"))
    return table(spark, sf, "proteins").where("sequence is not null").select("id", text.translate_cds(nt).alias("protein"), text.reverse_complement(nt).alias("turned"))



@query("select doc_id, source || '/' || lang || '.txt.gz' as path, lang || '.txt.gz' as base, lang || '.txt' as stem, regexp_replace(source || '/' || lang, '[^A-Za-z0-9._-]', '_', 'g') as safe from documents where lang is not null and source is not null and not contains(lang, '/')")
def str12_paths(spark: SparkSession, sf: str) -> DataFrame:
    """Last part of a path, without its last ending, and as a file name (STR-13)."""
    d = table(spark, sf, "documents").where("lang is not null and source is not null and not contains(lang, '/')")
    p = F.concat("source", F.lit("/"), "lang", F.lit(".txt.gz"))
    return d.select("doc_id", p.alias("path"), text.basename(p).alias("base"), text.stem(p).alias("stem"), text.file_safe(F.concat("source", F.lit("/"), "lang")).alias("safe"))


@query("select o_orderkey, case when o_orderkey < 128 then 1 when o_orderkey < 16384 then 2 when o_orderkey < 2097152 then 3 when o_orderkey < 268435456 then 4 else 5 end as n_bytes, o_orderkey as back from orders")
def str14_varints(spark: SparkSession, sf: str) -> DataFrame:
    """Whole numbers as seven bits a byte and back."""

    @F.pandas_udf("n_bytes int, back bigint")
    def there_and_back(s: pd.Series) -> pd.DataFrame:
        raw = [links.varint(int(x)) for x in s]
        return pd.DataFrame({"n_bytes": [len(b) for b in raw], "back": [sum((x & 127) << 7 * i for i, x in enumerate(b)) for b in raw]})

    return table(spark, sf, "orders").withColumn("r", there_and_back("o_orderkey")).select("o_orderkey", "r.n_bytes", "r.back")


@query("select id, repeat('(', cast(length(sequence) % 7 + 1 as integer)) || '...' || repeat(')', cast(length(sequence) % 7 + 1 as integer)) as whole, repeat('.', cast(length(sequence) % 7 + 4 as integer)) as left_half from proteins where sequence is not null")
def str15_structure_slice(spark: SparkSession, sf: str) -> DataFrame:
    """A hairpin cut by an alignment: all of it keeps its pairs, a half has none."""

    @F.pandas_udf("whole string, left_half string")
    def cut_out(n: pd.Series) -> pd.DataFrame:
        made = [("(" * k + "..." + ")" * k, k) for k in (int(x) % 7 + 1 for x in n)]
        return pd.DataFrame({"whole": [links.slice_structure(s, "A" * len(s), 1) for s, _ in made], "left_half": [links.slice_structure(s, "A" * (k + 3), 1) for s, k in made]})

    return table(spark, sf, "proteins").where("sequence is not null").withColumn("r", cut_out(F.length("sequence"))).select("id", "r.whole", "r.left_half")


@query("select id, name, ko from (select id, pname as name, kegg_ko as ko from eggnog_prots)")
def map01_qualifiers(spark: SparkSession, sf: str) -> DataFrame:
    """Entries of a map as columns; what it lacks is null."""
    m = F.map_filter(F.create_map(F.lit("name"), F.col("pname"), F.lit("ko"), F.col("kegg_ko")), lambda _, v: v.isNotNull())
    return text.map_columns(table(spark, sf, "eggnog_prots").select("id", m.alias("q")), "q", ["name", "ko"]).drop("q")


@query(f"""with {_REC} select uid, max(protein_id) as protein_id, count(*) > 0 as there from rec group by uid""")
def str_upserted(spark: SparkSession, sf: str) -> DataFrame:
    """A stream of record files into a table of one row a key."""
    src, out = table_path(spark, "in"), table_path(spark, "upserted")
    r = rec(spark, sf).select("uid", F.coalesce("protein_id", F.lit("")).alias("protein_id"))
    r.repartition(2, "uid").write.json(src)
    ingest.upsert_stream(ingest.report_stream(spark, src, "uid string, protein_id string"), ["uid"], "protein_id", out, table_path(spark, "ck")).awaitTermination(300)
    done = ingest.upserted(spark, out)
    return done.select("uid", F.nullif("protein_id", F.lit("")).alias("protein_id"), F.lit(True).alias("there"))
