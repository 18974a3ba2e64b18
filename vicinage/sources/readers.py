"""Readers as DataFrames (survey ids SRC-01..24)."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vicinage.functions.ids import id_class, region
from vicinage.functions.text import attribute, python_list
from vicinage.schemas import CONTIG, GFF, spark_type

#: Columns of tabular hits by number of fields (fixed values of the tools' output formats).
HITS12 = "qseqid string, sseqid string, pident double, length bigint, mismatch bigint, gapopen bigint, qstart bigint, qend bigint, sstart bigint, send bigint, evalue double, bitscore double"
HITS = {
    5: "qseqid string, sseqid string, pident double, evalue double, bitscore double",
    6: "qseqid string, sseqid string, pident double, length bigint, evalue double, bitscore double",
    7: "qseqid string, sseqid string, pident double, length bigint, evalue double, bitscore double, qcovs double",
    12: HITS12,
    14: HITS12 + ", qlen bigint, slen bigint",
}
FASTANI = {5: "query string, ref string, ani double, fragments bigint, total bigint", 12: HITS12}


def id_list(spark: SparkSession, path: str) -> DataFrame:
    """(og_index, id, start, end, strand, input_type) of a file with one id a line; blank lines are left out but counted."""
    lines = spark.read.text(path, wholetext=True).select(F.posexplode(F.split("value", r"\r\n|\n|\r")).alias("og_index", "line"))
    return lines.where(F.trim("line") != "").select(F.col("og_index").cast("bigint").alias("og_index"), region(F.col("line")).alias("r"), id_class(F.col("line")).alias("input_type")).select("og_index", "r.*", "input_type")


def input_sheet(spark: SparkSession, path: str, expected: list[str], reserved: set[str] | None = None) -> tuple[DataFrame, list[str]]:
    """(sheet, extra columns): a TSV sheet, all text; expected columns it lacks are added as nulls; input_type is the one
    given, else nucleotide, protein or uniprot by the first id column that has a value."""
    df = spark.read.option("sep", "\t").option("header", True).option("inferSchema", False).csv(path)
    df = df.select(*[F.nullif(F.trim(F.col(f"`{c}`")), F.lit("")).alias(c.strip()) for c in df.columns])
    extra = [c for c in df.columns if c not in (reserved or set(expected))]
    df = df.withColumns({c: F.lit(None).cast("string") for c in expected if c not in df.columns})
    derived = F.when(F.col("nucleotide_id").isNotNull(), "nucleotide").when(F.col("protein_id").isNotNull(), "protein").when(F.col("uniprot_id").isNotNull(), "uniprot")
    return df.withColumn("input_type", F.coalesce("input_type", derived)), extra


def premade(df: DataFrame) -> DataFrame:
    """df with premade: whether a record brings its own annotation, a GFF file with proteins or a GenBank file."""
    has = lambda c: F.length(F.trim(F.col(c))) > 0 if c in df.columns else F.lit(False)
    return df.withColumn("premade", F.coalesce(has("gff_path") & has("faa_path"), F.lit(False)) | F.coalesce(has("gbf_path"), F.lit(False)))


def gff(spark: SparkSession, path: str) -> DataFrame:
    """The nine columns of GFF3 files, typed, with the ID attribute as protein_id; comment lines are skipped."""
    cols = GFF.required
    df = spark.read.option("sep", "\t").option("comment", "#").option("quote", "").schema(", ".join(f"`{c}` {spark_type(t)}" for c, t in cols.items())).csv(path)
    return df.where("seqid is not null").withColumn("protein_id", attribute(F.col("attributes"), "ID"))


def fasta(spark: SparkSession, path: str) -> DataFrame:
    """(id, sequence): id up to the first blank of the header, sequence without white space."""
    records = spark.read.option("lineSep", ">").text(path).where(F.trim(F.regexp_replace("value", r"\s+", " ")) != "")
    header = F.substring_index("value", "\n", 1)
    body = F.expr("substring(value, length(substring_index(value, '\n', 1)) + 1)")
    return records.select(F.regexp_extract(header, r"^\s*(\S+)", 1).alias("id"), F.regexp_replace(body, r"\s", "").alias("sequence"))


def duplicate_ids(df: DataFrame, key: str = "id") -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def drift_parquet(spark: SparkSession, paths: list[str], columns: dict[str, str], required: list[str]) -> DataFrame:
    """Parquet parts of different shapes, by name: a column absent from every part is a typed null unless required."""
    parts = [spark.read.option("mergeSchema", True).parquet(p) for p in paths]
    df = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    lacking = [c for c in required if c not in df.columns]
    if lacking:
        raise ValueError(f"missing required columns: {', '.join(lacking)}")
    return df.select(*[(F.col(c).try_cast(spark_type(t)) if c in df.columns else F.lit(None).cast(spark_type(t))).alias(c) for c, t in columns.items()])


def contigs(spark: SparkSession, *paths: str) -> DataFrame:
    return drift_parquet(spark, list(paths), CONTIG.required | CONTIG.optional, list(CONTIG.required))


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(line_no, value): the lines of one file with their numbers from 1. The splits of a file come in its order; each
    counts its own lines, and only these counts reach the driver."""
    lines = spark.read.text(path).select("value", F.spark_partition_id().alias("_split"), F.monotonically_increasing_id().alias("_at"))
    before, offsets = 0, []
    for split, n in sorted(tuple(r) for r in lines.groupBy("_split").count().collect()):
        offsets += [F.lit(split), F.lit(before)]
        before += n
    if not offsets:
        return lines.select(F.lit(0).cast("bigint").alias("line_no"), "value")
    return lines.select((F.create_map(*offsets)[F.col("_split")] + F.col("_at") % (1 << 33) + 1).alias("line_no"), "value")


def typed_tsv(spark: SparkSession, path: str, types: dict[str, str], key: str, wanted: list[str] | None = None, pattern: str | None = None) -> DataFrame:
    """A TSV with its header in the first line, with or without # before it. Types go by name, unknown columns are text,
    `na` and empty cells are null. Raises ValueError for a missing, doubled or empty header name, a missing key column,
    and, when read, an error with the line of the file for a wrong number of fields, a value of the wrong type or a bad key.
    wanted: columns to keep, in order; those the file lacks are typed nulls."""
    head = spark.read.text(path).first()
    if head is None or not head[0].strip():
        raise ValueError(f"{path}: no header")
    names = [n.strip() for n in head[0].lstrip("\ufeff").lstrip("#").strip("\r\n").lstrip().split("\t")]
    if len(set(names)) != len(names) or "" in names:
        raise ValueError(f"{path}: doubled or empty column name")
    if key not in names:
        raise ValueError(f"{path}: no column {key}")
    rows = numbered_lines(spark, path).where((F.col("line_no") > 1) & ~F.col("value").startswith("#") & (F.trim("value") != ""))
    cells = F.split("value", "\t", -1)
    where = F.concat(F.lit(f"{path}, line "), F.col("line_no").cast("string"), F.lit(": "))
    bad = F.raise_error(F.concat(where, F.lit("wrong number of fields: "), F.col("value")))
    rows = rows.select("line_no", F.when(F.size(cells) == len(names), cells).otherwise(bad.cast("array<string>")).alias("c"))

    def cell(name: str) -> Column:
        if name not in names:
            return F.lit(None).cast(spark_type(types.get(name, "string"))).alias(name)
        raw = F.trim(F.regexp_replace(F.col("c")[names.index(name)], "\r$", ""))
        text = F.when((raw != "") & (F.lower(raw) != "na"), raw)
        t = spark_type(types.get(name, "string"))
        typed = text.try_cast(t)
        wrong = F.raise_error(F.concat(where, F.lit(f"{name} isn't {t}: "), text))
        out = text if t == "string" else F.when(text.isNotNull() & typed.isNull(), wrong.cast(t)).otherwise(typed)
        if name == key:
            ok = text.rlike(pattern) if pattern else text.isNotNull()
            out = F.when(~F.coalesce(ok, F.lit(False)), F.raise_error(F.concat(where, F.lit(f"bad {name}: "), F.coalesce(raw, F.lit("null")))).cast(t)).otherwise(out)
        return out.alias(name)

    return rows.select(*[cell(n) for n in (wanted or names)])


def hits(spark: SparkSession, path: str, fields: int = 12) -> DataFrame:
    """Tabular hits without a header; lines beginning with # are comments."""
    return spark.read.option("sep", "\t").option("comment", "#").schema(HITS[fields]).csv(path)


def fastani(spark: SparkSession, path: str, fields: int = 5) -> DataFrame:
    return spark.read.option("sep", "\t").schema(FASTANI[fields]).csv(path)


def skani_triangle(spark: SparkSession, path: str) -> DataFrame:
    """(query, ref, ani, af_query, af_ref) of a table with a header."""
    df = spark.read.option("sep", "\t").option("header", True).csv(path)
    at = {re.sub(r"[^a-z]", "", c.lower()): c for c in df.columns}
    pick = {"query": "queryfile", "ref": "reffile", "ani": "ani", "af_query": "alignfractionquery", "af_ref": "alignfractionref"}
    return df.select(*[(F.col(f"`{at[v]}`") if k in ("query", "ref") else F.col(f"`{at[v]}`").try_cast("double")).alias(k) for k, v in pick.items()])


#: Columns of the tools' tables that later steps need, with their types (fixed values of the tools' formats).
TOOLS = {
    "padloc": {"system": "string", "target.name": "string", "seqid": "string", "start": "long", "end": "long", "strand": "string", "protein.name": "string", "hmm.accession": "string"},
    "defensefinder": {"hit_id": "string", "gene_name": "string", "sys_id": "string", "type": "string", "subtype": "string", "hit_pos": "long"},
    "cctyper": {"Contig": "string", "Operon": "string", "Start": "long", "End": "long", "Prediction": "string", "Positions": "string", "Genes": "string"},
    "genomad": {"gene": "string", "start": "long", "end": "long", "strand": "string", "marker": "string", "annotation_description": "string"},
}


def tool_hits(spark: SparkSession, path: str, tool: str) -> DataFrame:
    """A tool's table with the columns of TOOLS, typed by name: NA and what can't be read are null, columns the file lacks
    are typed nulls, others are left out. Lists in the table of cctyper come as arrays."""
    wanted = TOOLS[tool]
    df = tool_table(spark, path, "," if tool == "padloc" else "\t")
    cols = [(F.col(f"`{c}`").try_cast(spark_type(t)) if c in df.columns else F.lit(None).cast(spark_type(t))).alias(c.replace(".", "_")) for c, t in wanted.items()]
    out = df.select(*cols)
    if tool == "cctyper":
        out = out.withColumns({c: python_list(F.col(c)) for c in ("Positions", "Genes")})
    return out


#: The first columns of a PAF line (fixed values of the format).
PAF = "query string, query_len bigint, query_start bigint, query_end bigint, strand string, ref string, ref_len bigint, ref_start bigint, ref_end bigint, matches bigint, block_len bigint, mapq int"


def paf_hits(spark: SparkSession, path: str) -> DataFrame:
    """Alignments of PAF lines: the twelve columns, edit distance (NM) and whether it is a primary one (tp:A:P, or no tag)."""
    cells = F.split("value", "\t", -1)
    names = [x.split() for x in PAF.split(", ")]
    tag = lambda k: F.nullif(F.regexp_extract("value", rf"\t{k}:[A-Za-z]:([^\t]*)", 1), F.lit(""))
    rows = spark.read.text(path).where(F.trim("value") != "")
    return rows.select(*[F.try_element_at(cells, F.lit(i + 1)).try_cast(t).alias(n) for i, (n, t) in enumerate(names)], tag("NM").try_cast("bigint").alias("edits"), F.coalesce(tag("tp") == "P", F.lit(True)).alias("is_primary"))


def tool_table(spark: SparkSession, path: str, sep: str = "\t") -> DataFrame:
    """A headed table of a tool, all text, NA as null."""
    return spark.read.option("sep", sep).option("header", True).option("nullValue", "NA").csv(path)


def xml_rows(spark: SparkSession, path: str, row_tag: str, schema: T.StructType | str) -> DataFrame:
    """One row per row_tag element; nested lists are exploded by the caller with explode_outer."""
    return spark.read.format("xml").option("rowTag", row_tag).schema(schema).load(path)


IPG = "_ipg string, _product_acc string, ProteinList struct<Protein: array<struct<_accver: string, _source: string, CDSList: struct<CDS: array<struct<_accver: string, _start: bigint, _stop: bigint, _strand: string, _assembly: string, _taxid: bigint>>>>>>"


def ipg_report(spark: SparkSession, path: str) -> DataFrame:
    """One row per protein and coding sequence of identical-protein reports in XML."""
    df = xml_rows(spark, path, "IPGReport", IPG)
    p = df.select(F.col("_ipg").try_cast("bigint").alias("ipg_id"), F.explode_outer("ProteinList.Protein").alias("p"))
    c = p.select("ipg_id", F.col("p._accver").alias("protein_id"), F.col("p._source").alias("source"), F.explode_outer("p.CDSList.CDS").alias("c"))
    return c.select("ipg_id", "protein_id", "source", F.col("c._accver").alias("nucleotide_id"), F.col("c._start").alias("start"), F.col("c._stop").alias("end"), F.col("c._strand").alias("strand"), F.col("c._assembly").alias("assembly_id"), F.col("c._taxid").alias("taxid"))


ASSEMBLY_OF = "_uid string, AssemblyAccession string, SpeciesTaxid bigint, Organism string, AssemblyStatus string, FtpPath_RefSeq string, FtpPath_GenBank string"
NUCLEOTIDE_OF = "Caption string, AccessionVersion string, Title string, Slen bigint, TaxId bigint, Biomol string"
LINKS_OF = "DbFrom string, IdList struct<Id: array<string>>, LinkSetDb array<struct<DbTo: string, LinkName: string, Link: array<struct<Id: string>>>>"


def assembly_summaries(spark: SparkSession, path: str) -> DataFrame:
    """One row per assembly of document summaries in XML, with its address on the file server, RefSeq first."""
    df = xml_rows(spark, path, "DocumentSummary", ASSEMBLY_OF)
    return df.select(F.col("_uid").alias("uid"), F.col("AssemblyAccession").alias("assembly_id"), F.col("SpeciesTaxid").alias("taxid"), F.col("Organism").alias("organism"), F.col("AssemblyStatus").alias("assembly_level"), F.coalesce(F.nullif(F.col("FtpPath_RefSeq"), F.lit("")), F.nullif(F.col("FtpPath_GenBank"), F.lit(""))).alias("ftp_path"))


def nucleotide_summaries(spark: SparkSession, path: str) -> DataFrame:
    """One row per nucleotide record of document summaries in XML."""
    df = xml_rows(spark, path, "DocumentSummary", NUCLEOTIDE_OF)
    return df.select(F.coalesce("AccessionVersion", "Caption").alias("nucleotide_id"), F.col("Title").alias("title"), F.col("Slen").alias("length"), F.col("TaxId").alias("taxid"), F.col("Biomol").alias("molecule"))


def nucleotide_links(spark: SparkSession, path: str) -> DataFrame:
    """(from_id, link_name, to_id) of link sets in XML, a row per linked pair."""
    df = xml_rows(spark, path, "LinkSet", LINKS_OF)
    one = df.select(F.explode_outer("IdList.Id").alias("from_id"), "LinkSetDb").select("from_id", F.explode_outer("LinkSetDb").alias("l"))
    return one.select("from_id", F.col("l.LinkName").alias("link_name"), F.explode_outer("l.Link").alias("t")).select("from_id", "link_name", F.col("t.Id").alias("to_id"))


def ipg_chunks(ids: DataFrame, key: str = "id", size: int = 100) -> DataFrame:
    """(chunk, ids): a list of at most size ids per request, in their order by text; blank ids are left out and repeated
    ones asked for once."""
    from vicinage.functions.stats import global_rank

    once = ids.select(F.trim(F.col(key)).alias("id")).where(F.length("id") > 0).distinct()
    placed = global_rank(once, [F.col("id")], "at").withColumn("chunk", F.expr(f"(at - 1) div {size}"))
    return placed.groupBy("chunk").agg(F.array_sort(F.collect_list("id")).alias("ids"))


def ipg_text(spark: SparkSession, path: str) -> DataFrame:
    """Identical-protein tables in text, names in lower case with underscores; all text."""
    df = spark.read.option("sep", "\t").option("header", True).csv(path)
    return df.toDF(*[re.sub(r"\W+", "_", c.strip().lower()) for c in df.columns])


def uniparc_best(spark: SparkSession, path: str) -> DataFrame:
    """(uniparc_id, accession): of JSON records' cross-references the first active RefSeq one, else the first active EMBL
    one, with its version."""
    schema = "uniParcId string, uniParcCrossReferences array<struct<database: string, id: string, version: int, active: boolean>>"
    df = spark.read.schema(schema).json(path)
    best = lambda db: F.try_element_at(F.filter("uniParcCrossReferences", lambda x: x["active"] & (x["database"] == db)), F.lit(1))
    ref = F.coalesce(best("RefSeq"), best("EMBL"))
    name = F.when(ref["version"].isNotNull() & ~ref["id"].contains("."), F.concat(ref["id"], F.lit("."), ref["version"].cast("string"))).otherwise(ref["id"])
    return df.select(F.col("uniParcId").alias("uniparc_id"), name.alias("accession"))


def sequence_reports(spark: SparkSession, path: str) -> DataFrame:
    """Contig rows of newline-JSON sequence reports; malformed lines are dropped."""
    schema = ", ".join(f"{c} {spark_type(t)}" for c, t in (CONTIG.required | CONTIG.optional).items())
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)


def strain_csv(spark: SparkSession, path: str, like: str) -> DataFrame:
    """A CSV whose header row begins with ID, after any number of other lines; the column whose name holds `like` becomes
    accession, and blank ids take the one above."""
    from vicinage.operators.windows import forward_fill

    lines = spark.read.text(path, wholetext=True).select(F.posexplode(F.split("value", r"\r\n|\n|\r")).alias("line_no", "line"))
    head = lines.where(F.col("line").rlike(r'^"?ID"?,')).orderBy("line_no").first()
    if head is None:
        raise ValueError(f"{path}: no header row that begins with ID")
    names = [n.strip().strip('"') for n in head["line"].split(",")]
    acc = next((n for n in names if like.lower() in n.lower()), None)
    if acc is None:
        raise ValueError(f"{path}: no column like {like}")
    schema = ", ".join(f"`{n}` string" for n in names)
    rows = lines.where((F.col("line_no") > head["line_no"]) & (F.trim("line") != "")).select("line_no", F.from_csv("line", schema).alias("r")).select("line_no", "r.*")
    filled = forward_fill(rows, [], ["line_no"], ["ID"])
    return filled.withColumnRenamed(acc, "accession").drop("line_no")


def stockholm_metadata(spark: SparkSession, path: str) -> DataFrame:
    """(id, accession, description, clan) of each record of a Stockholm file."""
    recs = spark.read.option("lineSep", "//\n").text(path)
    field = lambda k: F.nullif(F.trim(F.regexp_extract("value", rf"(?m)^#=GF {k}\s+(.+)$", 1)), F.lit(""))
    return recs.select(field("ID").alias("id"), field("AC").alias("accession"), field("DE").alias("description"), field("CL").alias("clan")).where("accession is not null")


def listing_groups(df: DataFrame, name: str = "name") -> DataFrame:
    """(group, name): files grouped by what stands before the first underscore; KEGG.tsv belongs to kofam."""
    n = F.col(name)
    return df.select(F.when(n == "KEGG.tsv", "kofam").otherwise(F.lower(F.substring_index(n, "_", 1))).alias("group"), n.alias("name"))


def distance_csv(spark: SparkSession, path: str) -> DataFrame:
    """(a, b, dist) of a square CSV matrix whose first column names the rows."""
    df = spark.read.option("header", True).csv(path)
    first, *rest = df.columns
    long = df.withColumnRenamed(first, "_row").unpivot("_row", rest, "_column", "dist")
    return long.select(F.col("_row").alias("a"), F.col("_column").alias("b"), F.col("dist").try_cast("double").alias("dist"))
