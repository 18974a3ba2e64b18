"""Tables of annotation tools in one form (ALG-32..40, SET-05, JN-15..19, AGG-05, AGG-07, ARR-01, ARR-02)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vicinage.functions.text import python_list, scientific
from vicinage.operators.enrich import first_by


def best_hits(hits: DataFrame, query: str = "qseqid", score: str = "bitscore", target: str = "sseqid") -> DataFrame:
    """One hit per query by score; ties: the smaller target. A grouped maximum, no window."""
    rest = [c for c in hits.columns if c != query]
    best = hits.groupBy(query).agg(F.min(F.struct(F.coalesce(-F.col(score), F.lit(float("inf"))).alias("_s"), F.col(target).alias("_t"), *rest)).alias("b"))
    return best.select(query, *[F.col(f"b.{c}").alias(c) for c in rest])


def explode_list(df: DataFrame, col: str, sep: str = ",", name: str = "item") -> DataFrame:
    """One row per part of a list that isn't blank; df without the list column."""
    parts = F.filter(F.transform(F.split(F.coalesce(F.col(col), F.lit("")), sep), lambda x: F.trim(x)), lambda x: x != "")
    return df.withColumn(name, F.explode(parts)).drop(col)


def deepest_group(hits: DataFrame, prots: DataFrame, groups: DataFrame) -> DataFrame:
    """(qseqid, og, depth, description): per query the deepest group of its best hit; ties: the smaller og.

    prots: (name, ogs); groups: (og, depth, description). Only the ids of best hits are exploded.
    """
    best = best_hits(hits)
    named = prots.join(best.select(F.col("sseqid").alias("name")).distinct(), "name", "left_semi")
    ogs = explode_list(named.select("name", "ogs"), "ogs", ",", "og")
    j = best.select("qseqid", F.col("sseqid").alias("name")).join(ogs, "name").join(groups, "og")
    return first_by(j, ["qseqid"], [F.col("depth").desc_nulls_last(), F.col("og").asc_nulls_last()]).select("qseqid", "og", "depth", "description")


def shift(df: DataFrame, windows: DataFrame, name: str = "temp_seqid", offset: int = 0) -> DataFrame:
    """Local coordinates of tool hits on their contig: start_win added; hits of unknown windows keep null coordinates."""
    w = windows.select(F.col("temp_seqid").alias(name), "seqid", "start_win")
    lo, hi = F.least("start", "end"), F.greatest("start", "end")
    return df.join(w, name, "left").withColumn("_lo", lo + F.col("start_win") + offset).withColumn("end", hi + F.col("start_win") + offset).withColumn("start", F.col("_lo")).drop("_lo", "start_win")


def as_features(df: DataFrame, source: str, kind: Column, attributes: Column, strand: Column | None = None, score: Column | None = None) -> DataFrame:
    """Rows of a tool as GFF features; coordinates in order, text score and phase."""
    dot = F.lit(".")
    return df.select("seqid", F.lit(source).alias("source"), kind.alias("type"), F.least("start", "end").alias("start"), F.greatest("start", "end").alias("end"), F.coalesce(score.cast("string") if score is not None else dot, dot).alias("score"), F.coalesce(strand if strand is not None else dot, dot).alias("strand"), dot.alias("phase"), attributes.alias("attributes"))


def mobile_spans(genes: DataFrame) -> DataFrame:
    """(seqid, label, start, end): span of each mobile element from its genes. A gene id is the element's with _number at
    its end; a provirus part behind a bar is left out of the contig name."""
    element = F.regexp_replace("gene", r"_[^_]+$", "")
    return genes.select(F.substring_index(element, "|", 1).alias("seqid"), "label", "start", "end").groupBy("seqid", "label").agg(F.min("start").alias("start"), F.max("end").alias("end"))


def defence_gene(c: Column) -> Column:
    """Cas genes up to the first underscore; others the part after a double underscore, if there is one."""
    return F.when(c.startswith("Cas"), F.substring_index(c, "_", 1)).when(c.contains("__"), F.substring_index(c, "__", -1)).otherwise(c)


def operon_members(operons: DataFrame, genes: DataFrame) -> DataFrame:
    """(operon, contig, position, gene, protein_id): operons hold lists of positions and genes as Python text; each entry
    finds its protein by (contig, position). Both lists are taken in step; unknown positions have no protein."""
    zipped = F.arrays_zip(python_list(F.col("genes")).alias("gene"), F.transform(python_list(F.regexp_replace("positions", r"(\d+)", "'$1'")), lambda x: x.cast("int")).alias("position"))
    rows = operons.select("operon", "contig", F.explode(zipped).alias("z")).select("operon", "contig", F.col("z.position").alias("position"), F.col("z.gene").alias("gene"))
    return rows.join(genes.select("contig", "position", "protein_id"), ["contig", "position"], "left")


def domain_metadata(hits: DataFrame, lengths: DataFrame, meta: DataFrame) -> DataFrame:
    """Hits with their coverage of the protein and the metadata of their unversioned domain."""
    key = F.regexp_replace("domain_id", r"\.[0-9]+$", "")
    j = hits.withColumn("domain_key", key).join(lengths, "protein_id", "left").join(meta, "domain_key", "left")
    return j.withColumn("cov", (F.col("end") - F.col("start") + 1) / F.col("target_len"))


def tidy_domains(df: DataFrame) -> DataFrame:
    """(protein_id, domain_id, start, end, bit_score, e_value, cov): complete rows only, floats of two digits, e-values as
    scientific text."""
    alias = lambda *names: F.coalesce(*[F.col(n) for n in names if n in df.columns])
    out = df.select(alias("protein_id", "target_name").alias("protein_id"), alias("domain_id_clean", "domain_id").alias("domain_id"), F.col("start").try_cast("bigint").alias("start"), F.col("end").try_cast("bigint").alias("end"), F.round(F.col("bit_score").try_cast("double"), 2).alias("bit_score"), scientific(F.col("e_value").try_cast("double")).alias("e_value"), F.round(F.col("cov").try_cast("double"), 2).alias("cov"))
    return out.dropna(subset=["protein_id", "domain_id", "start", "end"])


def ncrna_metadata(df: DataFrame) -> DataFrame:
    """The ten columns of ncRNA rows, typed, null where a tool doesn't give them."""
    want = {"seqid": "string", "name": "string", "type": "string", "start": "bigint", "end": "bigint", "strand": "string", "score": "double", "e_value": "double", "structure": "string", "source": "string"}
    return df.select(*[(F.col(c).try_cast(t) if c in df.columns else F.lit(None).cast(t)).alias(c) for c, t in want.items()])


def to_uniprot(ids: DataFrame, given: DataFrame, mapping: DataFrame) -> DataFrame:
    """(id, uniprot): the accession given with the input, else the database's for a RefSeq or EMBL protein id; the OR is
    two equi joins. given: (id, uniprot); mapping: (uniprot, refseq, embl)."""
    both = mapping.select(F.col("refseq").alias("id"), F.col("uniprot").alias("u"), F.lit(0).alias("p")).unionByName(mapping.select(F.col("embl").alias("id"), F.col("uniprot").alias("u"), F.lit(1).alias("p"))).where("id is not null")
    found = both.groupBy("id").agg(F.min(F.struct("p", "u")).alias("b")).select("id", F.col("b.u").alias("_db"))
    own = given.where("uniprot is not null").groupBy("id").agg(F.min("uniprot").alias("_own"))
    return ids.select("id").distinct().join(own, "id", "left").join(found, "id", "left").select("id", F.coalesce("_own", "_db").alias("uniprot"))


def tool_ids(df: DataFrame) -> DataFrame:
    """Rows with the synthetic name a tool gets, id-uid-start, one per name; the smaller sequence of equal names."""
    named = df.withColumn("tool_id", F.concat("id", F.lit("-"), F.col("uid").cast("string"), F.lit("-"), F.col("start").cast("string")))
    return named.where("tool_id is not null").groupBy("tool_id").agg(F.min("sequence").alias("sequence"))
