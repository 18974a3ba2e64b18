"""Identifier classes, prefixes and regions as column expressions (survey ids FLT-01, FLT-02, SRC-01)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns of public accession formats, tried in this order (fixed values).
UNIPARC = r"^UPI[0-9A-Fa-f]{10}$"
UNIPROT = r"^([OPQ][0-9][A-Z0-9]{3}[0-9]|[A-NR-Z][0-9]([A-Z][A-Z0-9]{2}[0-9]){1,2})$"
NUCLEOTIDE = (r"^(NC|NG|NM|NR|NT|NW|NZ|AC|AP|MT|PP|OR|OZ|LR|LN|KX)_[A-Z]*[0-9]+(\.[0-9]+)?$", r"^[A-Z]{1,2}[0-9]{5,8}(\.[0-9]+)?$", r"^[A-Z]{4,6}[0-9]{8,}(\.[0-9]+)?$")
PROTEIN = (r"^WP_[0-9]{9}(\.[0-9]+)?$", r"^(NP|XP|YP|ZP)_[0-9]{6,9}(\.[0-9]+)?$", r"^[A-Z]{3}[0-9]{5,8}(\.[0-9]+)?$")
REFSEQ = r"^[A-Z]{2}_"


def id_class(c: Column) -> Column:
    """uniparc, uniprot, nucleotide, protein or unmatched; the part before a colon decides, the first match wins."""
    t = F.substring_index(F.trim(c), ":", 1)
    any_of = lambda ps: F.greatest(*[t.rlike(p) for p in ps])
    out = F.when(t.rlike(UNIPARC), "uniparc").when(t.rlike(UNIPROT), "uniprot").when(any_of(NUCLEOTIDE), "nucleotide").when(any_of(PROTEIN), "protein")
    return F.when(c.isNotNull(), out.otherwise("unmatched"))


def region(c: Column) -> Column:
    """struct(id, start, end, strand) of ID:start-end; a turned-round region swaps its ends and lies on the - strand;
    without a region start, end and strand are null."""
    pattern = r"^([^:]+):([0-9]+)-([0-9]+)$"
    part = lambda i: F.nullif(F.regexp_extract(F.trim(c), pattern, i), F.lit(""))
    a, b = part(2).try_cast("bigint"), part(3).try_cast("bigint")
    return F.struct(F.coalesce(part(1), F.trim(c)).alias("id"), F.least(a, b).alias("start"), F.greatest(a, b).alias("end"), F.when(a > b, "-").when(a.isNotNull(), "+").alias("strand"))


def is_refseq(c: Column) -> Column:
    return c.rlike(REFSEQ)


def fit_prefix(assembly: Column, nucleotide: Column) -> Column:
    """The assembly id with the prefix its nucleotide asks for: GCF_ for RefSeq records, GCA_ for others."""
    core = F.substr(assembly, F.lit(5))
    known = assembly.rlike(r"^GC[AF]_")
    return F.when(known & is_refseq(nucleotide), F.concat(F.lit("GCF_"), core)).when(known & ~is_refseq(nucleotide), F.concat(F.lit("GCA_"), core)).otherwise(assembly)


def assembly_core(c: Column) -> Column:
    """Without the GCA_ or GCF_ that tells two copies of an assembly apart."""
    return F.regexp_replace(c, r"^GC[AF]_", "")


def unversioned(c: Column) -> Column:
    return F.regexp_replace(c, r"\.[0-9]+$", "")
