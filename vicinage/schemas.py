"""Table schemas: required and optional columns, lenient casts (survey id FLT-13, section 1.3)."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_TYPES = {"long": "bigint", "bool": "boolean"}


def spark_type(t: str) -> str:
    return _TYPES.get(t, t)


@dataclass(frozen=True)
class TableSchema:
    name: str
    required: dict[str, str]
    optional: dict[str, str] = field(default_factory=dict)

    def enforce(self, df: DataFrame, allow_extra: bool = True) -> DataFrame:
        """df with known columns cast, values that can't be cast being null; ValueError if a required column is missing."""
        lacking = [c for c in self.required if c not in df.columns]
        if lacking:
            raise ValueError(f"{self.name}: missing required columns: {', '.join(lacking)}")
        known = self.required | self.optional
        return df.select(*[lenient(F.col(f"`{c}`"), known[c]).alias(c) if c in known else F.col(f"`{c}`") for c in df.columns if c in known or allow_extra])


def lenient(c: Column, kind: str) -> Column:
    """Cast that gives null instead of an error; booleans also from yes/no, y/n, t/f and 1/0."""
    if kind == "bool":
        t = F.lower(F.trim(c.cast("string")))
        return F.when(t.isin("true", "1", "yes", "y", "t"), True).when(t.isin("false", "0", "no", "n", "f"), False)
    return c.try_cast(spark_type(kind))


def _text(*names: str) -> dict[str, str]:
    return dict.fromkeys(names, "string")


RECORDS = TableSchema("records", {"og_index": "long", "input_type": "string"}, _text("protein_id", "nucleotide_id", "uniprot_id", "failed_reason", "gff_path", "faa_path", "fna_path", "strand", "gbf_path", "assembly_id", "dive_id", "collection_id", "dive_type") | {"failed": "bool", "start": "long", "end": "long", "taxid": "long", "premade": "bool", "is_full_contig": "bool"})
PROTEINS = TableSchema("proteins", _text("id", "sequence"), _text("protein_id", "target_prot", "target_nuc", "fam_cluster", "product", "attributes", "unique_id"))
NEIGHBORHOODS = TableSchema("neighborhoods", {"seqid": "string", "start_win": "long", "end_win": "long", "sequence": "string", "unique_id": "string"}, {"start_target": "long", "end_target": "long", "target_prot": "string", "temp_seqid": "string", "strand_win": "string", "is_full_contig": "bool"})
GFF = TableSchema("gff", {"seqid": "string", "source": "string", "type": "string", "start": "long", "end": "long", "score": "string", "strand": "string", "phase": "string", "attributes": "string"}, _text("id", "protein_id"))
PAIRWISE_AA = TableSchema("pairwise_aa", {"qseqid": "string", "sseqid": "string", "pident": "double"}, {"length": "long", "evalue": "double", "bitscore": "double"})
PAIRWISE_NT = TableSchema("pairwise_nt", {"query": "string", "ref": "string", "ani": "double", "query_start": "long", "query_end": "long", "ref_start": "long", "ref_end": "long"})
TREE_META = TableSchema("tree_meta", {"leaf_id": "string"}, {"taxon": "string"})
CONTIG = TableSchema("contig", {"assemblyAccession": "string", "length": "long"}, _text("genbankAccession", "refseqAccession"))


def select_existing(df: DataFrame, names: list[str]) -> DataFrame:
    return df.select(*[n for n in names if n in df.columns])


def ensure_columns(df: DataFrame, types: dict[str, str]) -> DataFrame:
    return df.withColumns({c: F.lit(None).cast(spark_type(t)) for c, t in types.items() if c not in df.columns})


def rename_if_present(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed({a: b for a, b in names.items() if a in df.columns})


def first_alias(df: DataFrame, aliases: list[str]) -> str | None:
    """The first of several names that df has."""
    return next((a for a in aliases if a in df.columns), None)


#: Other names of columns in tables that users bring (fixed values).
ALIASES = {
    "prot_id": ["prot_id", "protein_id", "id", "gene_id"],
    "target_nuc": ["target_nuc", "nucleotide_id", "seqid", "contig"],
    "family": ["family", "fam_cluster", "cluster", "fam"],
}


def by_alias(df: DataFrame, wanted: list[str], first: dict[str, str] | None = None) -> DataFrame:
    """The wanted columns under their own names, each from the first of its other names that df has; `id` goes before
    `protein_id` where both are there. ValueError if df has none of them."""
    out = []
    for name in wanted:
        names = ALIASES.get(name, [name])
        if name == "prot_id" and "id" in df.columns and name not in df.columns:
            names = ["id", *names]
        found = (first or {}).get(name) or first_alias(df, names)
        if found is None:
            raise ValueError(f"no column for {name}: {', '.join(names)}")
        out.append(F.col(f"`{found}`").alias(name))
    return df.select(*out)


def extra_columns(df: DataFrame, reserved: set[str]) -> list[str]:
    return [c for c in df.columns if c not in reserved and not c.startswith("_")]
