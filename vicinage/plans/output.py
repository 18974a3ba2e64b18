"""The tables that a run leaves (SNK-01, SNK-09, FLT-14, FLT-17)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vicinage.plans.pipeline import Result
from vicinage.schemas import select_existing
from vicinage.sources import sinks

#: Columns of tables that a run has no rows for (fixed values).
EMPTY = {
    "gff": "seqid string, type string, start bigint, end bigint, id string, protein_id string",
    "hoods": "hood_id string, seqid string, start bigint, end bigint",
    "protein_metadata": "id string, uid string, fam_cluster bigint",
    "tree_metadata": "unique_id string, taxid string",
    "domains": "protein_id string, domain_id string, start bigint, end bigint, bit_score double, e_value string, cov double",
    "domains_metadata": "domain_id string, description string",
    "ncrna_metadata": "seqid string, name string, type string, start bigint, end bigint, score double, structure string",
    "nucleotide_links": "query string, ref string, ani double",
    "protein_links": "qseqid string, sseqid string, pident double, evalue double, bitscore double",
}


def bundle(done: Result, hits: DataFrame, given: dict[str, DataFrame] | None = None) -> dict[str, DataFrame]:
    """The tables of the bundle by name. given: tables that tools made (domains, domains_metadata, ncrna_metadata,
    nucleotide_links), which are limited to what lies in the neighbourhoods kept if they say where they lie."""
    kept = done.neighbourhoods.where("failed is null")
    hoods = kept.select(F.col("uid").alias("hood_id"), "seqid", F.col("start_win").alias("start"), F.col("end_win").alias("end"), *[c for c in ("start_target", "end_target", "strand", "taxid") if c in kept.columns])
    own = done.proteins.select("id").distinct()
    ends = lambda c: own.withColumnRenamed("id", c)
    links = hits.join(ends("qseqid"), "qseqid", "left_semi").join(ends("sseqid"), "sseqid", "left_semi").where("qseqid <> sseqid")
    out = {
        "gff": done.gff,
        "hoods": hoods,
        "protein_metadata": done.proteins.drop("sequence"),
        "protein_links": select_existing(links, ["qseqid", "sseqid", "pident", "length", "evalue", "bitscore"]),
    }
    if done.tree_metadata is not None:
        out["tree_metadata"] = done.tree_metadata
    for name, df in (given or {}).items():
        if name not in sinks.BUNDLE:
            raise ValueError(f"no table {name} in the bundle")
        if "protein_id" in df.columns:
            df = df.join(own.withColumnRenamed("id", "protein_id"), "protein_id", "left_semi")
        elif "seqid" in df.columns:
            df = df.join(kept.select("seqid").distinct(), "seqid", "left_semi")
        out[name] = df
    return out


def write(done: Result, hits: DataFrame, out: str, given: dict[str, DataFrame] | None = None) -> None:
    """The nine tables as Parquet and TSV, the run's own tables as TSV without sequences, the similarity and the tree."""
    spark = done.records.sparkSession
    sinks.write_bundle(bundle(done, hits, given), out, EMPTY, spark)
    sinks.write_run_table(done.records, f"{out}/records.tsv")
    sinks.write_run_table(done.neighbourhoods, f"{out}/all_neigh.tsv")
    sinks.write_parquet(done.similarity, f"{out}/similarity.parquet")
    if done.tree:
        spark.createDataFrame([(done.tree,)], "newick string").coalesce(1).write.mode("overwrite").text(f"{out}/tree.nwk")
