"""Command line: python -m vicinage.cli run | lengths, over Parquet tables."""

from __future__ import annotations

import argparse
from pathlib import Path

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from vicinage.functions.clean import bare_id, label
from vicinage.operators.taxonomy import lineages
from vicinage.plans import config, output, pipeline
from vicinage.sources import readers, sinks

#: Tables of the bundle that tools make.
MADE = ("domains", "domains_metadata", "ncrna_metadata")


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="vicinage")
    sub = p.add_subparsers(dest="what", required=True)
    run = sub.add_parser("run", help="records, gff, proteins and hits in a folder to the tables of the bundle")
    run.add_argument("tables")
    run.add_argument("out")
    run.add_argument("--config")
    for name, allowed in config.CHOICES.items():
        run.add_argument("--" + name.replace("_", "-"), choices=allowed)
    run.add_argument("--window", type=int)
    run.add_argument("--min-win", type=int)
    run.add_argument("--taxonomy", help="table of (taxid, parent), for the taxonomy tree")
    run.add_argument("--ranks", help="table of (taxid, rank, name), for the metadata of the leaves")
    run.add_argument("--ani", help="table of (query, ref, ani), for ani_tree")
    run.add_argument("--tree-file", help="Newick text, for use_input_tree")
    for name in MADE:
        run.add_argument("--" + name.replace("_", "-"), help=f"table {name} of the bundle, as a tool's reader gives it")
    lengths = sub.add_parser("lengths", help="assembly and length of nucleotide ids in a file, from contig tables")
    lengths.add_argument("ids")
    lengths.add_argument("out")
    lengths.add_argument("contigs", nargs="+")
    a = p.parse_args(argv)
    spark = SparkSession.builder.getOrCreate()
    if a.what == "lengths":
        found = nucleotide_lengths(readers.id_list(spark, a.ids), readers.contigs(spark, *a.contigs))
        sinks.write_tsv(found.coalesce(1), a.out, True)
        return
    read = lambda t: spark.read.parquet(f"{a.tables}/{t}.parquet")
    own = ("what", "tables", "out", "config", "taxonomy", "ranks", "ani", "tree_file", *MADE)
    given = {k: v for k, v in vars(a).items() if k not in own}
    more = {k: spark.read.parquet(getattr(a, k)) if getattr(a, k) else None for k in ("ranks", "ani")}
    more["lineages"] = lineages(spark.read.parquet(a.taxonomy)) if a.taxonomy else None
    more["newick"] = Path(a.tree_file).read_text(encoding="utf-8") if a.tree_file else None
    records = read("records").withColumn("uid", label("unique_id")).withColumn("nucleotide_id", label("nucleotide_id")).withColumn("is_query", F.coalesce("is_refseq_query", F.lit(False))).dropDuplicates(["uid"])
    gff = read("gff").where("seqid is not null").withColumn("id", label("id")).withColumn("seqid", label("seqid")).dropDuplicates(["id"])
    hits = read("hits").withColumn("qseqid", bare_id("qseqid")).withColumn("sseqid", bare_id("sseqid"))
    done = pipeline.run(records, gff, read("proteins").withColumn("id", label("id")), hits, config.load(a.config, **given), **more)
    made = {k: spark.read.parquet(getattr(a, k)) for k in MADE if getattr(a, k)}
    output.write(done, hits, a.out, made | ({"nucleotide_links": more["ani"]} if more["ani"] is not None else {}))


def nucleotide_lengths(ids, contigs):  # noqa: ANN001, ANN201
    """(id, assembly, length) in the order of the ids: GenBank ids pair a GCA assembly and RefSeq ids a GCF one; ids
    without a match keep nulls. The OR over both accessions is a union of two semi joins."""
    wanted = ids.select("og_index", "id")
    refseq = F.col("id").rlike("^[A-Z]{2}_")
    by = lambda c, prefix: contigs.where(F.col("assemblyAccession").startswith(prefix)).select(F.col(c).alias("id"), F.col("assemblyAccession").alias("assembly"), "length").where("id is not null")
    gb, rs = by("genbankAccession", "GCA_"), by("refseqAccession", "GCF_")
    found = wanted.where(~refseq).join(gb, "id").unionByName(wanted.where(refseq).join(rs, "id"))
    best = found.groupBy("og_index").agg(F.min(F.struct("assembly", "length")).alias("b"))
    return wanted.join(best, "og_index", "left").orderBy("og_index").select("id", F.col("b.assembly").alias("assembly"), F.col("b.length").alias("length"))


if __name__ == "__main__":
    main()
