"""Similarity of proteomes from pairwise hits and shared families (ALG-10, ALG-14..18, AGG-02..06, JN-11..13, JN-21)."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vicinage.functions.stats import Tails, adjusted, score
from vicinage.operators.enrich import unambiguous
from vicinage.operators.pairs import sharing
from vicinage.session import cut


def annotate_hits(hits: DataFrame, genomes: DataFrame) -> DataFrame:
    """(qseqid, sseqid, pident, q_genome, s_genome): the best hit per pair of proteins of different genomes.

    genomes: (id, genome), distinct; a protein of several genomes counts in each. Hits of unknown proteins and within a
    genome are left out.
    """
    best = hits.where("qseqid <> sseqid").groupBy("qseqid", "sseqid").agg(F.max("pident").alias("pident")).where("pident is not null")
    q, s = (genomes.select(F.col("id").alias(f"{x}seqid"), F.col("genome").alias(f"{x}_genome")) for x in "qs")
    return best.join(q, "qseqid").join(s, "sseqid").where("q_genome <> s_genome")


def _top(df: DataFrame, by: list[str], then: Column) -> DataFrame:
    """One row per key by pident, then `then`; kept by a maximum, which sums up before the shuffle, not by a window."""
    rest = [c for c in df.columns if c not in by]
    best = df.groupBy(*by).agg(F.min(F.struct((-F.col("pident")).alias("_p"), then.alias("_t"), *rest)).alias("b"))
    return best.select(*by, *[F.col(f"b.{c}").alias(c) for c in rest])


def reciprocal_best(ann: DataFrame) -> DataFrame:
    """Hits that are the query's best in the other genome and whose reverse is the subject's best in the query's, per pair
    of genomes; ties: the smaller id."""
    forward = _top(ann, ["qseqid", "q_genome", "s_genome"], F.col("sseqid"))
    back = forward.select(*[F.col(x).alias(y) for x, y in (("sseqid", "qseqid"), ("qseqid", "sseqid"), ("s_genome", "q_genome"), ("q_genome", "s_genome"))])
    return forward.join(back, ["qseqid", "sseqid", "q_genome", "s_genome"], "left_semi")


def proteome_sizes(genomes: DataFrame) -> DataFrame:
    return genomes.where("genome is not null and id is not null").groupBy("genome").agg(F.countDistinct("id").alias("n"))


def repertoire_similarity(rbh: DataFrame, sizes: DataFrame) -> DataFrame:
    """(q_genome, s_genome, wgrr, aai, n_rbh, rbh_frac_min) per ordered pair of genomes: summed identity over the smaller
    proteome, between 0 and 1; mean identity; number of pairs, and their share of the smaller proteome."""
    pair = rbh.groupBy("q_genome", "s_genome").agg(F.sum(F.col("pident") / 100).alias("total"), F.avg("pident").alias("aai"), F.count(F.lit(1)).alias("n_rbh"))
    q, s = (sizes.select(F.col("genome").alias(f"{x}_genome"), F.col("n").alias(f"n{x}")) for x in "qs")
    least = F.least("nq", "ns")
    return pair.join(q, "q_genome").join(s, "s_genome").select("q_genome", "s_genome", F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.col("total") / least)).alias("wgrr"), "aai", "n_rbh", (F.col("n_rbh") / least).alias("rbh_frac_min"))


def shared_families(members: DataFrame, max_df_frac: float = 0.2, min_shared: int = 2, method: str | None = "BH", sizes: bool = True) -> DataFrame:
    """(a, b, k, k_a, k_b, m[, pval, p_adj, score]) per pair of genomes a < b sharing at least min_shared families;
    without a method and sizes (a, b, k), so that no more than these leaves the tasks.

    members: (genome, family). Families in more than ceil(max_df_frac * genomes) genomes are left out first, which also
    bounds the pairs there can be.
    """
    once = cut(members.where("genome is not null and family is not null").distinct(), "once")
    n = once.select("genome").distinct().count()
    most = -(-round(n * max_df_frac * 10**9) // 10**9)
    df = once.groupBy("family").agg(F.count(F.lit(1)).alias("df")).where(F.col("df") <= most)
    m = df.count()
    kept = once.join(df.select("family"), "family", "left_semi")

    tails = Tails(m)

    def finish(k, _, k_a, k_b):  # noqa: ANN001, ANN202
        k, k_a, k_b = (x.astype(np.int64, copy=False) for x in (k, k_a, k_b))
        if bare:
            return slice(None), {"k": k}
        return slice(None), {"k": k, "k_a": k_a, "k_b": k_b} | ({"pval": tails(k_a, k_b, k)} if method else {})

    bare = method is None and not sizes
    bonferroni = method is not None and method.upper() == "BONFERRONI"
    out = sharing(kept.select(F.col("genome").alias("id"), F.col("family").alias("item")), finish, "k bigint" + ("" if bare else ", k_a bigint, k_b bigint") + (", pval double" if method else ""), min_shared, counted=bonferroni)
    out, tests = out if bonferroni else (out, None)
    if bare:
        return out
    out = out.withColumn("m", F.lit(m).cast("bigint"))
    if method is None:
        return out.select("a", "b", "k", "k_a", "k_b", "m")
    # every pair is a test, so that the pairs needn't be written before they are corrected by their number
    out = out.withColumn("p_adj", F.least(F.lit(1.0), F.col("pval") * tests)) if bonferroni else adjusted(out, "pval", ["a", "b"], method)
    return out.withColumn("score", score(F.col("p_adj"))).select("a", "b", "k", "k_a", "k_b", "m", "pval", "p_adj", "score")


def unordered_mean(df: DataFrame, a: str, b: str, values: list[str]) -> DataFrame:
    """(a, b, values) with a < b: means over both directions of a pair."""
    return df.where(F.col(a) != F.col(b)).groupBy(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).agg(*[F.avg(v).alias(v) for v in values])


def owned_by(df: DataFrame, name: str, exact: DataFrame, contigs: DataFrame, out: str) -> DataFrame:
    """df with the uid that owns a sequence name: an exact window name first, else a contig that only one uid has.

    exact: (temp_seqid, uid); contigs: (seqid, uid), any number of rows.
    """
    e = unambiguous(exact, "temp_seqid", "uid").select(F.col("temp_seqid").alias(name), F.col("uid").alias("_exact"))
    c = unambiguous(contigs, "seqid", "uid").select(F.col("seqid").alias(name), F.col("uid").alias("_contig"))
    return df.join(e, name, "left").join(c, name, "left").withColumn(out, F.coalesce("_exact", "_contig")).drop("_exact", "_contig")


def subset_ids(mode: str, genes: DataFrame, targets: DataFrame, width: int = 0, unit: str = "win_nts") -> DataFrame:
    """Protein ids used for similarity: the targets (target_prot), what lies in the target region (target_region), or
    that region widened (window) by positions, or by genes from its least to its greatest gene index.

    genes: (uid, id, start, end, gene_index); targets: (uid, target_prot, start_target, end_target).
    """
    if mode == "target_prot":
        return targets.select("uid", F.col("target_prot").alias("id")).where("id is not null").distinct()
    j = genes.join(targets, "uid")
    inside = j.where("start >= start_target and end <= end_target")
    if mode == "target_region":
        return inside.select("uid", "id").distinct()
    if unit == "win_nts":
        return j.where((F.col("start") >= F.greatest(F.lit(0), F.col("start_target") - width)) & (F.col("end") <= F.col("end_target") + width)).select("uid", "id").distinct()
    span = inside.groupBy("uid").agg(F.min("gene_index").alias("lo"), F.max("gene_index").alias("hi"))
    return genes.join(span, "uid").where((F.col("gene_index") >= F.col("lo") - width) & (F.col("gene_index") <= F.col("hi") + width)).select("uid", "id").distinct()


def reverse_total(df: DataFrame) -> DataFrame:
    """(query, ref, fragments, total) with the total of the reverse direction where the own one is missing."""
    back = df.select(F.col("ref").alias("query"), F.col("query").alias("ref"), F.col("total").alias("_back"))
    return df.join(back, ["query", "ref"], "left").withColumn("total", F.coalesce("total", "_back")).drop("_back")


def best_by_score(df: DataFrame, key: str, value: str, tie: str) -> DataFrame:
    w = W.partitionBy(key).orderBy(F.col(value).desc_nulls_last(), tie)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")
