"""Genomic windows around targets and what lies in them (ALG-01..06, ALG-08, FLT-07..09, WIN-01..09, JN-14, AGG-14)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vicinage.operators.coverage import coverage
from vicinage.operators.sweep import BIN, numbered

def gene_index(df: DataFrame, seqid: str = "seqid", order: list[str] | None = None, name: str = "gene_index") -> DataFrame:
    """Place of each feature on its contig, from 0, in a total order that begins with a position; a whole chromosome is
    numbered bin by bin."""
    return numbered(df, [seqid], order or ["start", "end", "id"], name)


def windows_by_distance(targets: DataFrame, width: int) -> DataFrame:
    """targets (uid, seqid, start, end, sequence_length) with start_win, end_win: width positions to either side, not
    beyond the contig's known ends."""
    up = F.col("end") + width
    return targets.withColumn("start_win", F.greatest(F.lit(0), F.col("start") - width)).withColumn("end_win", F.when(F.col("sequence_length").isNull(), up).otherwise(F.least(up, F.col("sequence_length"))))


def windows_by_rows(features: DataFrame, targets: DataFrame, n: int, order: list[str] | None = None) -> DataFrame:
    """(uid, seqid, start_win, end_win, n_features): the span of the n features before to n after the target feature.

    targets: (uid, seqid, target_id). Features are numbered along the contig, and a target meets those of the blocks of
    numbers its span touches, so a chromosome is spread over its blocks.
    """
    block = max(1024, n)
    g = gene_index(features.select("seqid", "id", "start", "end", *[c for c in order or [] if c not in ("seqid", "id", "start", "end")]), order=order, name="_i").select("seqid", "id", "start", "end", "_i")
    placed = targets.select("uid", "seqid", "target_id").join(g.select("seqid", F.col("id").alias("target_id"), F.col("_i").alias("_at")), ["seqid", "target_id"])
    spread = placed.withColumn("_block", F.explode(F.sequence(F.expr(f"greatest(0, _at - {n}) div {block}"), F.expr(f"(_at + {n}) div {block}"))))
    near = spread.join(g.select(F.col("seqid").alias("_seqid"), "start", "end", "_i"), (F.col("seqid") == F.col("_seqid")) & (F.col("_block") == F.expr(f"_i div {block}")) & (F.abs(F.col("_i") - F.col("_at")) <= n))
    return near.groupBy("uid", "seqid", "_at").agg(F.min("start").alias("start_win"), F.max("end").alias("end_win"), F.count(F.lit(1)).alias("n_features")).drop("_at")


def contained(features: DataFrame, windows: DataFrame, bin_width: int = BIN) -> DataFrame:
    """Features wholly inside a window on their contig: an equi join on (contig, bin of the feature's start).

    windows: (uid, seqid, start_win, end_win); each is repeated for the bins it spans. A contig of a third of all
    features is spread over its bins.
    """
    f = features.withColumn("_bin", F.expr(f"start div {bin_width}"))
    w = windows.select("uid", F.col("seqid").alias("_seqid"), "start_win", "end_win", F.explode(F.sequence(F.expr(f"start_win div {bin_width}"), F.expr(f"end_win div {bin_width}"))).alias("_wbin"))
    cond = (F.col("seqid") == F.col("_seqid")) & (F.col("_bin") == F.col("_wbin")) & (F.col("start") >= F.col("start_win")) & (F.col("end") <= F.col("end_win"))
    return f.join(w, cond).drop("_bin", "_wbin", "_seqid")


def resolve_contigs(features: DataFrame, wanted: DataFrame) -> DataFrame:
    """(uid, seqid, error): the contig of each query (uid, source, seqid or null, protein_id or null).

    A named contig must exist. Without a name the protein must lie on one contig only, or the source must have one.
    Errors are data: seqid is null then.
    """
    contigs = features.select("source", "seqid").where("seqid is not null").distinct()
    one = contigs.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.min("seqid").alias("only"))
    prot = features.where("protein_id is not null and seqid is not null").groupBy("source", "protein_id").agg(F.countDistinct("seqid").alias("np"), F.min("seqid").alias("onp"))
    j = wanted.join(contigs.select("source", F.col("seqid").alias("_known"), F.col("seqid")), ["source", "seqid"], "left").join(one, "source", "left").join(prot, ["source", "protein_id"], "left")
    named = F.col("seqid").isNotNull()
    found = F.when(named, F.col("_known")).when(F.col("protein_id").isNotNull() & (F.col("np") == 1), F.col("onp")).when(F.col("protein_id").isNull() & (F.col("n") == 1), F.col("only"))
    error = F.when(found.isNotNull(), None).when(named, "contig not found").when(F.col("np") > 1, "protein isn't on a unique contig").when(F.col("protein_id").isNotNull(), "protein not found").otherwise("no unique contig")
    return j.select("uid", found.alias("seqid"), error.alias("error"))


def too_small(mode: str, least: int, full: Column) -> Column:
    """Whether a window has less than `least` positions around its target: in total, upstream, downstream or on either
    side (both); full contigs never are."""
    up, down = F.col("start_target") - F.col("start_win"), F.col("end_win") - F.col("end_target")
    small = {"total": F.col("end_win") - F.col("start_win") < least, "upstream": up < least, "downstream": down < least, "both": (up < least) | (down < least)}[mode]
    return F.coalesce(small, F.lit(False)) & ~F.coalesce(full, F.lit(False))


def fill_full_contigs(df: DataFrame) -> DataFrame:
    """is_full_contig where a nucleotide record has no coordinates, with 0 to sequence_length as its window."""
    full = (F.col("input_type") == "nucleotide") & F.col("start").isNull() & F.col("end").isNull() & F.col("sequence_length").isNotNull()
    full = F.coalesce(full, F.lit(False))
    return df.withColumn("is_full_contig", full).withColumn("start", F.when(F.col("is_full_contig"), F.lit(0).cast("bigint")).otherwise(F.col("start"))).withColumn("end", F.when(F.col("is_full_contig"), F.col("sequence_length")).otherwise(F.col("end")))


def gaps_within(df: DataFrame, keys: list[str], lengths: DataFrame) -> DataFrame:
    """(keys, s, e): what the intervals (s, e) leave free of 1..length; a key without intervals is free as a whole."""
    found = coverage(df, keys, "s", "e").select(*keys, "kind", F.col("first_pos").alias("s"), F.col("last_pos").alias("e"))
    inner = found.where("kind = 'gap'").join(lengths, keys).select(*keys, F.greatest(F.lit(1), "s").alias("s"), F.least("e", "length").alias("e"))
    ends = found.where("kind = 'period'").groupBy(*keys).agg(F.min("s").alias("first"), F.max("e").alias("last")).join(lengths, keys)
    outer = ends.select(*keys, F.explode(F.array(F.struct(F.lit(1).cast("bigint").alias("s"), F.least(F.col("first") - 1, "length").alias("e")), F.struct((F.greatest(F.lit(0), "last") + 1).alias("s"), F.col("length").alias("e")))).alias("p")).select(*keys, "p.*")
    whole = lengths.join(found.select(*keys).distinct(), keys, "left_anti").select(*keys, F.lit(1).cast("bigint").alias("s"), F.col("length").alias("e"))
    return inner.unionByName(outer).unionByName(whole).where("s <= e")


def covered_length(df: DataFrame, keys: list[str], start: str, end: str) -> DataFrame:
    """(keys, covered): positions in the union of half-open intervals."""
    closed = df.select(*keys, F.col(start).alias("s"), (F.col(end) - 1).alias("e")).where("s <= e")
    return coverage(closed, keys, "s", "e").where("kind = 'period'").groupBy(*keys).agg(F.sum(F.col("last_pos") - F.col("first_pos") + 1).alias("covered"))


def forward_fill(df: DataFrame, keys: list[str], order: list[str], cols: list[str]) -> DataFrame:
    """Blank and null cells take the last value before them within the keys."""
    w = W.partitionBy(*keys).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    return df.withColumns({c: F.last(F.when(F.trim(F.col(c).cast("string")) != "", F.col(c)), ignorenulls=True).over(w) for c in cols})
