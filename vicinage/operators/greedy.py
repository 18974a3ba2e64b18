"""Greedy choice of intervals that don't overlap, and what is measured on them (ALG-04, ALG-07, ALG-09, ALG-13, WIN-08)."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vicinage.operators.sweep import islands
from vicinage.operators.windows import BIN, covered_length


class Apart:
    """Inclusive intervals, best first, of which each shares at most slack positions with every one taken before.

    Those taken lie in order of start; as each shares little with the next, only neighbours have to be looked at until
    one lies too far left.
    """

    def __init__(self, slack: int) -> None:
        self.slack, self.taken, self.longest = slack, [], 0

    def take(self, s: int, e: int) -> bool:
        at = bisect_left(self.taken, (s, e))
        i = at
        while i < len(self.taken) and self.taken[i][0] <= e:
            if min(e, self.taken[i][1]) - self.taken[i][0] + 1 > self.slack:
                return False
            i += 1
        i = at - 1
        while i >= 0 and self.taken[i][0] > s - self.longest:
            if min(e, self.taken[i][1]) - s + 1 > self.slack:
                return False
            i -= 1
        self.taken.insert(at, (s, e))
        self.longest = max(self.longest, e - s + 1)
        return True


def greedy(df: DataFrame, keys: list[str], order: list[tuple[str, bool]], start: str, end: str, slack: int = 0) -> DataFrame:
    """Rows of df kept greedily per key: in the order (column, ascending), if they share at most slack positions with
    every row kept before.

    Rows first fall into stretches of overlapping intervals, which can't influence each other; islands() finds them by
    shards of a key. A stretch is the unit of a task, however many a key has. Within stretches of one row nothing has to
    be decided and Python sees none of it.
    """
    marked = islands(df, keys, start, end, 0, "_stretch")
    marked = marked.withColumn("_size", F.count(F.lit(1)).over(W.partitionBy(*keys, "_stretch")))
    many = marked.where("_size > 1").drop("_size").withColumn("_group", F.concat_ws("\x01", *[F.coalesce(F.col(k).cast("string"), F.lit("\x02")) for k in keys], F.coalesce(F.col("_stretch").cast("string"), F.lit("\x02"))))
    by = [F.col(c).asc_nulls_last() if up else F.col(c).desc_nulls_last() for c, up in order]
    lo, hi, group = (many.columns.index(c) for c in (start, end, "_group"))

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chosen, last = Apart(slack), None
        for batch in batches:
            mask = []
            for g, s, e in zip(batch.column(group).to_pylist(), batch.column(lo).to_pylist(), batch.column(hi).to_pylist(), strict=True):
                if g != last:
                    chosen, last = Apart(slack), g
                mask.append(chosen.take(s, e))
            yield batch.filter(pa.array(mask, pa.bool_()))

    # the window has brought each stretch together already; only the order within is new
    kept = many.sortWithinPartitions("_group", *by).mapInArrow(choose, many.schema)
    return marked.where("_size = 1").drop("_size", "_stretch").unionByName(kept.drop("_stretch", "_group"))


def merge_domains(df: DataFrame, gap: int = 10, keys: tuple[str, ...] = ("protein_id", "database", "domain_id")) -> DataFrame:
    """Neighbouring hits of one domain on one protein whose start is at most gap beyond the end before become one: span
    from first to last, summed length, length-weighted mean score, least e-value. Hits without any length keep the
    score of the first."""
    isl = islands(df, list(keys), "start", "end", gap)
    out = isl.groupBy(*keys, "_island").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.sum("alignment_length").alias("alignment_length"), F.sum(F.col("bit_score") * F.col("alignment_length")).alias("weight"), F.min_by("bit_score", F.struct("start", "end", "bit_score", "alignment_length")).alias("_first"), F.min("e_value").alias("e_value"))
    return out.withColumn("bit_score", F.coalesce(F.try_divide("weight", "alignment_length"), F.col("_first"))).drop("_island", "_first")


def deduplicate_domains(df: DataFrame, gap: int = 10, max_overlap: int = 5, group_cols: tuple[str, ...] = ("protein_id", "database")) -> DataFrame:
    """merge_domains, then the best hits by score times length that share at most max_overlap positions with a better
    one, within group_cols: by default the hits of one protein and database."""
    return greedy(merge_domains(df, gap), list(group_cols), [("weight", False), ("domain_id", True), ("database", True), ("start", True)], "start", "end", max_overlap)


def ani_from_hsps(hsps: DataFrame, lengths: DataFrame, slack: int = 0) -> DataFrame:
    """(query, ref, ani, align_fraction) from alignment pieces kept apart on the query: identities over aligned length,
    and the covered share of the query; three decimals, half to even.

    hsps: (query, ref, pident, length, bitscore, q_start, q_end), 1-based inclusive, either direction.
    """
    h = hsps.select("query", "ref", "pident", "length", "bitscore", F.least("q_start", "q_end").alias("lo"), F.greatest("q_start", "q_end").alias("hi"))
    kept = greedy(h, ["query", "ref"], [("bitscore", False), ("length", False), ("pident", False), ("lo", True)], "lo", "hi", slack)
    sums = kept.groupBy("query", "ref").agg(F.sum(F.bround(F.col("pident") / 100 * F.col("length"), 0)).alias("same"), F.sum("length").alias("aligned"))
    cov = covered_length(kept.select("query", "ref", (F.col("lo") - 1).alias("a"), F.col("hi").alias("b")), ["query", "ref"], "a", "b")
    out = sums.join(cov, ["query", "ref"]).join(lengths.select(F.col("id").alias("query"), F.col("length").alias("q_len")), "query")
    return out.select("query", "ref", F.bround(100 * F.col("same") / F.col("aligned"), 3).alias("ani"), F.bround(100 * F.col("covered") / F.col("q_len"), 3).alias("align_fraction"))


def accept_predicted(features: DataFrame, predicted: DataFrame, max_share: float, min_len: int | None = None, max_len: int | None = None) -> DataFrame:
    """Predicted ORFs (seqid, id, start, end) of min_len to max_len positions that overlap no known feature by more than
    max_share per cent of their own length, and no prediction accepted before them (by start, end, id)."""
    p = predicted.withColumn("_len", F.col("end") - F.col("start") + 1)
    bins = lambda a, b: F.explode(F.sequence(F.expr(f"`{a}` div {BIN}"), F.expr(f"`{b}` div {BIN}")))
    # predictions and features meet in each bin both lie in
    f = features.where("start <= end").select(F.col("seqid").alias("_s"), F.col("start").alias("_a"), F.col("end").alias("_b"), bins("start", "end").alias("_fbin"))
    spread = p.where("start <= end").select("seqid", "id", "start", "end", "_len", bins("start", "end").alias("_bin"))
    shared = F.least("end", "_b") - F.greatest("start", "_a") + 1
    meets = (F.col("seqid") == F.col("_s")) & (F.col("_bin") == F.col("_fbin")) & (F.col("_a") <= F.col("end")) & (F.col("_b") >= F.col("start")) & (shared * 100 > max_share * F.col("_len"))
    taken = spread.join(f, meets, "left_semi").select("seqid", "id", "start", "end").distinct()
    fits = F.lit(True)
    if min_len is not None:
        fits &= F.col("_len") >= min_len
    if max_len is not None:
        fits &= F.col("_len") <= max_len
    free = p.where(fits).join(taken, ["seqid", "id", "start", "end"], "left_anti").drop("_len").select(*predicted.columns)
    return greedy(free, ["seqid"], [("start", True), ("end", True), ("id", True)], "start", "end", 0)
