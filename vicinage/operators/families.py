"""Families from hits: components over filtered edges and their numbers (ALG-20..22, FLT-10, FLT-11, WIN-03, WIN-04, WIN-07)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vicinage.functions.stats import global_rank
from vicinage.operators.sweep import lookup
from vicinage.operators.unionfind import BOUND, forests
from vicinage.session import cut, drop_table


def components(edges: DataFrame, a: str = "a", b: str = "b", bound: int = BOUND) -> DataFrame:
    """(id, rep): every end of an edge with the smallest id of its component.

    Each split keeps the spanning forest of its edges, without a shuffle. What is left, if it is more than one task takes,
    goes through alternating star steps: a large star hangs a node's larger neighbours on its least neighbour, a small
    star its smaller ones. Steps are grouped minima, so a hub's edges are summed up before the shuffle, and its rows find
    the minimum by a lookup that splits hot nodes.
    """
    pairs = edges.where(F.col(a).isNotNull() & F.col(b).isNotNull()).select(F.col(a).cast("string").alias("a"), F.col(b).cast("string").alias("b"))
    split = lambda bs: forests(bs, bound)
    trees = cut(pairs.mapInArrow(split, "node string, root string"), "star")
    nodes = trees.where("node = root").select(F.col("node").alias("u"), F.col("root").alias("v"))
    e, n = trees.where("node <> root").select(F.col("node").alias("u"), F.col("root").alias("v")), trees.count()
    if n > bound:
        before = None
        while True:
            both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
            least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"), F.count(F.lit(1)).alias("n"))
            large = lookup(both, least, ["u"], "n").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
            down = large.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n"))
            small = lookup(large, down, ["u"], "n").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
            new = cut(small, "star")
            mark = new.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
            if before is not None:
                drop_table(e)
            e = new
            if before == mark or mark[0] <= bound:
                break
            before = mark
    else:
        mark = None
    if mark is None or mark[0] <= bound:
        last = e.unionByName(nodes) if mark is None else e
        stars = last.repartition(1).mapInArrow(split, "node string, root string").select(F.col("node").alias("id"), F.col("root").alias("rep"))
        stars = cut(stars, "members")
        return stars if mark is None else _with_alone(stars, nodes)
    stars = e.select(F.col("u").alias("id"), F.col("v").alias("rep"))
    return _with_alone(stars.unionByName(e.select(F.col("v").alias("id"), F.col("v").alias("rep")).distinct()), nodes)


def _with_alone(members: DataFrame, nodes: DataFrame) -> DataFrame:
    """members with the nodes that have no edge to another."""
    return members.unionByName(nodes.select(F.col("u").alias("id")).distinct().join(members.select("id"), "id", "left_anti").withColumn("rep", F.col("id")))


def filtered_hits(hits: DataFrame, max_evalue: float = 1e-5, min_pident: float = 30.0) -> DataFrame:
    return hits.where((F.col("qseqid") != F.col("sseqid")) & (F.col("evalue") <= max_evalue) & (F.col("pident") >= min_pident))


def numbered_families(members: DataFrame) -> DataFrame:
    """(id, rep, family): families of two and more, numbered from 1 by size, largest first, ties by representative;
    singletons have a null family. members: (id, rep)."""
    sizes = members.groupBy("rep").agg(F.count(F.lit(1)).alias("n")).where("n >= 2")
    ranked = global_rank(sizes, [F.col("n").desc(), F.col("rep")], "family")
    return members.join(ranked.select("rep", "family"), "rep", "left").select("id", "rep", "family")


def drop_unsupported(proteins: DataFrame, family: str = "fam_cluster", source: str = "source", name: str = "id") -> DataFrame:
    """Without predicted small ORFs that have no family, and without families made of orfipy predictions only."""
    w = W.partitionBy(family)
    only = (F.sum(F.when(F.col(source) == "orfipy", 1).otherwise(0)).over(w) == F.count(F.lit(1)).over(w)) & F.col(family).isNotNull()
    return proteins.withColumn("_only", only).where(~F.col("_only") & ~(F.col(family).isNull() & F.col(name).contains("sORF"))).drop("_only")
