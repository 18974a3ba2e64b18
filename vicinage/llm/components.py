"""Groups from pairwise matches: spanning forests per edge partition, merged level by level.

Level 0 runs union-find inside each input split, without a shuffle, and keeps only the forest of the split. Every
level then brings the parents of a node together, contracts the node into the smallest of them and runs union-find
over the contracted edges, which link fewer nodes than before; the last level fits one bounded partition. Labels go
back down the levels with one join each. Nodes are compared by a hash of their id, so that chains of sorted ids shrink
as fast as any other shape, and a hub's edges never need to meet in one task: partitions get any mix of edges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vicinage.functions.clean import bare_id
from vicinage.operators.sweep import lookup
from vicinage.operators.unionfind import BOUND, forests
from vicinage.session import cut, drop_table


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", bound: int = BOUND) -> DataFrame:
    """(member_id, group_id): every id of an edge with the smallest id linked to it directly or through others.

    edges: two string columns a and b; other columns don't matter. Rows with a null end are no edges; an edge from an
    id to itself makes a group of one; repeated edges and both directions count once. An empty table gives no rows.
    bound: edges one task holds at once. Ids are compared as binary text.
    """
    key = lambda c: F.concat(F.lpad(F.hex(F.xxhash64(c)), 16, "0"), c)
    level = edges.where(F.col(a).isNotNull() & F.col(b).isNotNull()).select(key(F.col(a).cast("string")).alias("a"), key(F.col(b).cast("string")).alias("b"))
    split = lambda bs: forests(bs, bound)
    levels: list[DataFrame] = []
    while True:
        trees = level.mapInArrow(split, "node string, root string")
        # a hub has a row from each split; they meet in a sort that may spill, and no row lists them
        w = W.partitionBy("node").orderBy("root")
        met = trees.select("node", "root", F.first("root").over(w).alias("parent"), F.lag("root").over(w).alias("last"))
        met = met.where("last is null or last <> root").select("node", "root", "parent", F.col("last").isNull().alias("first"))
        levels.append(cut(met, f"forest{len(levels)}"))
        level = levels[-1].where("not first").select(F.col("parent").alias("a"), F.col("root").alias("b"))
        left = level.count()
        if not left:
            break
        if left <= bound:
            level = level.repartition(1)  # not coalesce: the wide table is still read by many tasks
    label = levels[-1].where("first").select("node", F.col("parent").alias("top"))
    for lower in reversed(levels[:-1]):
        lower = lower.where("first").select("node", "parent")
        n = lower.groupBy("parent").agg(F.count(F.lit(1)).alias("n"))
        upper = n.join(label.select(F.col("node").alias("parent"), "top"), "parent")
        label = lookup(lower, upper, ["parent"], "n", "left").select("node", F.coalesce("top", "parent").alias("top"))
    members = label.select(F.expr("substring(node, 17)").alias("member_id"), "top")
    members = cut(members, "members")
    for t in levels:
        drop_table(t)
    least = members.groupBy("top").agg(F.min("member_id").alias("group_id"), F.count(F.lit(1)).alias("n"))
    return lookup(members, cut(least, "groups"), ["top"], "n").select("member_id", "group_id")


def hit_edges(hits: DataFrame, max_evalue: float = 1e-5, min_pident: float = 30.0) -> DataFrame:
    """(a, b): bare ids of the hits that count. Nulls in any measure or id never count, nor do hits of an id on itself."""
    return hits.where((F.col("evalue") <= max_evalue) & (F.col("pident") >= min_pident)).select(bare_id("qseqid").alias("a"), bare_id("sseqid").alias("b")).where("a <> b")
