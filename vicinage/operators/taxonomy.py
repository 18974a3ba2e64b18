"""Lineages, ranks and distances in a taxonomy (ALG-23, ALG-24, ARR-03)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vicinage.operators import trees
from vicinage.session import cut, drop_table

#: Ranks of the leaf metadata, highest first (fixed values).
RANKS = ("superkingdom", "kingdom", "phylum", "class", "order", "family", "genus", "species")


def lineages(nodes: DataFrame) -> DataFrame:
    """(taxid, lineage): ids from the root down to each node. nodes: (taxid, parent); the root's parent is itself or null.

    Paths double in length each round, so a tree of depth d takes log2(d) joins, whatever d is. A parent that isn't in
    nodes ends the lineage. A cycle raises an error: each round takes the shortest open paths a step of 2 to the power
    of the round further, and a path longer than there are nodes can't come from a tree.
    """
    up = F.when(F.col("parent") == F.col("taxid"), None).otherwise(F.col("parent"))
    paths = nodes.select("taxid", up.alias("next"), F.array("taxid").alias("path"))
    steps, n = 1, None
    while not (open_paths := paths.where("next is not null")).isEmpty():
        if steps > 64:
            n = nodes.count() if n is None else n
            if steps > n or not open_paths.where(F.array_contains("path", F.col("next"))).isEmpty():
                raise ValueError("the parents of some nodes form a cycle")
        above = paths.select(F.col("taxid").alias("next"), F.col("next").alias("_n"), F.col("path").alias("_p"))
        longer = paths.join(above, "next", "left").select("taxid", F.col("_n").alias("next"), F.concat("path", F.coalesce("_p", F.array().cast("array<bigint>"))).alias("path"))
        done = cut(longer, "lineages")
        if steps > 1:
            drop_table(paths)
        paths, steps = done, steps * 2
    return paths.select("taxid", F.reverse("path").alias("lineage"))


def lca_distance(a: Column, b: Column, default: float = 1e6) -> Column:
    """Steps from both leaves to their last common ancestor; without one the sum of both lengths; default if either
    lineage is missing. a, b: lineages from the root to the leaf."""
    common = F.array_intersect(F.reverse(a), F.reverse(b))
    at = lambda x: F.array_position(F.reverse(x), common[0]) - 1
    d = F.when(F.size(common) > 0, at(a) + at(b)).otherwise(F.size(a) + F.size(b))
    return F.when(a.isNull() | b.isNull(), F.lit(default)).otherwise(d.cast("double"))


def leaf_distances(leaves: DataFrame, asked: Column, blocks: int = 8) -> DataFrame:
    """(cust, other, dist) of the leaves asked for and all leaves by lca_distance. leaves: (id, lineage) with the leaf
    last in its lineage and in no other.

    Two leaves are two steps further apart than what they hang on, so distances are worked out once for each pair of
    lineages above leaves. The leaves asked for are listed by lineage and block, a list has one distance to each lineage,
    and each leaf meets the lists of its own: a pair costs no more than a row that is written.
    """
    above = F.slice("lineage", F.lit(1), F.size("lineage") - 1)
    lin = cut(leaves.select("id", above.alias("above"), asked.alias("asked")), "leaves")
    groups = cut(lin.groupBy("above").agg(F.max("asked").alias("asked")).withColumn("g", F.monotonically_increasing_id()), "groups")
    named = lin.join(groups.select("above", "g"), "above").select("id", "g", "asked")
    to = groups.select(F.col("g").alias("to"), F.col("above").alias("other_above"))
    dist = groups.where("asked").crossJoin(to).select("g", "to", (lca_distance(F.col("above"), F.col("other_above")) + 2).alias("dist"))
    block = F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    lists = named.where("asked").groupBy(block.alias("j"), "g").agg(F.collect_list("id").alias("ids")).join(dist, "g").select("j", F.col("to").alias("g"), "ids", "dist").withColumn("i", every)
    # a small shuffle makes many rows: its parts are not to be merged by size
    dealt = lambda x: x.repartition(blocks * blocks, "i", "j", "g")
    met = dealt(named.select(F.col("id").alias("other"), "g", block.alias("i"), every.alias("j"))).join(dealt(lists), ["i", "j", "g"]).select(F.explode("ids").alias("cust"), "other", "dist")
    return met.select("cust", "other", F.when(F.col("cust") == F.col("other"), 0.0).otherwise(F.col("dist")).alias("dist"))


def taxonomy_tree(leaves: DataFrame, lineages: DataFrame) -> str:
    """Newick text of the single linkage of leaves by lca_distance. leaves: (id, taxid), null for the root, 1.

    Leaves of one taxid are at distance 0, so pairs are made of the taxids only, of which trees.MAX_LEAVES are taken.
    One and two leaves have fixed branches.
    """
    taxid = F.coalesce(F.col("taxid"), F.lit(1)).cast("bigint")
    rows = sorted(tuple(r) for r in leaves.select("id", taxid.alias("taxid")).distinct().collect())
    names = [x for x, _ in rows]
    if len(names) < 3:
        return "(" + ",".join(f"{x}:{0.1 if len(names) == 2 else 0.0}" for x in names) + ");" if names else ";"
    first: dict[int, str] = {}
    edges = [(first[t], x, 0.0) for x, t in rows if first.setdefault(t, x) != x]
    if len(first) > trees.MAX_LEAVES:
        raise ValueError(f"a tree takes at most {trees.MAX_LEAVES} taxids")
    spark = leaves.sparkSession
    known = cut(spark.createDataFrame([(t,) for t in first], "taxid bigint").join(lineages.select(F.col("taxid").cast("bigint").alias("taxid"), "lineage"), "taxid", "left"), "taxids")
    a, b = (known.select(F.col("taxid").alias(x), F.col("lineage").alias(f"l{x}")) for x in "ab")
    dist = a.join(b, F.col("a") < F.col("b")).select("a", "b", lca_distance(F.col("la"), F.col("lb")).alias("dist"))
    return trees.single_linkage(names, edges + [(first[x], first[y], d) for x, y, d in trees.minimum_forest(dist)])


def leaf_metadata(records: DataFrame, ranks: DataFrame) -> DataFrame:
    """(unique_id, taxid, the eight ranks): names by rank, `unclassified` where there is none. A `domain` fills the
    superkingdom only if that is absent. Failed records are left out. ranks: (taxid, rank, name)."""
    wanted = [*RANKS, "domain"]
    wide = ranks.where(F.col("rank").isin(*wanted)).groupBy("taxid").agg(*[F.max(F.when(F.col("rank") == r, F.col("name"))).alias(f"_{r}") for r in wanted])
    rows = records.where("failed is null").select("unique_id", F.coalesce("taxid", F.lit(32644)).cast("string").alias("taxid"))
    named = rows.join(wide.withColumn("taxid", F.col("taxid").cast("string")), "taxid", "left")
    fill = {r: F.coalesce(F.col(f"_{r}"), *([F.col("_domain")] if r == "superkingdom" else []), F.lit("unclassified")) for r in RANKS}
    return named.select("unique_id", "taxid", *[c.alias(r) for r, c in fill.items()])
