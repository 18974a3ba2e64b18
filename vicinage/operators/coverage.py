"""Covered stretches and gaps of intervals per entity, in two levels so that no entity is too large for a task.

The positions are cut into shards of SHARD. An interval leaves a piece in the shard of its start and one in the shard
of its end; the whole shards between are one bridge and never spelled out. Level 1 merges within (entity, shard), where
at most SHARD rows are left once each start keeps its largest end. Level 2 sees only the first and last stretch of each
shard and the bridges (one a shard at most), and coalesces what touches a shard boundary. Gaps come from the same two levels.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vicinage.session import cut

SHARD = 65_536


def merged(df: DataFrame, keys: list[str], start: str = "s", end: str = "e") -> DataFrame:
    """(keys, s, e) of the longest stretches covered by rows that overlap or touch, within the keys."""
    w = W.partitionBy(*keys).orderBy(start, end)
    reach = F.max(end).over(w.rowsBetween(W.unboundedPreceding, -1))
    opened = df.withColumn("_new", F.when(reach.isNull() | (F.col(start) > reach + 1), 1).otherwise(0))
    island = F.sum("_new").over(w.rowsBetween(W.unboundedPreceding, 0))
    return opened.withColumn("_island", island).groupBy(*keys, "_island").agg(F.min(start).alias("s"), F.max(end).alias("e")).drop("_island")


def coverage(df: DataFrame, keys: list[str], start: Column | str, end: Column | str, shard: int = SHARD) -> DataFrame:
    """(keys, kind, first_pos, last_pos): kind `period` for each longest stretch that intervals of the keys cover, where
    overlapping and touching intervals (next start = end + 1) belong together; kind `gap` for the positions between two
    neighbouring periods.

    Positions are inclusive whole numbers of any sign; start > end is read the other way round. Rows with a null key,
    start or end don't count; repeated rows change nothing; other columns don't matter; an empty table gives no rows.
    """
    a, b = (F.col(c) if isinstance(c, str) else c for c in (start, end))
    names, keys = keys, [f"_key{i}" for i in range(len(keys))]
    rows = df.select(*[F.col(n).alias(k) for n, k in zip(names, keys, strict=True)], F.least(a, b).cast("bigint").alias("s"), F.greatest(a, b).cast("bigint").alias("e"), (a.isNotNull() & b.isNotNull()).alias("ok"))
    for k in keys:
        rows = rows.where(F.col(k).isNotNull())
    rows = rows.where("ok").drop("ok")
    lo = lambda k: k * shard
    shard_of = lambda c: F.expr(f"{c} div {shard} - if({c} < 0 and {c} % {shard} <> 0, 1, 0)")
    spread = rows.withColumn("k1", shard_of("s")).withColumn("k2", shard_of("e"))
    pieces = spread.select(
        *keys,
        F.explode(
            F.when(F.col("k1") == F.col("k2"), F.array(F.struct(F.col("k1").alias("k"), "s", "e", F.lit(False).alias("bridge")))).otherwise(
                F.array(
                    F.struct(F.col("k1").alias("k"), F.col("s"), (lo(F.col("k1") + 1) - 1).alias("e"), F.lit(False).alias("bridge")),
                    F.struct(F.col("k2").alias("k"), lo(F.col("k2")).alias("s"), F.col("e"), F.lit(False).alias("bridge")),
                    F.struct((F.col("k1") + 1).alias("k"), lo(F.col("k1") + 1).alias("s"), (lo(F.col("k2")) - 1).alias("e"), F.lit(True).alias("bridge")),
                )
            )
        ).alias("p"),
    ).select(*keys, "p.*").where("s <= e")
    # a start keeps its largest end: at most one row per position goes into level 1
    kept = pieces.groupBy(*keys, "k", "bridge", "s").agg(F.max("e").alias("e"))
    level1 = merged(kept.where("not bridge"), [*keys, "k"])
    w = W.partitionBy(*keys, "k").orderBy("s")
    level1 = level1.withColumn("n", F.row_number().over(w)).withColumn("next", F.lead("s").over(w)).withColumn("bridge", F.lit(False))
    bridges = kept.where("bridge").select(*keys, "k", "s", "e", F.lit(1).alias("n"), F.lit(None).cast("bigint").alias("next"), "bridge")
    parts = cut(level1.unionByName(bridges), "stretches")
    period, gap = F.lit("period").alias("kind"), F.lit("gap").alias("kind")
    rows_of = lambda *cs: F.explode(F.array_compact(F.array(*cs))).alias("r")
    # level 2: first and last stretches of each shard and bridges, in order of place
    u = W.partitionBy(*keys).orderBy("s", "e")
    ends = parts.where("bridge or n = 1 or next is null").withColumn("reach", F.max("e").over(u.rowsBetween(W.unboundedPreceding, -1)))
    ends = ends.withColumn("new", F.when(F.col("reach").isNull() | (F.col("s") > F.col("reach") + 1), 1).otherwise(0)).withColumn("island", F.sum("new").over(u.rowsBetween(W.unboundedPreceding, 0)))
    # a stretch that isn't the first of its shard has the gap before it from level 1
    before = F.max(F.when((F.col("new") == 1) & (F.col("n") == 1), F.col("reach"))).alias("before")
    stitched = ends.groupBy(*keys, "island").agg(F.min("s").alias("s"), F.max("e").alias("e"), before)
    left_open = F.struct(gap, (F.col("before") + 1).alias("first_pos"), (F.col("s") - 1).alias("last_pos"))
    stitched = stitched.select(*keys, rows_of(F.struct(period, F.col("s").alias("first_pos"), F.col("e").alias("last_pos")), F.when(F.col("before").isNotNull(), left_open)))
    inner = F.when((F.col("n") > 1) & F.col("next").isNotNull(), F.struct(period, F.col("s").alias("first_pos"), F.col("e").alias("last_pos")))
    after = F.when(F.col("next").isNotNull(), F.struct(gap, (F.col("e") + 1).alias("first_pos"), (F.col("next") - 1).alias("last_pos")))
    inside = parts.where("not bridge and next is not null").select(*keys, rows_of(inner, after))
    inside = inside.withColumn("k", shard_of("r.first_pos"))
    over = parts.where("bridge")
    if not over.isEmpty():  # a bridge swallows what lies in its shards; a bridge is known by its first one
        v = W.partitionBy(*keys).orderBy("k").rowsBetween(W.unboundedPreceding, 0)
        spanned = parts.groupBy(*keys, "k").agg(F.max(F.when(F.col("bridge"), F.col("e"))).alias("e")).withColumn("reach", F.max("e").over(v))
        swallowed = spanned.where(F.col("reach") >= lo(F.col("k") + 1) - 1).select(*keys, "k")
        # a piece of the shard lies in the bridge as a whole, so entity and shard decide and no range has to be compared
        inside = inside.join(swallowed, [*keys, "k"], "left_anti")
    out = stitched.unionByName(inside.drop("k")).select(*keys, "r.*")
    return out.select(*[F.col(k).alias(n) for n, k in zip(names, keys, strict=True)], "kind", "first_pos", "last_pos")
