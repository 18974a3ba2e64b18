"""Lookups and enrichment of records (survey ids JN-01..10, SET-01..07, ALG-19, ALG-38, AGG-01, SRT-01)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vicinage.functions.ids import assembly_core


def semi_lookup(big: DataFrame, ids: DataFrame, key: str, id_col: str) -> DataFrame:
    """Rows of a large table whose key is among the ids; Spark broadcasts the ids if their size allows."""
    return big.join(ids.select(F.col(id_col).alias(key)).where(F.col(key).isNotNull()).distinct(), key, "left_semi")


def or_lookup(big: DataFrame, ids: DataFrame, keys: list[str], id_col: str, order: list[Column], value_cols: list[str]) -> DataFrame:
    """One row per id that equals any of the keys: the OR is split into equi joins, and the first row by order is kept."""
    wanted = ids.select(F.col(id_col).alias("id")).where("id is not null").distinct()
    parts = [big.where(F.col(k).isNotNull()).join(wanted, F.col(k) == F.col("id")).select("id", *[c for c in big.columns]) for k in keys]
    found = reduce(DataFrame.unionByName, parts).distinct()
    return first_by(found, ["id"], order).select("id", *value_cols)


def left_fill(df: DataFrame, dim: DataFrame, on: list[str], cols: list[str]) -> DataFrame:
    """df with the nulls of cols filled from dim; columns df lacks are added, values it has stay. dim has one row per on."""
    new = dim.select(*on, *[F.col(c).alias(f"_new_{c}") for c in cols])
    joined = df.join(new, on, "left")
    keep = [F.coalesce(F.col(c), F.col(f"_new_{c}")).alias(c) if c in cols else F.col(c) for c in df.columns]
    return joined.select(*keep, *[F.col(f"_new_{c}").alias(c) for c in cols if c not in df.columns])


def first_by(df: DataFrame, keys: list[str], order: list[Column], n: int = 1) -> DataFrame:
    """The first n rows per key in a total order."""
    return df.withColumn("_rn", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).where(F.col("_rn") <= n).drop("_rn")


def upsert(remote: DataFrame, local: DataFrame, keys: list[str]) -> DataFrame:
    """All local rows, and the remote rows with other keys."""
    return local.unionByName(remote.join(local.select(*keys).distinct(), keys, "left_anti"), allowMissingColumns=True)


def missing(wanted: DataFrame, present: DataFrame, key: str, present_key: str) -> DataFrame:
    """Wanted rows whose key isn't present yet."""
    return wanted.join(present.select(F.col(present_key).alias(key)), key, "left_anti")


def newer(df: DataFrame, date_text: str, cutoff: str) -> DataFrame:
    """Rows with a date after the cutoff, and rows whose date is missing or can't be read."""
    d = F.col(date_text).try_cast("date")
    return df.where(d.isNull() | (d > F.lit(cutoff).cast("date")))


def mark_failed(df: DataFrame, when: Column, reason: str) -> DataFrame:
    """failed and failed_reason set where the predicate is true; else both stay (null predicate: not failed)."""
    hit = F.coalesce(when, F.lit(False))
    return df.withColumn("failed", F.when(hit, True).otherwise(F.col("failed"))).withColumn("failed_reason", F.when(hit, reason).otherwise(F.col("failed_reason")))


def unambiguous(df: DataFrame, key: str, value: str) -> DataFrame:
    """(key, value) of the keys that have exactly one value."""
    return df.where(F.col(key).isNotNull() & F.col(value).isNotNull()).groupBy(key).agg(F.min(value).alias(value), F.max(value).alias("_hi")).where(F.col(value) == F.col("_hi")).drop("_hi")


def edge_room() -> Column:
    """Room between a feature and the nearer end of its contig, -1 if unknown."""
    return F.coalesce(F.when(F.col("start").isNotNull() & F.col("end").isNotNull() & F.col("sequence_length").isNotNull(), F.least(F.col("start"), F.col("sequence_length") - F.col("end"))), F.lit(-1))


def candidate_rank() -> Column:
    """1: RefSeq assembly of a finished level, 2: that level, 3: any assembly, 4: none."""
    done = F.coalesce(F.col("assembly_level").isin("Chromosome", "Complete Genome"), F.lit(False))
    return F.when(done & F.coalesce(F.col("assembly_id").startswith("GCF_"), F.lit(False)), 1).when(done, 2).when(F.col("assembly_id").isNotNull(), 3).otherwise(4)


def candidates(df: DataFrame, mode: str, queried: str = "is_query", tie: str = "uid") -> DataFrame:
    """The candidate rows of each og_index by mode; rows without ipg_id always pass.

    any_ipg   one row per (ipg_id, nucleotide_id, start, end); of equal places on both copies of an assembly the RefSeq one
    best_ipg  best rank, then most edge room, one per og_index
    best_id   the same among rows of the queried protein, if there are any
    one_id    one row per og_index
    same_id   rows of the queried protein, if any, one per (og_index, nucleotide_id, start, end)
    Ties: the smaller tie column.
    """
    free, rows = df.where("ipg_id is null"), df.where("ipg_id is not null")
    t = F.col(tie)
    if mode in ("best_id", "same_id"):
        any_hit = F.max(F.coalesce(F.col(queried), F.lit(False))).over(W.partitionBy("og_index"))
        rows = rows.withColumn("_any", any_hit).where(~F.col("_any") | F.coalesce(F.col(queried), F.lit(False))).drop("_any")
    if mode == "any_ipg":
        rows = first_by(rows, ["ipg_id", "nucleotide_id", "start", "end"], [t])
        gcf = F.coalesce(F.col("assembly_id").startswith("GCF_"), F.lit(False))
        place = W.partitionBy(assembly_core(F.col("assembly_id")), "start", "end")
        rows = rows.withColumn("_gcf", gcf).withColumn("_some", F.max("_gcf").over(place)).where("_gcf or not _some").drop("_gcf", "_some")
    elif mode in ("best_ipg", "best_id"):
        rows = first_by(rows, ["og_index"], [candidate_rank().asc(), edge_room().desc(), t])
    elif mode == "one_id":
        rows = first_by(rows, ["og_index"], [t])
    elif mode == "same_id":
        rows = first_by(rows, ["og_index", "nucleotide_id", "start", "end"], [t])
    else:
        raise ValueError(f"unknown candidate mode {mode}")
    return rows.unionByName(free)


def relaxed_union(*dfs: DataFrame) -> DataFrame:
    """All rows of all tables over the union of their columns."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def shared_union(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of both over the columns both have."""
    cols = [c for c in a.columns if c in b.columns]
    return a.select(*cols).unionByName(b.select(*cols))


def by_index(a: DataFrame, b: DataFrame, keys: list[str], index: str, ahead: int = 0, how: str = "inner") -> DataFrame:
    """a joined with the rows of b that lie `ahead` places further within the keys."""
    return a.join(b.withColumn(index, F.col(index) - ahead), [*keys, index], how)


def best_n(df: DataFrame, keys: list[str], order: list[Column], n: int) -> DataFrame:
    """The first n rows of each key; a limit of the rank lets each task drop the rest before the shuffle."""
    return df.withColumn("_rank", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).where(F.col("_rank") <= n).drop("_rank")


def ordered_distinct(df: DataFrame, key: str, item: str, order: list[str]) -> DataFrame:
    """(key, id, place): per key the key itself, then its different items in the order they first come; nulls
    of the order's columns come last."""
    first = df.where(F.col(item) != F.col(key)).groupBy(key, item).agg(F.min(F.struct(*[F.struct(F.col(c).isNull().alias("missing"), F.col(c).alias("value")) for c in order])).alias("o"))
    listed = first.select(key, F.col(item).alias("id"), (F.row_number().over(W.partitionBy(key).orderBy("o")) + 1).alias("place"))
    return listed.unionByName(df.select(key, F.col(key).alias("id"), F.lit(1).alias("place")).distinct())
