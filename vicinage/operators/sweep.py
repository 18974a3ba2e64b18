"""Running values over a huge key in two levels, and joins that a hot key can't gather into one task.

A running value (the furthest end so far, the number of rows before) is taken within bins of a key's positions, and the
bins' own values are carried from bin to bin; a task holds the rows of one bin, and one row a bin of a key.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vicinage.session import cut

#: Positions a bin of a key holds.
BIN = 65_536
#: A key of more than one in HOT rows is hot; there are fewer than HOT such keys, so they can be broadcast.
HOT = 10_000


def carried(df: DataFrame, keys: list[str], bins: DataFrame, name: str) -> DataFrame:
    """df with the value `name` of the bins (keys, _bin, name); keys may be null."""
    other = bins.select(*[F.col(k).alias(f"_c{i}") for i, k in enumerate(keys)], F.col("_bin").alias("_cbin"), F.col(name))
    same = reduce(Column.__and__, [df[k].eqNullSafe(other[f"_c{i}"]) for i, k in enumerate(keys)], df["_bin"].eqNullSafe(other["_cbin"]))
    return df.join(other, same).drop(*[f"_c{i}" for i in range(len(keys))], "_cbin")


def running_max(df: DataFrame, keys: list[str], order: list[str], at: str, value: Column, name: str, inclusive: bool, width: int = BIN) -> DataFrame:
    """df with the largest value among the rows before, or up to (inclusive), each row of its key in the order, whose
    first column is `at`. Null positions come first."""
    binned = df.withColumn("_bin", F.expr(f"`{at}` div {width} - if(`{at}` < 0 and `{at}` % {width} <> 0, 1, 0)")).withColumn("_value", value)
    w = W.partitionBy(*keys, "_bin").orderBy(*order)
    # rows that are alike in the order count for each other if the row itself counts, whichever of them comes first
    w = w.rangeBetween(W.unboundedPreceding, W.currentRow) if inclusive else w.rowsBetween(W.unboundedPreceding, -1)
    v = W.partitionBy(*keys).orderBy("_bin").rowsBetween(W.unboundedPreceding, -1)
    bins = binned.groupBy(*keys, "_bin").agg(F.max("_value").alias("_m")).withColumn("_before", F.max("_m").over(v)).drop("_m")
    placed = carried(binned.withColumn("_within", F.max("_value").over(w)), keys, bins, "_before")
    return placed.withColumn(name, F.greatest("_within", "_before")).drop("_bin", "_value", "_within", "_before")


def islands(df: DataFrame, keys: list[str], start: str, end: str, beyond: int = 0, name: str = "_island", width: int = BIN) -> DataFrame:
    """df with the start of the stretch each row belongs to: a row opens one if it starts more than `beyond` behind the
    furthest end before it. Each step reads its input twice, so the steps before are written."""
    reached = running_max(cut(df, "sweep"), keys, [start, end], start, F.col(end), "_reach", False, width)
    opens = F.when(F.col("_reach").isNull() | (F.col(start) - F.col("_reach") > beyond), F.col(start))
    return running_max(cut(reached.withColumn("_opens", opens), "sweep"), keys, [start, end], start, F.col("_opens"), name, True, width).drop("_reach", "_opens")


def numbered(df: DataFrame, keys: list[str], order: list[str], name: str, width: int = BIN) -> DataFrame:
    """df with the place of each row in its key, from 0, in a total order whose first column is a position."""
    binned = cut(df, "sweep").withColumn("_bin", F.expr(f"`{order[0]}` div {width} - if(`{order[0]}` < 0 and `{order[0]}` % {width} <> 0, 1, 0)"))
    w = W.partitionBy(*keys, "_bin").orderBy(*order)
    v = W.partitionBy(*keys).orderBy("_bin").rowsBetween(W.unboundedPreceding, -1)
    bins = binned.groupBy(*keys, "_bin").agg(F.count(F.lit(1)).alias("_n")).withColumn("_before", F.coalesce(F.sum("_n").over(v), F.lit(0))).drop("_n")
    placed = carried(binned.withColumn("_within", F.row_number().over(w) - 1), keys, bins, "_before")
    return placed.withColumn(name, F.col("_before") + F.col("_within")).drop("_bin", "_within", "_before")


def lookup(rows: DataFrame, table: DataFrame, keys: list[str], n: str, how: str = "inner") -> DataFrame:
    """rows joined with a table that is unique by keys and says in column n how many of the rows have them.

    Hot keys (more than one in HOT of all rows, so fewer than HOT keys) are broadcast and their rows stay where they
    are; the others meet in a shuffle. how: inner or left. The column n is left out. rows is read twice.
    """
    total = table.agg(F.sum(n)).first()[0] or 0
    hot = table.where(F.col(n) * HOT > total)
    rest = table.where(F.col(n) * HOT <= total).drop(n)
    if hot.isEmpty():
        return rows.join(rest, keys, how)
    there = rows.join(F.broadcast(hot.drop(n)), keys)
    return there.unionByName(rows.join(F.broadcast(hot.select(*keys)), keys, "left_anti").join(rest, keys, how), allowMissingColumns=True)
