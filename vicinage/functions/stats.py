"""Hypergeometric tails and corrections for many tests (survey ids MTH-03, MTH-04)."""

from __future__ import annotations

from decimal import ROUND_HALF_UP, Decimal

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vicinage.session import cut

LEAST = 1e-300
#: Terms of sums worked out at once, and ranks a task of the running minimum holds.
TERMS, RANKS = 2_000_000, 262_144


def rounded(x: np.ndarray, digits: int) -> np.ndarray:
    """As Spark's round: half up by the decimal digits of a number, away from zero. Only what is within 1e-6 of a half, or too
    large for sums of doubles to tell, is worked out in decimals."""
    y = np.abs(x) * 10.0**digits
    with np.errstate(invalid="ignore"):
        low = np.floor(y)
        out = np.copysign((low + (y - low >= 0.5)) / 10.0**digits, x) + 0.0
        at = np.flatnonzero((np.abs(y - low - 0.5) < 1e-6) | ((y >= 1e9) & np.isfinite(x)))
    if len(at):
        each, back = np.unique(x[at], return_inverse=True)
        out[at] = np.array([float(Decimal(repr(v)).quantize(Decimal(1).scaleb(-digits), ROUND_HALF_UP)) if abs(v) < 1e15 else v for v in each.tolist()])[back]
    return out


def _log_factorial(n: np.ndarray) -> np.ndarray:
    """ln n! to double precision: a table below 256 and Stirling's series above."""
    small = np.cumsum(np.log(np.maximum(1, np.arange(256))))
    x = n.astype(float) + 1
    with np.errstate(divide="ignore", invalid="ignore"):
        big = (x - 0.5) * np.log(x) - x + 0.5 * np.log(2 * np.pi) + 1 / (12 * x) - 1 / (360 * x**3) + 1 / (1260 * x**5)
    return np.where(n < 256, small[np.clip(n, 0, 255)], big)


def tail(m: np.ndarray, a: np.ndarray, b: np.ndarray, k: np.ndarray) -> np.ndarray:
    """P(X >= k) for X shared among draws of a and b of m, at least LEAST and at most 1. Equal rows are worked out once, all
    rows at a time."""
    if not len(m):
        return np.ones(0)
    (m, a, b, k), at = (x := np.unique(np.stack([m, a, b, k]), axis=1, return_inverse=True))[0], x[1].ravel()
    floor = np.maximum(0, a + b - m)
    lo, hi = np.maximum(k, floor), np.minimum(a, b)
    out = np.where(k <= floor, 1.0, LEAST)
    some = np.nonzero((k > floor) & (lo <= hi))[0]
    # rows of the sums one after another, a bounded number of terms at a time
    n = (hi - lo + 1)[some]
    for part in np.split(some, np.searchsorted(np.cumsum(n), np.arange(TERMS, n.sum() + 1, TERMS))) if len(some) else []:
        if not len(part):
            continue
        n = (hi - lo + 1)[part]
        first = np.cumsum(n) - n
        row = np.repeat(part, n)
        x = lo[row] + np.arange(n.sum()) - np.repeat(first, n)
        choose = lambda p, r: _log_factorial(p) - _log_factorial(r) - _log_factorial(p - r)
        log = choose(a[row], x) + choose(m[row] - a[row], b[row] - x) - choose(m[row], b[row])
        top = np.maximum.reduceat(log, first)
        out[part] = np.clip(np.exp(top) * np.add.reduceat(np.exp(log - np.repeat(top, n)), first), LEAST, 1.0)
    return out[at]


class Tails:
    """tail() for one m, which keeps what it has worked out."""

    def __init__(self, m: int) -> None:
        self.m, self.codes, self.tails = m, np.zeros(0, np.int64), np.zeros(0)

    def __call__(self, a: np.ndarray, b: np.ndarray, k: np.ndarray) -> np.ndarray:
        wide = 1 << 21  # a, b and k are numbers of items of one set each
        if len(a) and max(a.max(), b.max()) >= wide:
            return tail(np.full(len(a), self.m), a, b, k)
        codes, at = np.unique((np.minimum(a, b) * wide + np.maximum(a, b)) * wide + k, return_inverse=True)
        new = np.setdiff1d(codes, self.codes, assume_unique=True)
        if len(new):
            found = tail(np.full(len(new), self.m), new // wide // wide, new // wide % wide, new % wide)
            if len(self.codes) > TERMS:
                self.codes, self.tails, new = np.zeros(0, np.int64), np.zeros(0), codes
                found = tail(np.full(len(new), self.m), new // wide // wide, new // wide % wide, new % wide)
            every = np.concatenate([self.codes, new])
            order = np.argsort(every)
            self.codes, self.tails = every[order], np.concatenate([self.tails, found])[order]
        return self.tails[np.searchsorted(self.codes, codes)][at]


@F.pandas_udf(T.DoubleType())
def hypergeometric_tail(m: pd.Series, a: pd.Series, b: pd.Series, k: pd.Series) -> pd.Series:
    return pd.Series(tail(*(x.to_numpy(np.int64) for x in (m, a, b, k))))


def adjusted(df: DataFrame, p: str, tie: list[str], method: str = "BH") -> DataFrame:
    """df with p_adj: BH as p * m / rank without a running minimum, BH_MONOTONE with it, or BONFERRONI; at most 1.

    Rows without p are no tests: they don't count and their p_adj is null. Ranks come from a global order: each range partition counts its rows, so no task sorts all of them.
    """
    every = cut(df, "tests")
    untested = every.where(F.col(p).isNull()).withColumn("p_adj", F.lit(None).cast("double"))
    df = every.where(F.col(p).isNotNull())
    m = df.count()
    if method.upper() == "BONFERRONI":
        return df.withColumn("p_adj", F.least(F.lit(1.0), F.col(p) * m)).unionByName(untested)
    ranked = global_rank(df, [F.col(p), *[F.col(t) for t in tie]], "_rank")
    out = ranked.withColumn("p_adj", F.least(F.lit(1.0), F.col(p) * m / F.col("_rank")))
    if method.upper() == "BH_MONOTONE":
        # the least of all later ranks: within blocks of ranks, and carried from block to block
        out = out.withColumn("_block", F.expr(f"_rank div {RANKS}"))
        later = out.groupBy("_block").agg(F.min("p_adj").alias("_least"))
        later = later.select("_block", F.min("_least").over(W.orderBy(F.desc("_block")).rowsBetween(W.unboundedPreceding, -1)).alias("_after"))  # one row a block
        # from the last rank back: a frame that ends with the partition is worked out anew for each row
        inside = F.min("p_adj").over(W.partitionBy("_block").orderBy(F.desc("_rank")).rowsBetween(W.unboundedPreceding, W.currentRow))
        out = out.withColumn("_inside", inside).join(later, "_block").withColumn("p_adj", F.least("_inside", "_after")).drop("_block", "_inside", "_after")
    return out.drop("_rank").unionByName(untested)


def global_rank(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """df with its place from 1 in a total order, by range partitions and their offsets."""
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_part", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id())
    placed = cut(placed, "ranked")
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    before = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))  # one row per partition
    return placed.join(F.broadcast(before.select("_part", "_first", "_before")), "_part").withColumn(name, F.col("_before") + F.col("_at") - F.col("_first") + 1).drop("_part", "_at", "_first", "_before")


def score(p_adj: Column) -> Column:
    return F.when(p_adj.isNotNull(), 0 - F.log10(F.greatest(F.lit(LEAST), p_adj)))  # not -0.0 for 1
