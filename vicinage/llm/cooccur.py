"""Items that occur together in records: heavy-light counting of pairs.

An item is heavy if it occurs in at least one record of DENSITY; there are at most DENSITY times the mean record size
of them, however large the data. Records are worked off in blocks: pairs of two heavy items come from popcounts over
the block's bit matrix, pairs of two light items from hash counts, mixed pairs from probing the records of a light item
in the bit matrix. Only sums per block are shuffled.

A record with more than WIDE light items would give one task too many light pairs. Its items are dealt out to groups by
their hash, about WIDE in each, and a pair of groups is a unit of work of its own, as is a group with the record's heavy
items: a record of m items is copied m / WIDE times and no more, against the m * m / 2 pairs it holds. Units of the same
groups come together, so that their pairs are summed before the shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vicinage.operators.sweep import lookup
from vicinage.session import cut

DENSITY = 64
WIDE = 256
#: Rows of whole records that one block holds at least.
BLOCK = 500_000
#: Records whose bits are held at once, and pairs.
SLAB, AT_ONCE = 16_384, 4_000_000
#: Columns of a tile of counts.
TILE = 1024
PAIR = "item_a bigint, item_b bigint, n_ab bigint"


def popcount_pairs(rec: np.ndarray, col: np.ndarray, n_rec: int, n_col: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(i, j, n) with i < j: how many of the records 0..n_rec-1 hold both columns; (rec, col) are distinct and rec is
    sorted. Records are taken in slabs and columns in tiles, so neither the dense bits nor the counts grow with them."""
    for ti in range(0, n_col, TILE):
        for tj in range(ti, n_col, TILE):
            wi, wj = min(TILE, n_col - ti), min(TILE, n_col - tj)
            out = np.zeros((wi, wj), dtype=np.int64)
            for low in range(0, n_rec, SLAB):
                a, b = np.searchsorted(rec, [low, low + SLAB])
                left = _bits(rec[a:b] - low, col[a:b] - ti, min(SLAB, n_rec - low), wi)
                right = left if ti == tj else _bits(rec[a:b] - low, col[a:b] - tj, min(SLAB, n_rec - low), wj)
                for i in range(wi):
                    first = i if ti == tj else 0
                    out[i, first:] += np.bitwise_count(left[i] & right[first:]).sum(axis=1).astype(np.int64)
            i, j = np.nonzero(np.triu(out, 1) if ti == tj else out)
            yield i + ti, j + tj, out[i, j]


def _bits(rec: np.ndarray, col: np.ndarray, n_rec: int, n_col: int) -> np.ndarray:
    """A row of bits a column, a bit a record, for the columns 0..n_col-1."""
    dense = np.zeros((n_col, n_rec), dtype=np.uint8)
    own = (col >= 0) & (col < n_col)
    dense[col[own], rec[own]] = 1
    packed = np.packbits(dense, axis=1)
    return np.pad(packed, ((0, 0), (0, -packed.shape[1] % 8))).view(np.uint64)


def light_pairs(rec: np.ndarray, item: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of items within the same record, some AT_ONCE of them at a time; rec is sorted."""
    _, start, size = np.unique(rec, return_index=True, return_counts=True)
    for s in np.unique(size):
        if s > 1:
            i, j = np.triu_indices(s, 1)
            at = start[size == s]
            step = max(1, AT_ONCE // len(i))
            for k in range(0, len(at), step):
                part = at[k : k + step, None]
                yield item[(part + i).ravel()], item[(part + j).ravel()]


def counted(a: np.ndarray, b: np.ndarray, n: np.ndarray | None = None) -> pa.RecordBatch | None:
    """Sums of equal pairs, ordered within the pair."""
    if not len(a):
        return None
    a, b = np.minimum(a, b), np.maximum(a, b)
    items, codes = np.unique(np.concatenate([a, b]), return_inverse=True)
    key, at = np.unique(codes[: len(a)] * len(items) + codes[len(a) :], return_inverse=True)
    total = np.bincount(at, weights=n, minlength=len(key)).astype(np.int64)
    return pa.record_batch({"item_a": items[key // len(items)], "item_b": items[key % len(items)], "n_ab": total})


def block_pairs(rec: np.ndarray, item: np.ndarray, heavy: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Counts of all pairs within the records of a block."""
    order = np.lexsort((item, rec))
    rec, item, heavy = rec[order], item[order], heavy[order]
    rec = np.cumsum(np.r_[0, rec[1:] != rec[:-1]])
    n_rec = int(rec[-1]) + 1
    names, col = np.unique(item[heavy], return_inverse=True)
    hrec, lrec, litem = rec[heavy], rec[~heavy], item[~heavy]
    if len(names):
        for i, j, n in popcount_pairs(hrec, col, n_rec, len(names)):
            yield counted(names[i], names[j], n)
        # mixed: each light item's records are looked up in the heavy lists of the block
        begin = np.searchsorted(hrec, np.arange(n_rec + 1))
        width = (begin[1:] - begin[:-1])[lrec]
        step = max(1, AT_ONCE // max(1, int(width.max(initial=0))))
        for k in range(0, len(lrec), step):
            w = width[k : k + step]
            at = np.repeat(begin[lrec[k : k + step]] - np.r_[0, np.cumsum(w)[:-1]], w) + np.arange(w.sum())
            yield counted(np.repeat(litem[k : k + step], w), names[col[at]])
    for a, b in light_pairs(lrec, litem):
        yield counted(a, b)


def partition_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (rec, item, heavy) sorted by rec; a block ends where a record ends."""
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    rows, kept = 0, {}
    for batch in batches:
        codes = []
        for r in batch.column(0).to_pylist():
            codes.append(kept.setdefault(r, len(kept)))
        held.append((np.array(codes, dtype=np.int64), batch.column(1).to_numpy(), batch.column(2).to_numpy(zero_copy_only=False)))
        rows += batch.num_rows
        if rows >= BLOCK:
            rec, item, heavy = (np.concatenate(x) for x in zip(*held, strict=True))
            done = rec != rec[-1]
            if done.any():
                yield from filter(None, block_pairs(rec[done], item[done], heavy[done]))
            last = next(reversed(kept))
            held, rows, kept = [(np.zeros((~done).sum(), dtype=np.int64), item[~done], heavy[~done])], int((~done).sum()), {last: 0}
    if rows:
        yield from filter(None, block_pairs(*(np.concatenate(x) for x in zip(*held, strict=True))))


def unit_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of pairs of the units (unit, rec, side, item), which stand together by unit and record: pairs of sides 0
    and 1 if there is a 1, else pairs within side 0. Some AT_ONCE pairs are held and summed."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    size, last = 0, None
    sides: tuple[list, list] = ([], [])

    def close() -> None:
        nonlocal size
        a, b = (np.array(s, dtype=np.int64) for s in sides)
        if len(b):
            # a unit of many heavy items is worked off in parts
            step = max(1, AT_ONCE // len(b))
            for k in range(0, len(a), step):
                part = a[k : k + step]
                held.append((np.repeat(part, len(b)), np.tile(b, len(part))))
        elif len(a) > 1 and last[0]["a"] == last[0]["b"]:
            i, j = np.triu_indices(len(a), 1)
            held.append((a[i], a[j]))
        size = sum(len(x) for x, _ in held)

    def flush() -> pa.RecordBatch | None:
        nonlocal size
        out = counted(np.concatenate([x for x, _ in held]), np.concatenate([y for _, y in held])) if held else None
        held.clear()
        size = 0
        return out

    for batch in batches:
        for unit, rec, side, item in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if (unit, rec) != last:
                if last is not None:
                    close()
                    if size >= AT_ONCE and (out := flush()) is not None:
                        yield out
                sides, last = ([], []), (unit, rec)
            sides[side].append(item)
    if last is not None:
        close()
    if (out := flush()) is not None:
        yield out


def wide_pairs(items: DataFrame, wide: int) -> DataFrame:
    """(item_a, item_b, n_ab): the light and mixed pairs of wide records, summed a partition.

    items: (rec, item, heavy, m) of wide records, all distinct, m being a record's light items. A record has the power of
    two groups that leaves about `wide` light items in each, so records of like size share their units.
    """
    groups = F.expr(f"cast(pow(2, ceil(log2(m / {wide}))) as int)")
    known = items.withColumn("groups", groups).withColumn("g", F.pmod(F.xxhash64("item"), F.col("groups")).cast("int"))
    o = F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("o")
    light = known.where("not heavy").select("rec", "item", "groups", "g", o)
    unit = lambda a, b: F.struct(F.col("groups"), a.cast("int").alias("a"), b.cast("int").alias("b"))
    # group g meets each group, itself included: as side 0 if it is the smaller one
    light_units = light.select(unit(F.least("g", "o"), F.greatest("g", "o")).alias("unit"), "rec", F.when(F.col("g") > F.col("o"), 1).otherwise(0).alias("side"), "item")
    # the heavy items meet each group: -1 stands for them
    with_heavy = known.where("heavy").select("groups", "rec", o, "item").select(unit(F.col("o"), F.lit(-1)).alias("unit"), "rec", F.lit(1).alias("side"), "item")
    own = known.where("not heavy").select(unit(F.col("g"), F.lit(-1)).alias("unit"), "rec", F.lit(0).alias("side"), "item")
    mixed = own.unionByName(with_heavy)
    # a unit of groups whose other side is empty has no pairs; within one group it has, so the two are told apart by b
    units = light_units.unionByName(mixed).withColumn("slab", F.pmod(F.xxhash64("rec"), F.lit(64)))
    return units.repartition("unit", "slab").sortWithinPartitions("unit", "rec").select("unit", "rec", "side", "item").mapInArrow(unit_pairs, PAIR)


def cooccurrence(rows: DataFrame, rec: str, item: str, min_pairs: int = 1, min_lift: float = 0.0, wide: int = WIDE) -> DataFrame:
    """(item_a, item_b, n_a, n_b, n_ab, n_rec, lift) with item_a < item_b: pairs of items in at least min_pairs records
    together and at least min_lift times as often as chance, n_ab * n_rec / (n_a * n_b).

    rows: any columns; rec is any text, item a bigint. Rows with a null in either are no occurrence; repeated rows
    count once. n_rec counts the records with an item. An empty table gives no rows.
    Items in fewer than min_pairs records, or in more than n_rec / min_lift, are in no such pair (n_ab is at most n_a)
    and are dropped before the counting.
    """
    once = cut(rows.where(F.col(rec).isNotNull() & F.col(item).isNotNull()).select(F.col(rec).alias("rec"), F.col(item).alias("item")).distinct(), "occurrences")
    n_rec = once.select("rec").distinct().count()
    n = once.groupBy("item").agg(F.count(F.lit(1)).alias("n"))
    n = cut(n.where((F.col("n") >= min_pairs) & (F.col("n") * min_lift <= n_rec * (1 + 1e-9))).withColumn("heavy", F.col("n") * DENSITY >= n_rec), "items")
    known = lookup(once, n.select("item", "n", "heavy"), ["item"], "n")
    broad = known.where("not heavy").groupBy("rec").agg(F.count(F.lit(1)).alias("m")).where(F.col("m") > wide)
    broad = cut(broad, "wide")
    narrow = known
    if any_wide := not broad.isEmpty():
        known = cut(known, "known")
        of_wide = lookup(known, broad.withColumn("w", F.col("m")), ["rec"], "w")
        narrow = lookup(known, broad.select("rec", "m", F.lit(True).alias("is_wide")), ["rec"], "m", "left").where(F.col("heavy") | F.col("is_wide").isNull())
    parts = narrow.select("rec", "item", "heavy").repartition("rec").sortWithinPartitions("rec").mapInArrow(partition_pairs, PAIR)
    if any_wide:
        parts = parts.unionByName(wide_pairs(of_wide, wide))
    pairs = parts.groupBy("item_a", "item_b").agg(F.sum("n_ab").alias("n_ab"))
    pairs = pairs.where(F.col("n_ab") >= min_pairs)
    na, nb = (n.select(F.col("item").alias(f"item_{x}"), F.col("n").alias(f"n_{x}")) for x in "ab")
    out = pairs.join(na, "item_a").join(nb, "item_b").withColumn("n_rec", F.lit(n_rec).cast("bigint"))
    # whole numbers on both sides, so that a pair right on the bound is in
    out = out.where(F.col("n_ab").cast("decimal(20,0)") * F.col("n_rec") >= F.lit(min_lift).cast("decimal(12,6)") * F.col("n_a").cast("decimal(20,0)") * F.col("n_b"))
    return out.select("item_a", "item_b", "n_a", "n_b", "n_ab", "n_rec", (F.col("n_ab") * F.col("n_rec") / (F.col("n_a").cast("double") * F.col("n_b"))).alias("lift"))
