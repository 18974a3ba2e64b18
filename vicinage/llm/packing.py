"""Texts into containers of a fixed number of tokens: harmonic packing.

Lengths fall into reciprocal classes: class j holds lengths in (C/(j+1), C/j], and j of them always fit a container.
Each worker fills the containers of a class with a fixed count of j texts, whatever other workers do; texts up to
C/CLASSES make up the last class and are filled in turn. What room a full container of class j has left goes to texts of
the smallest class that fits for certain. Texts a worker can't complete a container with, fewer than j of each class,
go up a level, where the leftovers of a class meet in tasks of LEFT texts and again leave fewer than j each; the last level
has LEFT texts at most and closes what is open.

A text longer than a container is cut into whole containers and a rest that is packed like any other text.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vicinage.session import cut

CAPACITY, CLASSES = 2048, 32
TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: How the public byte-level vocabularies part texts before merging (a fixed value).
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Texts a worker holds before it fills containers, and leftovers one task of a higher level takes (more if a container takes more).
HELD, LEFT = 20_000, 500_000
PIECE = "piece_no int, tok_from int, tok_to int, n_tokens int, bin_id bigint"


@lru_cache(maxsize=2)
def encoder(path: str, pattern: str = PATTERN):  # noqa: ANN201
    """The tokenizer of a rank file, once per worker."""
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("packing", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


class Bins:
    """Pools of texts by class, and the containers they fill."""

    def __init__(self, capacity: int, first: int, classes: int = CLASSES) -> None:
        self.capacity, self.next, self.classes = capacity, first, max(1, min(classes, capacity))
        self.pools: list[list] = [[] for _ in range(self.classes + 1)]
        self.held = 0

    def put(self, item: object, size: int) -> None:
        self.pools[min(self.capacity // size, self.classes)].append((size, item))
        self.held += 1

    def _top_up(self, room: int, into: list) -> None:
        while room > 0:
            k = -(-self.capacity // room)  # any text of class k or above has at most room tokens
            if k > self.classes:
                pool = self.pools[self.classes]
                while pool and pool[-1][0] <= room:
                    room -= pool[-1][0]
                    into.append(pool.pop())
                return
            while k <= self.classes and not self.pools[k]:
                k += 1
            if k > self.classes:
                return
            into.append(self.pools[k].pop())
            room -= into[-1][0]

    def fill(self, close: bool = False) -> Iterator[tuple[int, list]]:
        """(container, texts) of the containers that are complete; with close, of all that is held."""
        for j in range(1, self.classes):
            pool = self.pools[j]
            while len(pool) >= j or (close and pool):
                take = [pool.pop() for _ in range(min(j, len(pool)))]
                self._top_up(self.capacity - sum(s for s, _ in take), take)
                yield self._done(take)
        pool = self.pools[self.classes]
        pool.sort(key=lambda x: x[0])
        while pool and (close or sum(s for s, _ in pool) >= self.capacity):
            take, room = [], self.capacity
            while pool and pool[-1][0] <= room:
                room -= pool[-1][0]
                take.append(pool.pop())
            at = 0
            while at < len(pool) and pool[at][0] <= room:  # the smallest into what is left
                room -= pool[at][0]
                at += 1
            take += pool[:at]
            del pool[:at]
            yield self._done(take)

    def _done(self, take: list) -> tuple[int, list]:
        self.held -= len(take)
        self.next += 1
        return self.next - 1, take


def _batch(rows: list[tuple], key: pa.DataType) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) if rows else [[]] * 6
    types = [key, pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.int64()]
    return pa.record_batch([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=["key", "piece_no", "tok_from", "tok_to", "n_tokens", "bin_id"])


def _packed(sizes: Iterator[list[tuple]], capacity: int, level: int, close: bool, key: pa.DataType, classes: int) -> Iterator[pa.RecordBatch]:
    """Rows (key, piece_no, tok_from, tok_to, n_tokens) with their container; null for those left over."""
    bins = Bins(capacity, (level << 54) + (TaskContext.get().partitionId() << 30), classes)
    for rows in sizes:
        for r in rows:
            bins.put(r, r[4])
        if bins.held >= HELD:
            yield _batch([(*r, b) for b, take in bins.fill() for _, r in take], key)
    yield _batch([(*r, b) for b, take in bins.fill(close) for _, r in take], key)
    yield _batch([(*r, None) for pool in bins.pools for _, r in pool], key)


def pack(docs: DataFrame, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY, tokenizer: str = TOKENIZER, pattern: str = PATTERN, classes: int = CLASSES, left: int = LEFT) -> DataFrame:
    """(key, piece_no, tok_from, tok_to, n_tokens, bin_id): the container of every text.

    piece_no is 0 but for texts of more than capacity tokens, which are cut; tok_from and tok_to (exclusive) are places
    in the text's tokens. Null and empty texts have no tokens and no row; a null key is kept; repeated rows are packed
    each for itself; other columns don't matter; an empty table gives no rows. tokenizer is the path of a rank file
    that every executor has.
    """
    kind = dict(docs.dtypes)[key]
    schema = f"key {kind}, {PIECE}"

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer, pattern)
        of = None

        def sizes(batch: pa.RecordBatch) -> list[tuple]:
            rows = []
            for k, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                n = len(enc.encode_ordinary(t)) if t else 0
                rows += [(k, i, a, min(a + capacity, n), min(capacity, n - a)) for i, a in enumerate(range(0, n, capacity))]
            return rows

        def stream() -> Iterator[list[tuple]]:
            nonlocal of
            for batch in batches:
                of = of or batch.schema.field(0).type
                yield sizes(batch)

        rows = stream()
        head = next(rows, None)
        if head is not None:
            yield from _packed((x for y in ([head], rows) for x in y), capacity, 0, False, of, classes)

    def again(batches: Iterator[pa.RecordBatch], level: int, close: bool) -> Iterator[pa.RecordBatch]:
        of = None

        def stream() -> Iterator[list[tuple]]:
            nonlocal of
            for batch in batches:
                of = of or batch.schema.field(0).type
                yield list(zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True))

        rows = stream()
        head = next(rows, None)
        if head is not None:
            yield from _packed((x for y in ([head], rows) for x in y), capacity, level, close, of, classes)

    done = cut(docs.select(F.col(key).alias("key"), F.col(text).alias("t")).mapInArrow(first, schema), "packed")
    out, level = done.where("bin_id is not null"), 1
    open_rows = done.where("bin_id is null")
    n_classes = max(1, min(classes, capacity))
    # a task of one class completes containers until fewer texts than one takes are left, so many go in for each left over
    left = max(left, 4 * max(n_classes, capacity))
    order = ("key", "piece_no", "n_tokens")
    while (n := open_rows.count()) > left:
        # leftovers of a class meet in tasks of their own; the same task must get the same rows if it runs again
        kind_of = F.least(F.lit(n_classes), F.expr(f"{capacity} div n_tokens"))
        held = open_rows.withColumn("_class", kind_of)
        sizes = {r[0]: -(-r[1] // left) for r in held.groupBy("_class").count().collect()}  # one row a class
        parts = F.create_map(*[F.lit(x) for kv in sizes.items() for x in kv])
        held = held.withColumn("_part", F.pmod(F.xxhash64(*order), parts[F.col("_class")]))
        slots = held.repartition("_class", "_part").sortWithinPartitions("_class", "_part", *order).drop("_class", "_part")
        packed = cut(slots.mapInArrow(lambda bs, at=level: again(bs, at, False), schema), "packed")
        out, open_rows, level = out.unionByName(packed.where("bin_id is not null")), packed.where("bin_id is null"), level + 1
    closing = open_rows.repartition(1).sortWithinPartitions(*order)
    out = out.unionByName(closing.mapInArrow(lambda bs, at=level: again(bs, at, True), schema))
    return out.select(F.col("key").alias(key), "piece_no", "tok_from", "tok_to", "n_tokens", "bin_id")


def fill_report(packed: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """(n_bins, n_tokens, least_bins, fill, fullest, over): one row about all containers; least_bins is the number that
    no packing can go below, fill the share of capacity in use, fullest the most tokens in a container and over the
    containers with more than their capacity."""
    per = packed.groupBy("bin_id").agg(F.sum("n_tokens").alias("n"))
    total = F.coalesce(F.sum("n"), F.lit(0))
    return per.agg(F.count(F.lit(1)).alias("n_bins"), total.alias("n_tokens"), F.ceil(total / capacity).alias("least_bins"), (F.sum("n") / (F.count(F.lit(1)) * capacity)).alias("fill"), F.max("n").alias("fullest"), F.count(F.when(F.col("n") > capacity, 1)).alias("over"))


def whole_report(docs: DataFrame, packed: DataFrame, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """(n_texts, n_packed, uneven, cut_needlessly): one row that says whether each text with a letter is packed once:
    texts, texts packed, texts whose pieces don't follow one another without a gap, and texts cut although they fit."""
    per = packed.groupBy(key).agg(F.min("tok_from").alias("lo"), F.max("tok_to").alias("hi"), F.sum("n_tokens").alias("n"), F.count(F.lit(1)).alias("k"))
    uneven = F.count(F.when((F.col("lo") != 0) | (F.col("hi") != F.col("n")), 1))
    needless = F.count(F.when(F.col("k") != F.ceil(F.col("n") / capacity), 1))
    n = docs.where(F.length(text) > 0).select(key).distinct().count()
    return per.agg(F.lit(n).cast("bigint").alias("n_texts"), F.count(F.lit(1)).alias("n_packed"), uneven.alias("uneven"), needless.alias("cut_needlessly"))
