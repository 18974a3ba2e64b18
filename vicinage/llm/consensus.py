"""The best record of each group of duplicates: align token sequences, vote per column, keep the record closest to the vote.

A record is a sequence of tokens, made of the values it has. The different sequences of a group are aligned progressively
into one profile of columns (Needleman-Wunsch against the profile so far); in every column the tokens collect the weights
of the records that hold them there. A token of trust t weighs B to the power of t, B being larger than any number of
records, so votes count among tokens of equal trust and no number of them outweighs more trust. The heaviest tokens are
the consensus. It need not exist as a record: the group's record with the least distance to it, column by column of its
alignment to the consensus, survives.

Nothing about a group is gathered: sequences are counted first, parts of at most CHUNK different sequences are aligned on
their own, the consensus sequences of parts are aligned level by level, and records are compared with the consensus of
their group where they are. The number of a group's parts follows from its own size alone.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import lru_cache, reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vicinage.operators.sweep import lookup
from vicinage.session import cut

GAP = None
#: Different sequences of a group that are aligned into one profile.
CHUNK = 256
#: A token: (kind, text, trust). Tokens of different kinds never share a column.
Token = tuple[int, str, int]
TOKENS = "array<struct<kind:int,tok:string,trust:bigint>>"

SAME, GAPPED, OTHER, ALIKE, NEVER = 2.0, -1.0, -1.5, 0.5, -1e9


def token(kind: int, text: Column, trust: Column) -> Column:
    """A token of a record; null if the text is."""
    return F.when(text.isNotNull(), F.struct(F.lit(kind).alias("kind"), text.cast("string").alias("tok"), trust.cast("bigint").alias("trust")))


def sequence(*tokens: Column) -> Column:
    """The tokens that aren't null, in order."""
    return F.array_compact(F.array(*tokens))


def _fit(col: dict, tok: Token) -> float:
    """The share of a column's weight that agrees with a token as score; other tokens of its kind may share the column:
    in free text (kind 0) at a loss, elsewhere because they are values of one field."""
    total = agree = 0
    alike = False
    for t, w in col.items():
        total += w
        if t is GAP:
            continue
        if t[0] != tok[0]:
            return NEVER
        if t[1] == tok[1]:
            agree += w
        alike = True
    if agree:
        return SAME * agree / total
    return (ALIKE if tok[0] else OTHER) if alike else NEVER


def _kind(col: dict) -> int:
    return next(t[0] for t in col if t is not GAP)


def align(profile: list[dict], seq: Sequence[Token], weight: int) -> list[dict]:
    """The profile (columns of token -> weight, GAP for none) after a sequence is aligned to it and its weight added.

    Needleman-Wunsch; ties prefer a match, then the order of kinds, then the profile.
    """
    if not profile:
        return [{t: weight} for t in seq]
    n, m = len(profile), len(seq)
    total = sum(profile[0].values())
    score = [[GAPPED * j for j in range(m + 1)]]
    fits = []
    for i in range(1, n + 1):
        col, above, row = profile[i - 1], score[-1], [GAPPED * i]
        fit = [_fit(col, t) for t in seq]
        fits.append(fit)
        for j in range(1, m + 1):
            row.append(max(above[j - 1] + fit[j - 1], above[j] + GAPPED, row[j - 1] + GAPPED))
        score.append(row)
    out: list[dict] = []
    i, j = n, m
    while i or j:
        if i and j and score[i][j] == score[i - 1][j - 1] + fits[i - 1][j - 1]:
            i, j = i - 1, j - 1
            col, tok = profile[i], seq[j]
        elif i and score[i][j] == score[i - 1][j] + GAPPED and not (j and score[i][j] == score[i][j - 1] + GAPPED and _kind(profile[i - 1]) < seq[j - 1][0]):
            i -= 1
            col, tok = profile[i], GAP
        else:
            j -= 1
            col, tok = {GAP: total}, seq[j]
        col[tok] = col.get(tok, 0) + weight
        out.append(col)
    return out[::-1]


def _vote(col: dict, gap_trust: int) -> Token | None:
    """The heaviest token of a column: more trust, then more votes, then a gap, then the larger text."""
    return max(col, key=lambda t: (gap_trust, col[t], True, "") if t is GAP else (t[2], col[t], False, t[1]))


def consensus(values: Sequence[tuple[Sequence[Token], int]], gap_trust: int = 0) -> list[Token]:
    """The consensus of weighted sequences: columns whose heaviest token is a gap are left out."""
    profile: list[dict] = []
    for seq, weight in sorted(values, key=lambda v: (-v[1], -len(v[0]), v[0])):
        profile = align(profile, seq, weight)
    return [t for t in (_vote(col, gap_trust) for col in profile) if t is not GAP]


def words_of(text: str) -> tuple[Token, ...]:
    return tuple((0, w, 0) for w in text.split())


def profile_text(values: Sequence[tuple[str, int]]) -> str:
    """The consensus words of weighted texts."""
    return " ".join(t[1] for t in consensus([(words_of(text), n) for text, n in values]))


def word_distance(a: Sequence[str], b: Sequence[str]) -> int:
    """Words to put in, take out or change to make one text of the other."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


FAR = 2**62


@lru_cache(maxsize=100_000)
def distances(agreed: tuple[Token, ...], seq: tuple[Token, ...]) -> list[int]:
    """How far a sequence is from the consensus in each of its columns: 0 for the same token, the trust that is missing
    for another one, at least 1, FAR for a gap; and at the end the number of tokens it has beside these columns."""
    out, beside = [], 0
    for col in align([{t: 1} for t in agreed], list(seq), 1):
        at = next((t for t in agreed if t in col), None)
        if at is None:
            beside += 1
            continue
        own = next((t for t in col if t is not GAP and t != at), None)
        out.append(0 if col.get(at, 0) > 1 else max(1, at[2] - own[2]) if own else FAR)
    return [*out, beside]


def _streamed(batches: Iterator[pa.RecordBatch], gap_trust: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """One row (grp, part, consensus, n, k) for the rows (grp, part, seq, n, k) of each part, which stand together."""
    held, last, k = [], None, 0
    out: list[tuple] = []

    def close() -> None:
        out.append((*last, [{"kind": a, "tok": b, "trust": c} for a, b, c in consensus(held, gap_trust)], sum(n for _, n in held), k))

    def flush() -> pa.RecordBatch:
        cols = list(zip(*out, strict=True))
        out.clear()
        return pa.record_batch([pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)

    for batch in batches:
        for grp, part, seq, n, own in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if (grp, part) != last:
                if held:
                    close()
                held, last, k = [], (grp, part), 0
            held.append((tuple((x["kind"], x["tok"], x["trust"]) for x in seq), n))
            k += own
        if len(out) >= 5000:
            yield flush()
    if held:
        close()
    if out:
        yield flush()


def agree(seqs: DataFrame, sizes: DataFrame, gap_trust: int, chunk: int = CHUNK) -> DataFrame:
    """(grp, agreed, k): the consensus of each group, in levels. seqs: (grp, seq, n), sizes: (grp, k) with the number of
    a group's different sequences, for the groups wanted.

    A sequence's part comes from a hash of it, so a task that runs again aligns the same.
    """
    kind = dict(seqs.dtypes)["grp"]
    names = [("part", pa.int64()), ("seq", pa.list_(pa.struct([("kind", pa.int32()), ("tok", pa.string()), ("trust", pa.int64())]))), ("n", pa.int64()), ("k", pa.int64())]
    schema = pa.schema([("grp", _arrow(kind)), *names])
    level = lookup(seqs, sizes.select("grp", F.col("k").alias("size"), F.col("k").alias("w")), ["grp"], "w").withColumn("k", F.lit(1).cast("bigint"))
    out: list[DataFrame] = []
    while True:
        # a group of at most chunk sequences is one part and done; -1 says so
        parts = F.ceil(F.col("size") / chunk).cast("bigint")
        placed = level.select("grp", F.when(parts > 1, F.pmod(F.xxhash64("seq", "n"), parts)).otherwise(-1).alias("part"), "seq", "n", "k")
        rows = placed.repartition("grp", "part").sortWithinPartitions("grp", "part")
        done = cut(rows.mapInArrow(lambda bs: _streamed(bs, gap_trust, schema), f"grp {kind}, part bigint, seq {TOKENS}, n bigint, k bigint"), "consensus")
        out.append(done.where("part = -1").select("grp", F.col("seq").alias("agreed"), "k"))
        more = done.where("part >= 0").select("grp", "seq", "n", "k")
        if more.isEmpty():
            return reduce(DataFrame.unionByName, out)
        sizes = more.groupBy("grp").agg(F.count(F.lit(1)).alias("size")).withColumn("w", F.col("size"))
        level = lookup(more, sizes, ["grp"], "w")


def _arrow(kind: str) -> pa.DataType:
    return {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "double": pa.float64(), "smallint": pa.int16(), "tinyint": pa.int8(), "date": pa.date32(), "boolean": pa.bool_()}[kind]


def survivors(df: DataFrame, group: str, key: Column, seq: Column, chunk: int = CHUNK, gap_trust: int = -1) -> DataFrame:
    """(group, survivor): per group with at least two different keys, the key of the record closest to the group's
    consensus; its first column counts before the second and so on. seq: the tokens of a record, see sequence().

    gap_trust: the trust of a missing token; at -1 any token outweighs it, at 0 it is voted for like a token.
    Rows with a null group or key belong to no group. Repeated rows change nothing but votes. A gap is further from a
    token than any other token is, and no distance where the consensus has no column. Equal distances: the smaller key.
    Other columns of df don't matter; an empty table gives no rows.
    """
    rows = df.select(F.col(group).alias("grp"), key.alias("key"), seq.alias("seq")).where("grp is not null and key is not null")
    own = dict(rows.dtypes)
    # a record of a group per sequence is enough: the smallest key of those alike
    seqs = cut(rows.groupBy("grp", "seq").agg(F.count(F.lit(1)).alias("n"), F.min("key").alias("key"), F.max("key").alias("last")), "sequences")
    sizes = cut(seqs.groupBy("grp").agg(F.count(F.lit(1)).alias("k"), F.min("key").alias("lo"), F.max("last").alias("hi")).where("lo < hi"), "groups")
    alike = sizes.where("k = 1").select("grp", F.col("lo").alias("survivor"))
    several = sizes.where("k > 1").select("grp", "k")
    agreed = agree(seqs.select("grp", "seq", "n"), several, gap_trust, chunk)
    placed = lookup(seqs.select("grp", "seq", "key"), agreed, ["grp"], "k")

    def far(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        as_tokens = lambda xs: tuple((x["kind"], x["tok"], x["trust"]) for x in xs)
        for batch in batches:
            apart = [distances(as_tokens(a), as_tokens(s)) for s, a in zip(batch.column("seq").to_pylist(), batch.column("agreed").to_pylist(), strict=True)]
            yield pa.record_batch([batch.column("grp"), batch.column("key"), pa.array(apart, pa.list_(pa.int64()))], names=["grp", "key", "d"])

    near = placed.select("grp", "key", "seq", "agreed").mapInArrow(far, f"grp {own['grp']}, key {own['key']}, d array<bigint>")
    best = near.groupBy("grp").agg(F.min(F.struct("d", "key")).alias("best")).select("grp", F.col("best.key").alias("survivor"))
    return alike.unionByName(best).withColumnRenamed("grp", group)


def text_consensus(df: DataFrame, group: str, text: str, chunk: int = CHUNK) -> DataFrame:
    """(group, consensus, value, n_rows): per group the consensus words, and the existing value closest to them, with
    the rows that hold it; equal distances: more rows, then the smaller text.

    Values are compared without outer and repeated blanks. Rows with a null or empty group or text don't count. Values
    of a group are counted first; each part of at most chunk different values is aligned on its own and the parts'
    consensus texts are aligned with their summed weight until one is left, so a group of any size fits. A group's
    parts come from its own number of values: other groups change nothing.
    """
    tidy = F.regexp_replace(F.trim(F.regexp_replace(F.col(text).cast("string"), r"(?U)\s+", " ")), "^ | $", "")
    values = cut(df.select(F.col(group).alias("grp"), tidy.alias("value")).where("grp is not null and value <> ''").groupBy("grp", "value").agg(F.count(F.lit(1)).alias("n")), "values")
    sizes = cut(values.groupBy("grp").agg(F.count(F.lit(1)).alias("k")), "groups")
    # a group of one value is its own consensus
    alone = lookup(values, sizes.where("k = 1"), ["grp"], "k").select("grp", F.col("value").alias("consensus"), "value", F.col("n").alias("n_rows"))
    several = sizes.where("k > 1")
    as_tokens = F.transform(F.split("value", " "), lambda w: F.struct(F.lit(0).alias("kind"), w.alias("tok"), F.lit(0).cast("bigint").alias("trust")))
    agreed = agree(values.select("grp", as_tokens.alias("seq"), "n"), several, 0, chunk)
    agreed = agreed.select("grp", F.array_join(F.transform("agreed", lambda t: t["tok"]), " ").alias("consensus"), "k")

    @F.pandas_udf("int")
    def distance(a, b):  # noqa: ANN001, ANN202
        return (a.combine(b, lambda x, y: word_distance(x.split(), y.split()))).astype("int32")

    near = lookup(values, agreed, ["grp"], "k").withColumn("d", distance("value", "consensus"))
    best = near.groupBy("grp", "consensus").agg(F.min(F.struct("d", (-F.col("n")).alias("m"), "value")).alias("b"))
    return alone.unionByName(best.select("grp", "consensus", F.col("b.value").alias("value"), (-F.col("b.m")).alias("n_rows"))).withColumnRenamed("grp", group)
