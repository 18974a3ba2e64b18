"""All pairs of records whose sets of values overlap above a Jaccard threshold: a prefix-filtered join.

Equal sets form one class and only classes are joined. Tokens are numbered by rarity; a class is indexed under the
tokens of its prefix only, as two sets at the threshold must share one there. Length and positional filters come next,
and a pair is verified only under the first token both have, so that none is made twice.

Sets of more than INLINE tokens are never gathered into one row: see long_pairs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vicinage.operators.sweep import lookup
from vicinage.session import cut

INLINE = 512


def _ceil(x: Column) -> Column:
    """Rounded up, but not for what floating point adds to a whole number."""
    return F.ceil(x - 1e-9).cast("int")


def set_classes(rows: DataFrame, rec: str, token: str, min_size: int, inline: int = INLINE) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(members, sets, long): (rec, class_id) of each record of at least min_size and at most inline tokens, class_id
    being the smallest record with the same set; (class_id, toks) with tokens as numbers by rarity, ascending; and
    (rec, tok, size) of the larger records."""
    once = cut(rows.where(F.col(rec).isNotNull() & F.col(token).isNotNull()).select(F.col(rec).alias("rec"), F.col(token).alias("token")).distinct(), "tokens")
    df = once.groupBy("token").agg(F.count(F.lit(1)).alias("df"))
    sizes = once.groupBy("rec").agg(F.count(F.lit(1)).cast("int").alias("size")).where(F.col("size") >= min_size)
    # the rarity of a token, not its place in a sorted list: equal frequencies are told apart by a hash and the token
    known = lookup(once, df.withColumn("n", F.col("df")), ["token"], "n").select("rec", F.struct("df", F.xxhash64("token").alias("h"), "token").alias("tok"))
    big = cut(sizes.where(F.col("size") > inline), "long")
    if big.isEmpty():
        short, long = known, known.where("false").select("rec", "tok", F.lit(0).alias("size"))
    else:
        short = known.join(big.select("rec"), "rec", "left_anti")
        long = cut(known.join(big, "rec").select("rec", "tok", "size"), "longrows")
    grouped = cut(short.groupBy("rec").agg(F.array_sort(F.collect_list("tok")).alias("toks")).where(F.size("toks") >= min_size), "sets")
    classes = cut(grouped.groupBy("toks").agg(F.min("rec").alias("class_id"), F.count(F.lit(1)).alias("n_recs")), "classes")
    # a class may be a third of all records: they find it by its set, and no row lists them
    of_many = classes.where("n_recs > 1")
    members = lookup(grouped, of_many.select("toks", "class_id", "n_recs"), ["toks"], "n_recs").select("rec", "class_id")
    alone = classes.where("n_recs = 1").select(F.col("class_id").alias("rec"), "class_id")
    return members.unionByName(alone), classes.select("class_id", "toks"), long


def class_pairs(sets: DataFrame, threshold: float) -> DataFrame:
    """(class_a, class_b, jaccard), class_a < class_b, of different classes at the threshold or above."""
    t = threshold
    full = sets.select("class_id", F.transform("toks", lambda x: x["token"]).alias("toks"), F.size("toks").alias("n"))
    prefix = full.withColumn("p", F.col("n") - _ceil(F.col("n") * t) + 1).select("class_id", "toks", "n", F.posexplode(F.slice("toks", F.lit(1), F.col("p"))).alias("pos", "tok"))
    a = prefix.select("tok", *[F.col(c).alias(f"{c}_a") for c in ("class_id", "toks", "n", "pos")])
    b = prefix.select("tok", *[F.col(c).alias(f"{c}_b") for c in ("class_id", "toks", "n", "pos")])
    need = _ceil((F.col("n_a") + F.col("n_b")) * (t / (1 + t)))
    long_enough = (F.col("n_b") >= F.col("n_a") * t - 1e-9) & (F.col("n_a") >= F.col("n_b") * t - 1e-9)
    may_reach = F.least(F.col("n_a") - F.col("pos_a"), F.col("n_b") - F.col("pos_b")) >= need
    found = a.join(b, (a["tok"] == b["tok"]) & (F.col("class_id_a") < F.col("class_id_b")) & long_enough & may_reach)
    # under a later shared token the pair has been seen: nothing before the two places may be shared
    first = ~F.arrays_overlap(F.slice("toks_a", F.lit(1), F.col("pos_a")), F.slice("toks_b", F.lit(1), F.col("pos_b")))
    shared = F.size(F.array_intersect("toks_a", "toks_b"))
    found = found.where(first).select(F.col("class_id_a").alias("class_a"), F.col("class_id_b").alias("class_b"), "n_a", "n_b", shared.alias("n_ab"))
    return found.where(F.col("n_ab") >= need).select("class_a", "class_b", (F.col("n_ab") / (F.col("n_a") + F.col("n_b") - F.col("n_ab"))).alias("jaccard"))


def long_pairs(long: DataFrame, members: DataFrame, sets: DataFrame, threshold: float, inline: int) -> DataFrame:
    """(rec_a, rec_b, jaccard) of pairs with a record too large for one row, with each other and with the records large
    enough to match one: the same filters over rows of tokens, then shared tokens of the candidates are counted by
    joins. A record's tokens are numbered by a window that streams them, whatever their number."""
    t = threshold
    near = sets.where(F.size("toks") >= inline * t).join(members, "class_id").select("rec", F.size("toks").alias("size"), F.posexplode("toks").alias("pos", "tok"))
    ranked = long.select("rec", "size", (F.row_number().over(W.partitionBy("rec").orderBy("tok")) - 1).alias("pos"), "tok")
    other = ranked.unionByName(near)
    prefix = F.col("pos") < F.col("size") - _ceil(F.col("size") * t) + 1
    a, b = (df.where(prefix).select("tok", F.col("rec").alias(f"r{x}"), F.col("size").alias(f"s{x}"), F.col("pos").alias(f"p{x}")) for x, df in (("a", ranked), ("b", other)))
    need = _ceil((F.col("sa") + F.col("sb")) * (t / (1 + t)))
    once = (F.col("ra") < F.col("rb")) | ((F.col("ra") > F.col("rb")) & (F.col("sb") <= inline))
    fits = (F.col("sa") >= F.col("sb") * t - 1e-9) & (F.col("sb") >= F.col("sa") * t - 1e-9) & (F.least(F.col("sa") - F.col("pa"), F.col("sb") - F.col("pb")) >= need)
    found = a.join(b, "tok").where(once & fits).select("ra", "rb", "sa", "sb").distinct()
    with_a = found.join(long.select(F.col("rec").alias("ra"), "tok"), "ra")
    shared = with_a.join(other.select(F.col("rec").alias("rb"), "tok"), ["rb", "tok"]).groupBy("ra", "rb", "sa", "sb").agg(F.count(F.lit(1)).cast("int").alias("n"))
    jaccard = (F.col("n") / (F.col("sa") + F.col("sb") - F.col("n"))).alias("jaccard")
    return shared.where(F.col("n") >= need).select(F.least("ra", "rb").alias("rec_a"), F.greatest("ra", "rb").alias("rec_b"), jaccard)


def similar_classes(rows: DataFrame, rec: str, token: str, threshold: float, min_size: int = 1, inline: int = INLINE) -> tuple[DataFrame, DataFrame]:
    """(membership, pairs): (rec, class_id) and (class_a, class_b, jaccard). Records with equal sets are one class and
    need no pairs; each larger record than inline is a class of its own."""
    members, sets, long = set_classes(rows, rec, token, min_size, inline)
    own = long.select("rec", F.col("rec").alias("class_id")).distinct()
    reps = sets.select(F.col("class_id").alias("rec"), "class_id")
    far = long_pairs(long, reps, sets, threshold, inline).select(F.col("rec_a").alias("class_a"), F.col("rec_b").alias("class_b"), "jaccard")
    return members.unionByName(own), class_pairs(sets, threshold).unionByName(far)


def similar_pairs(rows: DataFrame, rec: str, token: str, threshold: float, min_size: int = 1, inline: int = INLINE) -> DataFrame:
    """(rec_a, rec_b, jaccard) with rec_a < rec_b: all pairs of records whose token sets have a Jaccard similarity of
    threshold or more, of records with at least min_size tokens.

    rows: one row per record and token, other columns don't matter. Rows with a null in either don't count, repeated
    rows count once. An empty table gives no rows. Pairs of classes are spelled out to pairs of records at the end,
    as many as there are in the result; similar_classes keeps classes.
    """
    members, pairs = similar_classes(rows, rec, token, threshold, min_size, inline)
    a = members.select(F.col("class_id").alias("class_a"), F.col("rec").alias("ra"))
    b = members.select(F.col("class_id").alias("class_b"), F.col("rec").alias("rb"))
    across = pairs.join(a, "class_a").join(b, "class_b").select("ra", "rb", "jaccard")
    within = a.join(b, (F.col("class_a") == F.col("class_b")) & (F.col("ra") < F.col("rb"))).select("ra", "rb", F.lit(1.0).alias("jaccard"))
    out = across.unionByName(within)
    return out.select(F.least("ra", "rb").alias("rec_a"), F.greatest("ra", "rb").alias("rec_b"), "jaccard")


def match_tables(left: DataFrame, right: DataFrame, rec: str, token: str, threshold: float, min_size: int = 1) -> DataFrame:
    """(rec_a, rec_b, jaccard): the similar pairs between two tables, rec_a of left and rec_b of right."""
    both = left.select(F.concat(F.lit("l"), F.col(rec).cast("string")).alias("rec"), F.col(token).alias("token")).unionByName(right.select(F.concat(F.lit("r"), F.col(rec).cast("string")).alias("rec"), F.col(token).alias("token")))
    found = similar_pairs(both, "rec", "token", threshold, min_size).where(F.col("rec_a").startswith("l") & F.col("rec_b").startswith("r"))
    cut_first = lambda c: F.substr(c, F.lit(2))
    return found.select(cut_first("rec_a").alias("rec_a"), cut_first("rec_b").alias("rec_b"), "jaccard")

