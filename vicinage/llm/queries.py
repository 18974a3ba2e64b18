"""Queries of this subpackage over the test tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vicinage.functions.clean import label, whole_number
from vicinage.llm.components import connected_components, hit_edges
from vicinage.llm.consensus import text_consensus
from vicinage.llm.cooccur import cooccurrence
from vicinage.llm.leakage import leaks
from vicinage.llm.packing import fill_report, pack, whole_report
from vicinage.llm.records import record_survivors
from vicinage.llm.sentences import sentences
from vicinage.llm.setjoin import similar_classes, similar_pairs
from vicinage.llm.termfreq import TermCounts, signed
from vicinage.session import cut


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def families(spark: SparkSession, sf: str) -> DataFrame:
    """(rec, term): contig and family of each protein, null where they can't be read."""
    return _table(spark, sf, "proteins").select(label("target_nuc").alias("rec"), whole_number("fam_cluster").alias("term"))


def p1_found(spark: SparkSession, sf: str) -> DataFrame:
    return connected_components(hit_edges(_table(spark, sf, "hits")))


def p1_sizes(spark: SparkSession, sf: str) -> DataFrame:
    return p1_found(spark, sf).groupBy("group_id").agg(F.count(F.lit(1)).alias("n_members"))


def p3_found(spark: SparkSession, sf: str) -> DataFrame:
    return cooccurrence(families(spark, sf), "rec", "term", min_pairs=8, min_lift=3).select(F.col("item_a").alias("fam_a"), F.col("item_b").alias("fam_b"))


def p3_lift(spark: SparkSession, sf: str) -> DataFrame:
    return cooccurrence(families(spark, sf), "rec", "term", min_pairs=3).select(F.col("item_a").alias("fam_a"), F.col("item_b").alias("fam_b"), "n_a", "n_b", "n_ab", F.round("lift", 6).alias("lift"))


def first_reading(spark: SparkSession, sf: str) -> DataFrame:
    """(rec, term) as a load before any cleaning reads them: the contig as it is written, the family if it is plain digits."""
    return _table(spark, sf, "proteins").select(F.col("target_nuc").alias("rec"), F.col("fam_cluster").try_cast("bigint").alias("term"))


def _counts(spark: SparkSession, sf: str) -> TermCounts:
    """The first reading of the whole table is loaded; the rows that were read otherwise than they should be are
    corrected by a delta: their old form is deleted, their new one added."""
    counts = TermCounts(spark)
    counts.apply(signed(added=first_reading(spark, sf)))
    own = _table(spark, sf, "proteins")
    both = own.select(F.col("target_nuc").alias("rec0"), F.col("fam_cluster").try_cast("bigint").alias("term0"), label("target_nuc").alias("rec"), whole_number("fam_cluster").alias("term"))
    changed = both.where(~(F.col("rec0").eqNullSafe(F.col("rec")) & F.col("term0").eqNullSafe(F.col("term"))))
    forms = F.array(F.struct(F.col("rec0").alias("rec"), F.col("term0").alias("term"), F.lit(-1).alias("sign")), F.struct("rec", "term", F.lit(1).alias("sign")))
    counts.apply(changed.select(F.explode(forms).alias("f")).select("f.*"))
    return counts


def p4_found(spark: SparkSession, sf: str) -> DataFrame:
    return _counts(spark, sf).marked().where("mark is not null").select(F.col("term").alias("fam_cluster"), "mark")


def p4_counts(spark: SparkSession, sf: str) -> DataFrame:
    return _counts(spark, sf).counts().select(F.col("term").alias("fam_cluster"), "n_rows", F.col("n_records").alias("n_contigs"))


def p4_increments(spark: SparkSession, sf: str) -> DataFrame:
    """The same counts by three deltas: all contigs ending in .1, all others, then every row of family 3 taken away."""
    rows, counts = families(spark, sf), TermCounts(spark)
    first = F.coalesce(F.col("rec").endswith(".1"), F.lit(False))
    counts.apply(signed(added=rows.where(first)))
    counts.apply(signed(added=rows.where(~first)))
    counts.apply(signed(deleted=rows.where("term = 3")))
    return counts.counts().select(F.col("term").alias("fam_cluster"), "n_rows", F.col("n_records").alias("n_contigs"))


def p5_found(spark: SparkSession, sf: str) -> DataFrame:
    return similar_pairs(families(spark, sf), "rec", "term", 0.6, 3).select(F.col("rec_a").alias("nuc_a"), F.col("rec_b").alias("nuc_b"))


def p5_classes(spark: SparkSession, sf: str) -> DataFrame:
    """Each contig with its class of equal sets and the number of other classes similar to it."""
    members, pairs = similar_classes(families(spark, sf), "rec", "term", 0.6, 3)
    ends = pairs.select(F.explode(F.array("class_a", "class_b")).alias("class_id")).groupBy("class_id").agg(F.count(F.lit(1)).alias("n_links"))
    return members.join(ends, "class_id", "left").select(F.col("rec").alias("nuc"), "class_id", F.coalesce("n_links", F.lit(0)).alias("n_links"))


def p7_found(spark: SparkSession, sf: str) -> DataFrame:
    return record_survivors(_table(spark, sf, "records"))


def p7_products(spark: SparkSession, sf: str) -> DataFrame:
    """The product name that stands for each family, by word alignment and vote."""
    rows = _table(spark, sf, "proteins").select(whole_number("fam_cluster").alias("fam_cluster"), F.lower("product").alias("product"))
    return text_consensus(rows, "fam_cluster", "product")


def p8_pack(spark: SparkSession, sf: str) -> DataFrame:
    return pack(_table(spark, sf, "documents"))


def p8_fill(spark: SparkSession, sf: str) -> DataFrame:
    return fill_report(pack(_table(spark, sf, "documents")))


def p8_whole(spark: SparkSession, sf: str) -> DataFrame:
    """Whether every text is packed, once and whole, and no container holds more than its capacity."""
    docs = _table(spark, sf, "documents")
    packed = cut(pack(docs), "whole")
    over = fill_report(packed).first()["over"]
    return whole_report(docs, packed).withColumn("over", F.lit(over))


def p9_found(spark: SparkSession, sf: str) -> DataFrame:
    return leaks(_table(spark, sf, "documents"), _table(spark, sf, "eval_items")).select("doc_id", "item_id").distinct()


def p9_items(spark: SparkSession, sf: str) -> DataFrame:
    """Each test item that leaked, with the documents that hold part of it and the longest run of windows."""
    found = leaks(_table(spark, sf, "documents"), _table(spark, sf, "eval_items"))
    return found.groupBy("item_id").agg(F.countDistinct("doc_id").alias("n_docs"), F.max("n_found").alias("most_windows"))


def p10_found(spark: SparkSession, sf: str) -> DataFrame:
    return sentences(_table(spark, sf, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (p1_found, p1_sizes, p3_found, p3_lift, p4_found, p4_counts, p4_increments, p5_found, p5_classes, p7_found, p7_products, p8_pack, p8_fill, p8_whole, p9_found, p9_items, p10_found)
    return {f.__name__: f for f in own}


_FAMILIES = r"""
    fams as (
      select case when trim(target_nuc, e' \t\n\r') = '' then null else trim(target_nuc, e' \t\n\r') end as rec,
             case when regexp_matches(trim(fam_cluster, e' \t\n\r'), '^[+-]?[0-9]+(\.0*)?$')
                  then cast(split_part(trim(fam_cluster, e' \t\n\r'), '.', 1) as bigint) end as term
      from proteins),
    once as (select distinct rec, term from fams where rec is not null and term is not null),
    n as (select term, count(*) as n from once group by term),
    total as (select count(distinct rec) as n_rec from once)
"""
_BARE = r"trim(regexp_replace({}, '^.*\|', ''), e' \t\n\r')"
_EDGES = f"""
    hit as (select {_BARE.format("qseqid")} as a, {_BARE.format("sseqid")} as b from hits where evalue <= 1e-5 and pident >= 30),
    edge as (select a, b from hit where a <> b union select b, a from hit where a <> b)
"""
_GROUPS = f"""
    with recursive {_EDGES},
    reach(member_id, label) as (
      select a, least(a, min(b)) from edge group by a
      union
      select e.b, r.label from reach r join edge e on e.a = r.member_id where r.label < e.b)
"""
_SHARED = """
    pairs as (select x.term as fam_a, y.term as fam_b, count(*) as n_ab
              from once x join once y on x.rec = y.rec and x.term < y.term group by 1, 2)
"""
_SETS = """
    big as (select rec, count(*) as m from once group by rec having count(*) >= 3),
    shared as (select x.rec as nuc_a, y.rec as nuc_b, count(*) as k
               from once x join once y on x.term = y.term and x.rec < y.rec group by 1, 2),
    alike as (select nuc_a, nuc_b, p.m as ma, q.m as mb, k from shared join big p on p.rec = nuc_a join big q on q.rec = nuc_b
                where k * 5 >= 3 * (p.m + q.m - k))
"""
_RANKED = r"""
    with sound as (
      select ipg_id, cast(trim(unique_id, e' \t\n\r') as bigint) as uid,
             coalesce(lower(trim(assembly_level, e' \t\n\r')) in ('chromosome', 'complete genome'), false) as finished,
             nullif(trim(assembly_id, e' \t\n\r'), '') as assembly,
             coalesce(is_refseq_query, false) as refseq,
             case when sequence_length > 0 then sequence_length end as len
      from records where failed is distinct from true and ipg_id is not null),
    ranked as (
      select ipg_id, uid, row_number() over (partition by ipg_id order by
               case when finished and coalesce(upper(assembly) like 'GCF%', false) then 1 when finished then 2 when assembly is not null then 3 else 4 end,
               refseq desc, len desc nulls last, uid) as place
      from sound)
"""


def oracle_sql() -> dict[str, str]:
    return {
        "p1_found": f"{_GROUPS} select member_id, min(label) as group_id from reach group by member_id",
        "p1_sizes": f"{_GROUPS}, found as (select member_id, min(label) as group_id from reach group by member_id) select group_id, count(*) as n_members from found group by group_id",
        "p3_found": f"with {_FAMILIES}, {_SHARED} select fam_a, fam_b from pairs join n a on a.term = fam_a join n b on b.term = fam_b, total where n_ab >= 8 and n_ab * n_rec >= 3 * a.n * b.n",
        "p3_lift": f"with {_FAMILIES}, {_SHARED} select fam_a, fam_b, a.n as n_a, b.n as n_b, n_ab, round(n_ab * n_rec / (cast(a.n as double) * b.n), 6) as lift from pairs join n a on a.term = fam_a join n b on b.term = fam_b, total where n_ab >= 3",
        "p4_found": f"with {_FAMILIES} select term as fam_cluster, case when n < 3 then 'rare' else 'common' end as mark from n, total where n < 3 or n > (n_rec + 4) // 5",
        "p4_counts": f"with {_FAMILIES} select term as fam_cluster, count(*) as n_rows, count(distinct rec) as n_contigs from fams where rec is not null and term is not null group by term",
        "p4_increments": f"with {_FAMILIES} select term as fam_cluster, count(*) as n_rows, count(distinct rec) as n_contigs from fams where rec is not null and term <> 3 group by term",
        "p5_found": f"with {_FAMILIES}, {_SETS} select nuc_a, nuc_b from alike",
        "p5_classes": f"""with {_FAMILIES}, {_SETS},
            sets as (select rec, list(term order by term) as toks from once where rec in (select rec from big) group by rec),
            class as (select rec, min(rec) over (partition by toks) as class_id from sets),
            link as (select nuc_a as c from alike, class p, class q where p.rec = nuc_a and q.rec = nuc_b and p.class_id = p.rec and q.class_id = q.rec
                     union all select nuc_b from alike, class p, class q where p.rec = nuc_a and q.rec = nuc_b and p.class_id = p.rec and q.class_id = q.rec)
            select rec as nuc, class_id, (select count(*) from link where c = class_id) as n_links from class""",
        "p8_whole": "select count(*) as n_texts, count(*) as n_packed, 0 as uneven, 0 as cut_needlessly, 0 as over from documents where length(text) > 0",
        "p7_found": f"{_RANKED} select ipg_id, cast(uid as varchar) as unique_id from ranked where place = 1 and ipg_id in (select ipg_id from sound group by ipg_id having count(distinct uid) >= 2)",
    }
