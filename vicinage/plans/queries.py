"""Queries of the core over the test tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vicinage.functions.clean import label
from vicinage.operators.coverage import coverage
from vicinage.operators.packed import split_packed


#: Positions of a protein that one shard holds; proteins of more are merged in several and stitched.
DOMAIN_SHARD = 128


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def p2_found(spark: SparkSession, sf: str) -> DataFrame:
    gff = split_packed(table(spark, sf, "gff"), label("id"), "attributes").select(F.lit("gff").alias("src_table"), "*")
    ogs = split_packed(table(spark, sf, "eggnog_prots"), label(F.col("id").cast("string")), "ogs", name="ogs", keyed=False).select(F.lit("eggnog_prots").alias("src_table"), "*")
    return gff.unionByName(ogs)


def domain_hits(spark: SparkSession, sf: str) -> DataFrame:
    """(protein_id, domain_id_clean, start, end) with the domain as its id up to the first dot."""
    domain = F.nullif(F.substring_index(F.coalesce(label("domain_id_clean"), label("domain_id")), ".", 1), F.lit(""))
    return table(spark, sf, "domain_hits").select(label("protein_id").alias("protein_id"), domain.alias("domain_id_clean"), "start", "end")


def p6_found(spark: SparkSession, sf: str) -> DataFrame:
    return coverage(domain_hits(spark, sf), ["protein_id", "domain_id_clean"], "start", "end", DOMAIN_SHARD)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (p2_found, p6_found)}


def oracle_sql() -> dict[str, str]:
    return {
        "p6_found": r"""
    with hit as (
      select trim(protein_id, e' \t\n\r') as protein_id,
             split_part(coalesce(nullif(trim(domain_id_clean, e' \t\n\r'), ''), trim(domain_id, e' \t\n\r')), '.', 1) as domain_id_clean,
             least(start, "end") as s, greatest(start, "end") as e
      from domain_hits where protein_id is not null and start is not null and "end" is not null),
    reached as (select *, max(e) over (partition by protein_id, domain_id_clean order by s, e rows between unbounded preceding and 1 preceding) as reach from hit),
    numbered as (select *, sum(case when reach is null or s > reach + 1 then 1 else 0 end) over (partition by protein_id, domain_id_clean order by s, e rows unbounded preceding) as k from reached),
    period as (select protein_id, domain_id_clean, k, min(s) as first_pos, max(e) as last_pos from numbered group by 1, 2, 3),
    gap as (select protein_id, domain_id_clean, lag(last_pos) over (partition by protein_id, domain_id_clean order by first_pos) + 1 as first_pos, first_pos - 1 as last_pos from period)
    select protein_id, domain_id_clean, 'period' as kind, first_pos, last_pos from period
    union all select protein_id, domain_id_clean, 'gap', first_pos, last_pos from gap where first_pos is not null""",
    }
