"""The token sequences that choose a record of an identical-protein group."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vicinage.functions.clean import label, trim, whole_number
from vicinage.llm.consensus import sequence, survivors, token

#: Levels of a finished assembly, in lower case (fixed values).
FINISHED = ("chromosome", "complete genome")
#: Kinds of tokens, in their order of weight.
LEVEL, ASSEMBLY, QUERY, LENGTH = 1, 2, 3, 4


def record_survivors(records: DataFrame) -> DataFrame:
    """(ipg_id, unique_id): the record that stands for each ipg_id with two or more unique_id among records that
    haven't failed (failed null or false).

    A record is the sequence of what it says: its level if that is a finished one, its assembly (by GCF or not where the
    level is finished, else any), whether it is the RefSeq query, and its length. Finished levels are trusted alike, so
    are other assemblies; a longer sequence is trusted more. A length that is null or not positive is a gap. Ties:
    smaller unique_id as a number.
    """
    assembly, level = label("assembly_id"), F.lower(trim("assembly_level"))
    finished = F.coalesce(level.isin(*FINISHED), F.lit(False))
    refseq = F.coalesce(F.upper(assembly).startswith("GCF"), F.lit(False))
    seq = sequence(
        token(LEVEL, F.when(finished, F.lit("finished")), F.lit(1)),
        token(ASSEMBLY, F.when(finished & refseq, F.lit("GCF")).when(~finished & assembly.isNotNull(), F.lit("any")), F.when(finished, F.lit(2)).otherwise(1)),
        token(QUERY, F.when(F.col("is_refseq_query"), F.lit("query")), F.lit(1)),
        token(LENGTH, F.when(F.col("sequence_length") > 0, F.col("sequence_length").cast("string")), F.col("sequence_length")),
    )
    sound = records.where(~F.coalesce(F.col("failed"), F.lit(False)))
    out = survivors(sound, "ipg_id", whole_number("unique_id"), seq)
    return out.select("ipg_id", F.col("survivor").cast("string").alias("unique_id"))
