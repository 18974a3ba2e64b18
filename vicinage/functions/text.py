"""Text and sequence expressions (survey ids STR-01..15, FLT-16)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def extract(c: Column, pattern: str, group: int = 1) -> Column:
    """The group of the first match; null, not empty, if there is none."""
    return F.nullif(F.regexp_extract(c, pattern, group), F.lit(""))


def attribute(c: Column, key: str) -> Column:
    """The value of key=value in a GFF3 attribute text."""
    return extract(c, rf"(?:^|;)\s*{key}=([^;]+)")


def nth(c: Column, sep: str, n: int) -> Column:
    """The n-th part, from 1, or from the end with a negative n; null beyond the last."""
    return F.try_element_at(F.split(c, sep), F.lit(n))


def strict_concat(*cs: Column) -> Column:
    """All parts or null."""
    return F.concat(*cs)


def wrapped(c: Column, width: int = 80) -> Column:
    """Broken into lines of width, without an empty last line."""
    return F.regexp_replace(F.regexp_replace(c, f"(.{{{width}}})", "$1\n"), r"\n$", "")


def scientific(c: Column) -> Column:
    return F.when(c.isNotNull(), F.format_string("%.2e", c))


def map_text(c: Column) -> Column:
    """k=v;k=v of a map in the order of its keys, null values left out."""
    kept = F.filter(F.map_entries(c), lambda e: e["value"].isNotNull())
    return F.array_join(F.transform(F.array_sort(kept), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ";")


def map_columns(df: DataFrame, c: str, names: Sequence[str]) -> DataFrame:
    """df with a column for each of the names, from the entries of a map."""
    return df.withColumns({n: F.col(c)[n] for n in names})


def reverse_complement(c: Column) -> Column:
    return F.reverse(F.translate(c, "ACGTUNacgtun", "TGCAANtgcaan"))


_BASES = "TCAG"
#: Amino acids of the bacterial code (table 11) for codons in TCAG order (a fixed value).
_AMINO = "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG"


def translate_cds(c: Column) -> Column:
    """Protein of a coding sequence up to its first stop; unknown codons are X and a rest of one or two bases is left out."""
    codons = {a + b + d: _AMINO[16 * i + 4 * j + k] for i, a in enumerate(_BASES) for j, b in enumerate(_BASES) for k, d in enumerate(_BASES)}
    table = F.create_map(*[F.lit(x) for kv in codons.items() for x in kv])
    seq = F.translate(F.upper(c), "U", "T")
    n = F.floor(F.length(seq) / 3).cast("int")
    acids = F.transform(F.sequence(F.lit(1), n), lambda i: F.coalesce(table[F.substring(seq, (i - 1) * 3 + 1, F.lit(3))], F.lit("X")))
    return F.when(n > 0, F.substring_index(F.array_join(acids, ""), "*", 1)).otherwise(F.when(c.isNotNull(), ""))


def basename(c: Column) -> Column:
    return F.regexp_extract(c, r"([^/]*)$", 1)


def stem(c: Column) -> Column:
    return F.regexp_replace(basename(c), r"\.[^.]*$", "")


def file_safe(c: Column) -> Column:
    return F.regexp_replace(c, r"[^A-Za-z0-9._-]", "_")


def sanitised(df: DataFrame, digits: int = 2) -> DataFrame:
    """Every text column in one line and without quotes that break a table, every float rounded."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.StringType):
            c = F.translate(F.regexp_replace(c, r"\r\n|[\r\n]", " "), "`\"", "''")
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.round(c, digits)
        cols.append(c.alias(f.name))
    return df.select(*cols)


def nearest_allowed(c: Column, allowed: Sequence[int]) -> Column:
    """The smallest allowed number that isn't below c; null if there is none."""
    return F.array_min(F.filter(F.array(*[F.lit(a) for a in sorted(allowed)]), lambda x: x >= c))


def overlap(s1: Column, e1: Column, s2: Column, e2: Column) -> Column:
    """Positions two inclusive intervals share."""
    return F.greatest(F.lit(0), F.least(e1, e2) - F.greatest(s1, s2) + 1)


def python_list(c: Column) -> Column:
    """array<string> of a Python list literal, or null."""
    return F.from_json(F.translate(c, "'", '"'), "array<string>")
