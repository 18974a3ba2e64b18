"""Column expressions that read ids, labels and numbers from dirty text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: All Unicode white space.
BLANKS = "".join(c for c in map(chr, range(0x3001)) if c.isspace())


def trim(c: Column | str) -> Column:
    """Text without outer white space of any kind; null stays null."""
    c = F.col(c) if isinstance(c, str) else c
    return F.btrim(c, F.lit(BLANKS))


def label(c: Column | str) -> Column:
    """Text without outer blanks; null if nothing is left."""
    return F.nullif(trim(c), F.lit(""))


def whole_number(c: Column | str) -> Column:
    """A bigint if the text is a whole number, also one written as 3.0 or with outer blanks; else null."""
    t = trim(c)
    return F.when(t.rlike(r"^[+-]?[0-9]+(\.0*)?$"), F.substring_index(t, ".", 1).try_cast("bigint"))


def bare_id(c: Column | str) -> Column:
    """The id inside what search tools wrap it in: the part behind the last bar, without outer blanks; null if empty."""
    c = F.col(c) if isinstance(c, str) else c
    return label(F.substring_index(c, "|", -1))
