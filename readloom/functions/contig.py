"""Contig names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Sort keys of the sex chromosomes and the length of the name prefix ("chr").
KEY_X = 25
KEY_Y = 26
PREFIX_LENGTH = 3


def contig_key(contig, strict: bool = False) -> Column:
    """Integer sort key of a contig name; NULL (or an error when strict) if it has none."""
    name = F.col(contig) if isinstance(contig, str) else contig
    suffix = F.upper(F.substr(name, F.lit(PREFIX_LENGTH + 1)))
    # A failing try_cast is slow, and names without a number are common.
    number = F.when(suffix.rlike("^[0-9]+$"), suffix.try_cast("int"))
    if strict:
        text = F.concat(F.lit("no sort key for contig "), F.coalesce(name, F.lit("NULL")))
        number = F.coalesce(number, F.raise_error(text).cast("int"))
    return F.when(suffix == "X", F.lit(KEY_X)).when(suffix == "Y", F.lit(KEY_Y)).otherwise(number)


def region_string(contig: str, start: str, end: str) -> Column:
    """``contig:start-end`` with both ends counted from 1 and included."""
    return F.concat(F.col(contig), F.lit(":"), F.col(start).cast("string"), F.lit("-"), F.col(end).cast("string"))
