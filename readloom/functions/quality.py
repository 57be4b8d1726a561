"""Base qualities, held as ARRAY<INT>."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The largest quality taken as Sanger, the offset between the two
# encodings, the ASCII offset of a quality string and the text of a failed shift.
SANGER_MAX = 60
ILLUMINA_OFFSET = 31
ASCII_OFFSET = 33
SHIFT_ERROR = "quality below 0 when re-based: "


def decode_phred(qual: str) -> Column:
    """Quality string to integers; ``*`` (not stored) gives NULL."""
    codes = F.transform(F.split(F.col(qual), ""), lambda c: F.ascii(c) - ASCII_OFFSET)
    return F.when(F.col(qual) != "*", codes)


def encode_phred(quals: str) -> Column:
    """Integers to a quality string."""
    return F.array_join(F.transform(F.col(quals), lambda q: F.chr((q + ASCII_OFFSET).cast("bigint"))), "")


def guess_encoding(quals) -> Column:
    """SANGER or ILLUMINA by the largest quality; NULL for an empty array."""
    top = F.array_max(F.col(quals) if isinstance(quals, str) else quals)
    return F.when(top <= SANGER_MAX, F.lit("SANGER")).when(top > SANGER_MAX, F.lit("ILLUMINA"))


def rebase(quals: str) -> Column:
    """Qualities moved from the Illumina to the Sanger scale."""
    return F.transform(F.col(quals), lambda q: q - ILLUMINA_OFFSET)


def quality_error(quals: str) -> Column:
    """Message naming the first quality that is negative after ``rebase``, else NULL."""
    bad = F.filter(rebase(quals), lambda q: q < 0)
    return F.when(F.size(bad) > 0, F.concat(F.lit(SHIFT_ERROR), F.try_element_at(bad, F.lit(1)).cast("string")))
