"""Column-to-column functions; all stay inside the JVM."""

from readloom.functions.cigar import (
    aligned_blocks,
    alignment_end,
    five_prime,
    indels,
    reference_length,
    trim_to,
)
from readloom.functions.contig import contig_key, region_string
from readloom.functions.quality import (
    decode_phred,
    encode_phred,
    guess_encoding,
    quality_error,
    rebase,
)

__all__ = [
    "aligned_blocks",
    "alignment_end",
    "contig_key",
    "decode_phred",
    "encode_phred",
    "five_prime",
    "guess_encoding",
    "indels",
    "quality_error",
    "rebase",
    "reference_length",
    "region_string",
    "trim_to",
]
