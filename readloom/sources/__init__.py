"""File formats in and out."""

from readloom.sources.fasta import read_fasta
from readloom.sources.fastq import read_fastq
from readloom.sources.sinks import write_alignments, write_bed, write_region_strings, write_vcf
from readloom.sources.text import bed_header, read_bed, read_contigs, read_sam, read_vcf

__all__ = [
    "bed_header",
    "read_bed",
    "read_contigs",
    "read_fasta",
    "read_fastq",
    "read_sam",
    "read_vcf",
    "write_alignments",
    "write_bed",
    "write_region_strings",
    "write_vcf",
]
