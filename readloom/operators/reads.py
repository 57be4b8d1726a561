"""Filters, cleaning and counters on aligned reads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from readloom.functions.cigar import alignment_end, trim_to

# SAM flag bits, the contig indices kept (chr1..chrY) and the read group.
UNMAPPED = 0x4
REVERSE = 0x10
FIRST_PLACED = 1
LAST_PLACED = 24
READ_GROUP = {
    "rg_id": "GROUP1",
    "rg_lb": "LIB1",
    "rg_pl": "ILLUMINA",
    "rg_pu": "UNIT1",
    "rg_sm": "SAMPLE1",
}


def placed(reads: DataFrame, lo: int = FIRST_PLACED, hi: int = LAST_PLACED) -> DataFrame:
    """Mapped reads on the contigs ``lo..hi``; the mate's contig plays no part."""
    keep = F.col("ref_idx").between(lo, hi)
    if "flag" in reads.columns:
        keep = keep & (F.col("flag").bitwiseAND(UNMAPPED) == 0)
    return reads.where(keep)


def with_end(reads: DataFrame, name: str = "end_pos") -> DataFrame:
    return reads.withColumn(name, alignment_end("pos", "cigar"))


def with_contig(df: DataFrame, contigs: DataFrame, columns: Sequence[str] = ("contig",)) -> DataFrame:
    """Look up dictionary columns by contig index.

    No hint: the dictionary is a small file, so the planner broadcasts it by its
    known size and joins by shuffle should it ever be large.
    """
    return df.join(contigs.select("ref_idx", *columns), "ref_idx")


def clean(reads: DataFrame, contigs: DataFrame) -> DataFrame:
    """Soft-clip what hangs over the contig end; mapping quality 0 for unmapped reads.

    ``clipped`` counts the reference bases that hung over. A mapped read that
    starts past its contig end has no place left: it stays, with the unmapped flag
    (where there is a ``flag``), mapping quality 0 and CIGAR ``*``.
    """
    found = reads.join(contigs.select("ref_idx", "length"), "ref_idx", "left")
    inside = F.col("length").isNull() | (F.col("pos") <= F.col("length"))
    over = alignment_end("pos", "cigar") - F.col("length")
    if "flag" in reads.columns:
        unmapped = F.col("flag").bitwiseAND(UNMAPPED) != 0
    else:
        unmapped = F.col("length").isNull()
    lost = ~unmapped & ~inside
    found = found.withColumn("_lost", lost)
    if "flag" in reads.columns:
        found = found.withColumn("flag", F.when(F.col("_lost"), F.col("flag").bitwiseOR(UNMAPPED)).otherwise(F.col("flag")))
    else:
        unmapped = F.col("length").isNull() | F.col("_lost")
    return (
        found.withColumn("clipped", F.when(~unmapped & (over > 0), over).otherwise(0))
        .withColumn(
            "cigar",
            F.when(F.col("_lost"), F.lit("*")).when(F.col("clipped") > 0, trim_to("cigar", F.col("length") - F.col("pos") + 1)).otherwise(
                F.col("cigar")
            ),
        )
        .withColumn("mapq", F.when(unmapped, F.lit(0)).otherwise(F.col("mapq")))
        .drop("length", "_lost")
    )


def with_read_group(reads: DataFrame, **fields: str) -> DataFrame:
    """Constant read-group columns; keywords replace the fixed values."""
    unknown = set(fields) - set(READ_GROUP)
    if unknown:
        raise ValueError(f"unknown read-group fields: {sorted(unknown)}")
    return reads.withColumns({k: F.lit(v) for k, v in (READ_GROUP | fields).items()})


def stage_counts(df: DataFrame, by: str, name: str = "n") -> DataFrame:
    """Rows per chunk, region or other stage key."""
    return df.groupBy(by).agg(F.count("*").alias(name))


def union_chunks(chunks: Sequence[DataFrame]) -> DataFrame:
    """One read set from frames that hold a chunk each."""
    first, *rest = chunks
    for chunk in rest:
        first = first.unionByName(chunk)
    return first
