"""Pileup, genotype score and calls."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from readloom.operators.recal import BASES

# Fixed value: confidence a call must reach.
MIN_QUAL = 30.0
# Phred cost, in thousandths, of a read drawn from one of two alleles: 10 * log10(2).
HALF_MILLI = 3010


def pileup(bases: DataFrame, by: Sequence[str] = ("ref_idx", "p")) -> DataFrame:
    """Per locus: depth ``dp``, mismatching depth ``ad`` and score against the reference genotype.

    The score weighs the mismatch qualities against an even draw from two alleles.
    Whole thousandths, so the sum does not depend on the order of the reads.
    """
    weight = F.when(F.col("mm"), F.col("q") * 1000).otherwise(0).cast("bigint")
    return bases.groupBy(*by).agg(
        F.count("*").alias("dp"),
        F.count_if("mm").alias("ad"),
        (F.sum(weight) - HALF_MILLI * F.count("*")).alias("qual_milli"),
    )


def pileup_alleles(bases: DataFrame, by: Sequence[str] = ("ref_idx", "p")) -> DataFrame:
    """Per locus and alternate base: ``dp``, ``ad``, ``qual_milli`` with ``ref`` and ``alt``.

    The four bases are counted side by side, one shuffle for all alleles.
    """
    allele = F.col("base")
    sums = [
        column
        for b in BASES
        for column in (
            F.count_if(allele == b).alias(f"_n{b}"),
            F.sum(F.when(allele == b, F.col("q") * 1000).otherwise(0).cast("bigint")).alias(f"_q{b}"),
        )
    ]
    # The reference base as a number: a minimum of texts would make this an aggregation by sort, of every base.
    loci = bases.groupBy(*by).agg(F.count("*").alias("dp"), F.min(F.ascii("ref_base")).alias("_ref"), *sums)
    loci = loci.withColumn("ref", F.char("_ref"))
    alleles = F.array(
        *[F.struct(F.lit(b).alias("alt"), F.col(f"_n{b}").alias("ad"), F.col(f"_q{b}").alias("mass")) for b in BASES]
    )
    seen = F.filter(alleles, lambda a: (a.ad > 0) & (a.alt != F.col("ref")))
    return loci.select(*by, "ref", "dp", F.inline(seen)).select(
        *by, "ref", "alt", "dp", "ad", (F.col("mass") - HALF_MILLI * F.col("dp")).alias("qual_milli")
    )


def call_sites(pile: DataFrame, min_qual: float = MIN_QUAL) -> DataFrame:
    """Loci whose score reaches ``min_qual``."""
    return pile.where(F.col("qual_milli") >= round(min_qual * 1000))


def filter_qual(variants: DataFrame, min_qual: float = MIN_QUAL) -> DataFrame:
    """Variants, as read from VCF, with QUAL of ``min_qual`` or more; a missing QUAL does not pass."""
    return variants.where(F.col("qual") >= min_qual)


def vcf_records(calls: DataFrame) -> DataFrame:
    """Calls with ``contig, p, ref, alt`` as variants, with the text line of each.

    Calls with ``gt, pl, gq_milli`` show them in a FORMAT and a sample column.
    """
    qual = F.col("qual_milli") / 1000
    info = F.concat(F.lit("DP="), F.col("dp").cast("string"), F.lit(";AD="), F.col("ad").cast("string"))
    named = calls.select(
        "*",
        F.col("p").alias("pos"),
        F.lit(".").alias("id"),
        qual.alias("qual"),
        F.lit("PASS").alias("filter"),
        info.alias("info"),
    )
    shown = F.call_function("format_number", F.col("qual"), F.lit("0.###"))
    fields = ["contig", F.col("pos").cast("string"), "id", "ref", "alt", shown, "filter", "info"]
    if "gt" in calls.columns:
        quality = F.round(F.col("gq_milli") / 1000).cast("long").cast("string")
        sample = F.concat_ws(":", "gt", F.col("dp").cast("string"), F.col("ad").cast("string"), quality, "pl")
        fields += [F.lit("GT:DP:AD:GQ:PL"), sample]
    return named.withColumn("line", F.concat_ws("\t", *fields))
