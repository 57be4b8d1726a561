"""From alignments to calls, as one chain of operators.

Tables are written on the way where the data is needed more than once: the
placed and the cleaned reads, regions, covered targets, the reads that serve as
evidence and the recalibration table. Everything else is planned by Spark as it stands.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from readloom.operators import calling, duplicates, genotyping, intervals, pairing, quality, recal, regions, variants
from readloom.operators import reads as R
from readloom.operators.staging import stage
from readloom.sources.text import read_vcf

READ_ID = "read_no"
SECOND_OF_PAIR = 0x80
# Secondary and supplementary alignments and reads that failed quality control.
SET_ASIDE = 0x100 | 0x800 | 0x200


@dataclass
class Calls:
    """Results of ``call_variants``; all lazy but for the staged tables behind them."""

    contig_region: DataFrame
    reads: DataFrame
    metrics: DataFrame
    intervals: DataFrame
    indel_targets: DataFrame
    realignment_targets: DataFrame
    recal_table: DataFrame
    variants: DataFrame
    region_reads: DataFrame
    region_variants: DataFrame
    left_out: DataFrame


def call_variants(
    alignments: DataFrame,
    contigs: DataFrame,
    ref_chunks: DataFrame,
    known_sites: DataFrame,
    targets: DataFrame,
    k: int = regions.REGIONS,
    gap: int = intervals.READ_GAP,
    pad: int = intervals.INDEL_PAD,
    min_qual: float = calling.MIN_QUAL,
    covariates=recal.COVARIATES,
    set_aside: int = SET_ASIDE,
    **read_group: str,
) -> Calls:
    """Regions, cleaning, duplicates, covered targets, recalibration, pileup and calls.

    ``alignments`` as from ``read_sam``; ``ref_chunks`` with ``contig`` from
    ``read_fasta``, of any width; ``known_sites`` and
    ``targets`` with ``contig``, as from ``read_vcf`` and ``read_bed``. Reads with a flag
    of ``set_aside`` stay in the output, but are neither evidence nor anyone's duplicate, so a
    fragment counts once; 0 lets them all count. ``covariates`` may name read-group columns too.
    """
    index = contigs.select("contig", "ref_idx")
    flags = {
        "neg": F.col("flag").bitwiseAND(R.REVERSE) != 0,
        "second": F.col("flag").bitwiseAND(SECOND_OF_PAIR) != 0,
    }
    # Reads of one name are the ends of a fragment, where the alignments do not say otherwise.
    template = "template" if "template" in alignments.columns else "qname"
    # Written once: the id must not change between the passes over the reads.
    placed = stage(
        R.placed(alignments).withColumns(flags).withColumn(READ_ID, F.monotonically_increasing_id()), "placed"
    )
    contig_region = stage(regions.balance_regions(regions.count_contigs(placed), k), "regions")
    by_region = regions.assign_regions(placed, contig_region)
    rebased = quality.rebase_region(by_region, [READ_ID])
    cleaned = R.with_end(R.clean(rebased, contigs))
    scored = cleaned.withColumn(
        "score", F.coalesce(F.aggregate("quals", F.lit(0), lambda acc, q: acc + q), F.lit(0))
    )
    aside = F.col("flag").bitwiseAND(set_aside) != 0
    marked = duplicates.mark_pair_duplicates(scored.withColumn("_aside", aside), READ_ID, [template], within=["_aside"])
    marked = marked.withColumn("is_dup", F.col("is_dup") & ~F.col("_aside")).drop("_aside")
    reads = stage(regions.region_partitions(R.with_read_group(marked, **read_group), [READ_ID]), "reads")

    indexed_targets = targets.join(index, "contig")
    # Reads that start past their contig stay in the output but are no evidence.
    mapped = reads.where(F.col("flag").bitwiseAND(R.UNMAPPED | set_aside) == 0)
    covered = intervals.half_open(intervals.merge_reads(mapped, gap))
    bed = stage(intervals.intersect_intervals(indexed_targets, covered), "targets")
    inside = intervals.restrict_reads(mapped, bed)
    # Read twice below, so the restriction runs once.
    usable = stage(inside.where(~F.col("is_dup") & F.col("quality_error").isNull()), "usable")

    loci = intervals.indel_loci(inside)
    indel_targets = _restrict_spans(intervals.indel_targets(loci, pad), bed)

    chunks = ref_chunks.join(index, "contig").select("ref_idx", "chunk_start", "bases")
    sites = known_sites.join(index, "contig").select("ref_idx", F.col("pos").alias("p"))
    carried = [READ_ID, *[c for c in covariates if c in R.READ_GROUP]]
    clusters = intervals.mismatch_clusters(intervals.mismatch_loci(recal.read_bases(usable, chunks, [READ_ID], sites)))
    realignment_targets = _restrict_spans(intervals.realignment_targets(loci, clusters, pad), bed)
    table = stage(recal.recal_table(recal.read_bases(usable, chunks, carried, sites), covariates), "recal")
    improved = recal.recalibrate_reads(usable, table, recal.read_values(covariates), [READ_ID])
    shown = genotyping.genotypes(recal.read_bases(improved, chunks, [READ_ID]))
    called = calling.call_sites(shown.unionByName(genotyping.gap_genotypes(usable, chunks)), min_qual)
    points = called.withColumn("start0", F.col("p") - 1).withColumn("end0", F.col("p"))
    in_targets = intervals.restrict(points, bed).drop("start0", "end0")
    named = R.with_contig(regions.assign_regions(in_targets, contig_region), contigs)
    records = calling.vcf_records(named)
    return Calls(
        contig_region=contig_region,
        reads=reads,
        metrics=duplicates.dup_metrics(reads, ["rg_lb"]),
        intervals=bed,
        indel_targets=indel_targets,
        realignment_targets=realignment_targets,
        recal_table=table,
        variants=records,
        region_reads=R.stage_counts(reads, "region"),
        region_variants=R.stage_counts(records, "region"),
        left_out=recal.left_out(usable, chunks),
    )


def _restrict_spans(spots: DataFrame, bed: DataFrame) -> DataFrame:
    spans = spots.withColumn("start0", F.col("s") - 1).withColumn("end0", F.col("e"))
    return intervals.restrict(spans, bed).drop("start0", "end0")


def place_and_call(fastq: DataFrame, ref_chunks: DataFrame, contigs: DataFrame, **options) -> Calls:
    """``call_variants`` on pairs that ``place_pairs`` has placed by seeds and by the distance of their ends.

    The chunks overlap by ``seeding.K - 1`` bases or more, as the seeds need. The reads are
    staged, so compressed files are unpacked once.
    """
    placed = pairing.place_pairs(stage(fastq, "fastq"), ref_chunks, contigs, ["chunk", "pair_id"])
    return call_variants(pairing.as_alignments(placed, contigs), contigs, ref_chunks, **options)


def compare_vcf(spark, truth: str, calls: str, ref_chunks: DataFrame | None = None) -> DataFrame:
    """Concordance of two VCF files; with a reference, of alleles in one spelling rather than of raw text."""
    key = variants.variant_key if ref_chunks is None else lambda v: variants.normalised_key(v, ref_chunks)
    return variants.concordance(key(read_vcf(spark, truth)), key(read_vcf(spark, calls)))
