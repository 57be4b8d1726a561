"""Registered queries: ``(spark, sf_dir) -> DataFrame`` on the whole driver tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from readloom import sources
from readloom.functions import contig_key, guess_encoding
from readloom.operators import calling, chaining, duplicates, genotyping, intervals, ordering, pairing, quality, recal, regions, seeding, variants
from readloom.operators import reads as R
from readloom.operators.partitions import spread
from readloom.operators.staging import stage, staging_path
from readloom.plans import tables as T

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
IDS = T.IDS
CALL_KEY = ["c", "p", "r", "v"]


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# Shared steps -----------------------------------------------------------------


def _region_map(spark, sf):
    return stage(regions.balance_regions(regions.count_contigs(T.placed(spark, sf))), "regions")


def _covered(spark, sf):
    return intervals.merge_reads(T.placed(spark, sf))


def _named_covered(spark, sf):
    return R.with_contig(_covered(spark, sf), T.contigs(spark, sf))


def _recal(spark, sf):
    return recal.recal_table(T.bases(spark, sf, T.known(spark, sf)))


def _calls(spark, sf):
    return calling.call_sites(calling.pileup(T.bases(spark, sf)))


def _alleles(spark, sf):
    return calling.pileup_alleles(recal.read_bases(T.letters(spark, sf), T.reference(spark, sf), T.READ_IDS))


def _call_vcf(spark, sf, status):
    """A call set as a VCF file, read back and keyed."""
    return variants.variant_key(sources.read_vcf(spark, _written(_vcf_lines(spark, sf, status), "vcf")))


def _votes(spark, sf):
    targets = spread(T.table(spark, sf, "documents").select("doc_id", "text"))
    return seeding.seed_votes(T.table(spark, sf, "benchmark"), targets, "item_id", "doc_id")


# Reads and regions ------------------------------------------------------------


@query
def placed_reads(spark, sf):
    return T.placed(spark, sf).select(*IDS, "ref_idx", "pos")


@query
def alignment_end(spark, sf):
    return T.placed(spark, sf).select(*IDS, "end_pos")


@query
def contig_sort_key(spark, sf):
    return T.contigs(spark, sf).select("ref_idx", contig_key("contig").alias("contig_key"))


@query
def contig_counts(spark, sf):
    return regions.contig_counts(T.placed(spark, sf))


@query
def region_assignment(spark, sf):
    return _region_map(spark, sf)


@query
def region_load(spark, sf):
    return regions.region_load(regions.count_contigs(T.placed(spark, sf)), _region_map(spark, sf))


@query
def read_region(spark, sf):
    return regions.assign_regions(T.placed(spark, sf), _region_map(spark, sf)).select(*IDS, "region")


@query
def sorted_alignments(spark, sf):
    keyed = regions.assign_regions(T.placed(spark, sf).select(*IDS, "ref_idx", "pos"), _region_map(spark, sf))
    sources.write_alignments(keyed, path := staging_path(spark, "alignments"), IDS)
    ranked = ordering.ranked(spark.read.parquet(path), ["ref_idx", "pos", *IDS], group=["region"])
    return ranked.select(*IDS, "region", "rn")


@query
def chunk_counts(spark, sf):
    return R.stage_counts(T.placed(spark, sf), "chunk")


@query
def chunk_union(spark, sf):
    chunks = [T.placed(spark, sf).where(F.col("chunk") == i) for i in range(4)]
    return R.union_chunks(chunks).select("l_orderkey", "ref_idx")


@query
def clean_clip(spark, sf):
    listed = T.dense(spark, sf).where(F.col("ref_idx").between(0, 24))
    return R.clean(listed, T.contigs(spark, sf)).select(*IDS, "clipped")


@query
def read_groups(spark, sf):
    return R.with_read_group(T.placed(spark, sf)).select(*IDS, *R.READ_GROUP)


@query
def quality_encoding(spark, sf):
    return T.with_quals(spark, sf).select(*IDS, guess_encoding("quals").alias("encoding"))


@query
def quality_fix(spark, sf):
    fixed = quality.rebase_region(T.with_quals(spark, sf), IDS, region="ref_idx")
    total = F.aggregate("quals", F.lit(0), lambda acc, q: acc + q)
    return fixed.groupBy("ref_idx", "shift").agg(F.sum(total).alias("tot"))


@query
def mark_duplicates(spark, sf):
    return duplicates.mark_duplicates(R.placed(T.dense(spark, sf)), IDS).select(*IDS, "is_dup")


@query
def dup_metrics(spark, sf):
    libraries = R.placed(T.dense(spark, sf)).withColumn("lib", F.concat(F.lit("LIB"), F.col("l_suppkey") % 3))
    return duplicates.dup_metrics(duplicates.mark_duplicates(libraries, IDS, within=["lib"]), ["lib"])


@query
def dup_counts(spark, sf):
    return duplicates.duplicate_counts(R.placed(T.dense(spark, sf)))


# Intervals --------------------------------------------------------------------


@query
def covered_intervals(spark, sf):
    return _covered(spark, sf)


@query
def bed_lines(spark, sf):
    return intervals.bed_lines(_named_covered(spark, sf))


@query
def region_strings(spark, sf):
    return intervals.region_strings(_named_covered(spark, sf))


@query
def interval_span(spark, sf):
    return intervals.interval_span(_covered(spark, sf))


@query
def interval_label(spark, sf):
    spans = intervals.interval_span(_covered(spark, sf))
    return intervals.interval_label(R.with_contig(spans, T.contigs(spark, sf)))


@query
def merged_ranges(spark, sf):
    mixed = F.when(F.col("s") % 2 == 0, F.upper("contig")).otherwise(F.col("contig"))
    return intervals.merge_ranges(_named_covered(spark, sf).withColumn("contig", mixed), overlap=300)


@query
def interval_intersect(spark, sf):
    return intervals.intersect_intervals(T.targets(spark, sf), intervals.half_open(_covered(spark, sf)))


@query
def restrict_to_targets(spark, sf):
    return intervals.restrict_reads(T.placed(spark, sf), T.targets(spark, sf)).select(*IDS)


@query
def indel_loci(spark, sf):
    return intervals.indel_loci(T.placed(spark, sf))


@query
def indel_targets(spark, sf):
    return intervals.indel_targets(intervals.indel_loci(T.placed(spark, sf)))


@query
def realignment_targets(spark, sf):
    clusters = intervals.mismatch_clusters(intervals.mismatch_loci(T.bases(spark, sf)))
    return intervals.realignment_targets(intervals.indel_loci(T.dense(spark, sf).where("ref_idx between 1 and 24")), clusters)


# Recalibration and calling ----------------------------------------------------


@query
def recal_table(spark, sf):
    return _recal(spark, sf)


@query
def recal_apply(spark, sf):
    table = stage(_recal(spark, sf), "recal")
    values = {"q": F.col("quals"), "cyc": F.col("cycles")}
    new = recal.recalibrate_reads(T.base_arrays(spark, sf), table, values, T.READ_IDS)
    total = F.aggregate("quals", F.lit(0).cast("long"), lambda acc, q: acc + q)
    return new.select(*T.READ_IDS, F.array_join(F.col("quals").cast("array<string>"), ",").alias("quals"), total.alias("new_q"))


@query
def recal_by_levels(spark, sf):
    grouped = T.bases(spark, sf, T.known(spark, sf)).withColumn("rg", F.concat(F.lit("g"), F.col("pk") % 3))
    # Read group g0 and a quality stay unknown, and some combinations of the others.
    levels = recal.recal_levels(grouped.where("pk % 3 > 0 and q <> 27 and not (q > 30 and cyc = 5)"), "rg", ("cyc",))
    reads = T.base_arrays(spark, sf).withColumn("rg", F.concat(F.lit("g"), F.col("pk") % 3))
    values = {"rg": "rg", "q": "quals", "cyc": "cycles"}
    new = recal.recalibrate_by_levels(reads, levels, values)
    return new.select(*T.READ_IDS, F.array_join(F.col("quals").cast("array<string>"), ",").alias("quals"))


@query
def aligned_bases(spark, sf):
    bases = recal.read_bases(T.letters(spark, sf), T.reference(spark, sf), T.READ_IDS, T.known(spark, sf))
    return bases.groupBy("ref_idx", "cyc", "context").agg(
        F.count("*").alias("n"),
        F.count_if("mm").alias("err"),
        F.sum("q").alias("sum_q"),
        F.sum("p").alias("sum_p"),
        F.count_if(F.col("base") == "A").alias("n_a"),
    )


@query
def pileup_alleles(spark, sf):
    return _alleles(spark, sf)


@query
def pileup(spark, sf):
    return calling.pileup(T.bases(spark, sf))


@query
def called_variants(spark, sf):
    return _calls(spark, sf)


@query
def variants_per_region(spark, sf):
    return R.stage_counts(regions.assign_regions(_calls(spark, sf), _region_map(spark, sf)), "region")


@query
def variants_sorted(spark, sf):
    lettered = _calls(spark, sf).selectExpr(
        "*", "substring('ACGT', cast(p % 4 as int) + 1, 1) as ref", "substring('CGTA', cast(p % 4 as int) + 1, 1) as alt"
    )
    records = calling.vcf_records(R.with_contig(lettered, T.contigs(spark, sf)))
    sources.write_vcf(records, path := staging_path(spark, "calls"))
    keyed = variants.with_contig_key(sources.read_vcf(spark, path))
    last = keyed.withColumn("last", F.col("contig_key").isNull())
    ranked = ordering.ranked(last, ["last", "contig_key", "contig", "pos", "alt"])
    return ranked.select("contig", "pos", "ref", "alt", "info", "rn")


@query
def genotypes(spark, sf):
    bases = recal.read_bases(T.letters(spark, sf), T.reference(spark, sf), T.READ_IDS)
    return genotyping.genotypes(bases)


@query
def gap_alleles(spark, sf):
    return genotyping.gap_alleles(T.gapped_reads(spark, sf), stage(T.repeat_reference(spark, sf), "repeats"))


@query
def gap_genotypes(spark, sf):
    return genotyping.gap_genotypes(T.gapped_reads(spark, sf), stage(T.repeat_reference(spark, sf), "repeats"))


# Call sets --------------------------------------------------------------------


@query
def concordance(spark, sf):
    return variants.concordance(_call_vcf(spark, sf, "O"), _call_vcf(spark, sf, "F"))


@query
def normalised_concordance(spark, sf):
    chunks = stage(T.repeat_reference(spark, sf).withColumn("contig", F.concat(F.lit("chr"), "ref_idx")).drop("ref_idx"), "repeats")
    truth, calls = (variants.normalised_key(T.spelled_calls(spark, sf, status), chunks) for status in "OF")
    return variants.concordance(truth, calls)


@query
def matched_variants(spark, sf):
    return variants.matched(T.call_set(spark, sf, "O"), T.call_set(spark, sf, "F"), CALL_KEY)


@query
def missed_variants(spark, sf):
    return variants.missed(T.call_set(spark, sf, "O"), T.call_set(spark, sf, "F"), CALL_KEY)


# Placement --------------------------------------------------------------------


@query
def seed_votes(spark, sf):
    return _votes(spark, sf)


@query
def seed_best(spark, sf):
    return seeding.best_placement(_votes(spark, sf), "item_id", "doc_id")


@query
def chained_seeds(spark, sf):
    targets = spread(T.table(spark, sf, "documents").select("doc_id", "text"))
    # Ordered by a digest that other engines have too.
    return chaining.chain_reads(T.table(spark, sf, "benchmark"), targets, "item_id", "doc_id", order=F.md5)


def _part_reference(spark, sf):
    return stage(T.part_reference(spark, sf), "part_reference"), T.part_contigs(spark, sf)


@query
def placed_singly(spark, sf):
    chunks, contigs = _part_reference(spark, sf)
    placed = seeding.place_reads(T.read_pairs(spark, sf), chunks, contigs, [*T.TEMPLATE, "mate"])
    return placed.select(*T.TEMPLATE, "mate", "ref_idx", "pos", "flag", "cigar", "votes")


@query
def placed_pairs(spark, sf):
    chunks, contigs = _part_reference(spark, sf)
    placed = pairing.place_pairs(T.read_pairs(spark, sf), chunks, contigs, T.TEMPLATE)
    return placed.select(
        *T.TEMPLATE, "mate", "ref_idx", "pos", "flag", "mapq", "cigar", "mate_ref", "mate_pos", "tlen", "votes"
    )


def _marked_pairs(spark, sf):
    numbered = ordering.ranked(T.fragment_reads(spark, sf), IDS, name="read_no")
    return duplicates.mark_pair_duplicates(numbered, "read_no", ["l_orderkey", "fragment"], "mapq", within=["lib"])


@query
def pair_duplicates(spark, sf):
    return _marked_pairs(spark, sf).select(*IDS, "is_dup", "dup_of")


@query
def pair_metrics(spark, sf):
    marked = duplicates.with_optical(stage(_marked_pairs(spark, sf), "marked"), "read_no")
    return duplicates.pair_metrics(marked, ["l_orderkey", "fragment"], ["lib"])


# Scans: the tables are written in each format and read back ---------------------


def _written(lines: DataFrame, name: str, **options) -> str:
    path = staging_path(lines.sparkSession, name)
    lines.write.options(**options).text(path)
    return path


def _vcf_lines(spark, sf, status):
    lines = T.call_set(spark, sf, status).selectExpr(
        "concat_ws('\\t', concat('chr', c), cast(p + 1 as string), '.', r, v, '50', 'PASS', 'DP=8') as line"
    )
    return lines.union(spark.range(1).selectExpr("'##contig=<ID=chr1,length=9>' as line"))


@query
def contig_dict(spark, sf):
    rows = T.contigs(spark, sf).selectExpr(
        "ref_idx", "concat('@SQ\\tSN:', contig, '\\tLN:', cast(length as string), '\\tUR:file') as line"
    )
    header = spark.range(1).selectExpr("-1 as ref_idx", "'@HD\\tVN:1.0\\tSO:unsorted' as line")
    # One file in line order: a dictionary has a row per contig.
    lines = rows.union(header).orderBy("ref_idx").coalesce(1).select("line")
    return sources.read_contigs(spark, _written(lines, "dict"))


@query
def sam_scan(spark, sf):
    named = T.reads(spark, sf).join(T.contigs(spark, sf), "ref_idx", "left")
    # Every eleventh order has a flag that is no number, every thirteenth too few fields.
    digits = "lpad(conv(cast({} as string), 10, 4), 20, '0')"
    lines = named.selectExpr(
        "concat_ws('\\t', concat_ws(':', l_orderkey, l_linenumber, l_partkey, l_suppkey), "
        "case when l_orderkey % 11 = 0 then 'x' else cast((case when ref_idx < 0 then 4 else 0 end) + "
        "(case when neg then 16 else 0 end) as string) end, "
        "case when l_orderkey % 13 = 0 then null else concat_ws('\\t', "
        "coalesce(contig, '*'), cast(pos as string), cast(mapq as string), cigar, '*', '0', '0', "
        f"translate({digits.format('l_partkey')}, '0123', 'ACGT'), translate({digits.format('l_orderkey')}, '0123', '!5AI')) end, "
        "concat('RG:Z:', chunk), 'NM:i:0') as line"
    )
    found = sources.read_sam(spark, _written(lines, "sam"), T.contigs(spark, sf))
    return found.select(
        "qname",
        "flag",
        "ref_idx",
        "pos",
        "mapq",
        "cigar",
        "seq",
        F.aggregate("quals", F.lit(0), lambda acc, q: acc + q).alias("sum_q"),
        F.get("tags", F.lit(0)).alias("tag"),
        F.col("_corrupt").alias("corrupt"),
        F.col("_corrupt").isNull().alias("whole"),
    )


@query
def fastq_scan(spark, sf):
    seq = "translate(lpad(conv(cast(l_partkey as string), 10, 4), 20, '0'), '0123', 'ACGT')"
    record = "concat('@', id, '/{0}\\n', {1}, '\\n+\\n', repeat('@', length({1})))"
    pairs = (
        spread(T.table(spark, sf, "lineitem").select(*IDS))
        .selectExpr("concat_ws(':', l_orderkey, l_linenumber, l_partkey, l_suppkey) as id", f"{seq} as seq")
        .selectExpr(f"concat({record.format(1, 'seq')}, '\\n', {record.format(2, 'reverse(seq)')}) as line")
    )
    found = sources.read_fastq(spark, _written(pairs, "fastq", compression="gzip"))
    return found.select("name", "mate", "seq", "qual")


@query
def bed_scan(spark, sf):
    named = R.with_contig(T.targets(spark, sf), T.contigs(spark, sf))
    lines = named.selectExpr(
        "concat_ws('\\t', contig, cast(start0 as string), cast(end0 as string), concat('part', p_partkey), '0') as line"
    )
    header = spark.range(1).selectExpr("'track name=targets' as line")
    return sources.read_bed(spark, _written(lines.union(header), "bed"))


@query
def vcf_scan(spark, sf):
    return sources.read_vcf(spark, _written(_vcf_lines(spark, sf, "O"), "vcf"))


@query
def fasta_scan(spark, sf):
    # Documents as contigs: every byte of the text as two letters, in lines of 60.
    letters = "translate(lower(hex(text)), '0123456789', 'ghijklmnop')"
    lines = spread(T.table(spark, sf, "documents").select("doc_id", "lang", "text")).selectExpr(
        f"concat('>d', doc_id, ' ', lang, '\\n', array_join(regexp_extract_all({letters}, '(.{{1,60}})', 1), '\\n')) as line"
    )
    return sources.read_fasta(spark, _written(lines, "fasta"), width=256, overlap=16)
