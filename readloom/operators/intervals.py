"""Interval merging, intersection and restriction.

A contig is never one group. Positions are cut into bins of ``2 ** bits`` bases;
what happens inside a bin is settled there, and only what touches a bin edge,
at most two rows per bin, is looked at along the contig.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from readloom.functions.cigar import indels
from readloom.functions.contig import region_string

# The reach of a covered interval and the padding of an indel site.
READ_GAP = 51
INDEL_PAD = 10
# Mismatches that make a target: share of the quality in per cent, depth, and bases between two such loci.
MISMATCH_SHARE = 15
MISMATCH_DEPTH = 4
MISMATCH_WINDOW = 10

MERGE_BITS = 16
JOIN_BITS = 12


def _bin(position: Column, bits: int) -> Column:
    # An arithmetic shift rounds down, below zero too.
    return F.shiftright(position, bits)


def _bins(first: Column, last: Column, bits: int) -> Column:
    return F.explode(F.sequence(_bin(first, bits), _bin(F.greatest(first, last), bits)))


def merge_intervals(
    df: DataFrame,
    key: Sequence[str],
    start: str,
    end: str,
    gap: int,
    weight: Column | None = None,
    bits: int = MERGE_BITS,
    carry: str | None = None,
) -> DataFrame:
    """Join inclusive intervals of a key while ``start <= largest end so far + gap``.

    Gives ``key, start, end, n`` with ``n`` the sum of ``weight`` (1 by default), and
    with ``carry`` the value of this column in the interval that opens (the smallest at equal starts).

    1. Cut each interval, stretched by the gap, at bin edges and combine equal
       cut starts on the map side: a bin then holds at most one row per position.
    2. Merge inside each bin.
    3. Chain the islands that cross bin edges; all others stay in their bin.
    """
    key = list(key)
    weight = F.lit(1) if weight is None else weight
    reach = F.col("_e") + gap
    # With a negative gap a one-base interval reaches nothing, so equal ones stay apart.
    alone = reach < F.col("_s")

    own = [] if carry is None else ["_who"]
    opener = [] if carry is None else [F.min(F.struct("_s", "_who"))["_who"].alias("_who")]
    carried = [] if carry is None else [F.col(carry).alias("_who")]
    cut = (
        df.select(*key, F.col(start).alias("_s"), F.col(end).alias("_e"), weight.cast("bigint").alias("_n"), *carried)
        .withColumn("_bin", _bins(F.col("_s"), reach, bits))
        .withColumn("_at", F.greatest("_s", F.shiftleft("_bin", bits)))
        .withColumn("_n", F.when(F.col("_s") >= F.shiftleft("_bin", bits), F.col("_n")).otherwise(0))
    )
    pieces = cut.groupBy(*key, "_bin", "_at", alone.alias("_alone"), *own).agg(
        F.min("_s").alias("_s"), F.max("_e").alias("_e"), F.sum("_n").alias("_n"), F.count("*").alias("_copies")
    )

    in_bin = Window.partitionBy(*key, "_bin").orderBy("_at", "_s", "_e")
    before = F.max("_e").over(in_bin.rowsBetween(Window.unboundedPreceding, -1))
    opens = before.isNull() | (F.col("_at") > before + gap)
    islands = (
        pieces.withColumn("_opens", opens.cast("int"))
        .withColumn("_island", F.sum("_opens").over(in_bin.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy(*key, "_bin", "_island")
        .agg(
            F.min("_s").alias("_s"),
            F.max("_e").alias("_e"),
            F.sum("_n").alias("_n"),
            F.sum("_copies").alias("_copies"),
            *opener,
        )
    )

    enters = F.col("_s") < F.shiftleft("_bin", bits)
    leaves = reach >= F.shiftleft(F.col("_bin") + 1, bits)
    chained = islands.withColumn("_enters", enters).withColumn("_own", F.when(~(enters | leaves), F.col("_bin")))
    along = Window.partitionBy(*key, "_own").orderBy("_bin", "_s").rowsBetween(Window.unboundedPreceding, 0)
    merged = (
        chained.withColumn("_chain", F.sum((~F.col("_enters")).cast("int")).over(along))
        .groupBy(*key, "_own", "_chain")
        .agg(
            F.min("_s").alias("_s"),
            F.max("_e").alias("_e"),
            F.sum("_n").alias("_n"),
            F.sum("_copies").alias("_copies"),
            *opener,
        )
    )
    if gap < 0:
        # Equal one-base intervals were combined above; each is an interval of its own.
        merged = (
            merged.withColumn("_copies", F.when(alone, F.col("_copies")).otherwise(1))
            .withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_copies"))))
            .withColumn("_n", (F.col("_n") / F.col("_copies")).cast("bigint"))
        )
    named = [] if carry is None else [F.col("_who").alias(carry)]
    return merged.select(
        *key, F.col("_s").alias("start"), F.col("_e").alias("end"), F.col("_n").alias("n"), *named
    )


def merge_reads(reads: DataFrame, gap: int = READ_GAP, contig: str = "ref_idx") -> DataFrame:
    """Covered intervals ``(contig, s, e, n)`` of reads that carry ``pos`` and ``end_pos``."""
    merged = merge_intervals(reads, [contig], "pos", "end_pos", gap)
    return merged.withColumnsRenamed({"start": "s", "end": "e"})


def merge_ranges(ranges: DataFrame, overlap: int) -> DataFrame:
    """Ranges ``(contig, s, e)`` widened at the start by ``overlap`` and merged, names equal but for case.

    The first base stays at 1 or above; touching alone does not merge. A merged range has the name
    of the range that opens it.
    """
    if overlap < 0:
        raise ValueError("overlap must not be negative")
    keyed = ranges.withColumn("_name", F.upper("contig"))
    merged = merge_intervals(keyed, ["_name"], "s", "e", overlap - 1, carry="contig")
    return merged.select("contig", F.greatest(F.col("start") - overlap, F.lit(1)).alias("s"), F.col("end").alias("e"))


def indel_loci(reads: DataFrame, contig: str = "ref_idx") -> DataFrame:
    """Sites of insertions and deletions with the number of reads that show them."""
    sites = reads.where(F.col("cigar").rlike("[ID]")).select(contig, F.explode(indels("pos", "cigar")).alias("_site"))
    return sites.groupBy(contig, F.col("_site.locus").alias("locus"), F.col("_site.op").alias("op")).agg(
        F.count("*").alias("n")
    )


def indel_targets(loci: DataFrame, pad: int = INDEL_PAD, contig: str = "ref_idx") -> DataFrame:
    """Padded and merged indel sites ``(contig, s, e, support)``."""
    padded = loci.select(
        contig, F.greatest(F.col("locus") - pad, F.lit(1)).alias("s"), (F.col("locus") + pad).alias("e"), "n"
    )
    merged = merge_intervals(padded, [contig], "s", "e", 0, weight=F.col("n"))
    return merged.withColumnsRenamed({"start": "s", "end": "e", "n": "support"})


def mismatch_loci(
    bases: DataFrame, share: int = MISMATCH_SHARE, depth: int = MISMATCH_DEPTH, contig: str = "ref_idx"
) -> DataFrame:
    """Loci ``contig, p`` where mismatches hold at least ``share`` per cent of the quality, at a depth of ``depth`` or more.

    ``bases`` are as from ``read_bases``: ``p, q, mm``. Whole numbers, so the order of the reads plays no part.
    """
    wrong = F.sum(F.when(F.col("mm"), F.col("q")).otherwise(0).cast("bigint"))
    mass = bases.groupBy(contig, "p").agg(F.count("*").alias("_dp"), wrong.alias("_wrong"), F.sum("q").alias("_all"))
    return mass.where((F.col("_dp") >= depth) & (F.col("_wrong") > 0) & (100 * F.col("_wrong") >= share * F.col("_all"))).select(contig, "p")


def mismatch_clusters(loci: DataFrame, window: int = MISMATCH_WINDOW, contig: str = "ref_idx") -> DataFrame:
    """Runs ``contig, s, e, n`` of two or more mismatching loci, each less than ``window`` bases after the one before."""
    merged = merge_intervals(loci.select(contig, F.col("p").alias("s"), F.col("p").alias("e")), [contig], "s", "e", window - 1)
    return merged.where("n > 1").withColumnsRenamed({"start": "s", "end": "e"})


def realignment_targets(loci: DataFrame, clusters: DataFrame, pad: int = INDEL_PAD, contig: str = "ref_idx") -> DataFrame:
    """Targets ``contig, s, e, support`` around gaps (``locus, n``) and around clusters of mismatches (``s, e, n``).

    Both are padded and merged where they meet; ``support`` sums reads with a gap and loci with mismatches.
    """
    around = lambda df, s, e: df.select(
        contig, F.greatest(F.col(s) - pad, F.lit(1)).cast("int").alias("s"), (F.col(e) + pad).cast("int").alias("e"), F.col("n").cast("bigint").alias("n")
    )
    both = around(loci, "locus", "locus").unionAll(around(clusters, "s", "e"))
    merged = merge_intervals(both, [contig], "s", "e", 0, weight=F.col("n"))
    return merged.withColumnsRenamed({"start": "s", "end": "e", "n": "support"})


def half_open(covered: DataFrame) -> DataFrame:
    """1-based inclusive ``s, e`` as 0-based half-open ``start0, end0``."""
    return covered.withColumn("start0", F.col("s") - 1).withColumn("end0", F.col("e")).drop("s", "e")


def _binned(df: DataFrame, bits: int) -> DataFrame:
    return df.where("start0 < end0").withColumn("_bin", _bins(F.col("start0"), F.col("end0") - 1, bits))


def intersect_intervals(a: DataFrame, b: DataFrame, contig: str = "ref_idx", bits: int = JOIN_BITS) -> DataFrame:
    """Each overlap of half-open ``a`` and ``b``: the common piece with the columns of ``a``.

    An equi-join on contig and bin; a pair that meets in several bins is kept in
    the bin of its first common base. Neither side is hinted: the planner
    broadcasts by size and splits hot bins of a shuffled join at run time.
    """
    left = _binned(a, bits)
    right = _binned(b.select(contig, "start0", "end0"), bits).withColumnsRenamed({"start0": "_b0", "end0": "_b1"})
    first = F.greatest("start0", "_b0")
    return (
        left.join(right, [contig, "_bin"])
        .where((F.col("start0") < F.col("_b1")) & (F.col("_b0") < F.col("end0")))
        .where(_bin(first, bits) == F.col("_bin"))
        .select(
            *[
                first.alias(c) if c == "start0" else F.least("end0", "_b1").alias(c) if c == "end0" else F.col(c)
                for c in a.columns
            ]
        )
    )


def with_previous_end(df: DataFrame, key: Sequence[str], start: str, end: str, bits: int) -> DataFrame:
    """``prev_end``: end of the interval before, for disjoint intervals, by bins as in the merge."""
    in_bin = Window.partitionBy(*key, "_bin").orderBy(start)
    edges = Window.partitionBy(*key, "_own").orderBy(start)
    return (
        df.withColumn("_bin", _bin(F.col(start), bits))
        .withColumn("_prev", F.lag(end).over(in_bin))
        .withColumn("_next", F.lead(end).over(in_bin))
        .withColumn("_own", F.when(F.col("_prev").isNotNull() & F.col("_next").isNotNull(), F.col("_bin")))
        .withColumn("_edge", F.lag(end).over(edges))
        .withColumn("prev_end", F.coalesce("_prev", "_edge"))
        .drop("_bin", "_prev", "_next", "_own", "_edge")
    )


def restrict(df: DataFrame, intervals: DataFrame, contig: str = "ref_idx", bits: int = JOIN_BITS) -> DataFrame:
    """Rows of half-open ``df`` that overlap any of the half-open ``intervals``, each once.

    The intervals are made disjoint first. A row then has one first interval it
    overlaps: the one whose predecessor ends at or before the row's start. Only
    that pair passes the join, so no row is repeated and none needs a second
    shuffle to be made distinct.
    """
    inclusive = intervals.where("start0 < end0").select(contig, "start0", (F.col("end0") - 1).alias("_last"))
    disjoint = merge_intervals(inclusive, [contig], "start0", "_last", 1).select(
        contig, F.col("start").alias("_b0"), (F.col("end") + 1).alias("_b1")
    )
    chained = with_previous_end(disjoint, [contig], "_b0", "_b1", MERGE_BITS)
    right = chained.withColumn("_bin", _bins(F.col("_b0"), F.col("_b1") - 1, bits))
    return (
        _binned(df, bits)
        .join(right, [contig, "_bin"])
        .where((F.col("start0") < F.col("_b1")) & (F.col("_b0") < F.col("end0")))
        .where(F.col("prev_end").isNull() | (F.col("prev_end") <= F.col("start0")))
        .where(_bin(F.greatest("start0", "_b0"), bits) == F.col("_bin"))
        .select(*df.columns)
    )


def restrict_reads(reads: DataFrame, intervals: DataFrame, contig: str = "ref_idx") -> DataFrame:
    """``restrict`` for reads that carry ``pos`` and ``end_pos``."""
    spans = reads.withColumn("start0", F.col("pos") - 1).withColumn("end0", F.col("end_pos"))
    return restrict(spans, intervals, contig).drop("start0", "end0")


def interval_span(covered: DataFrame, contig: str = "ref_idx") -> DataFrame:
    """First start, last end and number of the intervals of each contig.

    Of merged intervals, as here, the last one also has the largest end.
    """
    return covered.groupBy(contig).agg(
        F.min("s").alias("first_start"), F.max("e").alias("last_end"), F.count("*").alias("n")
    )


def interval_label(span: DataFrame) -> DataFrame:
    """``<n>regions_<contig>-<start>`` for each row of ``interval_span`` with its ``contig``."""
    label = F.concat(
        F.col("n").cast("string"), F.lit("regions_"), F.col("contig"), F.lit("-"), F.col("first_start").cast("string")
    )
    return span.select(label.alias("label"))


def bed_lines(covered: DataFrame) -> DataFrame:
    """BED text of ``contig, s, e``: 0-based and half-open, so that no covered base is lost."""
    fields = F.concat_ws("\t", "contig", (F.col("s") - 1).cast("string"), F.col("e").cast("string"))
    return covered.select(fields.alias("line"))


def region_strings(covered: DataFrame) -> DataFrame:
    return covered.select(region_string("contig", "s", "e").alias("region_string"))
