"""Balanced regions: whole contigs dealt to a fixed number of regions by read count."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from readloom.functions.arrays import indices, let
from readloom.operators.ordering import layout

# Fixed value: the number of regions.
REGIONS = 4


def count_contigs(reads: DataFrame) -> DataFrame:
    """Reads per contig, combined before the shuffle."""
    return reads.groupBy("ref_idx").agg(F.count("*").alias("c"))


def contig_counts(reads: DataFrame) -> DataFrame:
    """Reads per contig, largest first."""
    return count_contigs(reads).orderBy(F.desc("c"), "ref_idx")


def balance_regions(counts: DataFrame, k: int = REGIONS) -> DataFrame:
    """Contigs by falling count, each to the least loaded of ``k`` regions, the lowest on a tie.

    Sequential by nature, on one row per contig of the dictionary, never on reads. The fold goes over
    runs of about sqrt(n) contigs: what a run has dealt is appended once it is done, so no step copies more than a run.
    """
    contigs = F.sort_array(F.collect_list(F.struct((-F.col("c")).alias("order"), "ref_idx", "c")))
    given = "array<struct<ref_idx:int,region:int>>"
    nothing = F.array().cast(given)

    def deal(acc, x):
        region = F.array_position(acc.loads, F.array_min(acc.loads)).cast("int")
        loads = F.transform(acc.loads, lambda load, i: F.when(i + 1 == region, load + x.c).otherwise(load))
        one = F.struct(x.ref_idx.alias("ref_idx"), region.alias("region"))
        return F.struct(loads.alias("loads"), F.concat(acc.given, F.array(one)).alias("given"))

    def deal_run(acc, run):
        start = F.struct(acc.loads.alias("loads"), nothing.alias("given"))
        return let(
            F.aggregate(run, start, deal),
            lambda done: F.struct(done["loads"].alias("loads"), F.concat(acc.given, F.array(done["given"])).alias("given")),
        )

    def all_runs(xs: Column) -> Column:
        width = F.greatest(F.lit(1), F.ceil(F.sqrt(F.size(xs))).cast("int"))
        return let(
            width,
            lambda w: F.transform(indices(F.ceil(F.size(xs) / w).cast("int")), lambda i: F.slice(xs, i * w + 1, w)),
        )

    start = F.struct(
        F.array_repeat(F.lit(0).cast("bigint"), k).alias("loads"), F.array().cast(f"array<{given}>").alias("given")
    )
    listed = counts.agg(contigs.alias("contigs"))
    dealt = listed.select(F.flatten(F.aggregate(let(F.col("contigs"), all_runs), start, deal_run, lambda acc: acc.given)).alias("given"))
    return dealt.select(F.inline("given"))


def assign_regions(df: DataFrame, contig_region: DataFrame) -> DataFrame:
    """Attach ``region`` by contig. No hint: stage the map, so that the planner knows its size and broadcasts it while it is small."""
    return df.join(contig_region, "ref_idx")


def region_load(counts: DataFrame, contig_region: DataFrame) -> DataFrame:
    """Reads per region."""
    return assign_regions(counts, contig_region).groupBy("region").agg(F.sum("c").alias("n"))


def region_partitions(reads: DataFrame, ids: Sequence[str], order: Sequence[str] = ("ref_idx", "pos")) -> DataFrame:
    """Reads laid out by region and coordinate; a region spans as many partitions as it needs."""
    return layout(reads, ["region", *order, *ids])
