"""Region-wide decision on the quality encoding."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from readloom.functions.quality import guess_encoding, quality_error, rebase


def first_quality(reads: DataFrame, ids: Sequence[str], region: str, quals: str) -> DataFrame:
    """``_top``: largest quality of each region's first read by contig, position and ids.

    The first coordinate comes from a hash aggregation over two narrow columns;
    only reads at that coordinate are then compared by id. A minimum over whole
    structs would sort every read, qualities included, before the shuffle.
    """
    place = F.col("ref_idx").cast("bigint") * (1 << 32) + F.col("pos")
    start = reads.groupBy(region).agg(F.min(place).alias("_start"))
    top = reads.select(region, *ids, place.alias("_place"), F.array_max(quals).alias("_top"))
    first = top.join(start, region).where(F.col("_place") == F.col("_start"))
    return first.groupBy(region).agg(F.min_by("_top", F.struct(*ids)).alias("_top"))


def rebase_region(
    reads: DataFrame,
    ids: Sequence[str],
    region: str = "region",
    quals: str = "quals",
    strict: bool = False,
) -> DataFrame:
    """Shift every read of a region if its first read looks like Illumina.

    Adds ``shift`` and ``quality_error``; a read with an error keeps its message
    and its shifted values, or fails the job when ``strict``. ``region`` is a
    region or contig column; few decisions are broadcast by their known size, many are not.
    """
    decision = first_quality(reads, ids, region, quals).select(
        region, F.coalesce(guess_encoding(F.array("_top")) == "ILLUMINA", F.lit(False)).alias("shift")
    )
    error = F.when(F.col("shift"), quality_error(quals))
    if strict:
        error = F.when(error.isNotNull(), F.raise_error(error)).cast("string")
    return (
        reads.join(decision, region)
        .withColumn("quality_error", error)
        .withColumn(quals, F.when(F.col("shift"), rebase(quals)).otherwise(F.col(quals)))
    )
