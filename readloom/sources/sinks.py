"""Sinks. Rows go from the executors to part files; none pass through the driver."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from readloom.operators.intervals import bed_lines, region_strings
from readloom.operators.ordering import layout
from readloom.operators.variants import sort_variants, with_contig_key


def write_alignments(
    df: DataFrame, path: str, ids: Sequence[str] = ("qname", "flag"), mode: str = "errorifexists"
) -> None:
    """Parquet in coordinate order: part files follow each other, rows are sorted inside."""
    layout(df, ["ref_idx", "pos", *ids]).write.mode(mode).parquet(path)


def write_bed(covered: DataFrame, path: str, mode: str = "errorifexists") -> None:
    bed_lines(covered).write.mode(mode).text(path)


def write_region_strings(covered: DataFrame, path: str, mode: str = "errorifexists") -> None:
    region_strings(covered).write.mode(mode).text(path)


def write_vcf(
    variants: DataFrame, path: str, by_region: bool = False, strict: bool = False, mode: str = "errorifexists"
) -> None:
    """Lines in global variant order, or in order inside a folder per ``region``."""
    if not by_region:
        sort_variants(variants, strict).select("line").write.mode(mode).text(path)
        return
    # Contigs without a key sort last here too.
    keyed = with_contig_key(variants, strict).withColumn("_last", F.col("contig_key").isNull())
    ordered = layout(keyed, ["region", "_last", "contig_key", "contig", "pos", "line"])
    ordered.select("region", "line").write.mode(mode).partitionBy("region").text(path)
