"""SAM, sequence dictionary, BED and VCF: splittable line scans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from readloom.functions.quality import decode_phred

# The mandatory SAM fields before the tags, and the first words of BED header lines.
SAM_FIELDS = 11
BED_HEADERS = ("track", "browser")


def _field(parts: str, i: int) -> Column:
    return F.try_element_at(F.col(parts), F.lit(i))


def read_contigs(spark: SparkSession, path: str) -> DataFrame:
    """Sequence dictionary as ``ref_idx, contig, length`` in line order from 0.

    The first line is the header; a length that is no number becomes 0. A last
    line without a newline counts. The file is small and read as one text, which
    is what keeps the line order.
    """
    lines = spark.read.text(path, wholetext=True).select(F.posexplode(F.split("value", "\n")).alias("_line", "_text"))
    words = lines.where((F.col("_line") > 0) & (F.trim("_text") != "")).withColumn("_w", F.split("_text", r"\s+"))

    def value(i: int) -> Column:
        # Everything after the first colon; the whole word where there is none.
        return F.regexp_replace(_field("_w", i), "^[^:]*:", "")

    return words.select(
        (F.col("_line") - 1).alias("ref_idx"),
        value(2).alias("contig"),
        F.coalesce(value(3).try_cast("int"), F.lit(0)).alias("length"),
    )


def read_sam(spark: SparkSession, path: str | list[str], contigs: DataFrame | None = None) -> DataFrame:
    """Alignments of SAM files, one row per line that is no header.

    A line with too few fields or a number that does not parse keeps the scan
    going: its text is in ``_corrupt`` and its other columns are NULL. With the
    dictionary ``contigs`` the rows carry ``ref_idx``, -1 where the contig is
    unknown or ``*``. ``chunk`` is the file's name up to its first dot.
    """
    lines = spark.read.text(path).where(~F.startswith("value", F.lit("@")) & (F.col("value") != ""))
    stem = F.regexp_extract("_metadata.file_name", r"^[^.]*", 0)
    parts = lines.select("value", F.split("value", "\t").alias("_p"), stem.alias("chunk"))
    names = {
        "qname": 1, "flag": 2, "contig": 3, "pos": 4, "mapq": 5, "cigar": 6,
        "mate_contig": 7, "mate_pos": 8, "tlen": 9, "seq": 10, "qual": 11,
    }
    numbers = ["flag", "pos", "mapq", "mate_pos", "tlen"]
    raw = parts.select(
        "value",
        "_p",
        "chunk",
        *[
            (_field("_p", i).try_cast("int") if name in numbers else _field("_p", i)).alias(name)
            for name, i in names.items()
        ],
    )
    good = F.size("_p") >= SAM_FIELDS
    for name in numbers:
        good = good & F.col(name).isNotNull()
    tags = F.slice("_p", SAM_FIELDS + 1, F.greatest(F.size("_p") - SAM_FIELDS, F.lit(0)))
    read = raw.select(
        *[F.when(good, F.col(name)).alias(name) for name in names],
        F.when(good, tags).alias("tags"),
        "chunk",
        F.when(~good, F.col("value")).alias("_corrupt"),
    ).withColumn("quals", decode_phred("qual"))
    if contigs is None:
        return read
    index = contigs.select("contig", "ref_idx")
    return read.join(index, "contig", "left").withColumn("ref_idx", F.coalesce("ref_idx", F.lit(-1)))


def _bed_lines(spark: SparkSession, path: str | list[str]) -> tuple[DataFrame, Column]:
    # The whole word: a contig may be called track1.
    header = F.col("value").startswith("#") | F.col("value").rlike(rf"^({'|'.join(BED_HEADERS)})(\s|$)")
    return spark.read.text(path), header


def read_bed(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """BED intervals ``contig, start0, end0, rest``: 0-based, half-open, further fields as text."""
    lines, header = _bed_lines(spark, path)
    parts = lines.where(~header & (F.trim("value") != "")).select(F.split("value", "\t", 4).alias("_p"))
    return parts.select(
        _field("_p", 1).alias("contig"),
        _field("_p", 2).try_cast("int").alias("start0"),
        _field("_p", 3).try_cast("int").alias("end0"),
        _field("_p", 4).alias("rest"),
    )


def bed_header(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Header lines of a BED file, as ``line``."""
    lines, header = _bed_lines(spark, path)
    return lines.where(header).select(F.col("value").alias("line"))


def read_vcf(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Variants of VCF files without the ``#`` lines; ``line`` is the text as it stands in the file."""
    lines = spark.read.text(path).where(~F.startswith("value", F.lit("#")) & (F.col("value") != ""))
    parts = lines.select(F.col("value").alias("line"), F.split("value", "\t").alias("_p"))
    return parts.select(
        _field("_p", 1).alias("contig"),
        _field("_p", 2).try_cast("int").alias("pos"),
        _field("_p", 3).alias("id"),
        _field("_p", 4).alias("ref"),
        _field("_p", 5).alias("alt"),
        _field("_p", 6).try_cast("double").alias("qual"),
        _field("_p", 7).alias("filter"),
        _field("_p", 8).alias("info"),
        "line",
    )
