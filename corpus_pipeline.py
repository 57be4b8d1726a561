"""Documents to packed training windows: language ID, near-dedup, PII redaction, best-fit packing.

Each stage takes ``(spark, docs, sf_dir)``, works on all rows its predecessor kept,
and its decisions take effect. All but the last return the columns of the documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from readloom.llm import langid, packing, pii, simhash
from readloom.operators.staging import staging_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that language ID rejects: no letter, a low score, or mostly unseen subwords."""
    found = langid.predict(docs, langid.fit_on_fold(docs), tuple(docs.columns))
    return found.where(~F.col("rejected")).select(docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group whose fingerprints of 3-word shingles differ in 3 bits or less."""
    return simhash.deduplicated(docs, shingle=3, max_bits=3)


def redact_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data by labels; every document stays."""
    return pii.redact(pii.find(docs)).select(docs.columns)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lay all documents out in windows of ``packing.CAPACITY`` words: a row per piece, with its text and its place."""
    return packing.pack_texts(docs)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("redact_pii", redact_pii),
    ("pack_windows", pack_windows),
]

#: A trained classifier and fingerprints decide which rows stay: SQL can't express them.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written as Parquet and read again for the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs.write.parquet(path := staging_path(spark, name))
            docs = spark.read.parquet(path)
    return docs
