"""Registered queries of the subpackage: each derives the columns that are compared from an operator's output."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from readloom.llm import bpe, chat, ctw, hnsw, k2treap, langid, merkle, mih, oracle, packing, pii, secrets, simhash, toxicity


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir))


def op2_small_world(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = hnsw.near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return found.select("vec_id", "n_links", "component_id", "kept")


def op3_context_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    found = ctw.score(docs, langid.remainder(7) != 2)
    held_out = F.coalesce(langid.remainder(7) == 2, F.lit(False)).alias("held_out")
    return found.select(
        "doc_id", held_out, "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte"
    )


def op4_quotation_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.link(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(documents(spark, sf_dir).select("doc_id", "text")).select("doc_id", "pii")
    count = lambda kind: F.size(F.filter("pii", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in pii.KINDS[:4]],
        F.sha2(pii.digest(F.col("pii"), pii.KINDS[:4]), 256).alias("base_sha256"),
        pii.digest(F.col("pii"), pii.KINDS).alias("spans"),
        F.array_join(F.transform("pii", lambda s: s["score"].cast("string")), ",").alias("scores"),
    )


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find(documents(spark, sf_dir).select("doc_id", "text", "source"))
    of = lambda name, value: F.filter("secrets", lambda s: s[name] == value)
    spans = pii.digest(F.col("secrets"), secrets.KINDS)
    return found.select(
        "doc_id",
        *[F.size(of("kind", kind)).cast("long").alias(f"n_{kind}") for kind in secrets.KINDS],
        F.sha2(spans, 256).alias("base_sha256"),
        spans.alias("spans"),
        *[F.size(of("verdict", v)).cast("long").alias(f"n_{v}") for v in ("live", "shared", "example")],
    )


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    found = langid.predict(docs, langid.fit_on_fold(docs), ("doc_id",))
    held_out = F.coalesce(langid.remainder(4) == 2, F.lit(False))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    vocabulary = bpe.Vocabulary.read(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    found = bpe.encode(documents(spark, sf_dir), vocabulary, decoded=True)
    return found.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op9_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return mih.nearest(vectors, F.col("vec_id") % 50 == 0)


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(documents(spark, sf_dir).select("doc_id", "text"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op11_toxic_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    model = toxicity.fit_on_fold(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    held_out = F.coalesce(langid.remainder(4) == 2, F.lit(False))
    found = toxicity.predict(docs, model, ("doc_id",))
    return found.select("doc_id", held_out.alias("held_out"), "score", "predicted", "spans")


def op12_k2_treap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return k2treap.search(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op13_merkle_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = merkle.manifest(documents(spark, sf_dir))
    return found.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_best_fit_packing,
        op2_small_world,
        op3_context_tree,
        op4_quotation_linking,
        op5_pii,
        op6_secrets,
        op7_language_id,
        op8_byte_bpe,
        op9_multi_index,
        op10_simhash,
        op11_toxic_crf,
        op12_k2_treap,
        op13_merkle_versions,
    )
}
ORACLE_SQL: dict[str, str] = {"op12_k2_treap": oracle.ranked_search(), "op13_merkle_versions": oracle.merkle()}
