"""Registered queries of the text operators; their SQL, where SQL can express them, is in ``oracle``."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from . import (alignment, iblt, license_digest, line_rules, mixing, pca_clustering, pii, quality_gam, secret_ledger, sentencepiece_codec, simhash,
               toxicity, url_lm)
from .common import held_out, table
from .oracle import ORACLE  # noqa: F401  (read by the driver's entry)

#: Score from which a document is predicted to be of class 1.
PREDICTED_FROM = 0.7
#: Vocabulary files of the tokenizers, by their names in the installed set.
MODEL_NAME, BYTE_LEVEL_NAME = "piece_bpe_32k.model", "byte_bpe_50k.json"


def model_bytes(path: str | None = None) -> bytes:
    if path is None:
        import public_tokenizers
        path = public_tokenizers.path(MODEL_NAME)
    with open(path, "rb") as f:
        return f.read()


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, radius=3)
    return found.select("doc_id", simhash.fingerprint_text(F.col("fp")).alias("fingerprint"), "component_id")


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing.mix_plan(table(spark, sf_dir, "documents"), weights=(1, 2, 3), cap=3)
    return plan.select("doc_id", "size", "source_size", "target", "taken")


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality_gam.train(docs, labels, "quality", ~held_out(F.col("doc_id"), 4, 2))
    return _scored(quality_gam.score(docs, model), 4, 2)


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return iblt.version_fingerprints(table(spark, sf_dir, "documents"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_rules.judge_documents(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.train(docs, labels, "toxic", ~held_out(F.col("doc_id"), 3, 1))
    return _scored(toxicity.score(docs, model), 3, 1)


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pii.find(docs, pii.disclosing_terms(docs)).select(
        "doc_id", "n_email", "n_ip", "n_card", "n_phone", "n_term", "base_sha256", "spans")


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_lm.judge(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_digest.scan(table(spark, sf_dir, "documents"))


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = sentencepiece_codec.encode(table(spark, sf_dir, "documents"), model_bytes(), with_ids=False)
    return coded.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def op11_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Over a ledger of its own, so that every text is scanned."""
    ledger = scratch_path(spark, f"llm/ledger-{uuid.uuid4().hex}")
    return secret_ledger.scan(table(spark, sf_dir, "documents"), ledger).select(
        "doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_added", "blob")


def op12_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pca_clustering.cluster(table(spark, sf_dir, "embeddings"), k=16, rounds=3)


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    files = alignment.read_tokenizers(public_tokenizers.path(BYTE_LEVEL_NAME), public_tokenizers.path(MODEL_NAME))
    return alignment.align(table(spark, sf_dir, "documents"), *files)


def _scored(scores: DataFrame, modulus: int, remainder: int) -> DataFrame:
    return scores.select("doc_id", held_out(F.col("doc_id"), modulus, remainder).alias("held_out"), "score",
                         F.when(F.col("score") >= PREDICTED_FROM, 1).otherwise(0).cast("int").alias("predicted"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_simhash, op2_mixing, op3_quality, op4_fingerprints, op5_quality_rules, op6_toxicity, op7_pii,
                            op8_url_filter, op9_license_scan, op10_sentencepiece, op11_secret_scan, op12_centroid_clustering,
                            op13_alignment)}
