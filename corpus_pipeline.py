"""A corpus pipeline: cleaning, near-duplicates, personal data, mixing, tokenizing.

``run`` applies ``STAGES`` to ``documents``. Each stage works on all that the one
before it kept, written as Parquet in the shared checkpoint folder and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hearth.llm import line_rules, mixing, pii, sentencepiece_codec, simhash
from hearth.llm.common import table, write_scratch
from hearth.llm.queries import model_bytes


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Failing lines go from the texts, rejected documents go whole."""
    return line_rules.clean(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near duplicates stays: that of the least id."""
    return simhash.deduplicate(docs, shingle=3, radius=3)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Entities and the terms that disclose them are replaced by their kind."""
    return pii.sanitise(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.mix(docs, weights=(1, 2, 3), cap=3)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every text, and the digest of what they decode to."""
    return sentencepiece_codec.encode(docs, model_bytes()).select(
        "doc_id", "n_tokens", "ids", "ids_sha256", "decoded_sha256")


STAGES = [("quality rules", quality_rules), ("near duplicates", near_duplicates), ("personal data", personal_data),
          ("source mix", source_mix), ("tokens", tokens)]

#: The stages' verdicts, hashes and ids are not expressible in SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = write_scratch(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return docs
