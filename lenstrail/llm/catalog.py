"""Registered queries of this subpackage: each applies an operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lenstrail.llm import (
    conversation_repair,
    embedding_dedup,
    exact_search,
    fingerprints,
    html_text,
    licenses,
    mixing,
    ngram_join,
    packing,
    quality,
    suffix_dedup,
    toxicity,
    vector_codes,
)
from lenstrail.llm.common import table


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(table(spark, sf_dir, "documents"), licenses.document_path())


def main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())


def quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint(table(spark, sf_dir, "documents"))


def near_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_join(table(spark, sf_dir, "documents"))


def repeated_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digest(table(spark, sf_dir, "documents"))


def near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_vectors(table(spark, sf_dir, "embeddings"))


def mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).drop("text_key")


def toxicity_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def repaired_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repair(table(spark, sf_dir, "conversations"), damage=True)


def vector_codes_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.vector_codes(table(spark, sf_dir, "embeddings"))


def nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_search.top_k(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_license_scan": license_scan,
    "op2_main_text": main_text,
    "op3_pack": pack,
    "op4_quality": quality_scores,
    "op5_fingerprint": document_fingerprints,
    "op6_ngram_join": near_documents,
    "op7_repeated_bytes": repeated_bytes,
    "op8_near_vectors": near_vectors,
    "op9_mix": mix_sources,
    "op10_toxicity": toxicity_scores,
    "op11_conversation_repair": repaired_conversations,
    "op12_vector_codes": vector_codes_of,
    "op13_exact_search": nearest_vectors,
}

ORACLES: dict[str, str] = {
    "op8_near_vectors": embedding_dedup.ORACLE,
    "op9_mix": mixing.ORACLE,
    "op11_conversation_repair": conversation_repair.ORACLE,
    "op12_vector_codes": vector_codes.ORACLE,
    "op13_exact_search": exact_search.ORACLE,
}
