"""Registered queries of the corpus operators and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm import alignment, bpe, exact, fingerprints, jaccard, language, licences, packing, passages, rans, scoring, suffixes, whitening
from sluice.llm.common import documents


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_groups(documents(spark, sf_dir, "doc_id", "text"))


def op2_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(documents(spark, sf_dir, "doc_id", "text"))


def op3_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_groups(documents(spark, sf_dir, "doc_id", "text"), size=3, percent=90)


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.remove_repeats(documents(spark, sf_dir, "doc_id", "text")).drop("spans")


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_documents(documents(spark, sf_dir, "doc_id", "text"))


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from public_tokenizers import PATTERN

    return bpe.encode_documents(documents(spark, sf_dir, "doc_id", "text"), vocabulary("byte_bpe_multi_50k.tiktoken"), PATTERN)


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.repeated_passages(documents(spark, sf_dir, "doc_id", "text"))


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify_languages(documents(spark, sf_dir, "doc_id", "text", "lang"))


def op9_token_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rans.round_trip(documents(spark, sf_dir, "doc_id", "text"), vocabulary("byte_bpe_50k.json"))


def op10_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(documents(spark, sf_dir, "doc_id", "text"), vocabulary("word_bpe_49k.json"))


def op11_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, "doc_id", "text")
    return scoring.score_documents(docs, scoring.held_out_fifth(F.col("doc_id")))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten_embeddings(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, "doc_id", "text")
    return alignment.align_documents(docs, vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_licence_scan": op2_licence_scan,
    "op3_ngram_jaccard": op3_ngram_jaccard,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_fingerprints": op5_fingerprints,
    "op6_byte_bpe": op6_byte_bpe,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_language": op8_language,
    "op9_token_blocks": op9_token_blocks,
    "op10_pack": op10_pack,
    "op11_lm_score": op11_lm_score,
    "op12_whitening": op12_whitening,
    "op13_alignment": op13_alignment,
}

SQL: dict[str, str] = {
    "op1_exact_dedup": exact.SQL,
    "op2_licence_scan": licences.sql(),
    "op3_ngram_jaccard": jaccard.sql(size=3, percent=90),
}
