"""Registered queries of the operators here: ``opN_<name>(spark, sf_dir)`` each over its whole table."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (
    byte_bpe, exact_dedup, fingerprints, jaccard_join, language_id, line_dedup, mixing, packing, phrases, search, substring_dedup,
)
from .quality import quality
from .tables import documents
from .token_counts import token_counts


def tokenizer_file(name: str) -> str:
    """Place of a public vocabulary file, as installed on every node."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(documents(spark, sf_dir, "doc_id", "text"), tokenizer_file("piece_bpe_32k.model"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(documents(spark, sf_dir, "doc_id", "text"),
                   spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality"))


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprints(documents(spark, sf_dir, "doc_id", "text"))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(documents(spark, sf_dir, "doc_id", "text"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir, "doc_id", "text"), tokenizer_file("byte_bpe_50k.json"))


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(documents(spark, sf_dir, "doc_id", "text"))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.substring_dedup(documents(spark, sf_dir, "doc_id", "text"))


def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_query(documents(spark, sf_dir, "doc_id", "text", "source"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.of_documents(documents(spark, sf_dir))


def language_id_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same operator over ``pages``, which have all four kinds of evidence."""
    return language_id.of_pages(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_dedup_query(documents(spark, sf_dir, "doc_id", "text"))


def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.round_trip(documents(spark, sf_dir, "doc_id", "text"), tokenizer_file("byte_bpe_50k.tiktoken"))


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(documents(spark, sf_dir, "lang", "text"))


def op13_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search(documents(spark, sf_dir, "doc_id", "text"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_counts": op1_token_counts,
    "op2_quality": op2_quality,
    "op3_fingerprints": op3_fingerprints,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_packing": op5_packing,
    "op6_jaccard_join": op6_jaccard_join,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_mix_sources": op8_mix_sources,
    "op9_language_id": op9_language_id,
    "op10_line_dedup": op10_line_dedup,
    "op11_byte_bpe": op11_byte_bpe,
    "op12_phrases": op12_phrases,
    "op13_search": op13_search,
    "language_id_pages": language_id_pages,
}

#: DuckDB SQL by query, where SQL can express the operator.
ORACLES: dict[str, str] = {
    "op4_exact_dedup": exact_dedup.ORACLE,
    "op6_jaccard_join": jaccard_join.ORACLE,
    "op7_substring_dedup": substring_dedup.ORACLE,
    "op10_line_dedup": line_dedup.ORACLE,
    "op12_phrases": phrases.ORACLE,
    "op13_search": search.ORACLE,
}
