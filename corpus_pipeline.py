"""Corpus pipeline over ``documents``: five of the operators, each stage written as
Parquet and reread as the next one's input.

1. ``language_id``: documents that no language explains go.
2. ``line_dedup``: lines that an earlier line repeats within one edit go; a document
   that loses all its lines but empty ones goes with them.
3. ``jaccard_join``: of each group of near copies the first row stays.
4. ``mix_sources``: the words that the mix takes, a row for each time.
5. ``packing``: pieces of sequences of 2048 tokens.

All but the last return the columns of their input. Rows are told apart by a row
number of their own where ids may repeat or be NULL. Empty tables stay empty.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brickyard.llm.jaccard_join import jaccard_components
from brickyard.llm.language_id import of_documents
from brickyard.llm.line_dedup import line_dedup
from brickyard.llm.mixing import mixed_texts
from brickyard.llm.packing import pack
from brickyard.llm.queries import tokenizer_file
from brickyard.llm.tables import documents, numbered, small, written


def _with_size(df: DataFrame) -> DataFrame:
    if "n_chars" not in df.columns:
        return df
    return df.withColumn("n_chars", F.char_length("text").cast(df.schema["n_chars"].dataType))


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    carry = [c for c in docs.columns if c != "doc_id"]
    return of_documents(docs, carry=carry, only_accepted=True).select(*docs.columns)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = line_dedup(docs, n_lines="__lines", n_dropped="__dropped")
    return _with_size(out.where((F.col("__dropped") == 0) | (F.btrim("text", F.lit(" \n")) != "")).select(*docs.columns))


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = numbered(docs, "__row", "near-rows")
    found = jaccard_components(rows, id="__row")
    gone = written(found.where("__row <> component_id").select("__row"), "near-gone")
    return rows.join(small(gone, 16), "__row", "left_anti").select(*docs.columns)


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixed_texts(docs)


def pack_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs, tokenizer_file("byte_bpe_50k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_stage), ("line_dedup", line_stage), ("jaccard_join", near_stage),
    ("mix_sources", mix_stage), ("packing", pack_stage),
]

#: SQL can't express the stages; tests/llm holds the result against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
