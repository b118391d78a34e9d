"""From raw documents to token ids: five stages, each over all that the one before kept.

Every stage's result is written as Parquet and read again, so a lost executor or
driver costs one stage at most.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from neolake.llm import decontaminate, language, mixing, simhash, token_output
from neolake.llm._common import Scratch, table


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go whose language can't be told: no letters, or no language at REJECT or more."""
    return language.keep_identified(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five-word shingles, similarity 0.8) the one with the least doc_id stays."""
    return simhash.near_dedup(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix by source takes it."""
    return mixing.mix_documents(docs)


def write_token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32), read back from the written files."""
    path = Scratch(spark, "pipeline-tokens").root
    token_output.write_tokens(docs, path)
    return token_output.read_tokens(spark, path)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", identify_language),
    ("simhash_near_dedup", drop_near_copies),
    ("benchmark_decontamination", drop_benchmark_leaks),
    ("source_mixing", mix_sources),
    ("token_output", write_token_ids),
]

#: Stages 1 to 3 and 5 can't be said in SQL; tests hold them against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs, before = scratch.store(stage(spark, docs, sf_dir), name), docs
        scratch.drop(before)  # the next stage reads this one's table only
    return docs
