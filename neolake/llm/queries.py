"""One query for each training-data operator, over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import decontaminate, divergence, html_crf, language, line_dedup, mixing, quality, simhash, suffix_dedup, token_output, url_filter, vector_codes, winnowing
from ._common import Scratch, table


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_filter.judge(table(spark, sf_dir, "pages"), url_filter.rule_table(spark))
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return language.predict(docs.drop("lang"), language.fit(docs))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("kept")


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.resample(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"))


def op7_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnowing.winnow(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_crf.extract(table(spark, sf_dir, "pages"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op10_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = Scratch(spark, "op10").root
    token_output.write_tokens(table(spark, sf_dir, "documents").select("doc_id", "text"), path)
    return token_output.read_tokens(spark, path)


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compress(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"), texts=False)


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents").select("text", "lang", "source"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mixing": op1_mixing,
    "op2_url_filter": op2_url_filter,
    "op3_decontaminate": op3_decontaminate,
    "op4_language": op4_language,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_quality": op6_quality,
    "op7_winnowing": op7_winnowing,
    "op8_html_text": op8_html_text,
    "op9_simhash": op9_simhash,
    "op10_tokens": op10_tokens,
    "op11_vector_codes": op11_vector_codes,
    "op12_line_dedup": op12_line_dedup,
    "op13_divergence": op13_divergence,
}

ORACLES: dict[str, str] = {"op1_mixing": mixing.ORACLE, "op2_url_filter": url_filter.ORACLE, "op7_winnowing": winnowing.ORACLE, "op11_vector_codes": vector_codes.ORACLE, "op12_line_dedup": line_dedup.ORACLE, "op13_divergence": divergence.ORACLE}
