"""The registered queries of the corpus operators: each applies its operator to a whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from llm import (chat_template, classifier, conversation_repair, decontaminate, filter_audit, html_extract, mixing, near_dup, oracles, quality_rules, secret_scan, substrings,
                 suffix_dedup, token_counts)
from llm.textops import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.contract(table(spark, sf_dir, "documents"))


@query
def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.contract(table(spark, sf_dir, "documents"))


@query
def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.contract(table(spark, sf_dir, "documents"))


@query
def op10_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contract(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.contract(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.contract(table(spark, sf_dir, "documents"))


@query
def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classifier.contract(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op8_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_template.contract(table(spark, sf_dir, "conversations"))


@query
def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.contract(table(spark, sf_dir, "documents"))


@query
def op3_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.contract(table(spark, sf_dir, "pages"))


@query
def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.contract(table(spark, sf_dir, "conversations"))


@query
def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.contract(spark, f"{sf_dir}/documents.parquet", table(spark, sf_dir, "labels"))


@query
def op13_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.contract(table(spark, sf_dir, "documents"))


ORACLE |= {"op1_mix_sources": oracles.MIX, "op2_quality_rules": oracles.QUALITY, "op4_substring_dedup": oracles.SUBSTRINGS,
           "op5_near_duplicates": oracles.NEAR, "op8_chat_formatting": oracles.CHAT,
           "op10_benchmark_decontamination": oracles.BENCHMARK, "op11_conversation_repair": oracles.REPAIR,
           "op12_filter_audit": oracles.AUDIT, "op13_suffix_array_dedup": oracles.BYTES}


from corpus_pipeline import ORACLE_SQL, run  # noqa: E402  part of this subpackage, kept at the top of the repository

QUERIES["pipeline"] = run
if ORACLE_SQL is not None:
    ORACLE["pipeline"] = ORACLE_SQL
