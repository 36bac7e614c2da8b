"""The operators over the driver tables: ``opN_<name>`` queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from rosterflow.llm import oracle
from rosterflow.llm.bpe import bpe_round_trip, default_vocabulary
from rosterflow.llm.collocations import collocations
from rosterflow.llm.common import table
from rosterflow.llm.compression_rules import quality_rules
from rosterflow.llm.decontam import leak_report
from rosterflow.llm.language_id import languages
from rosterflow.llm.license_scan import known_licences, license_scan
from rosterflow.llm.lm_score import lm_scores
from rosterflow.llm.near_dup import near_duplicates
from rosterflow.llm.quality import quality_scores
from rosterflow.llm.spelling import spelling_variants
from rosterflow.llm.token_counts import load_ranks, section_tokens
from rosterflow.llm.url_filter import url_verdicts
from rosterflow.llm.vector_search import top_k

URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"),
             ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def op1_vector_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(table(spark, sf_dir, "documents"), known_licences(spark))


def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), words=4, percent=80)


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return languages(table(spark, sf_dir, "documents"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_verdicts(table(spark, sf_dir, "pages"), rules)


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    ranks = load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return section_tokens(table(spark, sf_dir, "documents"), ranks)


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leak_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(table(spark, sf_dir, "documents"))


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_round_trip(table(spark, sf_dir, "documents"), default_vocabulary())


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"))


def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_vector_search": op1_vector_search,
    "op2_license_scan": op2_license_scan,
    "op3_near_duplicates": op3_near_duplicates,
    "op4_language_id": op4_language_id,
    "op5_quality": op5_quality,
    "op6_url_filter": op6_url_filter,
    "op7_token_counts": op7_token_counts,
    "op8_decontamination": op8_decontamination,
    "op9_lm_score": op9_lm_score,
    "op10_bpe": op10_bpe,
    "op11_collocations": op11_collocations,
    "op12_spelling": op12_spelling,
    "op13_quality_rules": op13_quality_rules,
}

ORACLE_SQL: dict[str, str] = {
    "op1_vector_search": oracle.VECTOR_SEARCH,
    "op2_license_scan": oracle.license_scan_sql(),
    "op6_url_filter": oracle.URL_FILTER,
    "op11_collocations": oracle.COLLOCATIONS,
}
