"""Corpus pipeline: quality, language, near-duplicates, benchmark leaks, tokens.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the
last return rows of ``documents`` with all their columns.  ``run`` writes what
each stage keeps to the shared checkpoint folder, so that the next one reads it
any number of times and a lost executor costs no earlier stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterflow.llm import bpe, decontam, language_id, near_dup, quality
from rosterflow.llm.common import fresh, staged, table

# A document goes if its best language is less likely than this.
LEAST_LIKELY = 0.5

# The stages learn from the rows that they are given; no SQL expresses them.
ORACLE_SQL = None


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier predicts to be good."""
    score = fresh(docs, "quality_score")
    classifier = quality.fit(docs, quality.train_labels(table(spark, sf_dir, "labels")))
    return quality.add_quality(docs, classifier, score).where(F.col(score) >= quality.THRESHOLD).drop(score)


def keep_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language of the model; those without letters or without a likely language go."""
    found = fresh(docs, "language")
    model = language_id.fit(language_id.train_fold(docs))
    sure = (F.col(f"{found}.lang") != language_id.UND) & (F.col(f"{found}.score") >= LEAST_LIKELY)
    return language_id.add_language(docs, model, found).where(sure).drop(found)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (runs of five words, Jaccard 0.8)."""
    return near_dup.deduplicated(docs, words=5, percent=80)


def keep_uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of a benchmark item."""
    return decontam.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokens of every document that is left, as digests of the ids and of the decoded text."""
    return bpe.bpe_round_trip(docs, bpe.default_vocabulary())


STAGES = [
    ("quality", keep_quality),
    ("language", keep_language),
    ("near_duplicates", keep_one_of_each),
    ("decontamination", keep_uncontaminated),
    ("tokens", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
