"""The corpus pipeline: five stages over ``documents``, each written before the next reads it.

A stage takes (spark, docs, sf_dir), works on all that its predecessor kept and returns the
columns of ``documents``; the last returns the token ids.

Defined results, for every stage: a NULL or empty text is rejected by the first stage (too few
words), and passes each later one unchanged if it is given one; rows that repeat a doc_id and a text are
treated alike by the rules, lose the same lines, and stay or go together as near duplicates and
as leaks; a NULL doc_id is an id like others, sorted first among lines and never the one that stands for
a group unless all are NULL; of ties the smallest doc_id stays; very long texts are read whole; an empty
table passes through as empty; further columns, whatever their names, pass through unchanged
up to the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from jobfacts.llm import decontam, jaccard, linededup, quality, sentencepieces
from jobfacts.llm.common import cut, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go."""
    return quality.keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines go, and documents of which nothing is left."""
    return linededup.keep_first_lines(docs)


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component stays."""
    return jaccard.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap with a benchmark item go."""
    return decontam.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of what is left."""
    return sentencepieces.sentencepiece_query(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("ngram_jaccard_join", jaccard_join),
    ("decontamination", decontamination),
    ("sentencepiece", sentencepiece),
]

#: SQL can't express the last stage; a test holds the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
