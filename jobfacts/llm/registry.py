"""Queries of this subpackage: ``name -> (spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from jobfacts.llm import (decontam, fim, htmltext, jaccard, langid, licenses, linededup, pii, quality, sentencepieces, toxicity, warczip,
                          whitening)
from jobfacts.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def queries() -> dict[str, Query]:
    return {
        "op1_decontamination": lambda s, d: decontam.decontamination_query(table(s, d, "documents"), table(s, d, "benchmark")),
        "op2_sentencepiece": lambda s, d: sentencepieces.sentencepiece_query(table(s, d, "documents")),
        "op3_toxicity": lambda s, d: toxicity.toxicity_query(table(s, d, "documents"), table(s, d, "labels")),
        "op4_quality_rules": lambda s, d: quality.quality_query(table(s, d, "documents")),
        "op5_html_extraction": lambda s, d: htmltext.html_query(table(s, d, "pages")),
        "op6_language_id": lambda s, d: langid.langid_query(table(s, d, "documents")),
        "op7_ngram_jaccard_join": lambda s, d: jaccard.jaccard_query(table(s, d, "documents")),
        "op8_license_scan": lambda s, d: licenses.license_query(table(s, d, "documents")),
        "op9_line_dedup": lambda s, d: linededup.line_dedup_query(table(s, d, "documents")),
        "op10_warc": lambda s, d: warczip.warc_query(s, table(s, d, "pages")),
        "op11_pii": lambda s, d: pii.pii_query(table(s, d, "documents")),
        "op12_fill_in_middle": lambda s, d: fim.fim_query(table(s, d, "documents")),
        "op13_embedding_whitening": lambda s, d: whitening.whitening_query(table(s, d, "embeddings")),
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_decontamination": decontam.oracle_sql(),
        "op4_quality_rules": quality.oracle_sql(),
        "op9_line_dedup": linededup.oracle_sql(),
        "op10_warc": warczip.oracle_sql(),
        "op12_fill_in_middle": fim.oracle_sql(),
    }
