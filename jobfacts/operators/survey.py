"""Survey ratings: latest flag with dedupe (C20) and the two-key latest join.

The job computes two row numbers over the *same* filtered rating rows -- a "latest per
(request, worker)" flag and a dedupe per (survey, worker, question type) -- then keeps
the dedupe winners.  A flagged row can lose the dedupe; its request/worker then gets no
survey columns.  Ties are arbitrary in the job; here both orders end in explicit
tie-breaks (parameters) so results are deterministic.

Both row numbers are firsts, so the rating rows are reduced once, by (request, worker,
survey, question type), to the best row under each order.  The flag's first per (request,
worker) and the dedupe's first per (survey, worker, question type) are then minima over
these few rows: partial aggregation keeps a hot group from ever meeting in one task before
it is small, and the questions are scanned and joined once.  A winner carries the flag iff
it is its group's latest row; groups match null-safe, as NULL workers form a group too.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobfacts import constants as K
from jobfacts.operators.hotkeys import NO_SPLIT, WORKER_PAIR, Split, split_join

RATING_COLUMNS = ("survey_id", "question_id", "survey_created_at", "vendor_or_tech_rating",
                  "vendor_tech_csat_comment")
FLAG_KEYS = ("service_request_id", "vendor_or_tech_id")
DEDUPE_KEYS = ("survey_id", "vendor_or_tech_id", "question_type_id")


_DETAIL = ("survey_id", "service_request_id", "question_id", "question_type_id", "question_type", "survey_text",
           "vendor_or_tech_id", "vendor_or_tech_rating", "survey_created_at", "vendor_tech_csat_comment")


def _nulls_last(column: str) -> list[Column]:
    """Two sort keys, ascending, that put NULL after all values."""
    return [F.col(column).isNull().alias(f"{column}_null"), F.col(column).alias(column)]


def _latest_first(column: str) -> list[Column]:
    """Two sort keys, ascending: NULL times first (they sort high in the job's dialect), then the newest."""
    return [F.col(column).isNotNull().alias(f"{column}_set"), (-F.unix_micros(F.col(column).cast("timestamp"))).alias(f"{column}_desc")]


def flag_order() -> list[Column]:
    """Latest first; question, survey and comment break ties that the job leaves open."""
    return [*_latest_first("survey_created_at"), *_nulls_last("question_id"), *_nulls_last("survey_id"),
            *_nulls_last("vendor_tech_csat_comment")]


def dedupe_order() -> list[Column]:
    """The job orders by a partition column; the tie-break picks the lowest question id,
    then the newest survey row (request and comment settle copies of a survey id)."""
    return [*_nulls_last("question_id"), *_latest_first("survey_created_at"), *_nulls_last("service_request_id"),
            *_nulls_last("vendor_tech_csat_comment")]


def rating_rows(questions: DataFrame, question_types: DataFrame, csat: DataFrame, splits: Mapping[str, Split] = {}) -> DataFrame:
    """Vendor/technician rating answers joined to their survey (filtered input of C20).  Surveys
    with a large share of the answers, or of the survey rows, are split."""
    q = questions.filter(F.col("question_type_id").isin(*K.RATING_QUESTION_TYPES))
    # question types: an enumeration, joined for existence and its labels
    q = q.join(question_types, on="question_type_id", how="inner")
    s = csat.select("survey_id", F.col("related_entity_id").alias("service_request_id"),
                    F.col("surveyed_time").alias("survey_created_at"),
                    F.col("comment").alias("vendor_tech_csat_comment"))
    rows = split_join(q, s, ["survey_id"], left_split=splits.get("question_survey", NO_SPLIT), by=["question_id"],
                      right_split=splits.get("csat_survey", NO_SPLIT), right_by=["service_request_id", "survey_created_at"])
    return rows.select(
        "survey_id", "service_request_id", "question_id", "question_type_id", "question_type",
        F.col("text").alias("survey_text"),
        F.col("related_entity_id").alias("vendor_or_tech_id"),
        F.col("answer").alias("vendor_or_tech_rating"),
        "survey_created_at", "vendor_tech_csat_comment")


def _ranked(rows: DataFrame, dedupe: Sequence[Column] | None) -> tuple[DataFrame, DataFrame]:
    """(latest row per flag group, winner per dedupe group), each with its sort keys and row."""
    row = F.struct(*_DETAIL).alias("row")
    best = rows.groupBy("service_request_id", "vendor_or_tech_id", "survey_id", "question_type_id").agg(
        F.min(F.struct(F.struct(*flag_order()).alias("by"), row)).alias("flag"),
        F.min(F.struct(F.struct(*(dedupe or dedupe_order())).alias("by"), row)).alias("dedupe"))
    latest = best.groupBy(*FLAG_KEYS).agg(F.min("flag").alias("latest"))
    winners = best.groupBy(*DEDUPE_KEYS).agg(F.min("dedupe").alias("winner")).select("winner.row.*")
    return latest, winners


def _with_flag(rows: DataFrame, dedupe: Sequence[Column] | None = None) -> DataFrame:
    latest, winners = _ranked(rows, dedupe)
    marks = latest.select(*[F.col(k).alias(f"_{k}") for k in FLAG_KEYS], F.col("latest.row").alias("_latest"))
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in FLAG_KEYS])
    return winners.join(marks, same, "left").select(
        *_DETAIL, F.col("_latest").eqNullSafe(F.struct(*_DETAIL)).alias("latest_survey"))


def latest_flag_with_dedupe(rows: DataFrame, dedupe: Sequence[Column] | None = None) -> DataFrame:
    """Dedupe winners, each with ``latest_survey`` (C20); ``dedupe`` are ascending sort keys."""
    return _with_flag(rows, dedupe).select(*rows.columns, "latest_survey")


def latest_ratings(rows: DataFrame) -> DataFrame:
    """Only the dedupe winners that carry the latest flag: at most one per (request, worker)."""
    return _with_flag(rows).filter("latest_survey").select(*FLAG_KEYS, *RATING_COLUMNS)


def two_key_latest_join(workers: DataFrame, ratings: DataFrame, splits: Mapping[str, Split] = {}) -> DataFrame:
    """Job-keyed survey branch (C21): each job's (request, worker) pair looked up in the
    latest ratings.  ``workers`` is narrow (job, request, worker), so the re-key by
    (request, worker) shuffles three columns, not the wide fact row; pairs with a large share
    of the jobs are split."""
    r = ratings.withColumnRenamed("vendor_or_tech_id", "worker_id")
    return split_join(workers.select("job_id", "service_request_id", "worker_id"), r, ["service_request_id", "worker_id"],
                      left_split=splits.get(WORKER_PAIR, NO_SPLIT), by=["job_id"]).select("job_id", *RATING_COLUMNS)
