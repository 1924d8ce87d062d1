"""One registered query per capability: ``name -> (spark, sf_dir) -> DataFrame``.

Each query reads the driver's tables through the role adapters, so its work grows with
the tables.  Branch queries return the job's intermediate relation (children of live
jobs only), which is what the oracle SQL computes; the fact itself uses the same
operators without that restriction (the final LEFT join applies it).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobfacts import constants as K
from jobfacts.functions.codes import code_slice, decode, label_normalize
from jobfacts.functions.timeops import billable_hours, elapsed_hours, to_local_time
from jobfacts.operators import dimensions, hotkeys, ranges, rollups, spine as spine_ops, survey
from jobfacts.operators.hotkeys import WORKER_PAIR, Split
from jobfacts.plans import bucketed, checks, fact
from jobfacts.plans.files import work_folder
from jobfacts.sources.roles import Roles

Query = Callable[[SparkSession, str], DataFrame]


#: the joins of the spine that a frequent key can load
SPINE_JOINS = ("job_request", "request_asset")
WORKER_JOINS = ("job_vendor", "job_staff")


def _splits(r: Roles, *joins: str) -> dict[str, Split]:
    return hotkeys.profile(r, joins)


def _spine(r: Roles, splits: dict[str, Split] | None = None) -> DataFrame:
    splits = _splits(r, *SPINE_JOINS) if splits is None else splits
    return spine_ops.job_spine(r.requests, r.jobs, r.codes, r.properties, splits)


def worker_resolution_q(r: Roles) -> DataFrame:
    splits = _splits(r, *SPINE_JOINS, *WORKER_JOINS)
    return dimensions.worker_branch(_spine(r, splits), r.vendors, r.users, splits)


def within_days_of_q(r: Roles) -> DataFrame:
    live = spine_ops.live_jobs(r.jobs, r.codes)
    return ranges.move_in_jobs(live, r.requests, r.leases, K.SERVICE_REQUEST_TYPE, K.MOVE_IN_WINDOW_DAYS,
                               _splits(r, "job_request")["job_request"])


def two_key_latest_join_q(r: Roles) -> DataFrame:
    splits = _splits(r, WORKER_PAIR, "job_request", "question_survey", "csat_survey")
    return survey.two_key_latest_join(_narrow_workers(r, splits), survey.latest_ratings(_ratings(r, splits)), splits)


def _live(df: DataFrame, r: Roles) -> DataFrame:
    """Keep rows of live jobs (the job computes its branches from the spine)."""
    return df.join(spine_ops.live_jobs(r.jobs, r.codes).join(r.requests.select("service_request_id"), "service_request_id", "left_semi")
                   .select("job_id"), on="job_id", how="left_semi")


def _narrow_workers(r: Roles, splits: dict[str, Split]) -> DataFrame:
    """(job, request, worker) of the live jobs whose request exists."""
    live = spine_ops.live_jobs(r.jobs, r.codes).select("job_id", "service_request_id",
                                                       F.coalesce("assigned_staff_id", "assigned_vendor_id").alias("worker_id"))
    return hotkeys.split_join(live, r.requests.select("service_request_id"), ["service_request_id"],
                              left_split=splits["job_request"], by=["job_id"])


def code_slice_q(r: Roles) -> DataFrame:
    def sliced(ns: str, counted: DataFrame, col: str, name: str | None = None) -> DataFrame:
        s = code_slice(r.codes, ns, "code", "code_name", code_name=name)
        n = counted.groupBy(F.col(col).alias("code")).agg(F.count(F.lit(1)).alias("matching_rows"))
        return s.join(n, on="code", how="left").select(
            F.lit(ns).alias("namespace"), "code", "code_name",
            F.coalesce("matching_rows", F.lit(0)).alias("matching_rows"))
    return sliced(K.NS_JOB_STATUS, r.jobs, "status").unionByName(
        sliced(K.NS_TRACKING_OBJECT, r.time_tracking, "object_type", K.KIND_JOB))


def decode_inner_q(r: Roles) -> DataFrame:
    st = code_slice(r.codes, K.NS_INVITATION_STATUS, "status", "status_name")
    up = code_slice(r.codes, K.NS_INVITATION_UPDATER, "updated_by_type", "updater_kind")
    inv = decode(decode(r.invitations, st, "status"), up, "updated_by_type")
    return inv.groupBy("status_name", "updater_kind").agg(F.count(F.lit(1)).alias("invitations"))


def decode_left_q(r: Roles) -> DataFrame:
    k = code_slice(r.codes, K.NS_INVOICE_AUTHOR, "created_by_type", "author_kind")
    return decode(r.invoice_authors, k, "created_by_type", how="left").select(
        "invoice_id", "created_by_type", "author_kind")


def label_normalize_q(r: Roles) -> DataFrame:
    st = code_slice(r.codes, K.NS_JOB_STATUS, "status", "status_name")
    return decode(r.jobs, st, "status").select("job_id", "status_name",
                                               label_normalize(F.col("status_name")).alias("job_status"))


def to_local_time_q(r: Roles) -> DataFrame:
    return r.jobs.select("job_id", F.col("created_at").alias("created_at_utc"),
                         to_local_time(F.col("created_at")).alias("created_at"),
                         to_local_time(F.col("completed_at")).alias("completed_at"))


def elapsed_hours_q(r: Roles) -> DataFrame:
    c, u = F.col("created_at"), F.col("updated_at")
    return r.invitations.select("job_id", "created_at", "updated_at",
                                elapsed_hours(c, u).alias("hours"),
                                elapsed_hours(c, u, scale=0).alias("whole_hours"),
                                elapsed_hours(c, u, scale=2).alias("hours_2dp"))


def billable_hours_q(r: Roles) -> DataFrame:
    return r.jobs.select("job_id", "billable_minutes",
                         billable_hours(F.col("billable_minutes")).alias("billable_hours"))


def _line_items(r: Roles) -> DataFrame:
    return rollups.bridge_join(r.bridge, r.line_items, r.invoices, splits=_splits(r, "item_invoice"))


def distinct_then_count_q(r: Roles) -> DataFrame:
    return _live(rollups.invoice_rollup(r.bridge, r.line_items, r.invoices, r.invoice_authors, r.codes,
                                        _splits(r, "item_invoice")).drop("invoice_amount"), r)


def _ratings(r: Roles, splits: dict[str, Split] | None = None) -> DataFrame:
    splits = _splits(r, "question_survey", "csat_survey") if splits is None else splits
    return survey.rating_rows(r.survey_questions, r.question_types, r.csat, splits)


def check_primary_key_q(r: Roles) -> DataFrame:
    rows = fact.fact_rows(r, _splits(r, *SPINE_JOINS, "request_area", *WORKER_JOINS))
    targets = [("job_fact", rows, ["job_id"]), *checks.dimension_keys(r)]
    return reduce(DataFrame.unionByName, [checks.check_primary_key(df, k, n) for n, df, k in targets])


def check_foreign_key_q(r: Roles) -> DataFrame:
    return checks.fact_key_checks(fact.fact_references(r, _splits(r, "job_request", "job_vendor")), r.requests, r.vendors, r.users)


def foreign_key_violations_q(r: Roles) -> DataFrame:
    rows = fact.fact_references(r, _splits(r, "job_request"), vendors=False)
    return checks.foreign_key_violations(rows, "assigned_staff_id", r.users, "staff_id").select("job_id", "assigned_staff_id")


def job_fact_bucketed_q(r: Roles) -> DataFrame:
    path = f"{work_folder(r.spark)}/bucketed-{uuid.uuid4().hex}"
    bucketed.prepare(r, path, int(r.spark.conf.get("spark.sql.shuffle.partitions")))
    return bucketed.bucketed_fact(r.spark, path)


_QUERIES: dict[str, Callable[[Roles], DataFrame]] = {
    "code_slice": code_slice_q,
    "decode_inner": decode_inner_q,
    "decode_left": decode_left_q,
    "label_normalize": label_normalize_q,
    "job_spine": _spine,
    "to_local_time": to_local_time_q,
    "elapsed_hours": elapsed_hours_q,
    "billable_hours": billable_hours_q,
    "dimension_rates": lambda r: dimensions.labor_rates(_spine(r), r.rates),
    "worker_resolution": worker_resolution_q,
    "response_flags": lambda r: _live(rollups.response_flags(r.invitations, r.codes), r),
    "response_flags_windowed": lambda r: _live(rollups.response_flags_windowed(r.invitations, r.codes), r),
    "fanout_counts": lambda r: _live(rollups.fanout_counts(r.notes, r.note_files, r.codes), r),
    "first_per_key": lambda r: _live(rollups.first_schedule(r.scheduled_services), r),
    "bridge_join": _line_items,
    "distinct_then_count": distinct_then_count_q,
    "sum_amount": lambda r: _live(rollups.sum_amount(_line_items(r)), r),
    "logged_hours": lambda r: _live(rollups.logged_hours(r.time_tracking, r.codes), r),
    "first_status_times": lambda r: rollups.first_status_times(r.approvals, r.approvers, r.approval_history,
                                                               jobs=r.jobs),
    "within_days_of": within_days_of_q,
    "latest_flag_with_dedupe": lambda r: survey.latest_flag_with_dedupe(_ratings(r)),
    "two_key_latest_join": two_key_latest_join_q,
    "defaulted_flags": lambda r: fact.spine_with_branches(r).select(
        "job_id", *[c.alias(n) for n, c in fact.invitation_flags().items()]),
    "conditional_attribute": lambda r: fact.spine_with_branches(r).select(
        "job_id", "worker_type", "job_status", "market_id", fact.in_house_market().alias("in_house_market")),
    "job_fact": fact.job_fact,
    "job_fact_bucketed": job_fact_bucketed_q,
    "job_fact_live_only": lambda r: fact.job_fact(r, live_only=True),
    "check_primary_key": check_primary_key_q,
    "check_foreign_key": check_foreign_key_q,
    "primary_key_violations": lambda r: checks.primary_key_violations(r.scheduled_services, ["job_id", "created_at"]),
    "foreign_key_violations": foreign_key_violations_q,
}


def _bind(build: Callable[[Roles], DataFrame]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build(Roles(spark, sf_dir))
    run.__name__ = getattr(build, "__name__", "query")
    return run


def queries() -> dict[str, Query]:
    return {name: _bind(build) for name, build in _QUERIES.items()}
