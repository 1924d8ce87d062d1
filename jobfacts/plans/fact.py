"""The job fact (C22-C24): spine + dimension lookups + job-keyed branches, 55 columns.

The plan:

* what depends on the request alone (market, area rates, the move-in window of its lease) is
  looked up once per request;
* all look-ups of a job run on its keys (``job_keys``: job, request, vendor, staff and the
  creation time); descriptions and other wide columns stay with the jobs and meet the result
  once, by ``job_id``;
* every child table is aggregated per job on its own (``operators.rollups``) -- the
  spine is not re-joined inside a branch -- and each branch leaves its aggregate
  hash-partitioned by ``job_id``;
* the survey branch, keyed by request and worker, starts from a narrow projection of the jobs
  and ends keyed by job;
* the assembly is a chain of LEFT sort-merge joins on ``job_id`` that reuses one
  hash partitioning (one exchange per input, none between joins);
* keys with a large share of a relation are found by one sketch job first and split in
  their joins (``operators.hotkeys``).

The dimensions must be unique on their keys; ``plans.sink`` checks that before it writes.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobfacts import constants as K
from jobfacts.functions.flags import conditional_attribute, defaulted_flag, exists_flag
from jobfacts.functions.timeops import billable_hours, elapsed_hours
from jobfacts.operators import dimensions, hotkeys, ranges, rollups, spine as spine_ops, survey
from jobfacts.operators.hotkeys import NO_SPLIT, Split, split_join
from jobfacts.operators.lookup import left_lookup
from jobfacts.sources.roles import LINE_ITEM_KEY, Roles

FACT_COLUMNS = (
    "job_id", "service_request_id", "external_id", "lease_flow_id", "created_at",
    "completed_at", "completed_by", "job_status", "worker_type", "vendor_id", "worker_name",
    "hours_to_accept_invitation", "invitation_accepted_at", "total_notes", "vendor_notes",
    "staff_notes", "scope_of_work", "summary", "total_attachments", "vendor_attachments",
    "staff_attachments", "initial_scheduled_created_at", "initial_scheduled_date",
    "invoice_amount", "total_invoices", "first_invoice_date", "first_invoice_created_at",
    "last_invoice_date", "last_invoice_created_at", "vendor_created_invoices",
    "staff_created_invoices", "billable_hours", "logged_hours", "assigned_staff_id",
    "authorization_requested", "authorization_approved", "maintenance_rate_amount",
    "first_hour_maintenance_rate_amount", "after_hours_emergency_rate", "worker_id",
    "invitation_rejected", "invitation_accepted", "invitation_accepted_by",
    "invitation_reminded", "hours_to_schedule_work", "hours_to_close_work",
    "hours_to_submit_last_invoice", "job_within_30_move_in", "is_in_house_vendor",
    "in_house_market", "survey_id", "question_id", "survey_created_at",
    "vendor_or_tech_rating", "vendor_tech_csat_comment",
)


# -- C22 / C23: derived flags and attributes --------------------------------------------
def invitation_flags() -> dict[str, Column]:
    """Invitation flags defaulted to FALSE when the job has no invitation rows."""
    return {
        "invitation_rejected": defaulted_flag(F.col("was_rejected")),
        "invitation_accepted": defaulted_flag(F.col("was_accepted")),
        "invitation_accepted_by": (F.when(F.col("accepted_by") == K.ACCEPTED_BY_VENDOR_RANK, F.lit(K.LABEL_VENDOR))
                                    .when(F.col("accepted_by") == K.ACCEPTED_BY_STAFF_RANK, F.lit(K.LABEL_STAFF))),
        "invitation_reminded": defaulted_flag(F.col("was_reminded")),
    }


def in_house_market() -> Column:
    """The job's market when a staff technician completed it, else NULL."""
    cond = (F.col("worker_type") == F.lit(K.WORKER_TYPE_STAFF)) & (F.col("job_status") == F.lit(K.COMPLETED_LABEL))
    return conditional_attribute(cond, F.col("market_id"))


def _final_columns() -> list[Column]:
    derived = {
        **invitation_flags(),
        "hours_to_accept_invitation": F.col("hours_to_accept"),
        "invitation_accepted_at": F.col("accepted_at"),
        "hours_to_schedule_work": elapsed_hours(F.col("accepted_at"), F.col("initial_scheduled_date")),
        "hours_to_close_work": elapsed_hours(F.col("accepted_at"), F.col("completed_at")),
        "hours_to_submit_last_invoice": elapsed_hours(F.col("completed_at"), F.col("last_invoice_created_at")),
        "job_within_30_move_in": exists_flag(F.col("within_move_in")),
        "in_house_market": in_house_market(),
    }
    return [derived[c].alias(c) if c in derived else F.col(c) for c in FACT_COLUMNS]


# -- C24: the plan -----------------------------------------------------------------------
def request_facts(r: Roles, splits: Mapping[str, Split] = {}) -> DataFrame:
    """Requests with market, area rates and move-in window: everything that follows from them."""
    located = spine_ops.located_requests(r.requests, r.properties, splits)
    rated = dimensions.requests_with_rates(located, r.rates, splits)
    return ranges.requests_with_move_in(rated, r.leases, K.SERVICE_REQUEST_TYPE, K.MOVE_IN_WINDOW_DAYS)


def job_keys(r: Roles, splits: Mapping[str, Split] = {}) -> DataFrame:
    """Live jobs with all that is looked up for them, without their own wide columns."""
    live = spine_ops.live_jobs(r.jobs, r.codes).select(
        "job_id", "service_request_id", "assigned_vendor_id", "assigned_staff_id", "created_at", "completed_by_kind")
    keyed = split_join(live, request_facts(r, splits), ["service_request_id"], left_split=splits.get("job_request", NO_SPLIT), by=["job_id"])
    staff = spine_ops.completed_by_label(F.col("completed_by_kind")) == F.lit(K.LABEL_STAFF)
    keyed = keyed.select("job_id", "service_request_id", "lease_flow_id", "market_id", "assigned_vendor_id", "assigned_staff_id",
                         ranges.moved_in(F.col("created_at")).alias("within_move_in"),
                         *[F.when(staff, F.col(c)).alias(c) for c in dimensions.RATE_COLUMNS])
    return dimensions.resolve_worker(keyed, r.vendors, r.users, splits).drop("assigned_vendor_id", "assigned_staff_id")


def job_details(jobs: DataFrame, codes: DataFrame) -> DataFrame:
    """The live jobs' own columns, as the fact shows them."""
    return spine_ops.live_jobs(jobs, codes).select(
        "job_id", "external_id", "created_at", "completed_at", "scope_of_work", "summary", "assigned_staff_id",
        spine_ops.completed_by_label(F.col("completed_by_kind")).alias("completed_by"),
        F.col("status_label").alias("job_status"), billable_hours(F.col("billable_minutes")).alias("billable_hours"))


def fact_rows(r: Roles, splits: Mapping[str, Split] = {}) -> DataFrame:
    """One row per row of the fact, ``job_id`` alone: the jobs' details with their looked-up
    keys.  The branches, one row a job by construction, can't add or remove any."""
    return job_details(r.jobs, r.codes).select("job_id").join(job_keys(r, splits).select("job_id"), on="job_id", how="inner")


def fact_references(r: Roles, splits: Mapping[str, Split] = {}, vendors: bool = True) -> DataFrame:
    """``job_id`` and the foreign keys of the fact's rows, from the jobs, their requests and (for
    ``vendor_id``, which comes from the look-up) the vendors."""
    live = spine_ops.live_jobs(r.jobs, r.codes).select("job_id", "service_request_id", "assigned_vendor_id", "assigned_staff_id")
    rows = split_join(live, r.requests.select("service_request_id"), ["service_request_id"],
                      left_split=splits.get("job_request", NO_SPLIT), by=["job_id"])
    if not vendors:
        return rows.drop("assigned_vendor_id")
    return left_lookup(rows, r.vendors.select("vendor_id"), "assigned_vendor_id", "vendor_id", "job_id",
                       split=splits.get("job_vendor", NO_SPLIT)).drop("assigned_vendor_id")


def survey_ratings(r: Roles, workers: DataFrame, splits: Mapping[str, Split] = {}) -> DataFrame:
    """The survey branch of ``workers`` (job, request, worker)."""
    ratings = survey.latest_ratings(survey.rating_rows(r.survey_questions, r.question_types, r.csat, splits))
    return survey.two_key_latest_join(workers, ratings, splits)


def line_item_key(r) -> tuple[str, ...]:
    """The columns that bridge and line items share; the test tables' unless the roles name others."""
    return getattr(r, "line_item_key", LINE_ITEM_KEY)


def tie_break(r) -> tuple[str, ...]:
    """What orders schedule rows of one creation time."""
    return getattr(r, "schedule_tie_break", rollups.SCHEDULE_TIE_BREAK)


def assemble(details: DataFrame, branches: list[DataFrame]) -> DataFrame:
    """``details`` with the job keys (first of ``branches``, INNER) and all others LEFT joined by job."""
    fact = details.join(branches[0], on="job_id", how="inner")
    for b in branches[1:]:
        fact = fact.join(b, on="job_id", how="left")
    return fact.select(*_final_columns())


def job_fact(r: Roles, live_only: bool = False, splits: Mapping[str, Split] | None = None) -> DataFrame:
    """The fact.  ``live_only=True`` semi-joins every child table to the live job keys
    before it is aggregated: worth it when the spine keeps a small share of all jobs
    (children of dead jobs are then dropped before their shuffle instead of being
    aggregated and discarded at assembly).  Both settings return the same rows.
    ``splits`` are the frequent keys (default: found by ``hotkeys.profile``)."""
    splits = hotkeys.profile(r) if splits is None else splits
    # live keys from the jobs table and its codes alone, not from the joined spine
    live_ids = spine_ops.live_jobs(r.jobs, r.codes).select("job_id")

    def live(df: DataFrame, key: str = "job_id") -> DataFrame:
        if not live_only:
            return df
        return df.join(live_ids.withColumnRenamed("job_id", key), on=key, how="left_semi")

    workers = live(r.jobs).select("job_id", "service_request_id",
                                  F.coalesce("assigned_staff_id", "assigned_vendor_id").alias("worker_id"))
    return assemble(job_details(r.jobs, r.codes), [
        job_keys(r, splits),
        rollups.response_flags(live(r.invitations), r.codes),
        rollups.fanout_counts(live(r.notes, "reference_id"), r.note_files, r.codes),
        rollups.first_schedule(live(r.scheduled_services), tie_break(r)),
        rollups.invoice_rollup(live(r.bridge), r.line_items, r.invoices, r.invoice_authors, r.codes, splits, line_item_key(r)),
        rollups.logged_hours(live(r.time_tracking, "object_id"), r.codes),
        rollups.first_status_times(live(r.approvals, "related_entity_id"), r.approvers, r.approval_history),
        survey_ratings(r, workers, splits),
    ])


def spine_with_branches(r: Roles, splits: Mapping[str, Split] = {}) -> DataFrame:
    """Spine plus the invitation branch only: the input of C22/C23's queries."""
    spine = spine_ops.job_spine(r.requests, r.jobs, r.codes, r.properties, splits)
    jobs = dimensions.resolve_worker(spine, r.vendors, r.users, splits)
    return jobs.join(rollups.response_flags(r.invitations, r.codes), on="job_id", how="left")
