"""The job spine (C04): live jobs with decoded status, one row per job.

Plan shape: jobs are decoded against two broadcast code slices and filtered *before*
the shuffle that joins them to their requests, so cancelled jobs never cross the
network; the property is looked up for the requests, which are fewer and narrower than
the jobs, with NULL asset keys spread over all partitions (``operators.lookup``).  Requests
with a large share of all jobs are split (``operators.hotkeys``).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobfacts import constants as K
from jobfacts.functions.codes import code_slice, decode, label_normalize
from jobfacts.functions.timeops import billable_hours, to_local_time
from jobfacts.operators.hotkeys import NO_SPLIT, Split, split_join
from jobfacts.operators.lookup import left_lookup


def local_jobs(jobs: DataFrame) -> DataFrame:
    """Jobs with creation and completion times on the local clock."""
    return (jobs.withColumn("created_at", to_local_time(F.col("created_at")))
                .withColumn("completed_at", to_local_time(F.col("completed_at"))))


def completed_by_label(kind):
    return (F.when(kind == K.KIND_STAFF, F.lit(K.LABEL_STAFF))
             .when(kind == K.KIND_VENDOR, F.lit(K.LABEL_VENDOR)))


def live_jobs(jobs: DataFrame, codes: DataFrame) -> DataFrame:
    """Jobs whose status decodes (INNER) to a name outside the excluded set.

    The exclusion compares the raw code name; a NULL name is dropped as well.
    """
    # labelled once per code, not once per job
    status = code_slice(codes, K.NS_JOB_STATUS, "status", "status_name").withColumn("status_label", label_normalize(F.col("status_name")))
    completer = code_slice(codes, K.NS_COMPLETED_BY, "completed_by_type", "completed_by_kind")
    live = decode(local_jobs(jobs), status, "status", how="inner")
    live = live.filter(~F.col("status_name").isin(*K.EXCLUDED_JOB_STATUSES))
    return decode(live, completer, "completed_by_type", how="left")


def located_requests(requests: DataFrame, properties: DataFrame, splits: Mapping[str, Split] = {}) -> DataFrame:
    """Requests with the market of their property."""
    props = properties.withColumnRenamed("asset_id", "_asset")
    return left_lookup(requests, props, "asset_id", "_asset", "service_request_id",
                       split=splits.get("request_asset", NO_SPLIT)).drop("_asset")


def job_spine(requests: DataFrame, jobs: DataFrame, codes: DataFrame, properties: DataFrame,
              splits: Mapping[str, Split] = {}) -> DataFrame:
    located = located_requests(requests, properties, splits)
    spine = split_join(live_jobs(jobs, codes), located, ["service_request_id"],
                       left_split=splits.get("job_request", NO_SPLIT), by=["job_id"])
    return spine.select(
        "job_id", "external_id", "created_at", "completed_at", "scope_of_work", "summary",
        "service_request_id", "lease_flow_id", "request_type", "assigned_vendor_id",
        "assigned_staff_id", "area_id", "market_id",
        completed_by_label(F.col("completed_by_kind")).alias("completed_by"),
        F.col("status_label").alias("job_status"),
        billable_hours(F.col("billable_minutes")).alias("billable_hours"),
    )
