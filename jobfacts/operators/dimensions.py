"""Dimension lookups on the spine: labor rates (C08) and worker resolution.

Both are LEFT lookups keyed by a dimension id, so they are expressed as joins that add
columns to the job rows instead of separate job-keyed branches that are joined back:
one join per dimension, no shuffle by job.  Dimension tables are not hinted: Spark
broadcasts them when their size estimate is under ``autoBroadcastJoinThreshold`` (AQE
re-checks with the real size) and otherwise sort-merge joins them; ``left_lookup``
spreads the NULL keys of jobs without a worker so no single partition receives them, and
splits the keys of vendors and staff who hold a large share of the jobs.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobfacts import constants as K
from jobfacts.operators.hotkeys import NO_SPLIT, Split
from jobfacts.operators.lookup import left_lookup

RATE_COLUMNS = ("maintenance_rate_amount", "first_hour_maintenance_rate_amount", "after_hours_emergency_rate")


def attach_rates(jobs: DataFrame, rates: DataFrame) -> DataFrame:
    """Area rates on jobs completed by staff; NULL rates on every other job.

    The staff condition sits inside the LEFT join condition, which gives exactly the
    job's filter-then-left-join branch joined back by job -- including its row
    multiplication if an area had several rate rows -- in a single join.  Jobs that are
    not eligible are spread like NULL keys (``left_lookup``).
    """
    r = rates.withColumnRenamed("area_id", "_rate_area")
    staff = F.col("completed_by") == F.lit(K.LABEL_STAFF)
    return left_lookup(jobs, r, "area_id", "_rate_area", "job_id", eligible=staff).drop("_rate_area")


def requests_with_rates(requests: DataFrame, rates: DataFrame, splits: Mapping[str, Split] = {}) -> DataFrame:
    """Requests with the rates of their area: looked up once per request, not once per job."""
    r = rates.withColumnRenamed("area_id", "_rate_area")
    return left_lookup(requests, r, "area_id", "_rate_area", "service_request_id",
                       split=splits.get("request_area", NO_SPLIT)).drop("_rate_area")


def labor_rates(spine: DataFrame, rates: DataFrame) -> DataFrame:
    """The rates branch on its own: one row per staff-completed job."""
    staff_jobs = spine.filter(F.col("completed_by") == F.lit(K.LABEL_STAFF)).select("job_id", "area_id")
    return staff_jobs.join(rates, on="area_id", how="left").select("job_id", *RATE_COLUMNS)


def resolve_worker(jobs: DataFrame, vendors: DataFrame, users: DataFrame, splits: Mapping[str, Split] = {}) -> DataFrame:
    """Adds ``vendor_id, is_in_house_vendor, worker_id, worker_type, worker_name``.

    Staff take precedence over vendors for id and type; the name of a staff worker
    comes from the user row even when that row is missing (NULL, no fall-through);
    an in-house vendor is named by a fixed label.
    """
    v = vendors.select(F.col("vendor_id"), F.col("name").alias("_vendor_name"),
                       F.col("is_in_house").alias("is_in_house_vendor"))
    u = users.select(F.col("staff_id").alias("_staff_id"), F.col("name").alias("_staff_name"))
    out = left_lookup(jobs, v, "assigned_vendor_id", "vendor_id", "job_id", split=splits.get("job_vendor", NO_SPLIT))
    out = left_lookup(out, u, "assigned_staff_id", "_staff_id", "job_id", split=splits.get("job_staff", NO_SPLIT))
    staff = F.col("assigned_staff_id").isNotNull()
    vendor = F.col("assigned_vendor_id").isNotNull()
    return (out
            .withColumn("worker_id", F.coalesce(F.col("assigned_staff_id"), F.col("assigned_vendor_id")))
            .withColumn("worker_type", F.when(staff, F.lit(K.WORKER_TYPE_STAFF))
                                        .when(vendor, F.lit(K.WORKER_TYPE_VENDOR)))
            .withColumn("worker_name", F.when(staff, F.col("_staff_name"))
                                        .when(F.col("is_in_house_vendor") == F.lit(True), F.lit(K.IN_HOUSE_WORKER_NAME))
                                        .when(vendor, F.col("_vendor_name")))
            .drop("_vendor_name", "_staff_id", "_staff_name"))


def worker_branch(spine: DataFrame, vendors: DataFrame, users: DataFrame, splits: Mapping[str, Split] = {}) -> DataFrame:
    """The worker branch on its own, one row per job (C09); only the keys of the spine travel."""
    narrow = spine.select("job_id", "service_request_id", "assigned_vendor_id", "assigned_staff_id")
    w = resolve_worker(narrow, vendors, users, splits)
    return w.select("job_id", "service_request_id", "vendor_id", "is_in_house_vendor",
                    "worker_id", "worker_type", "worker_name")
