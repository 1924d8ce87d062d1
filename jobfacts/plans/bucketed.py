"""Co-partitioned assembly: what the fact joins by job, written once bucketed by job.

``prepare`` writes every job-keyed input of the fact -- the jobs' own columns, their looked-up
keys, and the rows of each child table after the decodes and look-ups that need another
key -- as tables with the same number of buckets on ``job_id``.  ``bucketed_fact`` aggregates and
joins them: all of its groupings and its ten joins run inside the buckets, with no exchange at all
(``tests/test_bucketed.py`` holds the plan to that).

The tables are a stage of a refresh (lineage ends there, a lost executor re-reads a bucket)
and can also be kept between refreshes: ``prepare(only=[...])`` rewrites those whose sources changed.
A table is written to a new folder and swapped in by its manifest, one line per table, so a
run that fails leaves the last set as it was.

Skew: a bucket holds all rows of its jobs, so child rows are reduced before they are written
where their aggregate allows it (one row per job, or per job and invoice); a job with a third of
all rows is one row a table.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobfacts.operators import hotkeys, rollups
from jobfacts.operators.hotkeys import Split
from jobfacts.plans import fact
from jobfacts.plans.files import read_text, replace_file

MANIFEST = "tables.json"


def _workers(r) -> DataFrame:
    return r.jobs.select("job_id", "service_request_id", F.coalesce("assigned_staff_id", "assigned_vendor_id").alias("worker_id"))


#: table -> (rows by job_id from the roles and splits, the branch made of them inside a bucket)
_TABLES: dict[str, tuple[Callable[..., DataFrame], Callable[[DataFrame], DataFrame]]] = {
    "details": (lambda r, s: fact.job_details(r.jobs, r.codes), lambda d: d),
    "keys": (lambda r, s: fact.job_keys(r, s), lambda d: d),
    "responses": (lambda r, s: rollups.response_flags(r.invitations, r.codes), lambda d: d),
    "notes": (lambda r, s: rollups.fanout_counts(r.notes, r.note_files, r.codes), lambda d: d),
    "schedules": (lambda r, s: rollups.first_schedule(r.scheduled_services, fact.tie_break(r)), lambda d: d),
    # one row per (job, invoice): the hot invoice was split before, the rest adds up in the bucket
    "invoices": (lambda r, s: rollups.items_per_invoice(rollups.job_line_items(
        r.bridge, r.line_items, r.invoices, r.invoice_authors, r.codes, s, fact.line_item_key(r))), lambda d: rollups.totals_per_job(d)),
    "hours": (lambda r, s: rollups.logged_hours(r.time_tracking, r.codes), lambda d: d),
    "approvals": (lambda r, s: rollups.job_approvals(r.approvals, r.approvers, r.approval_history), lambda d: rollups.status_times_per_job(d)),
    "ratings": (lambda r, s: fact.survey_ratings(r, _workers(r), s), lambda d: d),
}
TABLES = tuple(_TABLES)


def _register(spark: SparkSession, name: str, folder: str, schema: str, buckets: int) -> str:
    """A catalogue entry over a written bucketed folder; its name is the folder's."""
    table = f"jobfacts_{name}_{folder.rsplit('-', 1)[-1]}"
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({schema}) USING parquet CLUSTERED BY (job_id) SORTED BY (job_id) "
              f"INTO {buckets} BUCKETS LOCATION '{folder}'")
    return table


def prepare(r, path: str, buckets: int, only: Sequence[str] | None = None, splits: Mapping[str, Split] | None = None) -> None:
    """Writes the tables (``only`` some of them) below ``path`` and swaps them in."""
    spark = r.spark if hasattr(r, "spark") else r.jobs.sparkSession
    if unknown := set(only or ()) - set(TABLES):
        raise ValueError(f"no such tables: {sorted(unknown)}")
    manifest = _manifest(spark, path) if only else {}
    if manifest and {m["buckets"] for m in manifest.values()} != {buckets}:
        raise ValueError("all tables have the same number of buckets")
    splits = hotkeys.profile(r) if splits is None else splits
    for name in only or TABLES:
        rows = _TABLES[name][0](r, splits)
        folder = f"{path}/{name}-{uuid.uuid4().hex}"
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
        # rows of a bucket come together first, so a bucket is one file, not one per task
        (rows.repartition(buckets, "job_id").write.format("parquet").bucketBy(buckets, "job_id").sortBy("job_id")
         .option("path", folder).saveAsTable(f"jobfacts_{name}_{folder.rsplit('-', 1)[-1]}"))
        manifest[name] = {"folder": folder, "schema": schema, "buckets": buckets}
    replace_file(spark, f"{path}/{MANIFEST}", json.dumps(manifest))


def _manifest(spark: SparkSession, path: str) -> dict[str, dict]:
    text = read_text(spark, f"{path}/{MANIFEST}")
    return json.loads(text) if text else {}


def tables(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """The tables as last swapped in, by name; also in a session that did not write them."""
    found = _manifest(spark, path)
    if missing := set(TABLES) - set(found):
        raise ValueError(f"not prepared: {sorted(missing)}")
    return {n: spark.table(_register(spark, n, m["folder"], m["schema"], m["buckets"])) for n, m in found.items()}


def bucketed_fact(spark: SparkSession, path: str) -> DataFrame:
    """The fact from the prepared tables: the same rows as ``fact.job_fact``."""
    t = tables(spark, path)
    branches = {n: _TABLES[n][1](df) for n, df in t.items()}
    return fact.assemble(branches.pop("details"), [branches.pop("keys"), *branches.values()])
