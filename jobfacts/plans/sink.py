"""Materialising the fact (C27): a full refresh that never leaves a reader without a table.

One refresh is one *epoch* of the table's folder:

1. **Fence.** The refresh creates the lease file of the next epoch.  Creating is atomic, so of two
   writers one gets it; the other sees a running lease and stops.  A lease that ran out is passed over
   by taking the next epoch.
2. **Dimensions.** Keys of everything that is looked up must be unique.
3. **Write.** The fact goes to a run folder of its own, bucketed by job; rows and NULL keys are
   counted on the way (``DataFrame.observe``), not by another pass.
4. **Gate.** The run is read once: jobs that repeat are found inside their buckets, without a
   shuffle, and foreign key values are counted and looked up.  Orphan values are kept
   beside the run.  A repeated or NULL key, or more orphans than a key's tolerance, ends the refresh.
5. **Publish.** The epoch's pointer file is created; readers follow the highest one.  A writer whose
   lease was passed over does not publish, and were it to slip through, its lower epoch would never hide
   a later table.
6. **Retention.** Runs but the last few published ones go, with the remains of failed runs.

A run that fails anywhere leaves the published table as it was.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from jobfacts.plans import checks, files

#: share of all rows that may be orphans, by foreign key; staff without a user row are known to
#: occur and only reported
TOLERANCE = {"service_request_id": 0.0, "vendor_id": 0.0, "assigned_staff_id": 1.0}
LEASE_SECONDS = 4 * 3600
KEEP_RUNS = 3


class KeyViolation(ValueError):
    """A key that must be unique repeats, or too many rows refer to nothing; nothing was published."""


class RefreshRunning(RuntimeError):
    """Another refresh holds the lease."""


class Fenced(RuntimeError):
    """The lease ran out and another refresh passed over it; nothing was published."""


class Refresh(NamedTuple):
    primary_key: DataFrame
    foreign_keys: DataFrame
    run: str


def write_fact(fact: DataFrame, path: str, partition_by: Sequence[str] = (),
               max_records_per_file: int | None = None) -> None:
    """Writes to a new folder; an existing one is an error, never overwritten."""
    writer = fact.write.mode("errorifexists").format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", str(max_records_per_file))
    writer.save(path)


# -- leases and pointers: files that are created once and never changed --------------------
def _name(epoch: int) -> str:
    return f"{epoch:012d}"


def _epochs(spark: SparkSession, folder: str) -> list[int]:
    return sorted(int(n) for n, _ in files.children(spark, folder) if n.isdigit())


def acquire(spark: SparkSession, path: str, seconds: float = LEASE_SECONDS) -> int:
    """The epoch of a new lease."""
    folder = f"{path}/leases"
    taken = _epochs(spark, folder)
    last = taken[-1] if taken else 0
    if last and files.read_text(spark, f"{folder}/{_name(last)}.done") is None:
        held = json.loads(files.read_text(spark, f"{folder}/{_name(last)}") or "{}")
        if held.get("until", 0) > time.time():
            raise RefreshRunning(f"epoch {last} of {path} runs until {held['until']:.0f}")
    mine = json.dumps({"until": time.time() + seconds, "by": uuid.uuid4().hex})
    if not files.create_new(spark, f"{folder}/{_name(last + 1)}", mine):
        raise RefreshRunning(f"epoch {last + 1} of {path} was taken by another refresh")
    return last + 1


def release(spark: SparkSession, path: str, epoch: int) -> None:
    files.create_new(spark, f"{path}/leases/{_name(epoch)}.done", "")


def _publish(spark: SparkSession, path: str, epoch: int, run: str) -> None:
    if _epochs(spark, f"{path}/leases")[-1] != epoch:
        raise Fenced(f"epoch {epoch} of {path} was passed over")
    if not files.create_new(spark, f"{path}/published/{_name(epoch)}", run):
        raise Fenced(f"epoch {epoch} of {path} is published already")


def published_runs(spark: SparkSession, path: str) -> list[str]:
    """Folders of the published runs that still exist, oldest first."""
    there = {n for n, _ in files.children(spark, path)}
    runs = [files.read_text(spark, f"{path}/published/{_name(e)}") for e in _epochs(spark, f"{path}/published")]
    return [r for r in runs if r in there]


def read_fact(spark: SparkSession, path: str) -> DataFrame:
    """The table as last published."""
    runs = published_runs(spark, path)
    if not runs:
        raise ValueError(f"nothing is published in {path}")
    return spark.read.parquet(f"{path}/{runs[-1]}")


def remove_old_runs(spark: SparkSession, path: str, keep: int = KEEP_RUNS) -> list[str]:
    """Deletes the runs of epochs before the last published one, but for the last ``keep``
    published; returns their names.  Runs of that epoch or later may be in use or in the making."""
    runs = published_runs(spark, path)
    if not runs:
        return []
    kept, newest = set(runs[-max(keep, 1):]), int(runs[-1].split("-")[1])
    old = [n for n, _ in files.children(spark, path)
           if n.startswith(("run-", "orphans-")) and int(n.split("-")[1]) < newest and n.replace("orphans-", "run-", 1) not in kept]
    for name in old:
        files.delete(spark, f"{path}/{name}")
        if name.startswith("run-"):
            spark.sql(f"DROP TABLE IF EXISTS {_table(name)}")
    return sorted(old)


# -- one refresh -------------------------------------------------------------------------
def _table(run: str) -> str:
    return "jobfacts_" + run.replace("-", "_")


def _write_counted(fact: DataFrame, path: str, run: str, buckets: int, keys: Sequence[str]) -> dict[str, int]:
    """Writes the run, bucketed by job; rows and NULLs of ``keys`` are counted while it is written.

    The fact's last joins leave it partitioned by job in ``spark.sql.shuffle.partitions`` parts;
    with as many buckets each part is written to one of them without another shuffle."""
    seen = Observation()
    counted = fact.observe(seen, F.count(F.lit(1)).alias("rows"), *[F.count_if(F.col(k).isNull()).alias(k) for k in keys])
    (counted.write.format("parquet").bucketBy(buckets, "job_id").sortBy("job_id").option("path", f"{path}/{run}").saveAsTable(_table(run)))
    return seen.get


def gate(written: DataFrame, foreign: Sequence[tuple[str, DataFrame, str]], orphans_path: str) -> tuple[dict[str, int], dict[str, int]]:
    """(duplicate_keys and duplicate_rows of the job, orphan rows by foreign key), from one read
    of the run.  Orphan values (fk_column, value, n) are written to ``orphans_path``.

    The duplicates are counted in front of a shuffle, whose tasks count again if an executor is
    lost: then their number may be too high, but is never 0 for a table that has some or above 0
    for one that has none.  Orphans are counted by the writing tasks, once."""
    job = F.col("job_id")
    numbered = written.select("job_id", *[fk for fk, _, _ in foreign], F.count(F.lit(1)).over(Window.partitionBy("job_id")).alias("_n"),
                              F.row_number().over(Window.partitionBy("job_id").orderBy("job_id")).alias("_i"))
    again = job.isNotNull() & (F.col("_n") > 1)
    repeats, orphans = Observation(), Observation()
    seen = numbered.observe(repeats, F.count_if(again & (F.col("_i") == 1)).alias("duplicate_keys"), F.count_if(again).alias("duplicate_rows"))
    values = checks.foreign_key_values(seen, foreign).where("value IS NOT NULL AND known IS NULL").drop("known")
    values = values.observe(orphans, *[F.coalesce(F.sum(F.when(F.col("fk_column") == fk, F.col("n"))), F.lit(0)).alias(fk) for fk, _, _ in foreign])
    values.write.parquet(orphans_path)
    return repeats.get, orphans.get


def refresh_fact(roles, path: str, tolerance: Mapping[str, float] = TOLERANCE, keep_runs: int = KEEP_RUNS,
                 lease_seconds: float = LEASE_SECONDS) -> Refresh:
    """One refresh; returns the key summaries of the published table (one row for the primary
    key, one for each foreign key) and the run's folder.  ``tolerance`` is the share of rows that may
    be orphans by foreign key; a key it doesn't name allows none."""
    from jobfacts.plans.fact import job_fact

    spark = roles.spark if hasattr(roles, "spark") else roles.jobs.sparkSession
    epoch = acquire(spark, path, lease_seconds)
    try:
        if repeated := checks.duplicated_dimensions(roles):
            raise KeyViolation(f"repeated keys in {', '.join(repeated)}")
        run = f"run-{_name(epoch)}-{uuid.uuid4().hex}"
        foreign = checks.fact_foreign_keys(roles.requests, roles.vendors, roles.users)
        columns = [fk for fk, _, _ in foreign]
        buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        counts = _write_counted(job_fact(roles), path, run, buckets, ["job_id", *columns])
        repeats, orphans = gate(spark.table(_table(run)), foreign, f"{path}/{run.replace('run-', 'orphans-', 1)}")
        if repeats["duplicate_keys"] or counts["job_id"]:
            raise KeyViolation(f"job_fact: {repeats['duplicate_keys']} repeated and {counts['job_id']} NULL keys")
        if over := [f"{fk} {orphans[fk]} of {counts['rows']}" for fk in columns if orphans[fk] > tolerance.get(fk, 0.0) * counts["rows"]]:
            raise KeyViolation(f"job_fact: rows that refer to nothing: {', '.join(over)}")
        _publish(spark, path, epoch, run)
    finally:
        release(spark, path, epoch)
    remove_old_runs(spark, path, keep_runs)
    primary = spark.createDataFrame([("job_fact", "job_id", counts["rows"], counts["job_id"], repeats["duplicate_keys"], repeats["duplicate_rows"])],
                                    checks.PRIMARY_SUMMARY)
    rows = [("job_fact", fk, pk, counts["rows"], counts[fk], orphans[fk]) for fk, _, pk in foreign]
    return Refresh(primary, spark.createDataFrame(rows, checks.FOREIGN_SUMMARY), run)
