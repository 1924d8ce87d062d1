"""Task balance of the fact plans on skewed data, from Spark's event log.

Usage: python tools/skew_report.py [sf_dir] [query] [skewed|normal] [--static | --small-split]

Runs the query (after a warm-up) with the event log written to a fresh scratch folder,
32 shuffle partitions and no partition coalescing, then prints, for every stage that
read at least 10,000 shuffled records, the share of them read by its largest task.  On ``SkewedRoles`` one key holds a third
of every child table; a plan that shuffled raw rows by that key would show one task
with >= 1/3 of a stage's records after the shuffle.
"""

from __future__ import annotations

import collections
import glob
import io
import json
import os
import sys
import tempfile
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from pyspark.sql import SparkSession  # noqa: E402

from jobfacts.plans.fact import job_fact  # noqa: E402
from jobfacts.session import configure  # noqa: E402
from jobfacts.sources.roles import Roles  # noqa: E402
from tests.skewed import SkewedRoles  # noqa: E402

PLANS = {"job_fact": job_fact}


def _events(run_dir: str):
    import zstandard
    for path in glob.glob(os.path.join(run_dir, "*", "*")) + glob.glob(os.path.join(run_dir, "*")):
        if os.path.isdir(path) or os.path.basename(path).startswith((".", "appstatus")):
            continue
        raw = open(path, "rb")
        stream = zstandard.ZstdDecompressor().stream_reader(raw) if path.endswith(".zstd") else raw
        for line in io.TextIOWrapper(stream, encoding="utf-8"):
            yield json.loads(line)


def main(sf_dir: str, query: str, mode: str, static: bool = False, small_split: bool = False) -> None:
    run_dir = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    builder = (SparkSession.builder.master("local[8]").appName("skew-report").config("spark.driver.memory", "8g")
               .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", run_dir))
    # many post-shuffle partitions and no coalescing: a hot key that is shuffled raw
    # shows up as one task reading a third of a stage's shuffle records
    spark = configure(builder, 32).getOrCreate()
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    if small_split:
        # AQE on, no broadcasts, skew thresholds scaled down to test-data size (the
        # defaults, 256 MB and 5x the median, are for cluster-size partitions)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", str(256 * 1024))
        spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "2")
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(256 * 1024))
    if static:
        # the plan's own partitioning: no runtime re-planning, and no broadcasts but of the
        # code slices (inline rows), so every other join is a real hash shuffle (what a large
        # cluster runs for big inputs)
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1024")
    spark.sparkContext.setLogLevel("ERROR")
    if mode == "skewed":
        def roles_cls(sp, d):
            return SkewedRoles(sp, d, map_tasks=32 if small_split else 0)
    else:
        roles_cls = Roles
    plan = PLANS[query]
    plan(roles_cls(spark, sf_dir)).write.format("noop").mode("overwrite").save()   # warm-up
    spark.sparkContext.setJobGroup("measured", "measured run")
    t0 = time.time()
    plan(roles_cls(spark, sf_dir)).write.format("noop").mode("overwrite").save()
    elapsed = time.time() - t0
    spark.stop()

    per_stage = collections.defaultdict(list)
    measured_jobs, stage_job = set(), {}
    for e in _events(run_dir):
        ev = e.get("Event")
        if ev == "SparkListenerJobStart":
            if (e.get("Properties") or {}).get("spark.jobGroup.id") == "measured":
                measured_jobs.add(e["Job ID"])
            for s in e.get("Stage IDs", []):
                stage_job[s] = e["Job ID"]
        elif ev == "SparkListenerTaskEnd":
            m = e.get("Task Metrics") or {}
            recs = (m.get("Shuffle Read Metrics") or {}).get("Total Records Read", 0)
            per_stage[e["Stage ID"]].append(recs)
    worst = []
    for sid, recs in per_stage.items():
        if stage_job.get(sid) not in measured_jobs or sum(recs) < 10_000:
            continue
        worst.append((max(recs) / sum(recs), sid, len(recs), sum(recs), max(recs)))
    worst.sort(reverse=True)
    print(json.dumps({"query": query, "mode": mode, "static": static, "small_split": small_split, "sf_dir": sf_dir, "sec": round(elapsed, 2),
                      "stages": len(worst), "event_log": run_dir}))
    for share, sid, n, total, top in worst[:8]:
        print(f"  stage {sid:4d} tasks {n:3d} records {total:9d} largest task {top:8d} ({share:.0%})")


if __name__ == "__main__":
    args = sys.argv[1:]
    main(args[0] if args else "/root/testdata/sf0.1", args[1] if len(args) > 1 else "job_fact",
         args[2] if len(args) > 2 else "skewed", static="--static" in args,
         small_split="--small-split" in args)
