"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is built (roles read, plan constructed) and executed in full with the
``noop`` sink (every row is computed, nothing is collected to the driver).  After $BENCH_WARMUP untimed runs of the flagship (JVM
warm-up), one untimed run per query, then the median of $BENCH_REPEAT timed runs.
Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from jobfacts.registry import queries  # noqa: E402
from jobfacts.session import local_session  # noqa: E402

HEADLINE = (
    "job_fact",            # the flagship: 55-column fact, set-based plan
    "job_fact_live_only",  # same result, children semi-joined to live jobs first
    "job_spine",
    "response_flags",
    "fanout_counts",
    "first_per_key",
    "distinct_then_count",
    "latest_flag_with_dedupe",
    "within_days_of",
    "check_primary_key",
)


def _sf(sf_dir: str):
    m = re.search(r"sf([0-9.]+)", sf_dir)
    return float(m.group(1)) if m else None


def run_once(build) -> float:
    """Wall time of building the query's DataFrame (role reads, plan construction)
    plus running it to completion."""
    t0 = time.perf_counter()
    build().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def plan_stats(spark, df) -> dict:
    """Shape of the static plan (AQE off): shuffles, joins and scans Catalyst chose."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return {"exchanges": len(re.findall(r"Exchange hashpartitioning", plan)),
            "sort_merge_joins": plan.count("SortMergeJoin"),
            "broadcast_joins": plan.count("BroadcastHashJoin"),
            "file_scans": plan.count("FileScan"),
            "python_udfs": len(re.findall(r"(BatchEvalPython|ArrowEvalPython)", plan))}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8, app="jobfacts-bench")
    qs = queries()
    # JVM warm-up (class loading, JIT of codegen paths) before anything is timed
    for _ in range(int(os.environ.get("BENCH_WARMUP", "2"))):
        run_once(lambda: qs["job_fact"](spark, sf_dir))
    times = {}
    for name in names:
        build = lambda q=qs[name]: q(spark, sf_dir)
        run_once(build)  # warm-up: JIT, file listing, broadcast of code slices
        samples = [run_once(build) for _ in range(repeat)]
        times[name] = round(statistics.median(samples), 3)
    # the plan as chosen at this size, and as for large inputs, where only code slices (a few
    # inline rows) fit under the broadcast threshold
    plans = {}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    for n in ("job_fact", "job_fact_live_only", "distinct_then_count", "check_foreign_key"):
        plans[n] = plan_stats(spark, qs[n](spark, sf_dir))
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1024")
        plans[f"{n}, large inputs"] = plan_stats(spark, qs[n](spark, sf_dir))
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(64 * 1024 * 1024))
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    print(json.dumps({
        "metric": "job_fact_sec",
        "value": times.get("job_fact"),
        "unit": "sec",
        "queries": times,
        "total_sec": round(sum(times.values()), 3),
        "sf": _sf(sf_dir),
        "cpus": cpus,
        "repeat": repeat,
        "plans": plans,
    }))


if __name__ == "__main__":
    main()
