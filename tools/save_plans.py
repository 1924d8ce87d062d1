"""Save the static physical plans of the headline queries to docs/plans/.

Usage: python tools/save_plans.py [sf_dir]   (AQE off: the shape Catalyst chose)
"""

from __future__ import annotations

import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from jobfacts.registry import queries  # noqa: E402
from jobfacts.session import local_session  # noqa: E402

OUT = os.path.join(ROOT, "docs", "plans")
NAMES = ("job_fact", "job_spine", "response_flags", "fanout_counts", "first_per_key",
         "distinct_then_count", "latest_flag_with_dedupe", "within_days_of")


def main(sf_dir: str) -> None:
    spark = local_session(8, 8)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    os.makedirs(OUT, exist_ok=True)
    for name in NAMES:
        plan = queries()[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        plan = re.sub(r"#\d+L?", "", plan)
        plan = re.sub(r"Location: InMemoryFileIndex\(1 paths\)\[file:[^\]]*/([a-z]+\.parquet)\]", r"Location: \1", plan)
        plan = re.sub(r"\[plan_id=\d+\]", "", plan)
        header = f"# {name}: static physical plan (AQE off, {sf_dir}, local[8], 8 shuffle partitions)\n\n"
        with open(os.path.join(OUT, f"{name}.txt"), "w") as fh:
            fh.write(header + plan)


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1")
