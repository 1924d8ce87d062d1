"""Physical plan shape: pushdown, pruning, no cartesian products or Python, skew-safe top-1."""

import re

import pytest
from pyspark.sql import functions as F

from jobfacts.functions.codes import code_slice, decode
from jobfacts.operators import rollups
from jobfacts.operators import survey
from jobfacts.plans import checks
from jobfacts.plans.fact import job_fact
from jobfacts.registry import queries
from jobfacts.sources.roles import Roles

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def static_plans(spark):
    """Plans with AQE off: the static shape Catalyst chose."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        r = Roles(spark, SF)
        yield {"fact": _plan(job_fact(r)), "schedule": _plan(rollups.first_schedule(r.scheduled_services)),
               "users": _plan(r.users.select("staff_id")),
               "decode": _plan(decode(r.invitations, code_slice(r.codes, "jobs.InvitationStatus", "status", "n"),
                                      "status"))}
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_no_cartesian_or_nested_loop(static_plans):
    for name, plan in static_plans.items():
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


def test_no_python_in_any_registered_query(spark):
    r = queries()
    for name, q in r.items():
        plan = _plan(q(spark, SF))
        assert not re.search(r"(BatchEvalPython|ArrowEvalPython|FlatMapGroupsInPandas|MapInPandas)", plan), name


def test_column_pruning_and_filter_pushdown(static_plans):
    scans = [l for l in static_plans["users"].splitlines() if "FileScan" in l]
    assert len(scans) == 1
    assert "ReadSchema: struct<c_custkey:bigint,c_acctbal:double>" in scans[0]
    assert "GreaterThanOrEqual(c_acctbal,0.0)" in scans[0]


def test_scans_read_only_needed_columns(static_plans):
    # no scan of the wide text tables, and the fact never reads lineitem's quantity/tax
    plan = static_plans["fact"]
    assert "documents" not in plan and "pages" not in plan
    for line in plan.splitlines():
        if "lineitem.parquet" in line:
            assert "l_quantity" not in line and "l_tax" not in line


def test_code_decode_is_a_broadcast_lookup(static_plans):
    assert "BroadcastHashJoin" in static_plans["decode"]
    assert "SortMergeJoin" not in static_plans["decode"]


def test_first_per_key_limits_before_the_shuffle(static_plans):
    plan = static_plans["schedule"].splitlines()
    limits = [i for i, l in enumerate(plan) if "WindowGroupLimit" in l]
    exchange = [i for i, l in enumerate(plan) if "Exchange hashpartitioning(job_id" in l]
    assert len(limits) == 2 and exchange and limits[0] < exchange[0] < limits[1]


def test_codes_are_inline_rows(static_plans):
    assert "LocalTableScan" in static_plans["decode"] and "ExistingRDD" not in static_plans["fact"]


def test_survey_is_read_once(spark):
    """One scan of the questions; no free text in a join key or exchange."""
    r = Roles(spark, SF)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(survey.latest_flag_with_dedupe(survey.rating_rows(r.survey_questions, r.question_types, r.csat)))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(64 * 1024 * 1024))
    assert not [x for x in plan.splitlines() if "hashpartitioning" in x and "comment" in x.split("hashpartitioning", 1)[1].split(")")[0]]
    assert "ReusedExchange" in plan and plan.count("FileScan") == 2   # questions and csat


def test_foreign_keys_count_before_they_join(spark):
    """A mostly-NULL key is one counted row when it is shuffled to the join."""
    child = spark.range(0, 9000, numPartitions=6).select(F.when(F.col("id") % 3 == 0, F.col("id") % 50).alias("fk"))
    parent = spark.range(40).select(F.col("id").alias("pk"))
    row = checks.check_foreign_key(child, "fk", parent, "pk", "t").first()
    assert (row.child_rows, row.null_fk_rows) == (9000, 6000) and row.orphan_rows == child.where("fk >= 40").count()
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = _plan(checks.check_foreign_key(child, "fk", parent, "pk", "t")).splitlines()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    first = next(i for i, x in enumerate(plan) if "hashpartitioning(fk_column" in x and "value" in x)
    assert any("HashAggregate" in x and "partial_count" in x for x in plan[first:first + 4])


def test_left_lookup_spreads_null_keys(spark):
    from collections import Counter

    from pyspark.sql import functions as F

    from jobfacts.operators.lookup import left_lookup
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        left = spark.range(0, 3000).select(F.col("id").alias("job_id"),
                                           F.when(F.col("id") % 3 == 0, F.col("id") % 50).alias("k"))
        right = spark.range(-70, 50).select(F.col("id").alias("rk"), F.lit("x").alias("name"))
        j = left_lookup(left, right, "k", "rk", "job_id")
        rows = j.select("job_id", "k", "name", F.spark_partition_id().alias("p")).collect()
        assert len(rows) == 3000
        # matches exactly the non-NULL keys in range; stand-ins never match (right has negatives)
        assert all((r.name is not None) == (r.k is not None) for r in rows)
        assert max(Counter(r.p for r in rows).values()) < 3000 // 4   # NULLs (2/3 of rows) spread out
        plain = left.join(right, left["k"] == right["rk"], "left").select(F.spark_partition_id().alias("p"))
        assert max(Counter(r.p for r in plain.collect()).values()) >= 2000   # without: one partition
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(64 * 1024 * 1024))


def test_left_lookup_int_and_string_keys(spark):
    from jobfacts.operators.lookup import left_lookup
    left = spark.createDataFrame([(1, 10, "a"), (2, None, None), (3, 11, "zz"), (4, 12, "b")],
                                 "job_id long, k int, s string")
    right_i = spark.createDataFrame([(10, "x"), (12, "y")], "rk int, v string")
    right_s = spark.createDataFrame([("a", 1), ("b", 2)], "rs string, w int")
    got = {r.job_id: (r.v, r.w) for r in
           left_lookup(left_lookup(left, right_i, "k", "rk", "job_id"), right_s, "s", "rs", "job_id").collect()}
    assert got == {1: ("x", 1), 2: (None, None), 3: (None, None), 4: ("y", 2)}
    # an eligibility condition behaves like a LEFT join condition on left columns
    elig = {r.job_id: r.v for r in left_lookup(left, right_i, "k", "rk", "job_id",
                                               eligible=left["job_id"] != 4).collect()}
    assert elig == {1: "x", 2: None, 3: None, 4: None}
