"""The co-partitioned assembly: same rows as the fact, no exchange in its plan."""

from collections import Counter

import pytest

from jobfacts.plans import bucketed
from jobfacts.plans.fact import job_fact
from jobfacts.sources.roles import Roles
from tests import oracle_roles
from tests.skewed import SkewedRoles

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def prepared(spark, tmp_path_factory):
    path = f"{tmp_path_factory.mktemp('bucketed')}/skewed"
    bucketed.prepare(SkewedRoles(spark, SF), path, 4)
    return path


def test_same_rows_as_the_oracle_under_skew(spark, prepared):
    got = bucketed.bucketed_fact(spark, prepared)
    assert Counter(map(tuple, got.collect())) == oracle_roles.facts(SkewedRoles(spark, SF))
    assert got.columns == job_fact(Roles(spark, SF)).columns


def test_no_exchange(spark, prepared):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = bucketed.bucketed_fact(spark, prepared)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(64 * 1024 * 1024))
    assert "Exchange" not in plan
    assert plan.count("SortMergeJoin") == len(bucketed.TABLES) - 1 and plan.count("Bucketed: true") == len(bucketed.TABLES)


def test_one_table_can_be_rewritten(spark, prepared):
    before = bucketed._manifest(spark, prepared)
    bucketed.prepare(SkewedRoles(spark, SF), prepared, 4, only=["hours"])
    after = bucketed._manifest(spark, prepared)
    assert {n for n in after if after[n] != before[n]} == {"hours"}
    assert bucketed.bucketed_fact(spark, prepared).count() == job_fact(SkewedRoles(spark, SF)).count()
    with pytest.raises(ValueError, match="same number"):
        bucketed.prepare(SkewedRoles(spark, SF), prepared, 8, only=["hours"])
    with pytest.raises(ValueError, match="no such"):
        bucketed.prepare(SkewedRoles(spark, SF), prepared, 4, only=["hour"])


def test_another_session_finds_the_tables(spark, prepared):
    other = spark.newSession()
    for t in list(bucketed.tables(spark, prepared)):
        other.sql(f"DROP TABLE IF EXISTS jobfacts_{t}_{bucketed._manifest(spark, prepared)[t]['folder'].rsplit('-', 1)[-1]}")
    assert bucketed.bucketed_fact(other, prepared).count() == job_fact(SkewedRoles(spark, SF)).count()
    with pytest.raises(ValueError, match="not prepared"):
        bucketed.tables(spark, prepared + "-none")
