"""Properties of the fact: grain, order independence, cancelled jobs, equivalent plans."""

from collections import Counter

from pyspark.sql import functions as F

from jobfacts.operators.spine import job_spine
from jobfacts.plans.fact import job_fact
from jobfacts.sources.roles import Roles
from tests import oracle_roles

SF = "/root/testdata/sf0.001"


def _same(a, b):
    """Same multiset of rows (each side executed once; fixture-sized results)."""
    return a.columns == b.columns and Counter(map(tuple, a.collect())) == Counter(map(tuple, b.collect()))


def test_fact_grain_equals_spine(spark):
    r = Roles(spark, SF)
    ids = [x.job_id for x in job_fact(r).select("job_id").collect()]
    assert len(ids) == len(set(ids)) == job_spine(r.requests, r.jobs, r.codes, r.properties).count()


def test_fact_equals_oracle(spark):
    r = Roles(spark, SF)
    assert Counter(map(tuple, job_fact(r).collect())) == oracle_roles.facts(r)


class _Permuted(Roles):
    """Every child table delivered in a different physical order and partitioning."""

    def table(self, name):
        df = super().table(name)
        return df.repartition(7).sortWithinPartitions(F.rand(seed=3))


def test_input_order_does_not_matter(spark):
    assert _same(job_fact(Roles(spark, SF)), job_fact(_Permuted(spark, SF)))


class _ExtraCancelled(Roles):
    """Adds cancelled jobs (with child rows) that must not change the fact."""

    @property
    def jobs(self):
        base = super().jobs
        extra = base.withColumn("job_id", F.col("job_id") + 10_000_000).withColumn("status", F.lit(80))
        return base.unionByName(extra)


def test_cancelled_jobs_change_nothing(spark):
    assert _same(job_fact(Roles(spark, SF)), job_fact(_ExtraCancelled(spark, SF)))


def test_live_only_prefilter_changes_nothing(spark):
    r = Roles(spark, SF)
    assert _same(job_fact(r), job_fact(r, live_only=True))
