"""Correctness with one key holding a third of the rows (SkewedRoles)."""

from collections import Counter

from pyspark.sql import functions as F

from jobfacts.plans.fact import job_fact
from tests import oracle_roles
from tests.skewed import HOT_JOB, SkewedRoles

SF = "/root/testdata/sf0.001"


def test_skewed_data_is_skewed(spark):
    r = SkewedRoles(spark, SF)
    inv = r.invitations
    assert inv.filter(F.col("job_id") == HOT_JOB).count() * 3 >= inv.count() * 0.9


def test_fact_equals_oracle_under_skew(spark):
    r = SkewedRoles(spark, SF)
    a = job_fact(r).collect()
    assert len(a) == len({x.job_id for x in a})
    assert Counter(map(tuple, a)) == oracle_roles.facts(r)
    hot = [x for x in a if x.job_id == HOT_JOB][0]
    # the hot job carries a third of all line items: by far the largest amount
    assert hot.invoice_amount == max(x.invoice_amount for x in a if x.invoice_amount is not None)
    assert hot.invitation_accepted
