"""Sink (C27) and key checks (C25, C26) with planted violations."""


import pytest
from pyspark.sql import functions as F

from jobfacts.plans import checks, sink
from jobfacts.plans.fact import job_fact
from jobfacts.sources.roles import Roles

SF = "/root/testdata/sf0.001"


def test_write_and_check_fact(spark, tmp_path):
    r = Roles(spark, SF)
    fact = job_fact(r)
    path = str(tmp_path / "job_fact")
    sink.write_fact(fact, path)
    written = spark.read.parquet(path)
    assert written.count() == fact.count()
    assert [(f.name, f.dataType) for f in written.schema] == [(f.name, f.dataType) for f in fact.schema]
    pk = checks.check_primary_key(written, ["job_id"], "job_fact").collect()[0]
    assert (pk.null_key_rows, pk.duplicate_keys, pk.duplicate_rows) == (0, 0, 0)
    assert pk.total_rows == written.count()
    # an existing folder is never overwritten
    with pytest.raises(Exception, match="exist"):
        sink.write_fact(fact, path)


def test_primary_key_planted_violations(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d"), (3, "e")], "k long, v string")
    s = checks.check_primary_key(df, ["k"], "t").collect()[0]
    assert (s.total_rows, s.null_key_rows, s.duplicate_keys, s.duplicate_rows) == (5, 1, 1, 2)
    bad = sorted(r.v for r in checks.primary_key_violations(df, ["k"]).collect())
    assert bad == ["a", "b", "d"]


def test_primary_key_clean_and_empty_tables_report_a_row(spark):
    empty = spark.createDataFrame([], "k long")
    s = checks.check_primary_key(empty, ["k"], "e").collect()
    assert len(s) == 1 and s[0].total_rows == 0 and s[0].duplicate_keys == 0


def test_foreign_key_planted_violations(spark):
    child = spark.createDataFrame([(1,), (2,), (None,), (9,), (9,)], "fk long")
    parent = spark.createDataFrame([(1,), (1,), (2,)], "pk long")      # duplicated parent key
    s = checks.check_foreign_key(child, "fk", parent, "pk", "c").collect()[0]
    assert (s.child_rows, s.null_fk_rows, s.orphan_rows) == (5, 1, 2)
    assert sorted(r.fk for r in checks.foreign_key_violations(child, "fk", parent, "pk").collect()) == [9, 9]


def test_fact_foreign_keys_on_testdata(spark):
    r = Roles(spark, SF)
    rows = {x.fk_column: x for x in checks.fact_key_checks(job_fact(r), r.requests, r.vendors, r.users).collect()}
    assert rows["service_request_id"].orphan_rows == 0
    # staff ids of customers with a negative balance have no user row by construction
    assert rows["assigned_staff_id"].orphan_rows > 0
    assert rows["vendor_id"].orphan_rows == 0            # vendor_id comes from the lookup itself


def test_refresh_publishes_a_checked_table(spark, tmp_path):
    r = Roles(spark, SF)
    path = str(tmp_path / "refresh")
    done = sink.refresh_fact(r, path)
    written = sink.read_fact(spark, path)
    pk = done.primary_key.first()
    assert pk.total_rows == written.count() == job_fact(r).count() and pk.duplicate_keys == 0 and pk.null_key_rows == 0
    assert {x.fk_column: x.orphan_rows > 0 for x in done.foreign_keys.collect()} == {
        "service_request_id": False, "vendor_id": False, "assigned_staff_id": True}
    first = written.inputFiles()
    sink.refresh_fact(r, path)
    assert set(sink.read_fact(spark, path).inputFiles()).isdisjoint(first)


class _Failing(Roles):
    @property
    def leases(self):
        return super().leases.withColumn("move_in_date", F.raise_error(F.lit("planted failure")).cast("date"))


class _Repeating(Roles):
    @property
    def vendors(self):
        base = super().vendors
        return base.unionByName(base.limit(1))


def test_a_failed_refresh_keeps_the_last_table(spark, tmp_path):
    path = str(tmp_path / "kept")
    sink.refresh_fact(Roles(spark, SF), path)
    before = sorted(sink.read_fact(spark, path).inputFiles())
    with pytest.raises(Exception, match="planted failure"):
        sink.refresh_fact(_Failing(spark, SF), path)
    with pytest.raises(sink.KeyViolation, match="vendors"):
        sink.refresh_fact(_Repeating(spark, SF), path)
    assert sorted(sink.read_fact(spark, path).inputFiles()) == before
    assert sink.read_fact(spark, path).count() > 0
