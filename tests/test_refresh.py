"""The refresh: gate on foreign keys, fence between writers, retention of runs, one read of the run."""

import time

import pytest
from pyspark.sql import functions as F

from jobfacts.plans import files, sink
from jobfacts.plans.fact import job_fact
from jobfacts.sources.roles import Roles

SF = "/root/testdata/sf0.001"


class _FewerUsers(Roles):
    """Staff rows of even ids are missing: more orphans than the plain data has."""

    @property
    def users(self):
        return super().users.where(F.col("staff_id").cast("long") % 2 == 1)


class _RepeatedJobs(Roles):
    """The look-up keeps one row a key, the child table repeats: a fact with repeated jobs."""

    @property
    def jobs(self):
        return super().jobs.unionByName(super().jobs.where("job_id < 50"))


def test_gate_stops_orphans_above_the_tolerance(spark, tmp_path):
    path = f"{tmp_path}/fact"
    first = sink.refresh_fact(Roles(spark, SF), path)
    before = sorted(sink.read_fact(spark, path).inputFiles())
    share = {x.fk_column: x.orphan_rows / x.child_rows for x in first.foreign_keys.collect()}["assigned_staff_id"]
    tolerance = sink.TOLERANCE | {"assigned_staff_id": share}
    sink.refresh_fact(Roles(spark, SF), path, tolerance)  # as many as allowed
    before = sorted(sink.read_fact(spark, path).inputFiles())
    with pytest.raises(sink.KeyViolation, match="assigned_staff_id"):
        sink.refresh_fact(_FewerUsers(spark, SF), path, tolerance)
    assert sorted(sink.read_fact(spark, path).inputFiles()) == before
    with pytest.raises(sink.KeyViolation, match="assigned_staff_id"):
        sink.refresh_fact(Roles(spark, SF), path, {})  # an unnamed key allows none


def test_orphans_lie_beside_the_run(spark, tmp_path):
    path = f"{tmp_path}/fact"
    done = sink.refresh_fact(Roles(spark, SF), path)
    kept = spark.read.parquet(f"{path}/{done.run.replace('run-', 'orphans-')}")
    written = sink.read_fact(spark, path)
    users = [u.staff_id for u in Roles(spark, SF).users.collect()]
    want = {r["assigned_staff_id"]: r["count"] for r in written.where(F.col("assigned_staff_id").isNotNull() & ~F.col("assigned_staff_id").isin(users))
            .groupBy("assigned_staff_id").count().collect()}
    assert {(r.fk_column, r.value): r.n for r in kept.collect()} == {("assigned_staff_id", k): n for k, n in want.items()}
    summary = {x.fk_column: x for x in done.foreign_keys.collect()}
    assert summary["assigned_staff_id"].orphan_rows == sum(want.values())
    assert summary["vendor_id"].null_fk_rows == written.where("vendor_id IS NULL").count()


def test_repeated_jobs_are_refused(spark, tmp_path):
    path = f"{tmp_path}/fact"
    with pytest.raises(sink.KeyViolation, match="jobs"):
        sink.refresh_fact(_RepeatedJobs(spark, SF), path)
    fact = spark.createDataFrame([(1, 7), (1, 7), (2, 8), (None, 9), (None, 9), (3, 99)], "job_id long, r long")
    fact.write.format("parquet").bucketBy(2, "job_id").sortBy("job_id").option("path", f"{tmp_path}/t").saveAsTable("repeats_t")
    parents = spark.createDataFrame([(7,), (8,), (9,)], "k long")
    repeats, orphans = sink.gate(spark.table("repeats_t"), [("r", parents, "k")], f"{tmp_path}/orphans")
    assert repeats == {"duplicate_keys": 1, "duplicate_rows": 2} and orphans == {"r": 1}


def test_the_run_is_read_once_and_not_shuffled_by_job(spark, tmp_path):
    path = f"{tmp_path}/fact"
    done = sink.refresh_fact(Roles(spark, SF), path)
    table = spark.table(sink._table(done.run))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        from pyspark.sql import Window
        plan = table.select("job_id", F.count(F.lit(1)).over(Window.partitionBy("job_id")))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(64 * 1024 * 1024))
    assert "Exchange" not in plan
    assert done.primary_key.first().total_rows == table.count() == job_fact(Roles(spark, SF)).count()


def test_two_writers(spark, tmp_path):
    path = f"{tmp_path}/fact"
    epoch = sink.acquire(spark, path)
    with pytest.raises(sink.RefreshRunning):
        sink.refresh_fact(Roles(spark, SF), path)
    sink.release(spark, path, epoch)
    sink.refresh_fact(Roles(spark, SF), path)
    # a lease that ran out is passed over, and its holder can't publish any more
    slow = sink.acquire(spark, path, seconds=0.2)
    time.sleep(0.4)
    done = sink.refresh_fact(Roles(spark, SF), path)
    with pytest.raises(sink.Fenced):
        sink._publish(spark, path, slow, "run-late")
    assert sink.published_runs(spark, path)[-1] == done.run
    # were the late writer to slip through, the later epoch still counts
    files.create_new(spark, f"{path}/published/{sink._name(slow)}", done.run)
    assert sink.published_runs(spark, path)[-1] == done.run


def test_one_of_two_simultaneous_leases(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    path = f"{tmp_path}/fact"

    def attempt(_):
        try:
            return sink.acquire(spark, path)
        except sink.RefreshRunning:
            return None

    with ThreadPoolExecutor(8) as pool:
        got = list(pool.map(attempt, range(8)))
    assert sorted(x for x in got if x) == [1]


def test_old_and_failed_runs_go(spark, tmp_path):
    path = f"{tmp_path}/fact"

    class _Failing(Roles):
        @property
        def leases(self):
            return super().leases.withColumn("move_in_date", F.raise_error(F.lit("planted failure")).cast("date"))

    runs = [sink.refresh_fact(Roles(spark, SF), path, keep_runs=2).run for _ in range(2)]
    with pytest.raises(Exception, match="planted"):
        sink.refresh_fact(_Failing(spark, SF), path, keep_runs=2)
    with pytest.raises(sink.KeyViolation):
        sink.refresh_fact(Roles(spark, SF), path, {}, keep_runs=2)
    there = {n for n, _ in files.children(spark, path) if n.startswith("run-")}
    assert set(runs) < there  # the refused run is kept, to be looked at, until the next one is published
    last = sink.refresh_fact(Roles(spark, SF), path, keep_runs=2).run
    there = {n for n, _ in files.children(spark, path) if n.startswith(("run-", "orphans-"))}
    assert there == {r for x in (runs[1], last) for r in (x, x.replace("run-", "orphans-"))}
    assert sink.read_fact(spark, path).count() > 0


def test_one_of_many_callers_creates_a_file(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    with ThreadPoolExecutor(8) as pool:
        for k in range(40):
            path = f"{tmp_path}/folder/{k}"
            made = list(pool.map(lambda i: files.create_new(spark, path, str(i)), range(8)))
            assert made.count(True) == 1 and files.read_text(spark, path) == str(made.index(True))
    assert len(files.children(spark, f"{tmp_path}/folder")) == 40
