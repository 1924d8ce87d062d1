"""Frequent keys: the sketch finds them, split joins return the rows of the plain join and
spread a hot key over many tasks."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from jobfacts.operators import hotkeys
from jobfacts.operators.hotkeys import NO_SPLIT, Split, split_join
from jobfacts.operators.lookup import left_lookup
from jobfacts.operators.ranges import within_days_of
from jobfacts.sources.roles import Roles
from tests.skewed import HOT_REQUEST, SkewedRoles

SF = "/root/testdata/sf0.001"


@pytest.fixture
def shuffled(spark):
    """Static plans, no broadcasts: every join is a shuffle, as for large inputs."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(64 * 1024 * 1024))


def hash_of(spark, value, kind="long"):
    return spark.range(1).select(F.xxhash64(F.lit(value).cast(kind))).first()[0]


def test_sketch_finds_the_frequent_keys(spark):
    df = spark.range(0, 30000, numPartitions=6).select(
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 10 == 0, 8).otherwise(F.col("id")).cast("long").alias("a"),
        F.when(F.col("id") % 2 == 0, F.lit(None)).otherwise(F.col("id")).cast("string").alias("b"))
    got = hotkeys.sketch([(df, {"a": ("a",), "b": ("b",), "ab": ("a", "b")})])
    assert got["a"].hashes == tuple(sorted(hash_of(spark, v) for v in (7, 8)))
    assert dict(zip(got["a"].hashes, got["a"].each)) == {hash_of(spark, 7): 8, hash_of(spark, 8): 2}  # of 8 tasks: 2.7 and 0.5
    assert got["b"] == NO_SPLIT and got["ab"] == NO_SPLIT  # NULL, however frequent, joins nothing
    assert hotkeys.sketch([(df.limit(0), {"a": ("a",)})])["a"] == NO_SPLIT


def test_shares_and_salts_follow_the_number_of_tasks(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "2000")
    try:
        assert hotkeys.hot_share(spark) == 0.002
        df = spark.range(0, 40000, numPartitions=4).select(F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 200 == 1, 8)
                                                           .otherwise(F.col("id")).cast("long").alias("a"))
        got = hotkeys.sketch([(df, {"a": ("a",)})])["a"]
        assert dict(zip(got.hashes, got.each)) == {hash_of(spark, 7): 2048, hash_of(spark, 8): 16}
        spark.conf.set("spark.sql.shuffle.partitions", "40000")
        assert hotkeys.hot_share(spark) == 0.0001
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert hotkeys.hot_share(spark) == 0.02


def test_profile_of_the_roles(spark):
    plain, skewed = hotkeys.profile(Roles(spark, SF)), hotkeys.profile(SkewedRoles(spark, SF))
    assert set(plain) == set(skewed) == {"job_request", "job_vendor", "job_staff", "job_worker", "request_asset", "request_area",
                                         "item_invoice", "question_survey", "csat_survey"}
    assert hash_of(spark, HOT_REQUEST) in skewed["job_request"].hashes
    assert set(hotkeys.profile(Roles(spark, SF), ["item_invoice"])) == {"item_invoice"}


def _sides(rng, n_left=400, n_right=60):
    key = lambda: rng.choice([1, 1, 1, 2, 2, None, *range(3, 20)])
    return [(i, key(), str(rng.randrange(3))) for i in range(n_left)], [(key(), str(rng.randrange(3)), i) for i in range(n_right)]


@pytest.mark.parametrize("how", ["inner", "left", "left_semi"])
def test_split_join_equals_the_plain_join(spark, how):
    left, right = _sides(random.Random(6))
    if how == "left":
        right = list({(k, c): (k, c, i) for k, c, i in right}.values())
    a = spark.createDataFrame(left, "id long, k long, c string").repartition(4)
    b = spark.createDataFrame(right, "k long, c string, r long")
    hot = Split((hash_of(spark, 1), hash_of(spark, 2)), 8)
    want = Counter(map(tuple, a.join(b, ["k"], how).collect())) if how != "left" else Counter(map(tuple, a.join(b, ["k", "c"], how).collect()))
    if how == "left":
        pairs = Split(tuple(spark.range(1).select(F.xxhash64(F.lit(1).cast("long"), F.lit(c))).first()[0] for c in "01"), 8)
        got = split_join(a, b, ["k", "c"], how, pairs, ["id"])
    else:
        got = split_join(a, b, ["k"], how, hot, ["id"])
    assert Counter(map(tuple, got.collect())) == want


def test_split_on_both_sides(spark):
    left, right = _sides(random.Random(7))
    a = spark.createDataFrame(left, "id long, k long, c string")
    b = spark.createDataFrame(right, "k int, d string, r long")  # another integer type
    want = Counter(map(tuple, a.join(b, ["k"]).collect()))
    hot = [Split((hash_of(spark, v),), 8) for v in (1, 2)]
    got = split_join(a, b, ["k"], "inner", hot[0], ["id"], Split(hot[0].hashes + hot[1].hashes, 8), ["r"])
    assert Counter(map(tuple, got.collect())) == want
    got = split_join(a, b, ["k"], "inner", NO_SPLIT, (), hot[0], ["r"])
    assert Counter(map(tuple, got.collect())) == want
    with pytest.raises(ValueError):
        split_join(a, b, ["k"], "left", NO_SPLIT, (), hot[0], ["r"])


def test_a_hot_key_is_spread(spark, shuffled):
    rows = spark.range(0, 4000, numPartitions=4).select(F.col("id").alias("job_id"), F.when(F.col("id") % 2 == 0, 5).otherwise(F.col("id")).cast("long").alias("k"))
    dim = spark.range(0, 4000).select(F.col("id").alias("rk"), F.lit("x").alias("v"))
    split = hotkeys.sketch([(rows, {"k": ("k",)})])["k"]
    largest = lambda df: max(Counter(r[0] for r in df.select(F.spark_partition_id()).collect()).values()) / df.count()
    looked_up = left_lookup(rows, dim, "k", "rk", "job_id", split=split)
    assert looked_up.where("v IS NULL").count() == 0 and looked_up.count() == 4000
    assert largest(looked_up) < 0.3 < 0.5 < largest(left_lookup(rows, dim, "k", "rk", "job_id"))
    joined = split_join(rows, dim.withColumnRenamed("rk", "k"), ["k"], left_split=split, by=["job_id"])
    assert joined.count() == 4000 and largest(joined) < 0.3


def test_time_bins_equal_the_plain_range_join(spark):
    rng = random.Random(8)
    left = [(i, rng.choice([1, 2, 3, None]), rng.randrange(-40, 200) * 86400 + rng.choice([0, 1, 86399])) for i in range(300)]
    right = [(rng.choice([1, 2, 3, None]), rng.choice([None, *range(-40, 200)])) for _ in range(40)]
    a = spark.createDataFrame(left, "id long, k long, s long").select("id", "k", F.timestamp_seconds("s").cast("timestamp_ntz").alias("ts"))
    b = spark.createDataFrame(right, "k long, n int").select("k", F.date_add(F.lit("1970-01-01").cast("date"), F.col("n")).alias("day"))
    plain = sorted((i, n) for i, k, s in left for k2, n in right if k is not None and k == k2 and n is not None and 0 <= s - n * 86400 <= 30 * 86400)
    for bins, split in ((None, NO_SPLIT), (7, NO_SPLIT), (90, NO_SPLIT), (None, Split((hash_of(spark, 1),), 8))):
        got = within_days_of(a, b, "k", "ts", "day", 30, bin_days=bins, split=split, by="id")
        assert got.columns == ["id", "k", "ts", "day"]
        assert sorted((r.id, (r.day - __import__("datetime").date(1970, 1, 1)).days) for r in got.collect()) == plain
        semi = within_days_of(a, b, "k", "ts", "day", 30, how="left_semi", bin_days=bins, split=split, by="id")
        assert sorted(r.id for r in semi.collect()) == sorted({i for i, _ in plain})


def test_a_hot_request_is_spread_over_its_bins(spark, shuffled):
    jobs = spark.range(0, 3000, numPartitions=4).select(F.col("id"), F.lit(1).cast("long").alias("k"),
                                                         F.timestamp_add("DAY", F.col("id"), F.lit("2000-01-01").cast("timestamp_ntz")).alias("ts"))
    windows = spark.range(0, 100).select(F.lit(1).cast("long").alias("k"), F.date_add(F.lit("2000-01-01").cast("date"), (F.col("id") * 30).cast("int")).alias("day"))
    got = within_days_of(jobs, windows, "k", "ts", "day", 30)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "_left_bin" in plan.split("SortMergeJoin")[1].split("\n")[0]
    sizes = Counter(r[0] for r in got.select(F.spark_partition_id()).collect())
    assert sum(sizes.values()) >= 3000 and max(sizes.values()) < sum(sizes.values()) * 0.4
