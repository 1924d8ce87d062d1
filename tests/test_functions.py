"""Column helpers: zone conversion, epochs, decimal hours, labels, flags (M-03, M-11, M-18..M-20)."""

from decimal import Decimal

from pyspark.sql import functions as F

from jobfacts.functions.codes import label_normalize
from jobfacts.functions.flags import conditional_attribute, defaulted_flag, exists_flag, flag01
from jobfacts.functions.timeops import billable_hours, elapsed_hours, epoch_seconds, to_local_time
from tests.rolefixtures import ts


def _one(spark, sql_select: str):
    return spark.sql(f"SELECT {sql_select}").collect()[0]


def test_to_local_time_dst(spark):
    df = spark.createDataFrame([(ts("2024-03-10 10:30:00"),), (ts("2024-11-03 08:30:00"),),
                                (ts("2024-11-03 09:30:00"),), (ts("2024-01-10 18:00:00"),)], "t timestamp_ntz")
    got = [r[0] for r in df.select(to_local_time(F.col("t"))).collect()]
    assert got == [ts("2024-03-10 03:30:00"), ts("2024-11-03 01:30:00"), ts("2024-11-03 01:30:00"),
                   ts("2024-01-10 10:00:00")]


def test_to_local_time_keeps_microseconds_and_type(spark):
    df = spark.createDataFrame([(ts("2024-01-01 00:00:07.179575"),)], "t timestamp_ntz")
    out = df.select(to_local_time(F.col("t")).alias("x"))
    assert out.schema["x"].dataType.simpleString() == "timestamp_ntz"
    assert out.collect()[0].x == ts("2023-12-31 16:00:07.179575")


def test_epoch_truncates_each_side_before_subtracting(spark):
    # M-20: start 0.9 s, end 2.1 s -> 2 whole seconds, not 1.2
    df = spark.createDataFrame([(ts("2024-01-01 00:00:00.9"), ts("2024-01-01 00:00:02.1"))],
                               "a timestamp_ntz, b timestamp_ntz")
    r = df.select((epoch_seconds(F.col("b")) - epoch_seconds(F.col("a"))).alias("s")).collect()[0]
    assert r.s == 2


def test_epoch_ignores_session_zone(spark):
    df = spark.createDataFrame([(ts("2024-01-01 00:00:00"),)], "a timestamp_ntz")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        tokyo = df.select(epoch_seconds(F.col("a"))).collect()[0][0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert tokyo == 1704067200


def test_elapsed_hours_scales(spark):
    # M-03: whole-hour mode 2 and 1; 2-decimal mode 1.50 and 1.39; M-19: 6 s -> 0.001667
    df = spark.createDataFrame([(0, 5400), (0, 5000), (0, 6), (5400, 0)], "a long, b long")
    base = ts("2024-01-01 00:00:00")
    start = F.timestamp_add("SECOND", F.col("a"), F.lit(base))
    end = F.timestamp_add("SECOND", F.col("b"), F.lit(base))
    rows = df.select(elapsed_hours(start, end).alias("h6"), elapsed_hours(start, end, 0).alias("h0"),
                     elapsed_hours(start, end, 2).alias("h2")).collect()
    assert [r.h0 for r in rows] == [Decimal("2"), Decimal("1"), Decimal("0"), Decimal("-2")]
    assert [r.h2 for r in rows] == [Decimal("1.50"), Decimal("1.39"), Decimal("0.00"), Decimal("-1.50")]
    assert [r.h6 for r in rows] == [Decimal("1.500000"), Decimal("1.388889"), Decimal("0.001667"),
                                    Decimal("-1.500000")]


def test_elapsed_hours_mixed_clocks(spark):
    # M-11: accepted 18:00 UTC -> 10:00 local; scheduled same day 18:00 unconverted -> 8 h
    df = spark.createDataFrame([(ts("2024-01-10 18:00:00"), ts("2024-01-10 18:00:00"))],
                               "acc timestamp_ntz, sched timestamp_ntz")
    r = df.select(elapsed_hours(to_local_time(F.col("acc")), F.col("sched")).alias("h")).collect()[0]
    assert r.h == Decimal("8.000000")


def test_elapsed_hours_to_a_date_uses_its_midnight(spark):
    df = spark.createDataFrame([(ts("2024-01-09 18:00:00"),)], "a timestamp_ntz").withColumn(
        "d", F.lit("2024-01-10").cast("date"))
    assert df.select(elapsed_hours(F.col("a"), F.col("d"))).collect()[0][0] == Decimal("6.000000")


def test_billable_hours(spark):
    # the NUMERIC cast precedes the division, so 2 decimals survive: 7 min -> 0.12
    df = spark.createDataFrame([(7,), (60,), (90,), (1,), (None,)], "m int")
    got = [r[0] for r in df.select(billable_hours(F.col("m"))).collect()]
    assert got == [Decimal("0.12"), Decimal("1.00"), Decimal("1.50"), Decimal("0.02"), None]


def test_label_normalize(spark):
    df = spark.createDataFrame([("IN_PROGRESS",), ("COMPLETED",), ("ON_HOLD_BY_VENDOR",)], "s string")
    assert [r[0] for r in df.select(label_normalize(F.col("s"))).collect()] == \
        ["In Progress", "Completed", "On Hold By Vendor"]


def test_flags_treat_null_as_false(spark):
    df = spark.createDataFrame([(1,), (0,), (None,)], "x int")
    rows = df.select(flag01(F.col("x") == 1).alias("f"), defaulted_flag(F.col("x")).alias("d"),
                     exists_flag(F.col("x")).alias("e"),
                     conditional_attribute(F.col("x") == 1, F.lit("m")).alias("c")).collect()
    assert [(r.f, r.d, r.e, r.c) for r in rows] == [(1, True, 1, "m"), (0, False, 1, None), (0, False, 0, None)]


def test_hours_match_exact_decimal_arithmetic(spark):
    """Many random spans (negative, sub-second, multi-year) against exact Python decimals."""
    import datetime as dt
    import random
    from decimal import ROUND_HALF_UP, Decimal as Dec

    rng = random.Random(7)
    base = dt.datetime(2020, 1, 1)
    rows = []
    for _ in range(400):
        a = base + dt.timedelta(microseconds=rng.randrange(-10**14, 10**14))
        b = a + dt.timedelta(microseconds=rng.choice([rng.randrange(-10**13, 10**13), rng.randrange(-10**7, 10**7),
                                                       1800 * 10**6, -1800 * 10**6, 18 * 10**6]))
        rows.append((a, b))
    df = spark.createDataFrame(rows, "a timestamp_ntz, b timestamp_ntz")
    got = df.select("a", "b", elapsed_hours(F.col("a"), F.col("b")).alias("h6"),
                    elapsed_hours(F.col("a"), F.col("b"), 0).alias("h0"),
                    elapsed_hours(F.col("a"), F.col("b"), 2).alias("h2")).collect()
    epoch = dt.datetime(1970, 1, 1)

    def secs(t):  # whole seconds, truncated toward zero like unix_timestamp
        us = (t - epoch) // dt.timedelta(microseconds=1)
        return int(us / 10**6) if us < 0 else us // 10**6

    # Spark rounds twice (to 6 places, then to the scale); a difference of whole seconds
    # over 3600 never lies on a tie at 6 places, so that equals one exact HALF_UP rounding.
    for r in got:
        exact = Dec(secs(r.b) - secs(r.a)) / Dec(3600)
        for scale, value in ((6, r.h6), (0, r.h0), (2, r.h2)):
            expected = exact.quantize(Dec(1).scaleb(-scale), ROUND_HALF_UP)
            assert value == expected, (r.a, r.b, scale, value, expected)


def test_initcap_breaks_words_at_punctuation(spark):
    import duckdb

    from jobfacts import oracle
    names = ["IN_PROGRESS", "on-hold", "a.b.c", "don't STOP", "x/y (z) [q] {w} <v>", "tab\there", "ünder_ÄRGER", "", "a--b", "2ND_STEP", "back\\slash", "é"]
    want = ["In Progress", "On-Hold", "A.B.C", "Don't Stop", "X/Y (Z) [Q] {W} <V>", "Tab\tHere", "Ünder Ärger", "", "A--B", "2nd Step", "Back\\Slash", "É"]
    df = spark.createDataFrame([(s,) for s in [*names, None]], "s string")
    assert [r[0] for r in df.select(label_normalize(F.col("s"))).collect()] == [*want, None]
    con = duckdb.connect()
    con.execute("CREATE TABLE t (s VARCHAR)")
    con.executemany("INSERT INTO t VALUES (?)", [(s,) for s in names])
    assert [r[0] for r in con.execute(f"SELECT {oracle.initcap_label('s')} FROM t").fetchall()] == want
