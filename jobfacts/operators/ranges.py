"""Equi + range join: rows created within N days after a keyed date.

``left.ts BETWEEN right.d AND right.d + N days`` on top of an equality key, as a join by time
bins: a right row is repeated for the bins that its window touches (two, with bins as
long as the window), a left row lies in one, and both meet on (key, bin).  Rows of one key are thereby
spread over their bins instead of all being compared in one task; the exact bounds are
tested on what meets.  A pair meets once, in the left row's bin.

When the window bound is a DATE the upper end is that day's midnight: ``d + 30 days 00:00:00`` is inside, one second
later is not.  A NULL time, date or key joins nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobfacts.operators.hotkeys import NO_SPLIT, Split, copied, spread
from jobfacts.operators.lookup import left_lookup


def _window_end(df: DataFrame, col: str, days: int) -> Column:
    if isinstance(df.schema[col].dataType, T.DateType):
        return F.date_add(F.col(col), days).cast("timestamp_ntz")
    return F.timestamp_add("DAY", F.lit(days), F.col(col))


def _window_start(df: DataFrame, col: str) -> Column:
    if isinstance(df.schema[col].dataType, T.DateType):
        return F.col(col).cast("timestamp_ntz")
    return F.col(col)


def _bin(ts: Column, days: int) -> Column:
    """Number of the bin of ``days`` days that ``ts`` lies in."""
    return F.floor(F.unix_date(ts.cast("date")) / F.lit(days)).cast("int")


def within_days_of(left: DataFrame, right: DataFrame, key: str, ts: str, date: str, days: int, how: str = "inner",
                   bin_days: int | None = None, split: Split = NO_SPLIT, by: str | None = None) -> DataFrame:
    """Join ``left`` to ``right`` on ``key`` where ``left.ts`` lies in ``[date, date + days]``.

    ``bin_days`` is the length of a bin (default: the window's).  Keys of ``split``, which hold
    a large share of ``left``, are spread further, by a hash of column ``by``.
    """
    width = bin_days or max(days, 1)
    # distinct names, so that the right side's can be dropped after the join
    r = right.select(F.col(key).alias("_key"), *[F.col(c) for c in right.columns if c != key])
    r = r.withColumns({"_start": _window_start(right, date), "_end": _window_end(right, date, days)})
    r = r.withColumn("_bin", F.explode(F.sequence(_bin(F.col("_start"), width), _bin(F.col("_end"), width))))
    keyed = left.withColumn("_left_bin", _bin(F.col(ts), width))
    cond = (keyed[key] == r["_key"]) & (keyed["_left_bin"] == r["_bin"])
    if split.hashes:
        keyed = keyed.withColumn("_left_salt", spread([F.col(key)], split, [F.col(by or ts)]))
        r = r.withColumn("_salt", copied([F.col("_key").cast(left.schema[key].dataType)], split))
        cond = (keyed[key] == r["_key"]) & (keyed["_left_bin"] == r["_bin"]) & (keyed["_left_salt"] == r["_salt"])
    joined = keyed.join(r, cond & keyed[ts].between(r["_start"], r["_end"]), how)
    return joined.drop("_left_bin", "_left_salt", "_key", "_start", "_end", "_bin", "_salt")


def move_in_matches(spine: DataFrame, leases: DataFrame, request_type: str, days: int) -> DataFrame:
    """The move-in branch: each job of the given request type created within ``days``
    after its lease's move-in, with the lease (one row per matching lease)."""
    jobs = spine.filter(F.col("request_type") == F.lit(request_type)).select(
        "job_id", "service_request_id", "lease_flow_id", "created_at")
    m = within_days_of(jobs, leases, "lease_flow_id", "created_at", "move_in_date", days)
    return m.select("job_id", "service_request_id", "lease_flow_id", "move_in_date")


def move_in_windows(requests: DataFrame, leases: DataFrame, request_type: str) -> DataFrame:
    """Requests of the given type with the move-in date of their lease (request-sized)."""
    return (requests.filter(F.col("request_type") == F.lit(request_type)).select("service_request_id", "lease_flow_id")
            .join(leases, on="lease_flow_id", how="inner").select("service_request_id", "lease_flow_id", "move_in_date"))


def move_in_jobs(jobs: DataFrame, requests: DataFrame, leases: DataFrame, request_type: str, days: int,
                 split: Split = NO_SPLIT) -> DataFrame:
    """``move_in_matches`` from narrow inputs: the jobs (``job_id, service_request_id, created_at``
    on the local clock) meet their requests' windows by (request, bin), with no spine built."""
    return within_days_of(jobs.select("job_id", "service_request_id", "created_at"), move_in_windows(requests, leases, request_type),
                          "service_request_id", "created_at", "move_in_date", days, split=split, by="job_id").select(
        "job_id", "service_request_id", "lease_flow_id", "move_in_date")


def move_in_flag(jobs: DataFrame, requests: DataFrame, leases: DataFrame, request_type: str,
                 days: int, split: Split = NO_SPLIT) -> DataFrame:
    """Job ids created within ``days`` after a move-in of their request's lease, each once.

    As ``move_in_jobs``, with a semi join: the fact only needs existence, so a lease id that
    repeats cannot multiply fact rows.  Jobs that are not live get a flag here too; the fact's
    LEFT join drops them.
    """
    m = within_days_of(jobs.select("job_id", "service_request_id", "created_at"), move_in_windows(requests, leases, request_type),
                       "service_request_id", "created_at", "move_in_date", days, how="left_semi", split=split, by="job_id")
    return m.select("job_id", F.lit(1).alias("within_move_in"))


MOVE_IN_COLUMNS = ("move_in_from", "move_in_until")


def requests_with_move_in(requests: DataFrame, leases: DataFrame, request_type: str, days: int) -> DataFrame:
    """Requests with the window after the move-in of their lease, which is unique; NULL for
    requests of another type or without a lease.  A job that carries its request's window needs no
    join of its own for the flag: see ``moved_in``."""
    windows = leases.select(F.col("lease_flow_id").alias("_lease"), _window_start(leases, "move_in_date").alias(MOVE_IN_COLUMNS[0]),
                            _window_end(leases, "move_in_date", days).alias(MOVE_IN_COLUMNS[1]))
    return left_lookup(requests, windows, "lease_flow_id", "_lease", "service_request_id",
                       eligible=F.col("request_type") == F.lit(request_type)).drop("_lease")


def moved_in(ts: Column) -> Column:
    """1 if ``ts`` lies in the row's own move-in window, else NULL."""
    return F.when(ts.between(*[F.col(c) for c in MOVE_IN_COLUMNS]), F.lit(1))
