"""Zone conversion and decimal-hour arithmetic.

Semantics kept from the modelled job:

* zone conversion maps a wall-clock timestamp without zone from UTC to local time and
  returns a timestamp without zone (``convert_timezone``);
* epochs are whole seconds, each side truncated before subtracting;
* a difference of seconds divided by 3600 is an exact decimal rounded HALF_UP to
  6 places (``decimal(26,6)``), never a double;
* the job casts to an unscaled NUMERIC *before* rounding to 2 places, so its hour
  measures are whole numbers; ``scale=`` exposes the 2-decimal reading as an option.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from jobfacts import constants as K


def to_local_time(ts: Column, source_tz: str = K.SOURCE_TZ, target_tz: str = K.LOCAL_TZ) -> Column:
    return F.convert_timezone(F.lit(source_tz), F.lit(target_tz), ts)


def epoch_seconds(ts: Column) -> Column:
    """Whole seconds since 1970 of a timestamp without zone (or a DATE's midnight).

    ``unix_timestamp`` on TIMESTAMP_NTZ ignores the session zone, and DATE -> NTZ is a
    zone-free cast, so the result does not depend on ``spark.sql.session.timeZone``.
    """
    return F.unix_timestamp(ts.cast("timestamp_ntz"))


def hours_from_seconds(seconds: Column, scale: int = 6) -> Column:
    """Exact ``seconds / 3600`` as ``decimal(18, scale)`` (HALF_UP).

    18 digits hold any realistic span (10^11 hours at 6 places) and keep the value a
    long-backed decimal in Spark's rows (wider decimals are BigDecimal-backed).
    """
    hours = seconds.cast("decimal(20,0)") / F.lit(3600).cast("decimal(4,0)")  # decimal(26,6)
    return hours.cast(f"decimal(18,{scale})")


def elapsed_hours(start: Column, end: Column, scale: int = 6) -> Column:
    """Hours from ``start`` to ``end``: whole-second epochs, exact decimal division.

    ``scale=6`` is the raw measure, ``scale=0`` the job's whole-hour rounding,
    ``scale=2`` the two-decimal reading; the result is ``decimal(18, scale)``.
    """
    return hours_from_seconds(epoch_seconds(end) - epoch_seconds(start), scale)


def billable_hours(minutes: Column) -> Column:
    """Minutes as hours rounded HALF_UP to 2 decimals (the cast precedes the division)."""
    hours = minutes.cast("decimal(20,0)") / F.lit(60).cast("decimal(2,0)")  # decimal(26,6)
    return F.round(hours, 2).cast(K.BILLABLE_HOURS_TYPE)
