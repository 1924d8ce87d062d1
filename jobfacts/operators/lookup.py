"""LEFT lookups whose NULL (or ineligible) keys do not pile up in one partition.

In a shuffled LEFT join every row whose key is NULL hashes to the same partition, and
such rows are common here (two thirds of jobs have no staff id, some requests no
asset).  They can never match, so their join key is replaced by a stand-in derived from
a hash of another column, spreading them over all partitions, while the residual
condition ``key IS NOT NULL`` guarantees a stand-in never matches a real key.  Right
rows are not replicated (nothing to match), so the fix costs one hash per NULL row.
When Spark broadcasts the dimension, the same join is a map-side lookup.

Frequent keys that do match (one vendor with a third of all jobs) are spread by a ``Split`` of
``operators.hotkeys``: their rows take a salt, and the dimension's row of such a key is
repeated once a salt.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobfacts.operators.hotkeys import NO_SPLIT, Split, copied, spread

_INT_TYPES = (T.ByteType, T.ShortType, T.IntegerType)


def _stand_in(dtype: T.DataType, spread_by: str) -> Column:
    h = F.xxhash64(F.col(spread_by))
    if isinstance(dtype, T.LongType):
        return h
    if isinstance(dtype, _INT_TYPES):
        return F.pmod(h, F.lit(2**31 - 1)).cast(dtype)
    if isinstance(dtype, T.StringType):
        return F.concat(F.lit("\u0000"), h.cast("string"))
    raise TypeError(f"look-ups by integers and strings only, not by {dtype.simpleString()}")


def left_lookup(left: DataFrame, right: DataFrame, left_key: str, right_key: str, spread_by: str,
                eligible: Column | None = None, split: Split = NO_SPLIT) -> DataFrame:
    """``left LEFT JOIN right ON left_key = right_key [AND eligible]``.

    ``eligible`` is an optional condition on left columns only (rows failing it get NULL
    right columns, like a LEFT join condition).  ``right_key`` must not also be a left
    column name.
    """
    usable = F.col(left_key).isNotNull()
    if eligible is not None:
        usable = usable & eligible
    stand_in = _stand_in(left.schema[left_key].dataType, spread_by)
    keyed = left.withColumn("_lookup_key", F.when(usable, F.col(left_key)).otherwise(stand_in))
    if split.hashes:
        keyed = keyed.withColumn("_lookup_salt", spread([F.col(left_key)], split, [F.col(spread_by)]))
        right = right.withColumn("_right_salt", copied([F.col(right_key).cast(left.schema[left_key].dataType)], split))
        cond = (keyed["_lookup_key"] == right[right_key]) & (keyed["_lookup_salt"] == right["_right_salt"]) & usable
        return keyed.join(right, cond, "left").drop("_lookup_key", "_lookup_salt", "_right_salt")
    cond = (keyed["_lookup_key"] == right[right_key]) & usable
    return keyed.join(right, cond, "left").drop("_lookup_key")
