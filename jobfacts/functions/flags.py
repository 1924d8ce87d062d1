"""Flags and conditional attributes (C22, C23 and the IFF / COALESCE idioms)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def flag01(cond: Column) -> Column:
    """1 when ``cond`` is true, else 0 -- a NULL condition gives 0."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def defaulted_flag(value: Column, expected: int = 1) -> Column:
    """``value = expected`` as a boolean whose NULL (missing branch) becomes FALSE."""
    return F.coalesce(value == F.lit(expected), F.lit(False))


def exists_flag(col: Column) -> Column:
    """1 when a LEFT-joined key matched, else 0."""
    return F.when(col.isNotNull(), F.lit(1)).otherwise(F.lit(0))


def conditional_attribute(cond: Column, value: Column) -> Column:
    """``value`` when ``cond`` holds, else NULL (NULL condition -> NULL)."""
    return F.when(cond, value)
