"""Column-level helpers (all built-in Spark expressions; no UDFs)."""

from jobfacts.functions.codes import code_slice, decode, label_normalize
from jobfacts.functions.flags import conditional_attribute, defaulted_flag, exists_flag, flag01
from jobfacts.functions.timeops import (
    billable_hours, elapsed_hours, epoch_seconds, hours_from_seconds, to_local_time,
)

__all__ = [
    "code_slice", "decode", "label_normalize",
    "conditional_attribute", "defaulted_flag", "exists_flag", "flag01",
    "billable_hours", "elapsed_hours", "epoch_seconds", "hours_from_seconds", "to_local_time",
]
