"""The shared code table and the survey question-type table.

The modelled job reads one tall table ``(namespace, code, code_name)`` holding every
enumeration and slices it per enumeration.  For the driver's data the table is inline;
its codes are the ones the role adapters derive (``sources.roles``).  Some codes are left
out on purpose so that INNER decodes drop rows and LEFT decodes yield NULL names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobfacts import constants as K

CODE_SCHEMA = T.StructType([
    T.StructField("namespace", T.StringType(), False),
    T.StructField("code", T.IntegerType(), False),
    T.StructField("code_name", T.StringType(), False),
])

# Codes derived from single-letter columns use the letter's ASCII value.
CODE_ROWS = [
    # job status <- o_orderstatus (F, O, P); REMOVED is never produced
    (K.NS_JOB_STATUS, 70, "COMPLETED"),
    (K.NS_JOB_STATUS, 79, "IN_PROGRESS"),
    (K.NS_JOB_STATUS, 80, "CANCELLED"),
    (K.NS_JOB_STATUS, 82, "REMOVED"),
    # who completed the job <- leading digit of o_orderpriority; 5 has no entry
    (K.NS_COMPLETED_BY, 1, "STAFF"),
    (K.NS_COMPLETED_BY, 2, "VENDOR"),
    (K.NS_COMPLETED_BY, 3, "SYSTEM"),
    (K.NS_COMPLETED_BY, 4, "RESIDENT"),
    # invitation status <- l_returnflag (A, N, R)
    (K.NS_INVITATION_STATUS, 65, "ACCEPTED"),
    (K.NS_INVITATION_STATUS, 78, "PENDING"),
    (K.NS_INVITATION_STATUS, 82, "REJECTED"),
    # who last updated the invitation <- l_linestatus (F, O)
    (K.NS_INVITATION_UPDATER, 70, "VENDOR"),
    (K.NS_INVITATION_UPDATER, 79, "STAFF"),
    # what a note refers to <- o_orderstatus of the note row
    (K.NS_NOTE_REFERENCE, 70, "JOB"),
    (K.NS_NOTE_REFERENCE, 79, "JOB"),
    (K.NS_NOTE_REFERENCE, 80, "REQUEST"),
    # note author <- leading digit of o_orderpriority; 5 has no entry
    (K.NS_NOTE_AUTHOR, 1, "STAFF"),
    (K.NS_NOTE_AUTHOR, 2, "VENDOR"),
    (K.NS_NOTE_AUTHOR, 3, "VENDOR"),
    (K.NS_NOTE_AUTHOR, 4, "SYSTEM"),
    # invoice author <- s_nationkey % 3; 2 has no entry
    (K.NS_INVOICE_AUTHOR, 0, "VENDOR"),
    (K.NS_INVOICE_AUTHOR, 1, "STAFF"),
    # time-tracking object kind <- event kind code
    (K.NS_TRACKING_OBJECT, 3, "TASK"),
    (K.NS_TRACKING_OBJECT, 4, "ISSUE"),
    (K.NS_TRACKING_OBJECT, 5, "JOB"),
    (K.NS_TRACKING_OBJECT, 6, "ACCOUNT"),
    (K.NS_TRACKING_OBJECT, 7, "VISIT"),
]

QUESTION_TYPE_SCHEMA = T.StructType([
    T.StructField("question_type_id", T.IntegerType(), False),
    T.StructField("question_type", T.StringType(), False),
    T.StructField("text", T.StringType(), False),
])

QUESTION_TYPE_ROWS = [
    (3, "VENDOR_RATING", "How would you rate the vendor?"),
    (4, "TECH_RATING", "How would you rate the technician?"),
    (5, "OVERALL", "How was the service overall?"),
    (6, "FOLLOW_UP", "May we contact you again?"),
    (7, "WORK_QUALITY", "How would you rate the quality of the work?"),
]


def values_sql(rows, columns) -> str:
    """The same rows as a SQL ``VALUES`` relation (also for the DuckDB oracle)."""
    def lit(v):
        return f"'{v}'" if isinstance(v, str) else str(v)
    body = ",\n    ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
    return f"(VALUES\n    {body}\n) AS t({', '.join(columns)})"


def _relation(spark: SparkSession, rows, schema: T.StructType) -> DataFrame:
    """Inline rows as a ``VALUES`` relation: of known size, and slices of it fold at planning."""
    return spark.sql(f"SELECT * FROM {values_sql(rows, [f.name for f in schema])}").select(
        *[F.col(f.name).cast(f.dataType) for f in schema])


def code_table(spark: SparkSession) -> DataFrame:
    return _relation(spark, CODE_ROWS, CODE_SCHEMA)


def question_types(spark: SparkSession) -> DataFrame:
    return _relation(spark, QUESTION_TYPE_ROWS, QUESTION_TYPE_SCHEMA)
