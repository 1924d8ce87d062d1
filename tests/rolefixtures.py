"""Hand-made role tables for unit tests (schemas as the role adapters produce them)."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal
from types import SimpleNamespace

from pyspark.sql import types as T

from jobfacts.sources.codes import code_table, question_types

L, I, S, B = T.LongType(), T.IntegerType(), T.StringType(), T.BooleanType()
TS, D = T.TimestampNTZType(), T.DateType()
MONEY, RATE = T.DecimalType(18, 2), T.DecimalType(9, 4)

SCHEMAS = {
    "jobs": [("job_id", L), ("service_request_id", L), ("external_id", S), ("assigned_staff_id", S),
             ("assigned_vendor_id", S), ("status", I), ("completed_by_type", I), ("billable_minutes", I),
             ("scope_of_work", S), ("summary", S), ("created_at", TS), ("completed_at", TS)],
    "requests": [("service_request_id", L), ("lease_flow_id", L), ("area_id", I), ("asset_id", I),
                 ("request_type", S)],
    "properties": [("asset_id", I), ("market_id", I)],
    "rates": [("area_id", I), ("maintenance_rate_amount", MONEY), ("first_hour_maintenance_rate_amount", MONEY),
              ("after_hours_emergency_rate", RATE)],
    "vendors": [("vendor_id", S), ("name", S), ("is_in_house", B)],
    "users": [("staff_id", S), ("name", S)],
    "invitations": [("job_id", L), ("status", I), ("updated_by_type", I), ("reminder_was_sent", B),
                    ("created_at", TS), ("updated_at", TS)],
    "notes": [("note_id", L), ("reference_id", L), ("reference_type", I), ("created_by_type", I)],
    "note_files": [("note_id", L), ("file_id", L)],
    "scheduled_services": [("job_id", L), ("created_at", TS), ("scheduled_date", D), ("removed", I),
                           ("line_number", I), ("part_key", L), ("supplier_key", L)],
    "bridge": [("job_id", L), ("li_order", L), ("li_line", I), ("li_part", L), ("li_supp", L), ("li_ship", TS)],
    "line_items": [("li_order", L), ("li_line", I), ("li_part", L), ("li_supp", L), ("li_ship", TS),
                   ("invoice_id", L), ("amount", MONEY)],
    "invoices": [("invoice_id", L), ("invoice_date", D), ("created_date", TS), ("is_voided", B), ("is_paid", B),
                 ("is_deleted", B)],
    "invoice_authors": [("invoice_id", L), ("created_by_type", I)],
    "time_tracking": [("object_id", L), ("object_type", I), ("start_period", TS), ("end_period", TS)],
    "approvals": [("approval_id", L), ("related_entity_id", L)],
    "approvers": [("approval_id", L), ("approver_id", L)],
    "approval_history": [("approval_id", L), ("approval_status", I), ("updated_at", TS)],
    "leases": [("lease_flow_id", L), ("move_in_date", D)],
    "survey_questions": [("survey_id", L), ("question_id", L), ("related_entity_id", S), ("question_type_id", I),
                         ("answer", S)],
    "csat": [("survey_id", L), ("related_entity_id", L), ("surveyed_time", TS), ("comment", S)],
}

# codes of the inline code table (sources.codes)
COMPLETED, IN_PROGRESS, CANCELLED = 70, 79, 80
BY_STAFF, BY_VENDOR, BY_UNKNOWN = 1, 2, 5
INV_ACCEPTED, INV_PENDING, INV_REJECTED = 65, 78, 82
UPD_VENDOR, UPD_STAFF = 70, 79
REF_JOB, REF_REQUEST = 70, 80
AUTH_STAFF, AUTH_VENDOR, AUTH_SYSTEM = 1, 2, 4
INVAUTH_VENDOR, INVAUTH_STAFF, INVAUTH_UNKNOWN = 0, 1, 2
TRACK_JOB, TRACK_TASK = 5, 3


def ts(s: str) -> dt.datetime:
    return dt.datetime.fromisoformat(s)


def d(s: str) -> dt.date:
    return dt.date.fromisoformat(s)


def money(x) -> Decimal:
    return Decimal(str(x)).quantize(Decimal("0.01"))


def frame(spark, name: str, rows):
    """Rows as written in the tests; numbers for text ids are turned into text."""
    schema = T.StructType([T.StructField(n, t, True) for n, t in SCHEMAS[name]])
    rows = [tuple(str(v) if isinstance(f.dataType, T.StringType) and isinstance(v, int) else v for v, f in zip(row, schema)) for row in rows]
    return spark.createDataFrame(rows, schema)


def job(job_id, request=1, status=COMPLETED, staff=None, vendor=None, completed_by=BY_STAFF, minutes=60,
        created="2024-01-10 18:00:00", completed=None):
    return (job_id, request, f"JOB-{job_id}", staff, vendor, status, completed_by, minutes, "scope", "summary",
            ts(created), ts(completed) if completed else None)


def make_roles(spark, **tables):
    """A Roles-like namespace: given tables as row lists, all others empty."""
    ns = {name: frame(spark, name, tables.get(name, [])) for name in SCHEMAS}
    ns["codes"] = code_table(spark)
    ns["question_types"] = question_types(spark)
    return SimpleNamespace(**ns)


def base_request(request=1, lease=None, request_type="Service Request", area=1, asset=1):
    return (request, lease, area, asset, request_type)
