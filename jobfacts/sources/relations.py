"""The fact's input relations, bound by contract to given tables.

``Relations`` takes a DataFrame or a catalogue name for every relation and checks, before any
plan is built, that each has the declared columns with fitting types; a misfit is reported with
relation and column, all of them at once.  Only declared columns are kept, so further ones, whatever their
names, take no part.  The result has the attributes that the operators and plans read, as
``sources.roles.Roles`` does for the test tables.

Ids are opaque: text or whole numbers, but one type per kind of id across all relations, as
joins don't cast.  ``code`` columns hold the integers that the code table decodes.

What a schema can't tell (unique keys, required values) is counted by ``contract_violations``,
one aggregation per relation.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobfacts.sources.codes import code_table, question_types
from jobfacts.sources.roles import LINE_ITEM_KEY

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_KINDS = {
    "text": (T.StringType,), "code": _WHOLE, "flag": _WHOLE, "boolean": (T.BooleanType,), "minutes": _WHOLE,
    "amount": (T.DecimalType,), "date": (T.DateType,), "time": (T.TimestampNTZType,), "day": (T.DateType, T.TimestampNTZType),
    "order": (*_WHOLE, T.StringType, T.TimestampNTZType, T.DateType),
}
_SAID = {"text": "a string", "code": "a whole number", "flag": "a whole number", "boolean": "a boolean", "minutes": "a whole number",
         "amount": "a decimal", "date": "a date", "time": "a timestamp_ntz", "day": "a date or a timestamp_ntz",
         "order": "a whole number, string, date or timestamp_ntz"}


class Contract(NamedTuple):
    """Columns by kind (``id:...`` is an id of that kind), the key, and columns without NULLs."""

    columns: dict[str, str]
    key: tuple[str, ...] = ()
    required: tuple[str, ...] = ()


CONTRACTS: dict[str, Contract] = {
    "jobs": Contract({"job_id": "id:job", "service_request_id": "id:request", "external_id": "text", "assigned_staff_id": "id:worker",
                      "assigned_vendor_id": "id:worker", "status": "code", "completed_by_type": "code", "billable_minutes": "minutes",
                      "scope_of_work": "text", "summary": "text", "created_at": "time", "completed_at": "time"}, ("job_id",), ("job_id",)),
    "requests": Contract({"service_request_id": "id:request", "lease_flow_id": "id:lease", "area_id": "id:area", "asset_id": "id:asset",
                          "request_type": "text"}, ("service_request_id",), ("service_request_id",)),
    "properties": Contract({"asset_id": "id:asset", "market_id": "id:market"}, ("asset_id",), ("asset_id",)),
    "rates": Contract({"area_id": "id:area", "maintenance_rate_amount": "amount", "first_hour_maintenance_rate_amount": "amount",
                       "after_hours_emergency_rate": "amount"}, ("area_id",), ("area_id",)),
    "vendors": Contract({"vendor_id": "id:worker", "name": "text", "is_in_house": "boolean"}, ("vendor_id",), ("vendor_id",)),
    "users": Contract({"staff_id": "id:worker", "name": "text"}, ("staff_id",), ("staff_id",)),
    "invitations": Contract({"job_id": "id:job", "status": "code", "updated_by_type": "code", "reminder_was_sent": "boolean",
                             "created_at": "time", "updated_at": "time"}),
    "notes": Contract({"note_id": "id:note", "reference_id": "id:job", "reference_type": "code", "created_by_type": "code"}),
    "note_files": Contract({"note_id": "id:note", "file_id": "id:file"}),
    "scheduled_services": Contract({"job_id": "id:job", "created_at": "time", "scheduled_date": "day", "removed": "flag"}),
    "bridge": Contract({"job_id": "id:job"}),
    "line_items": Contract({"invoice_id": "id:invoice", "amount": "amount"}),
    "invoices": Contract({"invoice_id": "id:invoice", "invoice_date": "day", "created_date": "time", "is_voided": "boolean",
                          "is_paid": "boolean", "is_deleted": "boolean"}, ("invoice_id",), ("invoice_id",)),
    "invoice_authors": Contract({"invoice_id": "id:invoice", "created_by_type": "code"}),
    "time_tracking": Contract({"object_id": "id:job", "object_type": "code", "start_period": "time", "end_period": "time"}),
    "approvals": Contract({"approval_id": "id:approval", "related_entity_id": "id:job"}),
    "approvers": Contract({"approval_id": "id:approval"}),
    "approval_history": Contract({"approval_id": "id:approval", "approval_status": "code", "updated_at": "time"}),
    "leases": Contract({"lease_flow_id": "id:lease", "move_in_date": "day"}, ("lease_flow_id",), ("lease_flow_id", "move_in_date")),
    "survey_questions": Contract({"survey_id": "id:survey", "question_id": "id:question", "related_entity_id": "id:worker",
                                  "question_type_id": "code", "answer": "text"}),
    "csat": Contract({"survey_id": "id:survey", "related_entity_id": "id:request", "surveyed_time": "time", "comment": "text"}),
    "codes": Contract({"namespace": "text", "code": "code", "code_name": "text"}, ("namespace", "code"), ("namespace", "code")),
    "question_types": Contract({"question_type_id": "code", "question_type": "text", "text": "text"}, ("question_type_id",), ("question_type_id",)),
}


class ContractError(ValueError):
    """Relations that don't fit; the message has a line per misfit."""


def contracts(line_item_key: Sequence[str], schedule_tie_break: Sequence[str]) -> dict[str, Contract]:
    """The contracts with the columns that a deployment names itself: the key that the bridge
    and the line items share, and what orders schedule rows of one time."""
    extra = {"bridge": {c: f"id:item.{c}" for c in line_item_key}, "line_items": {c: f"id:item.{c}" for c in line_item_key},
             "scheduled_services": dict.fromkeys(schedule_tie_break, "order")}
    return {n: c._replace(columns=c.columns | extra.get(n, {})) for n, c in CONTRACTS.items()}


def misfits(frames: Mapping[str, DataFrame], agreed: Mapping[str, Contract]) -> list[str]:
    """One line per missing relation or column, wrong type, or id of two types."""
    found, ids = [], {}
    for name, contract in agreed.items():
        if name not in frames:
            found.append(f"{name}: no such relation given")
            continue
        types = {f.name: f.dataType for f in frames[name].schema}
        for column, kind in contract.columns.items():
            at = f"{name}.{column}"
            if column not in types:
                found.append(f"{at}: no such column")
            elif kind.startswith("id:"):
                composite = kind.startswith("id:item.")
                if not isinstance(types[column], (*_WHOLE, T.StringType, *((T.TimestampNTZType, T.DateType) if composite else ()))):
                    found.append(f"{at}: an id must be a string or a whole number, not {types[column].simpleString()}")
                else:
                    first = ids.setdefault(kind, (at, types[column]))
                    if first[1] != types[column]:
                        found.append(f"{at}: {types[column].simpleString()}, but {first[0]} is {first[1].simpleString()}; joins don't cast ids")
            elif not isinstance(types[column], _KINDS[kind]):
                found.append(f"{at}: must be {_SAID[kind]}, not {types[column].simpleString()}")
    return found + [f"{n}: not a relation of the fact" for n in frames if n not in agreed]


class Relations:
    """All input relations, by the names of ``CONTRACTS``; code tables default to the inline ones."""

    def __init__(self, spark: SparkSession, given: Mapping[str, DataFrame | str], line_item_key: Sequence[str] = LINE_ITEM_KEY,
                 schedule_tie_break: Sequence[str] = ("line_number", "part_key", "supplier_key")):
        self.spark = spark
        self.line_item_key, self.schedule_tie_break = tuple(line_item_key), tuple(schedule_tie_break)
        agreed = contracts(self.line_item_key, self.schedule_tie_break)
        frames = {"codes": code_table(spark), "question_types": question_types(spark)}
        frames |= {n: spark.table(t) if isinstance(t, str) else t for n, t in given.items()}
        if found := misfits(frames, agreed):
            raise ContractError("\n".join(found))
        for name, contract in agreed.items():
            setattr(self, name, frames[name].select(*[F.col(f"`{c}`") for c in contract.columns]))


def contract_violations(relations) -> DataFrame:
    """``(relation, check, column, violations)``: repeated keys (rows beyond the first of each)
    and NULLs in required columns, one row per check, 0 for a relation that keeps it."""
    parts = []
    for name, contract in CONTRACTS.items():
        df = getattr(relations, name)
        if contract.required:
            counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in contract.required])
            parts.append(counts.select(F.inline(F.array(*[F.struct(F.lit(name).alias("relation"), F.lit("required").alias("check"),
                                                                   F.lit(c).alias("column"), F.col(c).alias("violations")) for c in contract.required]))))
        if contract.key:
            known = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in contract.key])
            repeats = df.where(known).groupBy(*contract.key).agg(F.count(F.lit(1)).alias("n")).agg(
                F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("long").alias("violations"))
            parts.append(repeats.select(F.lit(name).alias("relation"), F.lit("unique").alias("check"), F.lit(",".join(contract.key)).alias("column"), "violations"))
    return reduce(DataFrame.unionByName, parts)
