"""The oracle's SQL over role tables, as a second opinion on small or skewed roles."""

from __future__ import annotations

from collections import Counter

import duckdb

from jobfacts import oracle
from jobfacts.operators import survey
from jobfacts.plans.fact import FACT_COLUMNS

NAMES = {"scheduled": "scheduled_services", "items": "line_items", "tracking": "time_tracking", "history": "approval_history",
         "questions": "survey_questions", "qtypes": "question_types"}


def run(roles, name: str) -> tuple[list[str], list[tuple]]:
    con = duckdb.connect()
    for role in oracle.ROLES:
        con.register(role, getattr(roles, NAMES.get(role, role)).toArrow())
    got = con.execute(oracle.sql_for(name, roles=False))
    return [d[0] for d in got.description], got.fetchall()


def rows(roles, name: str, columns) -> Counter:
    names, found = run(roles, name)
    return Counter(tuple(r[names.index(c)] for c in columns) for r in found)


def facts(roles) -> Counter:
    return rows(roles, "job_fact", FACT_COLUMNS)


def flagged(roles) -> Counter:
    return rows(roles, "latest_flag_with_dedupe", [*survey._DETAIL, "latest_survey"])
