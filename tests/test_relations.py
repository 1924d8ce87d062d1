"""Relations by contract: the fact over given tables, and misfits named with their column."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from jobfacts.plans import sink
from jobfacts.plans.fact import job_fact
from jobfacts.sources.relations import CONTRACTS, ContractError, Relations, contract_violations
from jobfacts.sources.roles import Roles
from tests.test_random_equivalence import random_roles

SF = "/root/testdata/sf0.001"


def given(roles, without=("codes", "question_types")):
    return {n: getattr(roles, n) for n in CONTRACTS if n not in without}


def test_fact_over_given_tables_equals_the_oracle(spark):
    from tests import oracle_roles

    r = random_roles(spark, 5)
    frames = {n: df.withColumns({"id": F.lit(1), "n": F.lit("x"), "_salt": F.lit(0)}) for n, df in given(r).items()}
    assert Counter(map(tuple, job_fact(Relations(spark, frames)).collect())) == oracle_roles.facts(r)


def test_catalogue_names_text_ids_and_a_plain_item_key(spark):
    r = random_roles(spark, 6)
    frames = given(r)
    ids = {c for x in CONTRACTS.values() for c, kind in x.columns.items() if kind.startswith("id:") and not kind.startswith("id:item")}
    as_text = {n: df.select(*[F.col(c).cast("string").alias(c) if c in ids else F.col(c) for c in df.columns]) for n, df in frames.items()}
    item = F.concat_ws("/", "li_order", "li_line", "li_part", "li_supp").alias("line_item_id")
    as_text["bridge"] = as_text["bridge"].select("job_id", item)
    as_text["line_items"] = as_text["line_items"].select(item, "invoice_id", "amount")
    for n, df in as_text.items():
        df.createOrReplaceTempView(f"contract_{n}")
    relations = Relations(spark, {n: f"contract_{n}" for n in as_text}, line_item_key=["line_item_id"])
    text = lambda rows: Counter(tuple(None if v is None else str(v) for v in x) for x in rows)
    assert text(job_fact(relations).collect()) == text(job_fact(Relations(spark, frames)).collect())


def test_misfits_name_their_columns(spark):
    frames = given(random_roles(spark, 7))
    frames["jobs"] = frames["jobs"].withColumn("created_at", F.col("created_at").cast("string")).drop("summary")
    frames["vendors"] = frames["vendors"].withColumn("vendor_id", F.col("vendor_id").cast("long"))
    frames["leases"] = frames["leases"].withColumn("lease_flow_id", F.lit(1.5))
    frames["extra"] = frames.pop("csat")
    with pytest.raises(ContractError) as e:
        Relations(spark, frames)
    lines = str(e.value).split("\n")
    assert "jobs.created_at: must be a timestamp_ntz, not string" in lines and "jobs.summary: no such column" in lines
    assert any(x.startswith("vendors.vendor_id: bigint, but jobs.assigned_staff_id is string") for x in lines)
    assert any(x.startswith("leases.lease_flow_id: an id must be") for x in lines)
    assert "csat: no such relation given" in lines and "extra: not a relation of the fact" in lines
    assert len(lines) == 6


def test_violations_are_counted(spark):
    frames = given(random_roles(spark, 8))
    frames["vendors"] = frames["vendors"].unionByName(frames["vendors"].limit(2))
    frames["leases"] = frames["leases"].withColumn("move_in_date", F.when(F.col("lease_flow_id") > 102, F.col("move_in_date")))
    found = {(r.relation, r.check, r.column): r.violations for r in contract_violations(Relations(spark, frames)).collect()}
    assert found[("vendors", "unique", "vendor_id")] == 2 and found[("leases", "required", "move_in_date")] == 3
    assert sum(found.values()) == 5 and ("codes", "unique", "namespace,code") in found


def test_the_test_tables_keep_the_contract(spark):
    roles = Roles(spark, SF)
    Relations(spark, given(roles, without=()))
    assert contract_violations(roles).where("violations > 0").count() == 0


def test_refresh_over_given_tables(spark, tmp_path):
    relations = Relations(spark, given(random_roles(spark, 9)))
    loose = {"service_request_id": 1.0, "vendor_id": 1.0, "assigned_staff_id": 1.0}
    done = sink.refresh_fact(relations, f"{tmp_path}/fact", loose)
    assert sink.read_fact(spark, f"{tmp_path}/fact").count() == done.primary_key.first().total_rows > 0
