"""Key checks on the written fact and its dimensions.

The modelled job declares a primary key and three foreign keys after each refresh.
Here they are data-quality jobs.  Summaries return one row per checked key -- also for
a clean table -- and ``*_violations`` return the offending rows.  Each check is a single
aggregation (partial aggregates map-side, a one-row global result), no collect.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobfacts.operators.hotkeys import sketch, split_join


def _any_null(keys: Sequence[str]):
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])


def check_primary_key(df: DataFrame, keys: Sequence[str], relation: str) -> DataFrame:
    """``(relation, key_columns, total_rows, null_key_rows, duplicate_keys, duplicate_rows)``."""
    keys = list(keys)
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    has_null = _any_null(keys)
    dup = (~has_null) & (F.col("_n") > 1)
    return per_key.agg(
        F.sum("_n").alias("total_rows"),
        F.sum(F.when(has_null, F.col("_n")).otherwise(0)).alias("null_key_rows"),
        F.count_if(dup).alias("duplicate_keys"),
        F.sum(F.when(dup, F.col("_n")).otherwise(0)).alias("duplicate_rows"),
    ).select(F.lit(relation).alias("relation"), F.lit(",".join(keys)).alias("key_columns"),
             F.coalesce("total_rows", F.lit(0)).cast("bigint").alias("total_rows"),
             F.coalesce("null_key_rows", F.lit(0)).cast("bigint").alias("null_key_rows"),
             F.col("duplicate_keys").cast("bigint").alias("duplicate_keys"),
             F.coalesce("duplicate_rows", F.lit(0)).cast("bigint").alias("duplicate_rows"))


def primary_key_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is NULL or shared with another row."""
    keys = list(keys)
    dups = df.filter(~_any_null(keys)).groupBy(*keys).count().filter(F.col("count") > 1).drop("count")
    return df.filter(_any_null(keys)).unionByName(df.join(dups, on=keys, how="left_semi"))


PRIMARY_SUMMARY = "relation string, key_columns string, total_rows long, null_key_rows long, duplicate_keys long, duplicate_rows long"
FOREIGN_SUMMARY = "relation string, fk_column string, parent_column string, child_rows long, null_fk_rows long, orphan_rows long"


def foreign_key_values(child: DataFrame, keys: Sequence[tuple[str, DataFrame, str]]) -> DataFrame:
    """``(fk_column, value, n, known)``: every value of the foreign keys with its number of rows;
    ``known`` is true for those that a parent has.

    The columns of one pass over the child are unpivoted and counted per value first: a
    frequent value, NULL above all, is one row before it is shuffled.  The counted values
    meet the distinct keys of all parents in one join; values are compared as text.
    """
    cells = child.select(F.inline(F.array(*[F.struct(F.lit(fk).alias("fk_column"), F.col(fk).cast("string").alias("value"))
                                            for fk, _, _ in keys])))
    counted = cells.groupBy("fk_column", "value").agg(F.count(F.lit(1)).alias("n"))
    parents = reduce(DataFrame.unionByName, [parent.select(F.lit(fk).alias("fk_column"), F.col(pk).cast("string").alias("value"))
                                             for fk, parent, pk in keys]).where("value IS NOT NULL").distinct()
    return counted.join(parents.withColumn("known", F.lit(True)), ["fk_column", "value"], "left")


def check_foreign_keys(child: DataFrame, keys: Sequence[tuple[str, DataFrame, str]], relation: str) -> DataFrame:
    """``(relation, fk_column, parent_column, child_rows, null_fk_rows, orphan_rows)`` per (column, parent, key).
    A NULL foreign key is not a violation."""
    found = foreign_key_values(child, keys).groupBy("fk_column").agg(
        F.sum("n").alias("child_rows"), F.sum(F.when(F.col("value").isNull(), F.col("n"))).alias("null_fk_rows"),
        F.sum(F.when(F.col("value").isNotNull() & F.col("known").isNull(), F.col("n"))).alias("orphan_rows"))
    names = child.sparkSession.sql("SELECT * FROM VALUES " + ", ".join(f"('{fk}', '{pk}')" for fk, _, pk in keys) + " AS t(fk_column, parent_column)")
    return names.join(found, "fk_column", "left").select(
        F.lit(relation).alias("relation"), "fk_column", "parent_column",
        *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("child_rows", "null_fk_rows", "orphan_rows")])


def check_foreign_key(child: DataFrame, fk: str, parent: DataFrame, pk: str, relation: str) -> DataFrame:
    """``check_foreign_keys`` of a single column."""
    return check_foreign_keys(child, [(fk, parent, pk)], relation)


def foreign_key_violations(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Child rows whose non-NULL foreign key has no parent.

    The child's distinct values (counted map-side, so a hot or orphaned value is one row) meet
    the parent, and the few orphaned ones go back to the child's rows.  These are spread by the
    split join when one orphaned value is frequent."""
    present = child.select(F.col(fk).alias("_fk")).where("_fk IS NOT NULL").distinct()
    orphaned = present.join(parent.select(F.col(pk).alias("_pk")), F.col("_fk") == F.col("_pk"), "left_anti")
    split = sketch([(child, {"fk": (fk,)})])["fk"]
    return split_join(child, orphaned.withColumnRenamed("_fk", fk), [fk], "left_semi", split, [c for c in child.columns if c != fk]
                      ).select(*child.columns)


def fact_foreign_keys(requests: DataFrame, vendors: DataFrame, users: DataFrame) -> list[tuple[str, DataFrame, str]]:
    """(column of the fact, parent, key) of its three foreign keys."""
    return [("service_request_id", requests, "service_request_id"), ("vendor_id", vendors, "vendor_id"),
            ("assigned_staff_id", users, "staff_id")]


def fact_key_checks(fact: DataFrame, requests: DataFrame, vendors: DataFrame, users: DataFrame) -> DataFrame:
    """The fact's declared keys: PK ``job_id`` is reported by ``check_primary_key``;
    the three foreign keys here, in one pass over the fact."""
    return check_foreign_keys(fact, fact_foreign_keys(requests, vendors, users), "job_fact")


def dimension_keys(roles) -> list[tuple[str, DataFrame, list[str]]]:
    """(name, relation, key) of everything that the fact looks up and takes to be unique."""
    return [
        ("jobs", roles.jobs, ["job_id"]),
        ("requests", roles.requests, ["service_request_id"]),
        ("properties", roles.properties, ["asset_id"]),
        ("rates", roles.rates, ["area_id"]),
        ("vendors", roles.vendors, ["vendor_id"]),
        ("users", roles.users, ["staff_id"]),
        ("leases", roles.leases, ["lease_flow_id"]),
        ("codes", roles.codes, ["namespace", "code"]),
        ("question_types", roles.question_types, ["question_type_id"]),
        ("invoices", roles.invoices, ["invoice_id"]),
    ]


def duplicated_dimensions(roles) -> list[str]:
    """Names of the dimensions with a repeated key (one summary row each reaches the driver)."""
    found = reduce(DataFrame.unionByName, [check_primary_key(df, k, n) for n, df, k in dimension_keys(roles)])
    return sorted(r["relation"] for r in found.where("duplicate_keys > 0").collect())
