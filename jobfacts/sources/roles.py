"""Role adapters: the driver's tables playing the job's 23 input relations.

The modelled job reads operational tables (jobs, requests, invitations, notes, invoices,
time tracking, approvals, leases, surveys, ...).  The test data is a TPC-H-like star
schema, so each relation is *derived* from a driver table by a projection (and, for the
two keyed dimensions that must be unique, an aggregation).  The same derivations are
written in SQL in ``jobfacts.oracle`` so that an independent engine can check results.

Each adapter is a plain projection, so at scale it adds no shuffle: Catalyst folds it
into the scan (``ReadSchema`` keeps only the referenced columns) and pushes filters
through it.  Ids stay ``bigint`` (the driver's key type), but staff and vendor ids are text:
the worker id mixes both and must not rest on integers they share.  Every operator is
generic in the key type.

Mapping (driver table -> role):

========================  ======================  =========================================
role                      driver table            notes
========================  ======================  =========================================
codes                     inline rows             ``sources.codes``
jobs                      orders                  staff id on every 3rd job, vendor id on
                                                  4 of 5 (``o_custkey div 14``, ~7% with
                                                  no vendor row)
requests                  customer                lease NULL for one segment, asset NULL
                                                  for negative balances
properties                nation                  market = region
rates                     supplier by nation      unique per area (aggregated)
vendors                   supplier                in-house when ``s_nationkey % 4 = 0``
users                     customer, balance >= 0  staff ids of other customers have no row
invitations               lineitem                status <- return flag, updater <- line
                                                  status, created a few hours before ship
notes / note_files        orders / lineitem       note refers to job ``o_custkey``; files
                                                  fan out per note, some file ids NULL
scheduled_services        lineitem                removed <- return flag R
bridge / line_items       lineitem (self-join)    5-column natural key of a line
invoices / invoice_auth.  supplier                one invoice per supplier
time_tracking             events                  value read as minutes
approvals / approvers /   orders / lineitem /     status code <- line number
approval_history          lineitem
leases                    orders by customer      move-in = first order date
survey_questions          events                  type <- event kind, worker alternates
                                                  between staff and vendor ids
csat                      events of kind signup   survey ids repeat (several per survey)
========================  ======================  =========================================
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobfacts import constants as K
from jobfacts.sources.codes import code_table, question_types
from jobfacts.sources.tables import read_table

# Key of one line item: (order, line number, part, supplier, ship date) is unique in the
# driver's lineitem table at every scale factor.
LINE_ITEM_KEY = ("li_order", "li_line", "li_part", "li_supp", "li_ship")


def event_kind_code(event_type: Column) -> Column:
    """Integer kind of an event (used as tracking object kind and survey question type)."""
    return (F.when(event_type == "click", 3).when(event_type == "error", 4)
            .when(event_type == "purchase", 5).when(event_type == "signup", 6)
            .when(event_type == "view", 7))


def _minutes_before(ts: Column, minutes: Column) -> Column:
    return F.timestamp_add("MINUTE", -minutes, ts)


def _survey_id(user_id: Column, event_id: Column) -> Column:
    return user_id * 10 + event_id % 4


class Roles:
    """Lazily built role DataFrames over one scale-factor directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        """Each base table is resolved once (file listing, schema) and shared by the
        roles built from it; each role still prunes its own columns at the scan."""
        if name not in self._tables:
            self._tables[name] = read_table(self.spark, self.sf_dir, name)
        return self._tables[name]

    # -- code tables -------------------------------------------------------------------
    @cached_property
    def codes(self) -> DataFrame:
        return code_table(self.spark)

    @cached_property
    def question_types(self) -> DataFrame:
        return question_types(self.spark)

    # -- jobs and their parents --------------------------------------------------------
    @cached_property
    def jobs(self) -> DataFrame:
        o = self.table("orders")
        price_floor = F.floor("o_totalprice")
        return o.select(
            F.col("o_orderkey").alias("job_id"),
            F.col("o_custkey").alias("service_request_id"),
            F.concat(F.lit("JOB-"), F.col("o_orderkey").cast("string")).alias("external_id"),
            F.when(F.col("o_orderkey") % 3 == 0, F.col("o_custkey").cast("string")).alias("assigned_staff_id"),
            F.when(F.col("o_orderkey") % 5 != 0, F.expr("o_custkey div 14").cast("string")).alias("assigned_vendor_id"),
            F.ascii("o_orderstatus").alias("status"),
            F.split_part("o_orderpriority", F.lit("-"), F.lit(1)).cast("int").alias("completed_by_type"),
            (price_floor % 481).cast("int").alias("billable_minutes"),
            F.col("o_orderpriority").alias("scope_of_work"),
            F.concat_ws("/", "o_orderstatus", "o_orderpriority").alias("summary"),
            F.col("o_orderdate").alias("created_at"),
            F.when(F.col("o_orderstatus") == "F",
                   F.timestamp_add("MINUTE", price_floor % 10000, F.col("o_orderdate"))).alias("completed_at"),
        )

    @cached_property
    def requests(self) -> DataFrame:
        c = self.table("customer")
        return c.select(
            F.col("c_custkey").alias("service_request_id"),
            F.when(F.col("c_mktsegment") != "AUTOMOBILE", F.col("c_custkey")).alias("lease_flow_id"),
            F.col("c_nationkey").alias("area_id"),
            F.when(F.col("c_acctbal") >= 0, F.col("c_nationkey")).alias("asset_id"),
            F.when(F.col("c_mktsegment") == "HOUSEHOLD", F.lit("Turnover"))
             .otherwise(F.lit(K.SERVICE_REQUEST_TYPE)).alias("request_type"),
        )

    @cached_property
    def properties(self) -> DataFrame:
        n = self.table("nation")
        return n.select(F.col("n_nationkey").alias("asset_id"), F.col("n_regionkey").alias("market_id"))

    @cached_property
    def rates(self) -> DataFrame:
        s = self.table("supplier")
        return s.groupBy(F.col("s_nationkey").alias("area_id")).agg(
            F.max("s_acctbal").cast(K.MONEY_TYPE).alias("maintenance_rate_amount"),
            F.min("s_acctbal").cast(K.MONEY_TYPE).alias("first_hour_maintenance_rate_amount"),
            (F.lit(1) + F.count(F.lit(1)) / 100).cast(K.RATE_MULTIPLE_TYPE).alias("after_hours_emergency_rate"),
        )

    @cached_property
    def vendors(self) -> DataFrame:
        s = self.table("supplier")
        return s.select(
            F.col("s_suppkey").cast("string").alias("vendor_id"),
            F.col("s_name").alias("name"),
            (F.col("s_nationkey") % 4 == 0).alias("is_in_house"),
        )

    @cached_property
    def users(self) -> DataFrame:
        c = self.table("customer")
        return c.filter(F.col("c_acctbal") >= 0).select(
            F.col("c_custkey").cast("string").alias("staff_id"), F.col("c_name").alias("name"))

    # -- child tables ------------------------------------------------------------------
    @cached_property
    def invitations(self) -> DataFrame:
        li = self.table("lineitem")
        offset = (F.col("l_partkey") % 97) * 60 + F.col("l_suppkey") % 60
        return li.select(
            F.col("l_orderkey").alias("job_id"),
            F.ascii("l_returnflag").alias("status"),
            F.ascii("l_linestatus").alias("updated_by_type"),
            (F.col("l_discount") > F.lit(0.05).cast("double")).alias("reminder_was_sent"),
            _minutes_before(F.col("l_shipdate"), offset).alias("created_at"),
            F.col("l_shipdate").alias("updated_at"),
        )

    @cached_property
    def notes(self) -> DataFrame:
        o = self.table("orders")
        return o.select(
            F.col("o_orderkey").alias("note_id"),
            F.col("o_custkey").alias("reference_id"),
            F.ascii("o_orderstatus").alias("reference_type"),
            F.split_part("o_orderpriority", F.lit("-"), F.lit(1)).cast("int").alias("created_by_type"),
        )

    @cached_property
    def note_files(self) -> DataFrame:
        li = self.table("lineitem")
        return li.select(
            F.col("l_orderkey").alias("note_id"),
            F.when(F.col("l_returnflag") != "N", F.col("l_partkey")).alias("file_id"),
        )

    @cached_property
    def scheduled_services(self) -> DataFrame:
        li = self.table("lineitem")
        return li.select(
            F.col("l_orderkey").alias("job_id"),
            F.col("l_shipdate").alias("created_at"),
            F.date_add(F.to_date("l_shipdate"), F.col("l_linenumber")).alias("scheduled_date"),
            F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("removed"),
            # tie-break columns (the job's own order key ties on equal creation times)
            F.col("l_linenumber").alias("line_number"),
            F.col("l_partkey").alias("part_key"),
            F.col("l_suppkey").alias("supplier_key"),
        )

    @cached_property
    def bridge(self) -> DataFrame:
        li = self.table("lineitem")
        return li.select(F.col("l_orderkey").alias("job_id"), *self._line_key(li))

    @cached_property
    def line_items(self) -> DataFrame:
        li = self.table("lineitem")
        return li.select(
            *self._line_key(li),
            F.col("l_suppkey").alias("invoice_id"),
            F.col("l_extendedprice").cast(K.MONEY_TYPE).alias("amount"),
        )

    @staticmethod
    def _line_key(li: DataFrame) -> list[Column]:
        cols = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")
        return [li[c].alias(a) for c, a in zip(cols, LINE_ITEM_KEY)]

    @cached_property
    def invoices(self) -> DataFrame:
        s = self.table("supplier")
        invoice_date = F.date_add(F.lit("2000-01-01").cast("date"), (F.col("s_suppkey") % 2000).cast("int"))
        return s.select(
            F.col("s_suppkey").alias("invoice_id"),
            invoice_date.alias("invoice_date"),
            F.timestamp_add("HOUR", F.col("s_nationkey"), invoice_date.cast("timestamp_ntz")).alias("created_date"),
            (F.col("s_nationkey") == 24).alias("is_voided"),
            (F.col("s_acctbal") > 0).alias("is_paid"),
            F.when(F.col("s_nationkey") != 23, F.lit(False)).alias("is_deleted"),
        )

    @cached_property
    def invoice_authors(self) -> DataFrame:
        s = self.table("supplier")
        return s.select(F.col("s_suppkey").alias("invoice_id"),
                        (F.col("s_nationkey") % 3).alias("created_by_type"))

    @cached_property
    def time_tracking(self) -> DataFrame:
        e = self.table("events")
        return e.select(
            F.col("user_id").alias("object_id"),
            event_kind_code(F.col("event_type")).alias("object_type"),
            # both ends with a fraction of their own: only whole seconds count
            F.timestamp_add("MILLISECOND", F.col("event_id") * 91 % 1000, F.col("ts")).alias("start_period"),
            F.timestamp_add("MILLISECOND", F.col("event_id") * 37 % 1000,
                            F.timestamp_add("SECOND", F.floor(F.col("value") * 60), F.col("ts"))).alias("end_period"),
        )

    @cached_property
    def approvals(self) -> DataFrame:
        o = self.table("orders")
        return o.select(F.col("o_orderkey").alias("approval_id"), F.col("o_orderkey").alias("related_entity_id"))

    @cached_property
    def approvers(self) -> DataFrame:
        li = self.table("lineitem")
        return li.filter(F.col("l_returnflag") == "A").select(
            F.col("l_orderkey").alias("approval_id"), F.col("l_suppkey").alias("approver_id"))

    @cached_property
    def approval_history(self) -> DataFrame:
        li = self.table("lineitem")
        return li.select(
            F.col("l_orderkey").alias("approval_id"),
            F.col("l_linenumber").alias("approval_status"),
            F.col("l_shipdate").alias("updated_at"),
        )

    @cached_property
    def leases(self) -> DataFrame:
        o = self.table("orders")
        return o.groupBy(F.col("o_custkey").alias("lease_flow_id")).agg(
            F.to_date(F.min("o_orderdate")).alias("move_in_date"))

    @cached_property
    def survey_questions(self) -> DataFrame:
        e = self.table("events")
        return e.select(
            _survey_id(F.col("user_id"), F.col("event_id")).alias("survey_id"),
            F.col("event_id").alias("question_id"),
            # every 11th answer names no worker
            F.when(F.col("event_id") % 11 != 0, F.when(F.col("event_id") % 2 == 0, F.col("user_id"))
                   .otherwise(F.expr("user_id div 14")).cast("string")).alias("related_entity_id"),
            event_kind_code(F.col("event_type")).alias("question_type_id"),
            ((F.floor("value") % 5) + 1).cast("string").alias("answer"),
        )

    @cached_property
    def csat(self) -> DataFrame:
        e = self.table("events")
        return e.filter(F.col("event_type") == "signup").select(
            _survey_id(F.col("user_id"), F.col("event_id")).alias("survey_id"),
            F.col("user_id").alias("related_entity_id"),
            F.col("ts").alias("surveyed_time"),
            F.col("props").alias("comment"),
        )
