"""Per-job rollups of child tables (C10-C18): the job-keyed branches of the fact.

Every branch is *child -> aggregate by job*; the fact joins each one to the spine with a
LEFT join.  Because the spine is unique on ``job_id``, filtering children through the
spine first (the modelled job's form) changes nothing after that LEFT join, so the
branches skip it: no extra shuffle of the spine per branch, and every branch leaves its
final aggregate hash-partitioned by ``job_id``, which the sort-merge joins of the
assembly reuse without a new exchange.

Skew: every rollup is an aggregation, so a job holding a third of all child rows is
combined map-side (partial aggregate) before it is shuffled.  Where the job's SQL fans
rows out before aggregating (notes x files, approvers x history, line items x invoice
authors), the fan-out side is pre-aggregated to one row per join key first, so no hot
key is multiplied.  ``first_per_key`` uses ``row_number() = 1``, which Spark plans as a
partial ``WindowGroupLimit`` before the shuffle: a hot job ships one row per map task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobfacts import constants as K
from jobfacts.functions.codes import code_slice, decode
from jobfacts.functions.flags import flag01
from jobfacts.functions.timeops import epoch_seconds, hours_from_seconds, to_local_time
from jobfacts.operators.hotkeys import NO_SPLIT, Split, split_join
from jobfacts.sources.roles import LINE_ITEM_KEY

INVOICE_COLUMNS = ("vendor_created_invoices", "staff_created_invoices", "total_invoices",
                   "first_invoice_date", "first_invoice_created_at", "last_invoice_date",
                   "last_invoice_created_at")


# -- C10 / C11: invitation response flags ---------------------------------------------
def _decoded_invitations(invitations: DataFrame, codes: DataFrame) -> DataFrame:
    status = code_slice(codes, K.NS_INVITATION_STATUS, "status", "status_name")
    updater = code_slice(codes, K.NS_INVITATION_UPDATER, "updated_by_type", "updater_kind")
    inv = decode(invitations, status, "status", how="inner")
    inv = decode(inv, updater, "updated_by_type", how="inner")
    return inv.filter(F.col("status_name").isin(K.INVITATION_REJECTED, K.INVITATION_ACCEPTED))


def _invitation_measures() -> dict[str, Column]:
    accepted = F.col("status_name") == F.lit(K.INVITATION_ACCEPTED)
    return {
        "was_rejected": flag01(F.col("status_name") == F.lit(K.INVITATION_REJECTED)),
        "was_accepted": flag01(accepted),
        "accepted_by": (F.when(accepted & (F.col("updater_kind") == K.KIND_VENDOR), F.lit(K.ACCEPTED_BY_VENDOR_RANK))
                         .when(accepted & (F.col("updater_kind") == K.KIND_STAFF), F.lit(K.ACCEPTED_BY_STAFF_RANK))),
        "was_reminded": flag01((F.col("reminder_was_sent") == F.lit(True)) & accepted),
        # whole-second difference; turned into rounded hours after the MAX (see below)
        "hours_to_accept": F.when(accepted, epoch_seconds(F.col("updated_at")) - epoch_seconds(F.col("created_at"))),
        "accepted_at": F.when(accepted, to_local_time(F.col("updated_at"))),
    }


def response_flags(invitations: DataFrame, codes: DataFrame) -> DataFrame:
    """One row per job: rejected / accepted / accepted-by / reminded / hours / time.

    Every output of the job's window form is a maximum over all of the job's rows, so
    which row its dedupe keeps is irrelevant; a grouped MAX is the same result.
    """
    inv = _decoded_invitations(invitations, codes)
    agg = inv.groupBy("job_id").agg(*[F.max(c).alias(n) for n, c in _invitation_measures().items()])
    return agg.withColumn("hours_to_accept", _to_whole_hours(F.col("hours_to_accept")))


def response_flags_windowed(invitations: DataFrame, codes: DataFrame) -> DataFrame:
    """The same relation as the job writes it (C11): each measure a maximum over the job's whole
    window, on every row, then one row a job, the last updated.  Kept to hold ``response_flags``
    against; it sorts every invitation and gathers a job's rows in one task."""
    whole, latest = Window.partitionBy("job_id"), Window.partitionBy("job_id").orderBy(F.col("updated_at").desc_nulls_first())
    inv = _decoded_invitations(invitations, codes)
    marked = inv.select("job_id", *[F.max(c).over(whole).alias(n) for n, c in _invitation_measures().items()],
                        F.row_number().over(latest).alias("_rn"))
    return marked.filter(F.col("_rn") == 1).drop("_rn").withColumn("hours_to_accept", _to_whole_hours(F.col("hours_to_accept")))


def _to_whole_hours(seconds: Column) -> Column:
    """Rounding to whole hours is monotone, so the MAX of rounded per-row hours equals the
    rounded MAX of the seconds: the decimal division runs once per job, not per row."""
    return hours_from_seconds(seconds, scale=0)


# -- C12: note and attachment counts ----------------------------------------------------
def _job_notes(notes: DataFrame, codes: DataFrame) -> DataFrame:
    ref = code_slice(codes, K.NS_NOTE_REFERENCE, "reference_type", "reference_kind")
    author = code_slice(codes, K.NS_NOTE_AUTHOR, "created_by_type", "author_kind")
    n = decode(notes, ref, "reference_type", how="inner")
    n = decode(n, author, "created_by_type", how="inner")
    return n.filter((F.col("reference_kind") == K.KIND_JOB)
                    & F.col("author_kind").isin(K.KIND_VENDOR, K.KIND_STAFF))


def fanout_counts(notes: DataFrame, note_files: DataFrame, codes: DataFrame) -> DataFrame:
    """Note and attachment counts per job, with the job's note x file fan-out.

    The job LEFT joins notes to files and counts rows, so a note with k files counts k
    times (once if it has none).  The same numbers come from counting file rows per
    note first -- a pre-aggregation that keeps a note with many files from being
    multiplied across the network -- and weighting each note by ``max(k, 1)``.
    """
    return note_counts(job_notes(notes, note_files, codes))


def job_notes(notes: DataFrame, note_files: DataFrame, codes: DataFrame) -> DataFrame:
    """The jobs' notes by vendors and staff: job_id, note_id, author_kind, rows (as often as the
    note counts) and files."""
    per_note = note_files.groupBy("note_id").agg(
        F.count(F.lit(1)).alias("_file_rows"), F.count("file_id").alias("_files"))
    n = _job_notes(notes, codes).join(per_note, on="note_id", how="left")
    return n.select(F.col("reference_id").alias("job_id"), "note_id", "author_kind",
                    F.greatest(F.coalesce("_file_rows", F.lit(0)), F.lit(1)).alias("rows"),
                    F.coalesce("_files", F.lit(0)).alias("files"))


def note_counts(notes: DataFrame) -> DataFrame:
    """One row per job from ``job_notes``."""
    rows, files = F.col("rows"), F.col("files")
    vendor = F.col("author_kind") == K.KIND_VENDOR
    staff = F.col("author_kind") == K.KIND_STAFF
    return notes.groupBy("job_id").agg(
        F.sum(F.when(vendor, rows).otherwise(0)).alias("vendor_notes"),
        F.sum(F.when(staff, rows).otherwise(0)).alias("staff_notes"),
        F.sum(F.when(vendor, files).otherwise(0)).alias("vendor_attachments"),
        F.sum(F.when(staff, files).otherwise(0)).alias("staff_attachments"),
        F.sum(F.when(F.col("note_id").isNotNull(), rows).otherwise(0)).alias("total_notes"),
        F.sum(files).alias("total_attachments"),
    )


# -- C13: first row per key -------------------------------------------------------------
def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key group under ``order`` (ties must be broken in ``order``).

    ``row_number() = 1`` is planned with a partial ``WindowGroupLimit`` below the shuffle,
    so each map task sends at most one row per key.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


SCHEDULE_TIE_BREAK = ("line_number", "part_key", "supplier_key")


def first_schedule(scheduled: DataFrame, tie_break: Sequence[str] = SCHEDULE_TIE_BREAK) -> DataFrame:
    """The earliest live schedule row per job: its local creation time and date.

    Earliest = ``created_at`` ascending with NULLs last; equal times are broken by
    ``tie_break`` (the job leaves them arbitrary).
    """
    s = scheduled.filter(F.col("removed") == 0)
    order = [F.col("created_at").asc_nulls_last(), *[F.col(c).asc_nulls_last() for c in tie_break]]
    first = first_per_key(s, ["job_id"], order)
    return first.select("job_id",
                        to_local_time(F.col("created_at")).alias("initial_scheduled_created_at"),
                        F.col("scheduled_date").alias("initial_scheduled_date"))


# -- C14-C16: line items, invoice counts and amounts ----------------------------------
def bridge_join(bridge: DataFrame, line_items: DataFrame, invoices: DataFrame, carry: Sequence[str] = (),
                splits: Mapping[str, Split] = {}, key: Sequence[str] = LINE_ITEM_KEY) -> DataFrame:
    """Line items of each job with their (live, paid) invoice (C14) and its columns ``carry``.

    A NULL invoice flag fails the equality and drops the row, as in the job.  An invoice with a
    large share of all items is split by the items' ``key``, which the bridge shares.
    """
    live = invoices.filter((F.col("is_voided") == F.lit(False)) & (F.col("is_paid") == F.lit(True))
                           & (F.col("is_deleted") == F.lit(False)))
    # the invoice lookup first: it filters, and as a dimension it is usually broadcast,
    # so the line-item stream shrinks before the bridge join shuffles it
    items = split_join(line_items, live.select("invoice_id", "invoice_date", "created_date", *carry), ["invoice_id"],
                       left_split=splits.get("item_invoice", NO_SPLIT), by=key)
    items = bridge.join(items, on=list(key), how="inner")
    return items.select("job_id", "amount", "invoice_id", "invoice_date",
                        F.col("created_date").alias("created_at"), *carry)


def _invoice_authors(invoice_authors: DataFrame, codes: DataFrame) -> DataFrame:
    author = code_slice(codes, K.NS_INVOICE_AUTHOR, "created_by_type", "author_kind")
    return decode(invoice_authors, author, "created_by_type", how="left").select("invoice_id", "author_kind")


def _invoice_aggregates(count_weight: Column, vendor: Column, staff: Column) -> list[Column]:
    return [
        F.sum(vendor).alias("vendor_created_invoices"),
        F.sum(staff).alias("staff_created_invoices"),
        F.sum(count_weight).alias("total_invoices"),
        F.min("invoice_date").alias("first_invoice_date"),
        F.min("created_at").alias("first_invoice_created_at"),
        F.max("invoice_date").alias("last_invoice_date"),
        F.max("created_at").alias("last_invoice_created_at"),
    ]


def sum_amount(line_items: DataFrame) -> DataFrame:
    """Invoice amount per job: the sum over all line items."""
    return line_items.groupBy("job_id").agg(F.sum("amount").cast(K.MONEY_SUM_TYPE).alias("invoice_amount"))


AUTHOR_COLUMNS = ("_kinds", "_vendor", "_staff")


def with_authors(invoices: DataFrame, invoice_authors: DataFrame, codes: DataFrame) -> DataFrame:
    """Invoices with the number of their distinct author kinds (a NULL kind, or no author,
    counts as one) and whether a vendor and a staff member are among them.  The kinds of an
    invoice are a set of code names, so it stays small however many authors there are."""
    kind = F.col("author_kind")
    per_invoice = _invoice_authors(invoice_authors, codes).groupBy("invoice_id").agg(
        (F.size(F.collect_set(kind)) + F.max(flag01(kind.isNull()))).cast("bigint").alias("_kinds"),
        F.max(flag01(kind == K.KIND_VENDOR)).cast("bigint").alias("_vendor"),
        F.max(flag01(kind == K.KIND_STAFF)).cast("bigint").alias("_staff"))
    return invoices.join(per_invoice, on="invoice_id", how="left").fillna({"_kinds": 1, "_vendor": 0, "_staff": 0})


def job_line_items(bridge: DataFrame, line_items: DataFrame, invoices: DataFrame, invoice_authors: DataFrame, codes: DataFrame,
                   splits: Mapping[str, Split] = {}, key: Sequence[str] = LINE_ITEM_KEY) -> DataFrame:
    """Line items by job with what the invoice branch needs of their invoice."""
    return bridge_join(bridge, line_items, with_authors(invoices, invoice_authors, codes), AUTHOR_COLUMNS, splits, key)


def invoice_rollup(bridge: DataFrame, line_items: DataFrame, invoices: DataFrame, invoice_authors: DataFrame,
                   codes: DataFrame, splits: Mapping[str, Split] = {}, key: Sequence[str] = LINE_ITEM_KEY) -> DataFrame:
    """Amount and invoice counts in one pass over the line items (C15 + C16 merged).

    Author kinds are facts of the invoice, so they ride along with the one invoice look-up
    that the line items need anyway.  Line items then shrink to one row per (job, invoice,
    dates) with the summed amount, and these to one per job: adding up ``_kinds`` is the
    count of distinct (job, invoice, dates, kind), and every line item's amount is summed
    once, as in the separate amount branch.
    """
    return invoice_totals(job_line_items(bridge, line_items, invoices, invoice_authors, codes, splits, key))


def invoice_totals(rows: DataFrame) -> DataFrame:
    """One row per job from ``job_line_items``."""
    return totals_per_job(items_per_invoice(rows))


def items_per_invoice(rows: DataFrame) -> DataFrame:
    """One row per (job, invoice, dates): the summed amount and the invoice's author kinds."""
    return rows.groupBy("job_id", "invoice_id", "invoice_date", "created_at").agg(
        F.sum("amount").alias("_amount"), *[F.max(c).alias(c) for c in AUTHOR_COLUMNS])


def totals_per_job(per_invoice: DataFrame) -> DataFrame:
    return per_invoice.groupBy("job_id").agg(
        F.sum("_amount").cast(K.MONEY_SUM_TYPE).alias("invoice_amount"),
        *_invoice_aggregates(F.col("_kinds"), F.col("_vendor"), F.col("_staff")),
    )


# -- C17: logged hours --------------------------------------------------------------------
def logged_hours(time_tracking: DataFrame, codes: DataFrame, scale: int = 0) -> DataFrame:
    """Hours logged against each job, summed exactly and rounded to ``scale`` (C17).

    Only entries whose object kind is the job kind count (the decode is the filter).
    Seconds are summed as integers and divided once, so the total is exact.
    """
    return hours_per_job(job_seconds(time_tracking, codes), scale)


def job_seconds(time_tracking: DataFrame, codes: DataFrame) -> DataFrame:
    """The jobs' time entries: job_id and whole seconds."""
    kind = code_slice(codes, K.NS_TRACKING_OBJECT, "object_type", "object_kind", code_name=K.KIND_JOB)
    tt = decode(time_tracking, kind, "object_type", how="inner")
    return tt.select(F.col("object_id").alias("job_id"),
                     (epoch_seconds(F.col("end_period")) - epoch_seconds(F.col("start_period"))).alias("seconds"))


def hours_per_job(entries: DataFrame, scale: int = 0) -> DataFrame:
    """One row per job from ``job_seconds``."""
    agg = entries.groupBy("job_id").agg(F.sum("seconds").alias("_seconds"))
    return agg.select("job_id", hours_from_seconds(F.col("_seconds"), scale).alias("logged_hours"))


# -- C18: first approval status times -------------------------------------------------
def first_status_times(approvals: DataFrame, approvers: DataFrame, history: DataFrame,
                       jobs: DataFrame | None = None) -> DataFrame:
    """Earliest 'requested' and 'approved' status times per job.

    Approver and history rows are reduced together, one row per approval, before they meet the
    approvals: one shuffle for both.  An approval counts if it has a row of each kind, as the
    job's inner joins ask; MIN ignores duplicates, so the approver x history fan-out is never
    built.
    """
    return status_times_per_job(job_approvals(approvals, approvers, history, jobs))


def job_approvals(approvals: DataFrame, approvers: DataFrame, history: DataFrame, jobs: DataFrame | None = None) -> DataFrame:
    """Approvals with an approver and a history: job_id and their earliest times."""
    status, at = F.col("approval_status"), F.col("updated_at")
    known = history.select("approval_id", F.lit(1).alias("_history"), F.lit(None).cast("int").alias("_approver"),
                           F.when(status.isin(*K.APPROVAL_REQUESTED_CODES), at).alias("_requested"),
                           F.when(status.isin(*K.APPROVAL_APPROVED_CODES), at).alias("_approved"))
    time = known.schema["_requested"].dataType
    known = known.unionByName(approvers.select("approval_id", F.lit(None).cast("int").alias("_history"), F.lit(1).alias("_approver"),
                                               F.lit(None).cast(time).alias("_requested"), F.lit(None).cast(time).alias("_approved")))
    per_approval = known.where("approval_id IS NOT NULL").groupBy("approval_id").agg(
        *[F.max(c).alias(c) for c in ("_history", "_approver")], *[F.min(c).alias(c) for c in ("_requested", "_approved")])
    per_approval = per_approval.where("_history = 1 AND _approver = 1").select("approval_id", "_requested", "_approved")
    a = approvals
    if jobs is not None:
        a = a.join(jobs.select(F.col("job_id").alias("related_entity_id")), on="related_entity_id", how="left_semi")
    return a.join(per_approval, on="approval_id", how="inner").select(
        F.col("related_entity_id").alias("job_id"), "_requested", "_approved")


def status_times_per_job(times: DataFrame) -> DataFrame:
    """One row per job from ``job_approvals``."""
    return times.groupBy("job_id").agg(F.min("_requested").alias("authorization_requested"),
                                       F.min("_approved").alias("authorization_approved"))
