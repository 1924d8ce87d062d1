"""Operators on hand-made rows: one case per semantic rule."""

from collections import Counter
from decimal import Decimal

from pyspark.sql import functions as F

from tests import oracle_roles
from jobfacts import constants as K
from jobfacts.operators import dimensions, ranges, rollups, spine as spine_ops, survey
from jobfacts.plans import fact
from tests.rolefixtures import (
    AUTH_STAFF, AUTH_SYSTEM, AUTH_VENDOR, BY_STAFF, BY_UNKNOWN, BY_VENDOR, CANCELLED, COMPLETED, INV_ACCEPTED,
    INV_PENDING, INV_REJECTED, INVAUTH_STAFF, INVAUTH_UNKNOWN, INVAUTH_VENDOR, IN_PROGRESS, REF_JOB, REF_REQUEST,
    TRACK_JOB, TRACK_TASK, UPD_STAFF, UPD_VENDOR, base_request, d, job, make_roles, money, ts,
)


def _by(df, key="job_id"):
    return {r[key]: r for r in df.collect()}


# -- spine: M-07, M-18 ---------------------------------------------------------------------
def test_spine_status_decode_and_filter(spark):
    r = make_roles(spark,
                   requests=[base_request(1)],
                   jobs=[job(1, status=COMPLETED), job(2, status=CANCELLED), job(3, status=99),
                         job(4, status=IN_PROGRESS, completed_by=BY_UNKNOWN), job(5, completed_by=BY_VENDOR)],
                   properties=[(1, 7)])
    s = _by(spine_ops.job_spine(r.requests, r.jobs, r.codes, r.properties))
    assert sorted(s) == [1, 4, 5]                     # cancelled and unknown status dropped
    assert s[1].job_status == "Completed" and s[4].job_status == "In Progress"
    assert s[1].completed_by == "Staff" and s[5].completed_by == "Vendor"
    assert s[4].completed_by is None                  # unknown completer code kept, NULL label
    assert s[1].market_id == 7
    assert s[1].created_at == ts("2024-01-10 10:00:00")   # local clock


# -- C08, C09: M-12, M-13 ----------------------------------------------------------------------
def test_worker_resolution(spark):
    r = make_roles(spark,
                   requests=[base_request(1)],
                   jobs=[job(1, staff=100, vendor=200),     # both: staff wins
                         job(2, vendor=200),                # contractor only
                         job(3),                            # none
                         job(4, staff=101, vendor=201),     # staff without user row -> NULL name
                         job(5, vendor=202)],               # in-house vendor -> fixed label
                   users=[(100, "Ann")],
                   vendors=[(200, "Acme", False), (201, "Bolt", False), (202, "Crew", True)])
    spine = spine_ops.job_spine(r.requests, r.jobs, r.codes, r.properties)
    w = _by(dimensions.worker_branch(spine, r.vendors, r.users))
    assert (w[1].worker_id, w[1].worker_type, w[1].worker_name) == ("100", K.WORKER_TYPE_STAFF, "Ann")
    assert (w[2].worker_id, w[2].worker_type, w[2].worker_name) == ("200", "Vendor", "Acme")
    assert (w[3].worker_id, w[3].worker_type, w[3].worker_name) == (None, None, None)
    assert (w[4].worker_id, w[4].worker_type, w[4].worker_name) == ("101", K.WORKER_TYPE_STAFF, None)
    assert w[5].worker_name == K.IN_HOUSE_WORKER_NAME and w[5].is_in_house_vendor is True


def test_rates_only_for_staff_completed_jobs(spark):
    r = make_roles(spark, requests=[base_request(1, area=3)],
                   jobs=[job(1, completed_by=BY_STAFF), job(2, completed_by=BY_VENDOR)],
                   rates=[(3, money(80), money(120), Decimal("1.5000"))])
    spine = spine_ops.job_spine(r.requests, r.jobs, r.codes, r.properties)
    branch = _by(dimensions.labor_rates(spine, r.rates))
    assert sorted(branch) == [1] and branch[1].maintenance_rate_amount == money(80)
    attached = _by(dimensions.attach_rates(spine, r.rates))
    assert attached[1].first_hour_maintenance_rate_amount == money(120)
    assert attached[2].maintenance_rate_amount is None


# -- C10 / C11: M-08, M-09, M-10 ----------------------------------------------------------------
def _invitation_roles(spark):
    return make_roles(spark, invitations=[
        # job 1: accepted by vendor and by staff (staff wins), also rejected
        (1, INV_ACCEPTED, UPD_VENDOR, False, ts("2024-01-01 00:00:00"), ts("2024-01-01 01:24:00")),  # 1.4 h
        (1, INV_ACCEPTED, UPD_STAFF, True, ts("2024-01-01 00:00:00"), ts("2024-01-01 01:36:00")),    # 1.6 h
        (1, INV_REJECTED, UPD_VENDOR, None, ts("2024-01-01 00:00:00"), ts("2024-01-02 00:00:00")),
        # job 2: only a pending invitation -> no branch row
        (2, INV_PENDING, UPD_VENDOR, True, ts("2024-01-01 00:00:00"), ts("2024-01-01 05:00:00")),
        # job 3: accepted with unknown updater -> dropped by the inner decode
        (3, INV_ACCEPTED, 99, True, ts("2024-01-01 00:00:00"), ts("2024-01-01 05:00:00")),
        # job 4: rejected only; reminder on a rejected row does not count
        (4, INV_REJECTED, UPD_STAFF, True, ts("2024-01-01 00:00:00"), ts("2024-01-01 05:00:00")),
    ])


def test_response_flags(spark):
    r = _invitation_roles(spark)
    got = _by(rollups.response_flags(r.invitations, r.codes))
    assert sorted(got) == [1, 4]
    g = got[1]
    assert (g.was_rejected, g.was_accepted, g.accepted_by, g.was_reminded) == (1, 1, 2, 1)
    assert g.hours_to_accept == Decimal("2")        # max(round(1.4), round(1.6)) = 2
    assert g.accepted_at == ts("2023-12-31 17:36:00")
    g = got[4]
    assert (g.was_rejected, g.was_accepted, g.accepted_by, g.was_reminded, g.hours_to_accept) == (1, 0, None, 0, None)


# -- C12: M-04 -------------------------------------------------------------------------------------
def test_note_fanout_counts(spark):
    r = make_roles(spark,
                   notes=[(10, 1, REF_JOB, AUTH_VENDOR), (11, 1, REF_JOB, AUTH_STAFF),
                          (20, 2, REF_JOB, AUTH_VENDOR),
                          (30, 3, REF_REQUEST, AUTH_VENDOR), (31, 3, REF_JOB, AUTH_SYSTEM),
                          (None, 4, REF_JOB, AUTH_VENDOR)],
                   note_files=[(10, 100), (10, 101), (10, 102), (20, None)])
    for f in (rollups.fanout_counts(r.notes, r.note_files, r.codes),):
        got = _by(f)
        assert sorted(got) == [1, 2, 4]   # job 3: wrong reference kind / author kind
        # note with 3 files counts 3 times, note with none once
        assert (got[1].total_notes, got[1].total_attachments) == (4, 3)
        assert (got[1].vendor_notes, got[1].staff_notes, got[1].vendor_attachments, got[1].staff_attachments) == \
            (3, 1, 3, 0)
        # a note whose only file row has a NULL id: one row, zero attachments (not NULL)
        assert (got[2].total_notes, got[2].total_attachments) == (1, 0)
        # a NULL note id is not counted by total_notes but is by the author count
        assert (got[4].total_notes, got[4].vendor_notes) == (0, 1)


# -- C13: M-02, M-21 -------------------------------------------------------------------------------
def test_first_schedule_nulls_last_and_tie_break(spark):
    r = make_roles(spark, scheduled_services=[
        (1, None, d("2024-02-01"), 0, 1, 1, 1),
        (1, ts("2024-01-10 10:00:00"), d("2024-02-02"), 0, 2, 1, 1),
        (2, ts("2024-01-10 10:00:00"), d("2024-03-02"), 0, 5, 1, 1),
        (2, ts("2024-01-10 10:00:00"), d("2024-03-01"), 0, 3, 1, 1),   # tie: smaller line wins
        (2, ts("2024-01-01 00:00:00"), d("2024-01-01"), 1, 1, 1, 1),   # removed
        (3, ts("2024-01-01 00:00:00"), d("2024-01-01"), None, 1, 1, 1),  # NULL removed flag drops
    ])
    got = _by(rollups.first_schedule(r.scheduled_services))
    assert sorted(got) == [1, 2]
    assert got[1].initial_scheduled_date == d("2024-02-02")
    assert got[1].initial_scheduled_created_at == ts("2024-01-10 02:00:00")
    assert got[2].initial_scheduled_date == d("2024-03-01")


# -- C14-C16: M-05, M-06 ------------------------------------------------------------------------
def _line_item_roles(spark):
    t = ts("2024-01-01 00:00:00")
    li = [(1, 1, 1, 1, t, 500, money(10)), (1, 2, 1, 1, t, 500, money(5)),     # one invoice, two lines
          (2, 1, 1, 1, t, 600, money(7)),                                        # two author kinds
          (3, 1, 1, 1, t, 700, money(9)),                                        # unpaid invoice
          (4, 1, 1, 1, t, 800, money(4)),                                        # NULL deleted flag
          (5, 1, 1, 1, t, 900, money(3))]                                        # no author row
    return make_roles(spark,
                      bridge=[(r[0], r[0], r[1], r[2], r[3], r[4]) for r in li],
                      line_items=li,
                      invoices=[(500, d("2024-01-05"), ts("2024-01-05 08:00:00"), False, True, False),
                                (600, d("2024-01-06"), ts("2024-01-06 08:00:00"), False, True, False),
                                (700, d("2024-01-07"), ts("2024-01-07 08:00:00"), False, False, False),
                                (800, d("2024-01-08"), ts("2024-01-08 08:00:00"), False, True, None),
                                (900, d("2024-01-09"), ts("2024-01-09 08:00:00"), False, True, False)],
                      invoice_authors=[(500, INVAUTH_VENDOR), (600, INVAUTH_VENDOR), (600, INVAUTH_STAFF),
                                       (600, INVAUTH_STAFF), (900, INVAUTH_UNKNOWN), (900, INVAUTH_UNKNOWN)])


def test_invoice_counts_and_amounts(spark):
    r = _line_item_roles(spark)
    items = rollups.bridge_join(r.bridge, r.line_items, r.invoices)
    assert sorted(x.job_id for x in items.collect()) == [1, 1, 2, 5]
    merged = _by(rollups.invoice_rollup(r.bridge, r.line_items, r.invoices, r.invoice_authors, r.codes))
    amounts = _by(rollups.sum_amount(items))
    assert merged[1].total_invoices == 1 and merged[1].invoice_amount == money(15)   # M-05, M-06
    assert merged[2].total_invoices == 2                                            # two author kinds
    assert (merged[2].vendor_created_invoices, merged[2].staff_created_invoices) == (1, 1)
    assert (merged[5].total_invoices, merged[5].vendor_created_invoices) == (1, 0)  # NULL kind counts once
    for j in merged:
        assert merged[j].invoice_amount == amounts[j].invoice_amount


# -- C17 ------------------------------------------------------------------------------------------
def test_logged_hours(spark):
    r = make_roles(spark, time_tracking=[
        (1, TRACK_JOB, ts("2024-01-01 00:00:00.9"), ts("2024-01-01 01:00:02.1")),
        (1, TRACK_JOB, ts("2024-01-01 02:00:00"), ts("2024-01-01 02:29:58")),
        (1, TRACK_TASK, ts("2024-01-01 00:00:00"), ts("2024-01-01 09:00:00")),
        (2, TRACK_JOB, ts("2024-01-01 00:00:00"), ts("2024-01-01 00:45:00"))])
    got = _by(rollups.logged_hours(r.time_tracking, r.codes))
    assert got[1].logged_hours == Decimal("2")     # 3602 + 1798 s = 1.5 h -> 2 (HALF_UP)
    assert got[2].logged_hours == Decimal("1")
    two_dp = _by(rollups.logged_hours(r.time_tracking, r.codes, scale=2))
    assert two_dp[1].logged_hours == Decimal("1.50") and two_dp[2].logged_hours == Decimal("0.75")


# -- C18: M-16, M-17 ------------------------------------------------------------------------------
def test_first_status_times(spark):
    r = make_roles(spark,
                   approvals=[(50, 1), (51, 1), (60, 2)],
                   approvers=[(50, 7), (50, 8), (60, 9)],        # approval 51 has no approver
                   approval_history=[(50, 1, ts("2024-01-01 01:00:00")), (50, 2, ts("2024-01-01 02:00:00")),
                                     (50, 3, ts("2024-01-01 03:00:00")), (50, 4, ts("2024-01-01 00:30:00")),
                                     (51, 1, ts("2023-01-01 00:00:00")), (60, 4, ts("2024-01-01 00:00:00"))])
    jobs = make_roles(spark, jobs=[job(1), job(2, status=CANCELLED)]).jobs
    for got in (_by(rollups.first_status_times(r.approvals, r.approvers, r.approval_history)),
                _by(rollups.first_status_times(r.approvals, r.approvers, r.approval_history, jobs=jobs))):
        assert got[1].authorization_requested == ts("2024-01-01 01:00:00")
        assert got[1].authorization_approved == ts("2024-01-01 02:00:00")
        assert got[2].authorization_requested is None and got[2].authorization_approved is None


# -- C19: M-14 -------------------------------------------------------------------------------------
def test_move_in_window_inclusive_to_midnight(spark):
    r = make_roles(spark,
                   requests=[base_request(1, lease=9), base_request(2, lease=9, request_type="Turnover")],
                   jobs=[job(1, created="2024-01-31 08:00:00"),      # 00:00:00 local on day 30 -> in
                         job(2, created="2024-01-31 08:00:01"),      # one second later -> out
                         job(3, created="2023-12-31 08:00:00"),      # before move-in -> out
                         job(4, request=2, created="2024-01-10 08:00:00")],  # other request type
                   leases=[(9, d("2024-01-01"))])
    spine = spine_ops.job_spine(r.requests, r.jobs, r.codes, r.properties)
    matches = ranges.move_in_matches(spine, r.leases, K.SERVICE_REQUEST_TYPE, 30)
    assert sorted(x.job_id for x in matches.collect()) == [1]
    flag = ranges.move_in_flag(spine_ops.local_jobs(r.jobs), r.requests, r.leases, K.SERVICE_REQUEST_TYPE, 30)
    assert sorted(x.job_id for x in flag.collect()) == [1]


# -- C20 / C21: M-01, M-02 -----------------------------------------------------------------------
def _survey_roles(spark, csat):
    # question rows: (survey, question, worker, type, answer)
    return make_roles(spark, survey_questions=[
        (7, 1, 40, 3, "5"), (7, 2, 40, 4, "4"), (7, 3, 40, 7, "3"),
        (8, 4, 41, 3, "2"), (8, 5, 41, 5, "1")], csat=csat)


def test_latest_flag_survives_dedupe(spark):
    r = _survey_roles(spark, [(7, 1, ts("2024-01-01 10:00:00"), "ok"), (8, 1, None, "null time")])
    rows = survey.rating_rows(r.survey_questions, r.question_types, r.csat)
    out = survey.latest_flag_with_dedupe(rows)
    assert Counter(tuple(x[c] for c in [*survey._DETAIL, "latest_survey"]) for x in out.collect()) == oracle_roles.flagged(r)
    flagged = [(x.survey_id, x.question_id) for x in out.filter("latest_survey").collect()]
    # three questions of one survey tie on time: the lowest question id is flagged; the
    # NULL-time survey counts as latest for its worker (DESC puts NULL first)
    assert sorted(flagged) == [(7, 1), (8, 4)]
    assert out.filter("survey_id = 8").count() == 1        # type 5 is not a rating question


def test_rows_of_an_unknown_worker_form_a_group(spark):
    r = make_roles(spark, survey_questions=[(7, 1, None, 3, "5"), (7, 2, None, 4, "4"), (8, 3, 40, 3, "3")],
                   csat=[(7, 1, ts("2024-01-01 10:00:00"), "a"), (8, 1, ts("2024-01-02 10:00:00"), "b")])
    out = survey.latest_flag_with_dedupe(survey.rating_rows(r.survey_questions, r.question_types, r.csat))
    assert {x.question_id: x.latest_survey for x in out.collect()} == {1: True, 2: False, 3: True}
    assert Counter(tuple(x[c] for c in [*survey._DETAIL, "latest_survey"]) for x in out.collect()) == oracle_roles.flagged(r)


def test_flagged_row_removed_by_dedupe(spark):
    # M-01: survey id 7 appears twice in csat (times 5 and 9); the newer row is flagged, but the
    # dedupe (lowest question id, then the newer time) keeps... a different copy of the pair
    r = make_roles(spark, survey_questions=[(7, 1, 40, 3, "5")],
                   csat=[(7, 1, ts("2024-01-01 05:00:00"), "old"), (7, 1, ts("2024-01-01 09:00:00"), "new")])
    rows = survey.rating_rows(r.survey_questions, r.question_types, r.csat)
    older_first = [F.col("question_id"), F.col("survey_created_at")]
    out = survey.latest_flag_with_dedupe(rows, dedupe=older_first)
    kept = out.collect()
    assert len(kept) == 1 and kept[0].vendor_tech_csat_comment == "old" and kept[0].latest_survey is False
    # with the default tie-break the newer copy survives and stays flagged
    kept = survey.latest_flag_with_dedupe(rows).collect()
    assert len(kept) == 1 and kept[0].vendor_tech_csat_comment == "new" and kept[0].latest_survey is True


def test_two_key_latest_join(spark):
    r = _survey_roles(spark, [(7, 1, ts("2024-01-01 10:00:00"), "ok"), (8, 1, ts("2024-01-02 10:00:00"), "x")])
    ratings = survey.latest_ratings(survey.rating_rows(r.survey_questions, r.question_types, r.csat))
    workers = spark.createDataFrame([(100, 1, "40"), (101, 1, "41"), (102, 1, "42"), (103, 2, "40")],
                                    "job_id long, service_request_id long, worker_id string")
    got = _by(survey.two_key_latest_join(workers, ratings))
    assert sorted(got) == [100, 101]
    assert (got[100].survey_id, got[100].question_id, got[100].vendor_or_tech_rating) == (7, 1, "5")
    assert got[101].survey_id == 8


# -- C22-C24: defaults and the assembled fact -----------------------------------------------------
def test_fact_defaults_for_job_without_children(spark):
    r = make_roles(spark, requests=[base_request(1)], jobs=[job(1, vendor=200, completed_by=BY_VENDOR)])
    rows = fact.job_fact(r).collect()
    assert len(rows) == 1
    x = rows[0]
    for c in ("total_notes", "vendor_notes", "total_attachments", "invoice_amount", "total_invoices",
              "vendor_created_invoices", "logged_hours", "hours_to_accept_invitation", "survey_id"):
        assert x[c] is None, c
    assert (x.invitation_rejected, x.invitation_accepted, x.invitation_reminded) == (False, False, False)
    assert x.job_within_30_move_in == 0 and x.invitation_accepted_by is None
    assert len(fact.job_fact(r).columns) == 55


def test_in_house_market(spark):
    r = make_roles(spark, requests=[base_request(1, asset=3)], properties=[(3, 44)],
                   jobs=[job(1, staff=100), job(2, staff=100, status=IN_PROGRESS), job(3, vendor=200)])
    got = _by(fact.job_fact(r))
    assert got[1].in_house_market == 44
    assert got[2].in_house_market is None and got[3].in_house_market is None


def test_fact_on_hand_rows(spark):
    r = make_roles(
        spark,
        requests=[base_request(1, lease=9)],
        jobs=[job(1, staff=40, created="2024-01-05 08:00:00", completed="2024-01-06 08:00:00"),
              job(2, vendor=41, completed_by=BY_VENDOR), job(3, status=CANCELLED)],
        leases=[(9, d("2024-01-01"))],
        invitations=[(1, INV_ACCEPTED, UPD_STAFF, True, ts("2024-01-05 00:00:00"), ts("2024-01-05 03:00:00")),
                     (3, INV_ACCEPTED, UPD_STAFF, True, ts("2024-01-05 00:00:00"), ts("2024-01-05 03:00:00"))],
        scheduled_services=[(1, ts("2024-01-05 04:00:00"), d("2024-01-07"), 0, 1, 1, 1)],
        survey_questions=[(7, 1, 40, 3, "5")],
        csat=[(7, 1, ts("2024-01-08 00:00:00"), "great")],
        notes=[(10, 2, REF_JOB, AUTH_VENDOR)], note_files=[(10, 5), (10, 6)])
    a = fact.job_fact(r).collect()
    assert len(a) == 2 and Counter(map(tuple, a)) == oracle_roles.facts(r)
    a = {x.job_id: x for x in a}
    one = a[1]
    assert one.survey_id == 7 and one.job_within_30_move_in == 1
    assert one.hours_to_schedule_work == Decimal("53.000000")      # 2024-01-04 19:00 local -> 2024-01-07 00:00
    assert a[2].total_notes == 2
