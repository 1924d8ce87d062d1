"""Names and literals shared by the whole library.

The block marked FIXED VALUES holds values that must equal those of the modelled job for
its results to be right.  Everything else here is a naming choice of this library.
"""

# ---------------------------------------------------------------------------------------
# FIXED VALUES (must equal the modelled job's literals; listed in natural order)
# ---------------------------------------------------------------------------------------
# Job statuses dropped from the spine (compared on the raw code name).
EXCLUDED_JOB_STATUSES = ("CANCELLED", "REMOVED")
# Invitation statuses that take part in the response flags.
INVITATION_REJECTED = "REJECTED"
INVITATION_ACCEPTED = "ACCEPTED"
# Status label compared after normalisation (INITCAP of the code name).
COMPLETED_LABEL = "Completed"
# Request type whose jobs are checked against the move-in window, and the window length.
SERVICE_REQUEST_TYPE = "Service Request"
MOVE_IN_WINDOW_DAYS = 30
# Survey question types that rate the vendor or technician.
RATING_QUESTION_TYPES = (3, 4, 7)
# Approval status codes (literals, not decoded): requested, then approved.
APPROVAL_REQUESTED_CODES = (1,)
APPROVAL_APPROVED_CODES = (2, 3)
# Ranks used to pick who accepted an invitation: the higher rank wins (staff over vendor).
ACCEPTED_BY_VENDOR_RANK = 1
ACCEPTED_BY_STAFF_RANK = 2
# Time zones of the local-time conversion (source clock -> business clock).
SOURCE_TZ = "UTC"
LOCAL_TZ = "America/Los_Angeles"
# Worker-type and worker-name labels.
WORKER_TYPE_STAFF = "Service Tech"
IN_HOUSE_WORKER_NAME = "Service Tech"
# ---------------------------------------------------------------------------------------

# Code-table namespaces (one per enumeration sliced out of the shared code table).
NS_JOB_STATUS = "jobs.JobStatus"
NS_COMPLETED_BY = "jobs.CompletedByKind"
NS_INVITATION_STATUS = "jobs.InvitationStatus"
NS_INVITATION_UPDATER = "jobs.InvitationUpdaterKind"
NS_NOTE_REFERENCE = "notes.ReferenceKind"
NS_NOTE_AUTHOR = "notes.AuthorKind"
NS_INVOICE_AUTHOR = "invoices.AuthorKind"
NS_TRACKING_OBJECT = "tracking.ObjectKind"

# Code names compared by the job (neutral spellings of the actor kinds).
KIND_STAFF = "STAFF"
KIND_VENDOR = "VENDOR"
KIND_JOB = "JOB"

# Output labels of this library.
LABEL_STAFF = "Staff"
LABEL_VENDOR = "Vendor"
WORKER_TYPE_VENDOR = "Vendor"

# Decimal types of the derived measures.
WHOLE_HOURS_TYPE = "decimal(18,0)"
BILLABLE_HOURS_TYPE = "decimal(18,2)"
ELAPSED_HOURS_TYPE = "decimal(18,6)"
MONEY_TYPE = "decimal(18,2)"
MONEY_SUM_TYPE = "decimal(38,2)"
RATE_MULTIPLE_TYPE = "decimal(9,4)"
