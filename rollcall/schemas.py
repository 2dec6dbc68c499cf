"""Explicit schemas for every input (no inference anywhere).

Codes and ids that are not compared as numbers are text: a course code such
as ``"0042"`` must keep its leading zeros.
"""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType, BooleanType, LongType, StringType, StructField, StructType,
    TimestampType,
)


def _s(*fields) -> StructType:
    return StructType([StructField(n, t, True) for n, t in fields])


PERSON = _s(("Email", StringType()), ("FirstName", StringType()), ("LastName", StringType()))

STUDENT = _s(("StudentID", StringType()), ("CustomerID", StringType()), ("Person", PERSON))

COURSE = _s(("CourseName", StringType()), ("IsOnline", BooleanType()))

SCHEDULED_EVENT = _s(("EventCd", StringType()), ("Course", COURSE))

# Enrollment feed: one record per enrollment event, nested event and list of
# students.
FEED = _s(
    ("EventEnrollmentID", LongType()),
    ("EnrollmentStatusCd", StringType()),
    ("CreatedDate", TimestampType()),
    ("ScheduledEvent", SCHEDULED_EVENT),
    ("Students", ArrayType(STUDENT)),
)

# Course catalogue: courses with a list of course groups.
COURSE_GROUP = _s(("GroupCd", StringType()), ("GroupName", StringType()))
CATALOGUE = _s(
    ("CourseCd", StringType()),
    ("CourseName", StringType()),
    ("IsOnline", BooleanType()),
    ("CourseGroups", ArrayType(COURSE_GROUP)),
)

# Canonical flat feed row used by every sync operator (see operators.feed).
FEED_ROW_COLUMNS = [
    "event_id", "pos", "status", "created", "course_code", "course_name",
    "is_online", "student_id", "customer_id", "email", "first_name", "last_name",
]

# LMS snapshots
TERM = _s(("sis_term_id", StringType()))
COURSES = _s(
    ("course_id", LongType()), ("sis_course_id", StringType()), ("name", StringType()),
    ("course_code", StringType()), ("account_id", LongType()),
    ("enrollment_term_id", LongType()), ("total_students", LongType()),
    ("workflow_state", StringType()), ("restrict_student_future_view", BooleanType()),
    ("term", TERM),
)
ACCOUNTS = _s(("account_id", LongType()), ("subaccount_name", StringType()))
TERMS = _s(("enrollment_term_id", LongType()), ("sis_term_id", StringType()),
           ("enrollment_name", StringType()))
USERS = _s(
    ("id", LongType()), ("name", StringType()), ("short_name", StringType()),
    ("sortable_name", StringType()), ("login_id", StringType()),
    ("sis_user_id", StringType()), ("last_login", StringType()),
    ("primary_email", StringType()),
)
LOGINS = _s(("user_id", LongType()), ("unique_id", StringType()))
ENROLLMENTS = _s(
    ("id", LongType()), ("course_id", LongType()), ("sis_course_id", StringType()),
    ("user_id", LongType()), ("type", StringType()), ("role", StringType()),
    ("role_id", LongType()), ("enrollment_state", StringType()),
)
ROLES = _s(("id", LongType()), ("label", StringType()), ("role", StringType()),
           ("base_role_type", StringType()))
GROUP_MEMBERS = _s(("id", LongType()), ("name", StringType()), ("login_id", StringType()))
CONTENT = _s(("course_id", LongType()), ("item_id", LongType()), ("body", StringType()))

# Mapping and state files (all text unless noted)
SKIP_LIST = _s(("CourseCode", StringType()))
LEDGER = _s(("Email", StringType()))
WATERMARK = _s(("EventEnrollmentID", LongType()))
RECODE_MAP = _s(("currentcoursecode", StringType()), ("coursecodenew", StringType()))
RENAME_MAP = _s(("id", LongType()), ("NewShortName", StringType()), ("New name", StringType()))
DUPLICATE_REQUEST = _s(("NewSIS_ID", StringType()), ("CurrentSIS_ID", StringType()),
                       ("CourseName", StringType()))
COPY_REQUEST = _s(("NewSIS_ID", StringType()), ("CurrentSIS_ID", StringType()),
                  ("SubAccount", StringType()))
TEMPLATE_REQUEST = _s(("CourseName", StringType()), ("NewSIS_ID", StringType()),
                      ("Email", StringType()), ("Template", StringType()),
                      ("SubAccount", StringType()))
CLASS_REQUEST = _s(("EMAIL", StringType()), ("CourseName", StringType()),
                   ("COURSECODE", StringType()), ("TEMPLATE", StringType()))

MAPPINGS = {
    "skip_list": SKIP_LIST, "ledger": LEDGER, "watermark": WATERMARK,
    "recode_map": RECODE_MAP, "rename_map": RENAME_MAP,
    "duplicate_request": DUPLICATE_REQUEST, "copy_request": COPY_REQUEST,
    "template_request": TEMPLATE_REQUEST, "class_request": CLASS_REQUEST,
}

SNAPSHOTS = {
    "courses": COURSES, "accounts": ACCOUNTS, "terms": TERMS, "users": USERS,
    "logins": LOGINS, "enrollments": ENROLLMENTS, "roles": ROLES,
    "group_members": GROUP_MEMBERS, "content": CONTENT,
}
