"""Column expressions used across the jobs.  All are built-in Spark
functions (JVM side, inside whole-stage codegen); no Python UDF."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the domain (they must equal the reference's for the same
# results):
#   status that removes an enrollment:      DROPPED
#   enrollment type of a student:           StudentEnrollment
#   enrollment states that count as enrolled: active, invited
#   role id given to a transition specialist TA: 16
#   null text for a user who never logged in: no last login
#   null text for a course without teacher:   No Teacher in Class
#   date window asked of the feed: 1 week back, 16 weeks ahead
DROPPED = "DROPPED"
STUDENT_ENROLLMENT = "StudentEnrollment"
TEACHER_ENROLLMENT = "TeacherEnrollment"
TA_ENROLLMENT = "TaEnrollment"
ENROLLED_STATES = ("active", "invited")
TRANSITION_ROLE_ID = 16
NO_LAST_LOGIN = "no last login"
NO_TEACHER = "No Teacher in Class"
WINDOW_DAYS_BACK = 7
WINDOW_DAYS_AHEAD = 16 * 7

# ISO-8601 with an offset written as Z, +hh:mm or +hhmm.
ISO_WITH_OFFSET = "yyyy-MM-dd'T'HH:mm:ss[XXX][XX]"
# Heading time of a run report, e.g. "09:05AM on March 02, 2024".
REPORT_TIME = "hh:mma 'on' MMMM dd, yyyy"


def email_key(c) -> Column:
    """Case-insensitive e-mail key; blank text becomes null."""
    c = F.col(c) if isinstance(c, str) else c
    t = F.lower(F.trim(c))
    return F.when(t == "", F.lit(None)).otherwise(t)


def is_blank(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return c.isNull() | (F.trim(c) == "")


def full_name(first, last) -> Column:
    """'First Last' (null if either part is null, as text concatenation)."""
    return F.concat(F.col(first), F.lit(" "), F.col(last))


def sortable_name(first, last) -> Column:
    """'Last, First'."""
    return F.concat(F.col(last), F.lit(", "), F.col(first))


def parse_iso(c, lenient: bool = True) -> Column:
    """ISO-8601 text with offset -> timestamp.  Lenient form gives null for
    malformed text; strict form raises under ANSI mode."""
    c = F.col(c) if isinstance(c, str) else c
    fmt = F.lit(ISO_WITH_OFFSET)
    return F.try_to_timestamp(c, fmt) if lenient else F.to_timestamp(c, ISO_WITH_OFFSET)


def utc_text(ts, fmt: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """An instant written as UTC wall-clock text, whatever the session time
    zone (date_format alone renders in the session zone)."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.date_format(F.convert_timezone(F.current_timezone(), F.lit("UTC"), ts.cast("timestamp_ntz")), fmt)


def window_bounds(as_of, days_back: int = WINDOW_DAYS_BACK,
                  days_ahead: int = WINDOW_DAYS_AHEAD) -> tuple[Column, Column]:
    """[as_of - days_back, as_of + days_ahead] as dates."""
    d = F.to_date(F.lit(as_of) if isinstance(as_of, str) else as_of)
    return F.date_add(d, -days_back), F.date_add(d, days_ahead)


def report_time(ts) -> Column:
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.date_format(ts, REPORT_TIME)
