"""Enrollment planning (J9, W3, P12) and final state (A5).

Per (account, course) in event order: a non-DROPPED event enrolls the
student (active); a DROPPED event removes the enrollment if the student is
enrolled just before it (DROP), otherwise it reports DROP_NOT_FOUND.  "Just
before" is the previous event of the same pair in the batch, or — for the
pair's first event — the LMS roster snapshot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.functions import DROPPED, ENROLLED_STATES, STUDENT_ENROLLMENT
from rollcall.operators.ordered import last_per_key, previous_value

ENROLL = "ENROLL"
DROP = "DROP"
DROP_NOT_FOUND = "DROP_NOT_FOUND"


def current_students(enrollments: DataFrame) -> DataFrame:
    """``(account, course_code)`` pairs enrolled as students in the snapshot
    (not deduplicated: callers restrict them to a batch first)."""
    return (enrollments
            .where((F.col("type") == STUDENT_ENROLLMENT)
                   & F.col("enrollment_state").isin(*ENROLLED_STATES))
            .select(F.col("user_id").cast("string").alias("account"),
                    F.col("sis_course_id").alias("course_code")))


def _is_drop(c):
    return F.coalesce(c == F.lit(DROPPED), F.lit(False))


def plan_enrollments(rows: DataFrame, enrollments: DataFrame | None,
                     current: DataFrame | None = None) -> DataFrame:
    """Every resolved row with a known course -> one enrollment action.
    The state before the batch is the roster snapshot ``enrollments`` or,
    if given, ``current`` (account, course_code) pairs.

    Columns: event_id, pos, action, account, email, course_code, course_name, plus
    the payload of an ENROLL (type, enrollment_state, notify)."""
    keys = ["account", "course_code"]
    base = rows.select("event_id", "pos", "account", "email", "course_code", "course_name", "status")
    # the roster enters as the "status before the first event" of a pair;
    # only the batch's pairs are looked up (a broadcast semi-join of the
    # large roster with the batch's pairs, then the distinct)
    pairs = base.select(*keys).distinct()
    cur = ((current if current is not None else current_students(enrollments))
           .select("account", "course_code").join(pairs, keys, "left_semi")
           .distinct().withColumn("value", F.lit("ENROLLED")))
    j = previous_value(base, keys, "event_id", "status", tie_col="pos", out_col="_prev", initial=cur)
    prior_active = F.coalesce(~_is_drop(F.col("_prev.value")) & F.col("_prev").isNotNull(), F.lit(False))
    action = (F.when(~_is_drop(F.col("status")), F.lit(ENROLL))
              .when(prior_active, F.lit(DROP))
              .otherwise(F.lit(DROP_NOT_FOUND)))
    enroll = action == F.lit(ENROLL)
    return j.select(
        "event_id", "pos", action.alias("action"), "account", "email", "course_code", "course_name",
        F.when(enroll, F.lit(STUDENT_ENROLLMENT)).alias("type"),
        F.when(enroll, F.lit("active")).alias("enrollment_state"),
        F.when(enroll, F.lit(True)).alias("notify"))


def final_enrollments(rows: DataFrame) -> DataFrame:
    """Final state per (account, course): the last event wins (A5).
    Columns: account, course_code, last_event_id, last_status, active."""
    last = last_per_key(rows, ["account", "course_code"], ["event_id", "pos"], ["status"])
    return last.select("account", "course_code", F.col("last_event_id"),
                       F.col("last_status"), (~_is_drop(F.col("last_status"))).alias("active"))
