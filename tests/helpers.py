"""Builders for hand-made inputs."""

from __future__ import annotations

import datetime

from rollcall.schemas import COURSES, ENROLLMENTS, FEED, LOGINS, USERS


def feed_record(eid, code, students, status="ENROLLED", online=False, name=None, created=None):
    """students: list of (customer_id, email, first, last)."""
    return (eid, status, created or datetime.datetime(2024, 1, 1) + datetime.timedelta(minutes=eid),
            (code, (name or f"Course {code}", online)),
            [(c, c, (e, f, l)) for c, e, f, l in students])


def feed_df(spark, records):
    return spark.createDataFrame(records, FEED)


def users_df(spark, rows):
    """rows: (id, login_id, sis_user_id)."""
    return spark.createDataFrame(
        [(i, f"User {i}", f"User {i}", f"{i}, User", lg, sis, None, lg) for i, lg, sis in rows], USERS)


def logins_df(spark, rows):
    return spark.createDataFrame(rows, LOGINS)


def courses_df(spark, codes, term="T1", account=1):
    return spark.createDataFrame(
        [(n, c, f"Course {c}", c, account, 1, None, "available", False, (term,))
         for n, c in enumerate(codes)], COURSES)


def enrollments_df(spark, rows):
    """rows: (id, course_id, sis_course_id, user_id, type, state)."""
    return spark.createDataFrame(
        [(i, cid, sis, uid, typ, typ.replace("Enrollment", ""), None, st) for i, cid, sis, uid, typ, st in rows],
        ENROLLMENTS)


def _null_first(t):
    return tuple((v is not None, v) for v in t)


def rows_of(df, *cols):
    """Rows as tuples, sorted with nulls first."""
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=_null_first)
