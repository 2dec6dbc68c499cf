"""Feed operators: canonical flat rows (S1 P1-P3), watermark filter (P9),
date window (P15), skip / allow lists (J4 J5 J6), required e-mail (P13),
unknown courses (J10)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.functions import is_blank, window_bounds
from rollcall.operators.shape import explode_records, keep

# The eleven feed fields the importer keeps (dotted names as
# the flattened document spells them).
FEED_KEEP = [
    "CreatedDate", "EventEnrollmentID", "ScheduledEvent.Course.CourseName",
    "ScheduledEvent.Course.IsOnline", "EnrollmentStatusCd", "ScheduledEvent.EventCd",
    "StudentID", "CustomerID", "Person.Email", "Person.FirstName", "Person.LastName",
]

_CANONICAL = {
    "EventEnrollmentID": "event_id", "pos": "pos", "EnrollmentStatusCd": "status",
    "CreatedDate": "created", "ScheduledEvent.EventCd": "course_code",
    "ScheduledEvent.Course.CourseName": "course_name",
    "ScheduledEvent.Course.IsOnline": "is_online", "StudentID": "student_id",
    "CustomerID": "customer_id", "Person.Email": "email",
    "Person.FirstName": "first_name", "Person.LastName": "last_name",
}


def flatten_feed(feed: DataFrame) -> DataFrame:
    """One row per (record, student) with the nested fields flattened to
    dotted names, plus the student's position ``pos`` (P1 P2).  Records with
    no student keep one row with null student fields."""
    from rollcall.operators.shape import flatten
    exploded = explode_records(feed, "Students", pos_col="pos")
    return flatten(exploded, sep=".")


def flatten_catalogue(catalogue: DataFrame) -> DataFrame:
    """One row per (course, course group) with the group fields beside the
    course's columns (D22); a course without groups keeps one row."""
    from rollcall.operators.shape import flatten
    return flatten(explode_records(catalogue, "CourseGroups", pos_col="group_pos"), sep=".")


def feed_rows(feed: DataFrame) -> DataFrame:
    """Nested feed -> canonical flat rows used by every sync operator:
    the keep-list projection (P3) with snake-case names.  ``pos`` is 0 for a
    record without students, so ``(event_id, pos)`` is the processing order
    (O5)."""
    flat = keep(flatten_feed(feed), FEED_KEEP + ["pos"])
    out = flat.select(*[F.col("`" + c + "`").alias(_CANONICAL[c]) for c in flat.columns])
    return out.withColumn("pos", F.coalesce(F.col("pos"), F.lit(0)))


def since(rows: DataFrame, watermark) -> DataFrame:
    """Rows past the saved sequence number (P9).  ``watermark`` is a number
    (pushed into the parquet scan as a literal) or a one-row state frame
    (a scalar subquery)."""
    if isinstance(watermark, DataFrame):
        wm = watermark.agg(F.max("EventEnrollmentID")).scalar()
        return rows.where(F.col("event_id") > F.coalesce(wm, F.lit(0)))
    return rows.where(F.col("event_id") > F.lit(int(watermark)))


def below_watermark(rows: DataFrame, watermark) -> DataFrame:
    """Rows at or below the watermark: already seen, or late (never processed)."""
    if isinstance(watermark, DataFrame):
        wm = watermark.agg(F.max("EventEnrollmentID")).scalar()
        return rows.where(F.col("event_id") <= F.coalesce(wm, F.lit(0)))
    return rows.where(F.col("event_id") <= F.lit(int(watermark)))


def date_window(rows: DataFrame, as_of, column: str = "created",
                days_back: int = 7, days_ahead: int = 112) -> DataFrame:
    """Rows whose ``column`` date lies in [as_of - days_back, as_of + days_ahead]
    (P15).  ``as_of`` is a parameter, never the wall clock."""
    lo, hi = window_bounds(as_of, days_back, days_ahead)
    # bounds on the column itself, which reach the scan where they are literals
    start, end = (d.cast("date").cast("timestamp") for d in (lo, F.date_add(hi, 1)))
    return rows.where((F.col(column) >= start) & (F.col(column) < end))


def _codes(codes: DataFrame, column: str, distinct: bool = False) -> DataFrame:
    """The list's non-null codes.  Semi/anti-joins ignore duplicates on the
    list side, so only a flagging left join needs them removed (a shuffle)."""
    out = codes.select(F.col(column).alias("_code")).where(F.col("_code").isNotNull())
    return out.distinct() if distinct else out


def flag_listed(rows: DataFrame, codes: DataFrame, code_col: str, flag: str) -> DataFrame:
    """``rows`` with the boolean ``flag``: whether ``codes`` lists the row's
    course code (never for a null code).  One left join to the distinct list,
    so both sides of a split come from a single read of the rows.

    No broadcast hint: the list is broadcast when the planner's estimate or
    AQE's measured size is under the broadcast threshold, and shuffled
    otherwise."""
    listed = _codes(codes, code_col, distinct=True).withColumn("_listed", F.lit(True))
    joined = rows.join(listed, rows["course_code"] == listed["_code"], "left")
    return joined.select(*[rows[c] for c in rows.columns],
                         F.coalesce(F.col("_listed"), F.lit(False)).alias(flag))


def flag_skipped(rows: DataFrame, skip: DataFrame, code_col: str = "CourseCode",
                 online_override: bool = False) -> DataFrame:
    """``rows`` with ``skipped`` (J4); with ``online_override`` a row of a
    listed course isn't skipped when the course is online (J6)."""
    flagged = flag_listed(rows, skip, code_col, "skipped")
    if online_override:
        online = F.coalesce(F.col("is_online"), F.lit(False))
        flagged = flagged.withColumn("skipped", F.col("skipped") & ~online)
    return flagged


def split_skipped(rows: DataFrame, skip: DataFrame, code_col: str = "CourseCode",
                  online_override: bool = False) -> tuple[DataFrame, DataFrame]:
    """(kept, skipped) by the skip list (J4, J6; see ``flag_skipped``).
    Membership never matches a null code.  Where only one side is used, the
    plain semi/anti-join needs no distinct list."""
    if not online_override:
        codes = _codes(skip, code_col)
        on = rows["course_code"] == codes["_code"]
        return rows.join(codes, on, "left_anti"), rows.join(codes, on, "left_semi")
    flagged = flag_skipped(rows, skip, code_col, online_override)
    return flagged.where(~F.col("skipped")).drop("skipped"), flagged.where("skipped").drop("skipped")


def only_listed(rows: DataFrame, allow: DataFrame, code_col: str = "CourseCode") -> tuple[DataFrame, DataFrame]:
    """(kept, not listed) by an allow list."""
    codes = _codes(allow, code_col)
    on = rows["course_code"] == codes["_code"]
    return rows.join(codes, on, "left_semi"), rows.join(codes, on, "left_anti")


def validate_email(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good, rejects) by the required e-mail (P13): blank and missing both
    reject."""
    bad = is_blank("email")
    return rows.where(~bad), rows.where(bad).withColumn("reason", F.lit("BLANK_EMAIL"))


def reject_reasons(rows: DataFrame, courses: DataFrame, key: str = "sis_course_id") -> DataFrame:
    """``rows`` with ``reason``: BLANK_EMAIL (P13), else UNKNOWN_COURSE (J10),
    else null, in one pass over the rows."""
    flagged = flag_listed(rows, courses, key, "_known")
    reason = (F.when(is_blank("email"), F.lit("BLANK_EMAIL"))
              .when(~F.col("_known"), F.lit("UNKNOWN_COURSE")))
    return flagged.withColumn("reason", reason).drop("_known")


def split_unknown_courses(rows: DataFrame, courses: DataFrame,
                          key: str = "sis_course_id") -> tuple[DataFrame, DataFrame]:
    """(good, rejects) by course existence (J10).  The course list holds one
    short code per LMS course (even a million courses is a few tens of MB),
    so it is joined as is and the planner / AQE broadcast it."""
    codes = _codes(courses, key)
    on = rows["course_code"] == codes["_code"]
    return (rows.join(codes, on, "left_semi"),
            rows.join(codes, on, "left_anti").withColumn("reason", F.lit("UNKNOWN_COURSE")))
