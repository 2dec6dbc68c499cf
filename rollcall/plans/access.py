"""Access jobs: roster transfer (D12), grants (D13, D14), revocation across
a term (D15), roles of users (D18), roles of the account (D19), the feed's
student list (D20) and course staff (D21)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.functions import (
    ENROLLED_STATES, STUDENT_ENROLLMENT, TA_ENROLLMENT, TEACHER_ENROLLMENT,
    TRANSITION_ROLE_ID, email_key,
)
from rollcall.operators.feed import FEED_KEEP, flatten_feed
from rollcall.operators.joins import delete_where, lookup
from rollcall.operators.shape import keep

# Grant kinds -> (enrollment type, role id).
GRANT_KINDS = {
    "teacher": (TEACHER_ENROLLMENT, None),
    "ta": (TA_ENROLLMENT, None),
    "transition": (TA_ENROLLMENT, TRANSITION_ROLE_ID),
}


def _kind_columns(kind_col):
    typ = F.lit(None).cast("string")
    rid = F.lit(None).cast("long")
    for k, (t, r) in GRANT_KINDS.items():
        typ = F.when(F.lower(kind_col) == k, F.lit(t)).otherwise(typ)
        if r is not None:
            rid = F.when(F.lower(kind_col) == k, F.lit(r)).otherwise(rid)
    return typ, rid


def users_by_login(users: DataFrame, logins: DataFrame, only: DataFrame | None = None) -> DataFrame:
    """(e, user_id): one user per lower-cased login (primary or extra).
    ``only`` (column ``e``): restrict to the requested logins first (a
    broadcast semi-join), so a large directory is not aggregated whole."""
    all_logins = (logins.select(email_key("unique_id").alias("e"), F.col("user_id").alias("uid"))
                  .unionByName(users.select(email_key("login_id").alias("e"), F.col("id").alias("uid")))
                  .where(F.col("e").isNotNull()))
    if only is not None:
        all_logins = all_logins.join(only.select("e").where(F.col("e").isNotNull()), "e", "left_semi")
    return all_logins.groupBy("e").agg(F.min("uid").alias("user_id"))


def with_role(enrollments: DataFrame, roles, active_only: bool = True) -> DataFrame:
    """Enrollments of one type or a list of types (P11), by default only
    active and invited ones."""
    types = [roles] if isinstance(roles, str) else list(roles)
    out = enrollments.where(F.col("type").isin(*types))
    return out.where(F.col("enrollment_state").isin(*ENROLLED_STATES)) if active_only else out


def _course_by_sis(courses: DataFrame) -> DataFrame:
    return (courses.where(F.col("sis_course_id").isNotNull())
            .groupBy("sis_course_id").agg(F.min("course_id").alias("course_id")))


def transfer_roster(pairs: DataFrame, enrollments: DataFrame) -> DataFrame:
    """Students of each source course enrolled in its target (D12):
    StudentEnrollment, active, notify.  ``pairs``: from_sis, to_sis."""
    wanted = pairs.select("from_sis", "to_sis").distinct()
    # only the roster of the courses asked for is made distinct
    students = (with_role(enrollments, STUDENT_ENROLLMENT)
                .select(F.col("sis_course_id").alias("from_sis"), "user_id")
                .join(pairs.select("from_sis"), "from_sis", "left_semi").distinct())
    j = wanted.join(students, "from_sis")
    return j.select("from_sis", "to_sis", "user_id", F.lit(STUDENT_ENROLLMENT).alias("type"),
                    F.lit("active").alias("enrollment_state"), F.lit(True).alias("notify"))


def grant(requests: DataFrame, users: DataFrame, logins: DataFrame, courses: DataFrame) -> DataFrame:
    """One enrollment per request (D13): ``login, course_sis, kind`` with kind
    teacher / ta / transition.  The user is found by login and the course by
    external id; a miss gives action USER_NOT_FOUND / COURSE_NOT_FOUND."""
    r = requests.select(email_key("login").alias("e"), "course_sis", "kind")
    u = users_by_login(users, logins, only=r).withColumnRenamed("e", "_login")
    j = lookup(lookup(r, u, "e", "_login", "_user"), _course_by_sis(courses), "course_sis", "sis_course_id", "_course")
    typ, rid = _kind_columns(F.col("kind"))
    action = (F.when(~F.col("_course"), F.lit("COURSE_NOT_FOUND"))
              .when(~F.col("_user"), F.lit("USER_NOT_FOUND"))
              .when(typ.isNull(), F.lit("UNKNOWN_KIND"))
              .otherwise(F.lit("ENROLL")))
    return j.select(F.col("e").alias("login"), "course_sis", "course_id", "user_id", action.alias("action"),
                    typ.alias("type"), rid.alias("role_id"), F.lit("active").alias("enrollment_state"),
                    F.lit(True).alias("notify"))


def grant_across_term(requests: DataFrame, users: DataFrame, logins: DataFrame,
                      courses: DataFrame) -> DataFrame:
    """Grant a user a role in every course of a term (D14): ``login,
    sis_term_id, kind``.  The courses are found by an equi-join on the term,
    not a cross join."""
    r = requests.select(email_key("login").alias("e"), "sis_term_id", "kind")
    r = r.join(users_by_login(users, logins, only=r), "e")
    c = courses.select("course_id", "sis_course_id", F.col("term.sis_term_id").alias("sis_term_id"))
    j = r.join(c, "sis_term_id")
    typ, rid = _kind_columns(F.col("kind"))
    return j.select(F.col("e").alias("login"), "sis_term_id", "course_id", "sis_course_id", "user_id",
                    typ.alias("type"), rid.alias("role_id"), F.lit("active").alias("enrollment_state"),
                    F.lit(True).alias("notify"))


def revoke_across_term(requests: DataFrame, courses: DataFrame, enrollments: DataFrame,
                       enrollment_type: str = TEACHER_ENROLLMENT) -> tuple[DataFrame, DataFrame]:
    """Remove a user's enrollments of one type from every course of a term
    (D15): ``user_id, sis_term_id``.  Returns (removed, others seen), each
    enrollment once however many requests name its term."""
    c = courses.select("course_id", F.col("term.sis_term_id").alias("sis_term_id"))
    e = enrollments.where(F.col("type") == enrollment_type).select(
        F.col("id").alias("enrollment_id"), "course_id", "user_id", "sis_course_id")
    seen = e.join(c, "course_id").join(requests.select("sis_term_id"), "sis_term_id", "left_semi")
    target = requests.select("sis_term_id", "user_id").distinct().withColumn("_asked", F.lit(True))
    others, removed = delete_where(seen.join(target, ["sis_term_id", "user_id"], "left"), F.col("_asked"))
    cols = ["sis_term_id", "course_id", "sis_course_id", "enrollment_id", "user_id"]
    return removed.select(*cols), others.select(*cols)


def roles_of_users(requests: DataFrame, users: DataFrame, logins: DataFrame,
                   enrollments: DataFrame) -> DataFrame:
    """Every enrollment of the users named by login."""
    r = requests.select(email_key("login").alias("e")).distinct()
    r = r.join(users_by_login(users, logins, only=r), "e")
    return r.join(enrollments, "user_id").select(
        F.col("e").alias("login"), "user_id", F.col("id").alias("enrollment_id"),
        "sis_course_id", "role", "type")


def roles_in_account(roles: DataFrame) -> DataFrame:
    """The account's roles."""
    return roles.select("id", "label", "role", "base_role_type")


def student_list(feed: DataFrame) -> DataFrame:
    """Distinct e-mails of the feed's students."""
    flat = keep(flatten_feed(feed), [c for c in FEED_KEEP if c == "Person.Email"])
    return flat.select(F.col("`Person.Email`").alias("email")).where(F.col("email").isNotNull()).distinct()


def course_staff(enrollments: DataFrame, users: DataFrame,
                 types=(TEACHER_ENROLLMENT, TA_ENROLLMENT)) -> DataFrame:
    """Teachers and TAs of every course with their names."""
    e = with_role(enrollments, types, active_only=False).select(
        "course_id", "sis_course_id", "user_id", "type").distinct()
    names = users.select(F.col("id").alias("user_id"), "name")
    return e.join(names, "user_id", "left").select("course_id", "sis_course_id", "user_id", "name", "type")
