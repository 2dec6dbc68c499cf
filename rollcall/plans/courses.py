"""Course jobs: report (D3), renames and recodes (D5-D7), hiding until the
term starts (D16), term lookup (O4), creation plans (D8-D10), staff
propagation (J13) and content copy (D11).

Every function returns change sets; nothing is applied to a live system.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.functions import (
    ENROLLED_STATES, NO_TEACHER, STUDENT_ENROLLMENT, TA_ENROLLMENT, TEACHER_ENROLLMENT,
    TRANSITION_ROLE_ID, email_key,
)
from rollcall.operators.joins import set_where
from rollcall.operators.ordered import last_per_key

# --------------------------------------------------------------- report --


def course_report(courses: DataFrame, accounts: DataFrame, terms: DataFrame,
                  enrollments: DataFrame, users: DataFrame) -> DataFrame:
    """One row per course whose sub-account and term are known (inner joins:
    a course of an unreadable sub-account drops out, J1 J2), with the number
    of students (the snapshot's ``total_students``, else counted from the
    roster, A8) and the teachers' names joined by one blank in name order
    (A3), or 'No Teacher in Class'."""
    c = courses.select("course_id", "sis_course_id", F.col("name").alias("Course_Name"),
                       "account_id", "enrollment_term_id", "total_students", "workflow_state")
    a = accounts.select("account_id", "subaccount_name").dropDuplicates(["account_id"])
    t = terms.select("enrollment_term_id", "enrollment_name").dropDuplicates(["enrollment_term_id"])
    # one pass over the roster: per (course, user) whether they study and/or
    # teach there; both branches below read this one aggregate
    per_user = (enrollments.where(F.col("enrollment_state").isin(*ENROLLED_STATES)
                                  & F.col("type").isin(STUDENT_ENROLLMENT, TEACHER_ENROLLMENT))
                .groupBy("course_id", "user_id")
                .agg(F.bool_or(F.col("type") == STUDENT_ENROLLMENT).alias("_s"),
                     F.bool_or(F.col("type") == TEACHER_ENROLLMENT).alias("_t")))
    students = per_user.where("_s").groupBy("course_id").agg(F.count(F.lit(1)).alias("_n_students"))
    teacher_ids = per_user.where("_t").select("course_id", "user_id")
    names = users.select(F.col("id").alias("user_id"), "name")
    teachers = names_in_order(teacher_ids.join(names, "user_id"), "course_id", "name", "teacher")
    out = (c.join(a, "account_id").join(t, "enrollment_term_id")
           .join(students, "course_id", "left").join(teachers, "course_id", "left"))
    return out.select(
        "course_id", "sis_course_id", "Course_Name", "account_id", "enrollment_term_id",
        F.coalesce(F.col("total_students"), F.col("_n_students"), F.lit(0)).alias("total_students"),
        "workflow_state", "subaccount_name", "enrollment_name",
        F.coalesce(F.col("teacher"), F.lit(NO_TEACHER)).alias("teacher"))


def names_in_order(df: DataFrame, key: str, name: str, out: str) -> DataFrame:
    """Per ``key``: the ``name`` values joined by one blank in name order
    (listagg), built in two levels so that one key with very many names is
    not sorted in one task.  Rows are dealt by sampled ranges of (key, name),
    whatever their beginnings; each range joins its own names of a key, and
    the parts — at most one per range — are joined in range order.  Null names
    take no part."""
    ranged = (df.where(F.col(name).isNotNull()).select(key, name)
              .repartitionByRange(key, name).withColumn("_p", F.spark_partition_id()))
    parts = ranged.groupBy(key, "_p").agg(
        F.concat_ws(" ", F.array_sort(F.collect_list(name))).alias("_part"))
    ordered = F.array_sort(F.collect_list(F.struct("_p", "_part")))
    return parts.groupBy(key).agg(
        F.concat_ws(" ", F.transform(ordered, lambda x: x["_part"])).alias(out))


# ------------------------------------------------------- term-wide edits --


def in_term(courses: DataFrame, sis_term_id: str) -> DataFrame:
    """Courses whose nested term id equals ``sis_term_id`` (P10)."""
    return courses.where(F.col("term.sis_term_id") == F.lit(sis_term_id))


def rename_term(courses: DataFrame, sis_term_id: str, name_prefix: str, code_suffix: str) -> DataFrame:
    """End-of-term rename (D5): name = prefix + name; external id and course
    code = external id + suffix (the reference's "prepend" text is appended
    to the code).  A null part gives a null result, as text concatenation."""
    c = in_term(courses, sis_term_id)
    new_code = F.concat(F.col("sis_course_id"), F.lit(code_suffix))
    return c.select("course_id", F.col("sis_course_id").alias("old_sis_course_id"),
                    F.col("name").alias("old_name"),
                    new_code.alias("sis_course_id"), new_code.alias("course_code"),
                    F.concat(F.lit(name_prefix), F.col("name")).alias("name"))


def hide_until_start(courses: DataFrame, sis_term_id: str) -> DataFrame:
    """Set ``restrict_student_future_view`` on every course of the term.
    ``changed`` tells which updates are not already in place."""
    hidden = set_where(in_term(courses, sis_term_id), F.lit(True), "restrict_student_future_view", True)
    return hidden.select("course_id", "sis_course_id", "restrict_student_future_view", "changed")


def _last_row_per_key(mapping: DataFrame, key: str, row_col: str = "_row") -> DataFrame:
    """A mapping file may list a key twice; the reference applies rows in
    file order, so the last one wins."""
    values = [c for c in mapping.columns if c not in (key, row_col)]
    last = last_per_key(mapping.where(F.col(key).isNotNull()), [key], [row_col], values, prefix="")
    return last.drop(row_col)


def with_file_order(mapping: DataFrame, row_col: str = "_row") -> DataFrame:
    """Order the rows of a freshly read mapping by file, place in the file and
    row (splits are handed out by size, so partition order isn't file order).
    A table that comes from no file keeps its partition order."""
    row = F.monotonically_increasing_id()
    try:
        return mapping.select("*", F.struct(F.col("_metadata.file_path"), F.col("_metadata.file_block_start"),
                                            row.alias("row")).alias(row_col))
    except AnalysisException:  # no file behind it
        return mapping.withColumn(row_col, row)


def rename_courses(courses: DataFrame, mapping: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rename by course id (D6): (changes, unknown ids).  ``mapping`` has
    ``id, NewShortName, New name`` and a file-order column ``_row``."""
    m = _last_row_per_key(mapping, "id")
    c = courses.select("course_id", F.col("name").alias("old_name"),
                       F.col("course_code").alias("old_course_code"))
    changes = m.join(c, m["id"] == c["course_id"]).select(
        "course_id", "old_name", "old_course_code",
        F.coalesce(F.col("`New name`"), F.col("old_name")).alias("name"),
        F.coalesce(F.col("NewShortName"), F.col("old_course_code")).alias("course_code"))
    unknown = m.join(c, m["id"] == c["course_id"], "left_anti").select(F.col("id").alias("course_id"))
    return changes, unknown


def recode_courses(courses: DataFrame, mapping: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Recode by external id (D7): course code and external id both become
    ``coursecodenew``.  (changes, unknown codes) — an unknown code failed
    the reference's run."""
    m = _last_row_per_key(mapping, "currentcoursecode")
    c = courses.select("course_id", "sis_course_id")
    on = m["currentcoursecode"] == c["sis_course_id"]
    changes = m.join(c, on).select(
        "course_id", F.col("sis_course_id").alias("old_sis_course_id"),
        F.col("coursecodenew").alias("sis_course_id"), F.col("coursecodenew").alias("course_code"))
    unknown = m.join(c, on, "left_anti").select("currentcoursecode")
    return changes, unknown


# ---------------------------------------------------------------- terms --


def term_matches(terms: DataFrame) -> DataFrame:
    """Per term name: the id the reference would pick (the last listed,
    taken as the largest id) and how many terms carry the name (O4)."""
    return terms.groupBy("enrollment_name").agg(
        F.max("enrollment_term_id").alias("enrollment_term_id"),
        F.count(F.lit(1)).alias("matches"))


def resolve_term(terms: DataFrame, name: str) -> int:
    """The id of the term called ``name``.  Stops (raises) when no term or
    more than one term has that name; the reference stopped on none and
    silently took the last on several."""
    rows = terms.where(F.col("enrollment_name") == F.lit(name)).select("enrollment_term_id").limit(2).collect()
    if not rows:
        raise LookupError(f"term {name!r} not found")
    if len(rows) > 1:
        raise LookupError(f"term name {name!r} is ambiguous")
    return int(rows[0][0])


# ------------------------------------------------------- creation plans --


def _sis_index(courses: DataFrame, prefix: str) -> DataFrame:
    return (courses.where(F.col("sis_course_id").isNotNull())
            .groupBy("sis_course_id")
            .agg(F.min(F.struct("course_id", "account_id")).alias("_c"))
            .select(F.col("sis_course_id").alias(prefix + "sis"),
                    F.col("_c.course_id").alias(prefix + "course_id"),
                    F.col("_c.account_id").alias(prefix + "account_id")))


def plan_courses(requests: DataFrame, courses: DataFrame, term_id: int, *, new_col: str,
                 source_col: str, name_col: str, account_from: str = "source",
                 account_col: str | None = None, copy_existing: bool = True) -> DataFrame:
    """Exists / not-exists split of course requests (J14) with the account
    lookup on the source course (J15).

    One row per request: new_sis, source_sis, name, action, account_id,
    term_id.  ``action``: SOURCE_NOT_FOUND (something would be copied from a
    course that doesn't exist), CREATE (target missing), COPY (target exists
    and ``copy_existing``), EXISTS (target exists, left as is)."""
    new = _sis_index(courses, "t_")
    src = _sis_index(courses, "s_")
    r = requests.select(F.col(new_col).alias("new_sis"), F.col(source_col).alias("source_sis"),
                        F.col(name_col).alias("name"),
                        (F.col(account_col) if account_col else F.lit(None).cast("string")).alias("_req_account"))
    j = (r.join(new, r["new_sis"] == new["t_sis"], "left")
          .join(src, r["source_sis"] == src["s_sis"], "left"))
    exists = F.col("t_course_id").isNotNull()
    source_known = F.col("s_course_id").isNotNull()
    # whatever is copied needs its source, whether or not the target exists
    needs_source = F.lit(copy_existing) | ~exists
    action = (F.when(~source_known & needs_source, F.lit("SOURCE_NOT_FOUND"))
              .when(exists & F.lit(copy_existing), F.lit("COPY"))
              .when(exists, F.lit("EXISTS"))
              .otherwise(F.lit("CREATE")))
    account = (F.col("s_account_id") if account_from == "source"
               else F.col("_req_account").cast("long"))
    return j.select("new_sis", "source_sis", "name", action.alias("action"),
                    F.when(~exists, account).alias("account_id"),
                    F.when(~exists, F.lit(term_id)).cast("long").alias("term_id"))


def teacher_by_email(plans: DataFrame, requests: DataFrame, users: DataFrame, logins: DataFrame,
                     new_col: str, email_col: str, notify: bool) -> DataFrame:
    """Teacher enrollment of each planned course, the teacher found by
    e-mail login (J18).  Unknown teachers come back with ``user_id`` null and
    action TEACHER_NOT_FOUND."""
    req = requests.select(F.col(new_col).alias("new_sis"), email_key(email_col).alias("_e"))
    from rollcall.plans.access import users_by_login
    by_login = users_by_login(users, logins, only=req.select(F.col("_e").alias("e"))) \
        .withColumnRenamed("e", "_e")
    p = plans.where(F.col("action").isin("CREATE", "COPY")).select("new_sis").distinct()
    j = p.join(req, "new_sis").join(by_login, "_e", "left")
    return j.select("new_sis", "user_id",
                    F.when(F.col("user_id").isNull(), F.lit("TEACHER_NOT_FOUND"))
                    .otherwise(F.lit("ENROLL")).alias("action"),
                    F.lit(TEACHER_ENROLLMENT).alias("type"), F.lit("active").alias("enrollment_state"),
                    F.lit(notify).alias("notify"), F.lit(None).cast("long").alias("role_id"))


def propagate_staff(pairs: DataFrame, enrollments: DataFrame, ta_role_id: int | None = TRANSITION_ROLE_ID) -> DataFrame:
    """Staff of each source course enrolled in its target (J13): teachers as
    active TeacherEnrollment, TAs as active TaEnrollment (with ``ta_role_id``
    and notify, as the duplication job does; ``None`` for the plain copy).

    ``pairs``: source_sis, new_sis.  Columns out: new_sis, user_id, type,
    enrollment_state, notify, role_id."""
    staff = (enrollments.where(F.col("type").isin(TEACHER_ENROLLMENT, TA_ENROLLMENT)
                               & F.col("enrollment_state").isin(*ENROLLED_STATES))
             .select(F.col("sis_course_id").alias("source_sis"), "user_id", "type")
             # only the staff of the courses asked for is made distinct
             .join(pairs.select("source_sis"), "source_sis", "left_semi").distinct())
    j = pairs.select("source_sis", "new_sis").distinct().join(staff, "source_sis")
    is_ta = F.col("type") == TA_ENROLLMENT
    return j.select("new_sis", "user_id", "type", F.lit("active").alias("enrollment_state"),
                    F.when(is_ta & F.lit(ta_role_id is not None), F.lit(True)).alias("notify"),
                    F.when(is_ta, F.lit(ta_role_id)).cast("long").alias("role_id"))


def copy_content(pairs: DataFrame, courses: DataFrame, content: DataFrame,
                 reset: bool = False) -> tuple[DataFrame, DataFrame]:
    """Content copy (D11): the source course's rows re-keyed to the target.
    With ``reset`` the target's own rows are removed first.  Both courses
    must exist.  Returns (final content rows of the targets, rejected pairs).

    Columns: course_id, item_id, body, source_course_id (null for rows the
    target already had)."""
    idx = _sis_index(courses, "")
    p = (pairs.select("source_sis", "new_sis").distinct()
         .join(idx.select(F.col("sis").alias("source_sis"), F.col("course_id").alias("source_course_id")),
               "source_sis", "left")
         .join(idx.select(F.col("sis").alias("new_sis"), F.col("course_id").alias("target_course_id")),
               "new_sis", "left"))
    ok = F.col("source_course_id").isNotNull() & F.col("target_course_id").isNotNull()
    rejects = p.where(~ok).select("source_sis", "new_sis",
                                  F.when(F.col("target_course_id").isNull(), F.lit("TARGET_NOT_FOUND"))
                                  .otherwise(F.lit("SOURCE_NOT_FOUND")).alias("reason"))
    good = p.where(ok).select("source_course_id", "target_course_id")
    # one pass over the content: each course row joins the roles it plays —
    # source of a copy (re-keyed to the target), and, without reset, target
    # keeping its own rows
    roles = good.select(F.col("source_course_id").alias("_cid"), F.col("target_course_id").alias("_tgt"),
                        F.col("source_course_id").alias("_src"))
    if not reset:
        roles = roles.unionByName(
            good.select(F.col("target_course_id").alias("_cid"), F.col("target_course_id").alias("_tgt"),
                        F.lit(None).cast("long").alias("_src")).distinct())
    out = content.join(roles, content["course_id"] == roles["_cid"]).select(
        F.col("_tgt").alias("course_id"), "item_id", "body", F.col("_src").alias("source_course_id"))
    return out, rejects
