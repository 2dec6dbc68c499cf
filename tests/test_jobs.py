"""Course, access, group and user jobs (D3-D21) on hand-made rows, with the
fixture cases of FIXTURES.md."""

import pytest
from pyspark.sql import functions as F

from helpers import courses_df, enrollments_df, logins_df, rows_of, users_df
from rollcall.plans.access import (
    grant, grant_across_term, revoke_across_term, roles_of_users, transfer_roster,
)
from rollcall.plans.courses import (
    copy_content, course_report, plan_courses, propagate_staff, recode_courses, rename_courses,
    rename_term, resolve_term, term_matches, with_file_order,
)
from rollcall.plans.groups import group_changes, group_difference, students_of_counselors
from rollcall.plans.users import last_login_report
from rollcall.schemas import ACCOUNTS, CONTENT, TERMS


@pytest.fixture()
def lms(spark):
    courses = courses_df(spark, ["A", "B", "C"]).withColumn(
        "account_id", F.when(F.col("sis_course_id") == "C", F.lit(99)).otherwise(F.lit(1)).cast("long"))
    accounts = spark.createDataFrame([(1, "Adult Ed")], ACCOUNTS)      # 99 unreadable
    terms = spark.createDataFrame([(1, "T1", "Fall"), (2, "T2", "Spring"), (3, "T3", "Spring")], TERMS)
    users = users_df(spark, [(10, "t1@x.org", "s10"), (11, "t2@x.org", "s11"), (12, "st@x.org", "s12")])
    enr = enrollments_df(spark, [
        (1, 0, "A", 10, "TeacherEnrollment", "active"), (2, 0, "A", 11, "TeacherEnrollment", "active"),
        (3, 0, "A", 12, "StudentEnrollment", "active"), (4, 1, "B", 12, "StudentEnrollment", "invited"),
        (5, 1, "B", 11, "TaEnrollment", "active"), (6, 1, "B", 10, "TeacherEnrollment", "deleted"),
    ])
    return courses, accounts, terms, users, enr


def test_course_report(lms):
    courses, accounts, terms, users, enr = lms
    rep = {r.sis_course_id: r for r in course_report(courses, accounts, terms, enr, users).collect()}
    assert set(rep) == {"A", "B"}                       # unreadable sub-account drops C
    assert rep["A"].teacher == "User 10 User 11" and rep["A"].total_students == 1
    assert rep["B"].teacher == "No Teacher in Class" and rep["B"].total_students == 1
    assert rep["A"].subaccount_name == "Adult Ed" and rep["A"].enrollment_name == "Fall"


def test_rename_term_appends_code_suffix(spark):
    c = courses_df(spark, ["A", "B"], term="T9").union(courses_df(spark, ["X"], term="T1"))
    c = c.withColumn("sis_course_id", F.when(F.col("sis_course_id") == "B", None).otherwise(F.col("sis_course_id")))
    got = rows_of(rename_term(c, "T9", "OLD-", "-24"), "old_name", "name", "sis_course_id")
    assert got == [("Course A", "OLD-Course A", "A-24"), ("Course B", "OLD-Course B", None)]


def test_rename_map_last_row_wins_and_unknown(spark):
    c = courses_df(spark, ["A", "B"])
    m = with_file_order(spark.createDataFrame(
        [(0, "N1", "First"), (0, "N2", "Second"), (7, "N7", "Seven")],
        "id long, NewShortName string, `New name` string").coalesce(1))
    changes, unknown = rename_courses(c, m)
    assert rows_of(changes, "course_id", "name", "course_code") == [(0, "Second", "N2")]
    assert rows_of(unknown, "course_id") == [(7,)]


def test_file_order_follows_the_files_not_the_splits(spark, tmp_path):
    """A large later file is read in a split of its own, before the small
    first file; its rows still come after the first file's."""
    from rollcall.sources import read_mapping
    (tmp_path / "map").mkdir()
    (tmp_path / "map" / "a.csv").write_text("currentcoursecode,coursecodenew\n0001,first\n0002,only\n")
    (tmp_path / "map" / "b.csv").write_text("currentcoursecode,coursecodenew\n" + "".join(
        f"X{i},y\n" for i in range(5000)) + "0001,second\n0001,last\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        m = with_file_order(read_mapping(spark, str(tmp_path / "map"), "recode_map"))
        changes, unknown = recode_courses(courses_df(spark, ["0001", "0002"]), m)
        assert rows_of(changes, "old_sis_course_id", "sis_course_id") == [("0001", "last"), ("0002", "only")]
        assert unknown.count() == 5000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_names_with_one_shared_beginning_are_dealt_over_ranges(spark):
    """Names that all begin alike don't meet in one group."""
    from rollcall.plans.courses import names_in_order
    df = spark.range(20000).select(F.lit(1).alias("k"), F.concat(F.lit("Prof. "), F.col("id").cast("string")).alias("name"))
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled", "true")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = names_in_order(df, "k", "name", "t").first().t
        sizes = [r["count"] for r in df.repartitionByRange("k", "name")
                 .groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    assert got == " ".join(sorted(f"Prof. {i}" for i in range(20000)))
    assert len(sizes) > 1 and max(sizes) < 10000


def test_recode(spark):
    c = courses_df(spark, ["0042", "B"])
    m = spark.createDataFrame([("0042", "X42", 1), ("ZZ", "Q", 2)], "currentcoursecode string, coursecodenew string, _row long")
    changes, unknown = recode_courses(c, m)
    assert rows_of(changes, "old_sis_course_id", "sis_course_id", "course_code") == [("0042", "X42", "X42")]
    assert rows_of(unknown, "currentcoursecode") == [("ZZ",)]


def test_terms(lms):
    _, _, terms, _, _ = lms
    assert resolve_term(terms, "Fall") == 1
    with pytest.raises(LookupError):
        resolve_term(terms, "Spring")                   # two terms share the name
    with pytest.raises(LookupError):
        resolve_term(terms, "Summer")
    assert {r.enrollment_name: (r.enrollment_term_id, r.matches) for r in term_matches(terms).collect()} \
        == {"Fall": (1, 1), "Spring": (3, 2)}


def test_plan_courses_branches(spark, lms):
    courses = lms[0]
    req = spark.createDataFrame([("B", "A", "Copy"), ("NEW", "A", "New"), ("NEW2", "ZZ", "Lost")],
                                "NewSIS_ID string, CurrentSIS_ID string, CourseName string")
    p = {r.new_sis: r for r in plan_courses(req, courses, 5, new_col="NewSIS_ID", source_col="CurrentSIS_ID",
                                            name_col="CourseName").collect()}
    assert p["B"].action == "COPY" and p["B"].account_id is None
    assert (p["NEW"].action, p["NEW"].account_id, p["NEW"].term_id) == ("CREATE", 1, 5)
    assert p["NEW2"].action == "SOURCE_NOT_FOUND"
    p2 = {r.new_sis: r.action for r in plan_courses(req, courses, 5, new_col="NewSIS_ID", source_col="CurrentSIS_ID",
                                                    name_col="CourseName", copy_existing=False).collect()}
    assert p2["B"] == "EXISTS"


def test_staff_and_content(spark, lms):
    courses, _, _, _, enr = lms
    pairs = spark.createDataFrame([("A", "B"), ("B", "C")], "source_sis string, new_sis string")
    staff = rows_of(propagate_staff(pairs, enr), "new_sis", "user_id", "type", "role_id")
    assert staff == [("B", 10, "TeacherEnrollment", None), ("B", 11, "TeacherEnrollment", None),
                     ("C", 11, "TaEnrollment", 16)]
    content = spark.createDataFrame([(0, 1, "a"), (0, 2, "b"), (1, 3, "c")], CONTENT)
    kept, rej = copy_content(pairs, courses, content)
    assert sorted(rows_of(kept, "course_id", "item_id", "source_course_id"), key=lambda t: t[:2]) == \
        [(1, 1, 0), (1, 2, 0), (1, 3, None), (2, 3, 1)]
    reset, _ = copy_content(pairs, courses, content, reset=True)
    assert rows_of(reset, "course_id", "item_id") == [(1, 1), (1, 2), (2, 3)]
    _, rej = copy_content(spark.createDataFrame([("A", "NOPE")], "source_sis string, new_sis string"),
                          courses, content)
    assert rows_of(rej, "reason") == [("TARGET_NOT_FOUND",)]


def test_access_jobs(spark, lms):
    courses, _, _, users, enr = lms
    logins = logins_df(spark, [(10, "t1@x.org")])
    pairs = spark.createDataFrame([("A", "B")], "from_sis string, to_sis string")
    assert rows_of(transfer_roster(pairs, enr), "to_sis", "user_id") == [("B", 12)]
    req = spark.createDataFrame([("T1@x.org", "A", "transition"), ("nobody@x.org", "A", "ta"),
                                 ("t2@x.org", "Z", "teacher")], "login string, course_sis string, kind string")
    g = {r.login: (r.action, r.type, r.role_id) for r in grant(req, users, logins, courses).collect()}
    assert g["t1@x.org"] == ("ENROLL", "TaEnrollment", 16)
    assert g["nobody@x.org"][0] == "USER_NOT_FOUND" and g["t2@x.org"][0] == "COURSE_NOT_FOUND"
    treq = spark.createDataFrame([("t2@x.org", "T1", "ta")], "login string, sis_term_id string, kind string")
    assert len(grant_across_term(treq, users, logins, courses).collect()) == 3
    rreq = spark.createDataFrame([(10, "T1")], "user_id long, sis_term_id string")
    removed, others = revoke_across_term(rreq, courses, enr)
    assert rows_of(removed, "enrollment_id") == [(1,), (6,)]
    assert rows_of(others, "enrollment_id") == [(2,)]
    roles = roles_of_users(spark.createDataFrame([("ST@x.org",)], "login string"), users, logins, enr)
    assert rows_of(roles, "enrollment_id", "role") == [(3, "Student"), (4, "Student")]


def test_groups(spark):
    stu = spark.createDataFrame([(6, "Zed", "z@s", 9, 1, 0, ""), (6, "Amy", "a@s", 9, 1, 0, ""),
                                 (6, "Del", "d@s", 9, 1, 1, ""), (6, "Tag", "t@s", 9, 1, 0, "X"),
                                 (6, "NoC", "n@s", 9, 0, 0, ""), (5, "Oth", "o@s", 9, 1, 0, "")],
                                "SC int, LN string, SEM string, GR int, CU int, DEL int, TG string")
    tch = spark.createDataFrame([(6, 1, "c@s"), (5, 1, "c5@s")], "SC int, TN int, EM string")
    alt = spark.createDataFrame([(6, "Alt")], "SCID int, ALTSC string")
    got = [r.LN for r in students_of_counselors(stu, tch, alt, 6).collect()]
    assert got == ["Amy", "Zed"]                        # ordered by school, counselor, last name
    want = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "login_id string")
    have = spark.createDataFrame([("b",), ("c",), ("c",)], "login_id string")
    assert rows_of(group_difference(want, have), "login_id") == [(None,), ("a",), ("c",)]
    ch = {(r.login_id, r.op) for r in group_changes(want, have).collect()}
    assert ch == {("a", "ADD"), (None, "ADD"), ("c", "REMOVE")}


def test_last_login_offsets(spark):
    u = users_df(spark, [(1, "a", "1"), (2, "b", "2"), (3, "c", "3"), (4, "d", "4"), (5, "e", "5")])
    texts = {1: "2024-01-02T03:04:05Z", 2: "2024-01-02T03:04:05-07:00", 3: "2024-01-02T03:04:05-0700",
             4: "not a date", 5: None}
    u = u.withColumn("last_login", F.element_at(F.create_map(*[x for k, v in texts.items()
                                                               for x in (F.lit(k), F.lit(v))]), F.col("id")))
    rep = {r.id: r for r in last_login_report(u, as_of="2024-02-01", inactive_days=14).collect()}
    assert rep[1].last_login_at == "2024-01-02 03:04:05"
    assert rep[2].last_login_at == rep[3].last_login_at == "2024-01-02 10:04:05"
    assert rep[4].parse_error and rep[4].last_login_at == "no last login"
    assert rep[5].last_login_at == "no last login" and not rep[5].parse_error
    assert all(r.inactive for r in rep.values())


def test_last_login_is_utc_whatever_the_session_zone(spark):
    u = users_df(spark, [(1, "a", "1")]).withColumn("last_login", F.lit("2024-01-02T03:04:05-07:00"))
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        assert last_login_report(u).first().last_login_at == "2024-01-02 10:04:05"
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_names_in_order_equals_one_level_listagg(spark):
    import random
    from rollcall.plans.courses import names_in_order
    rng = random.Random(5)
    alphabet = "abAB é-"
    rows = [(rng.randint(0, 3), "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 5))))
            for _ in range(400)] + [(9, None)]
    df = spark.createDataFrame(rows, "k int, name string")
    got = {r.k: r.t for r in names_in_order(df, "k", "name", "t").collect()}
    for k in range(4):
        names = sorted((n for kk, n in rows if kk == k and n is not None), key=lambda x: x.encode())
        assert got[k] == " ".join(names)
    assert 9 not in got
