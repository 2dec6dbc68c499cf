"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per
operator of SURVEY §2, run on stand-in inputs built from the driver's
tables (rollcall.standins).  Matching DuckDB SQL is in rollcall.oracle."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall import standins as S
from rollcall.operators.feed import (
    date_window, feed_rows, flag_skipped, flatten_catalogue, flatten_feed, only_listed, reject_reasons, since, split_skipped,
)
from rollcall.operators.ordered import last_per_key
from rollcall.operators.sets import union_all
from rollcall.operators.shape import drop_strict, keep, row_index, zip_alignment, zip_rows
from rollcall.operators.feed import FEED_KEEP
from rollcall.plans.access import (
    course_staff, grant, grant_across_term, revoke_across_term, roles_in_account,
    roles_of_users, student_list, transfer_roster,
)
from rollcall.plans.courses import (
    copy_content, course_report, hide_until_start, plan_courses, propagate_staff,
    recode_courses, rename_courses, rename_term, resolve_term, teacher_by_email, term_matches,
    with_file_order,
)
from rollcall.plans.groups import group_changes, group_difference, member_logins, students_of_counselors
from rollcall.plans.sync import run_messages, sync_batch
from rollcall.plans.users import last_login_report
from rollcall.session import ensure_checkpoint_dir
from rollcall.sources.directory import lay_out_directory, open_directory
from rollcall.sources.feed import read_catalogue, read_feed
from rollcall.sources.files import (
    append_ledger, export_csv, export_ordered, read_mapping, read_ordered, read_watermark, write_watermark,
)
from rollcall.sources.json_array import write_json_array
from rollcall.sources.keyed_state import KeyedState
from rollcall.sources.landed import LandedFeed
from rollcall.sources.ledger_index import LedgerIndex
from rollcall.sources.lms import read_snapshot
from rollcall.sources.sinks import write_change_set
from rollcall.streaming.sync_stream import read_output, sync_stream

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn=None, *, name: str | None = None):
    """Register ``fn`` under ``name`` (default: the function's name)."""
    def add(f):
        REGISTRY[name or f.__name__] = f
        return f
    return add(fn) if fn is not None else add


INTRO_COURSE = "INTRO-101"


# ---------------------------------------------------------------- feed ----

def _rows(t: S.Tables, students: str = "one") -> DataFrame:
    return since(feed_rows(S.feed(t, students)), S.watermark_value(t))


@query
def feed_flatten(spark, d):
    """Nested feed (records with zero, one and two
    students) flattened, one row per (record, student)."""
    flat = flatten_feed(S.feed(S.Tables(spark, d), "mixed"))
    flat = flat.withColumn("CreatedDate", F.date_format("CreatedDate", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    return flat.select(*[F.col("`" + c + "`").alias(c.replace(".", "_")) for c in flat.columns])


@query
def feed_since_watermark(spark, d):
    """Rows past the saved watermark whose creation date lies in
    [as_of - 1 week, as_of + 16 weeks]; as_of = first event date + 14 days."""
    t = S.Tables(spark, d)
    as_of = t.events.agg(F.date_add(F.to_date(F.min("ts")), 14)).scalar()
    rows = date_window(_rows(t), as_of)
    return rows.select("event_id", "pos", "status", "course_code", "customer_id", "email")


@query
def feed_skip_list(spark, d):
    """Rows split by the skip list (``skipped`` flag)."""
    t = S.Tables(spark, d)
    return flag_skipped(_rows(t), S.skip_list(t)).select("event_id", "pos", "course_code", "skipped")


@query
def feed_allow_list(spark, d):
    """Rows of allow-listed courses only."""
    t = S.Tables(spark, d)
    kept, _ = only_listed(_rows(t), S.allow_list(t))
    return kept.select("event_id", "pos", "course_code")


@query
def feed_online_override(spark, d):
    """Rows kept when their course is not skipped or is online."""
    t = S.Tables(spark, d)
    kept, _ = split_skipped(_rows(t), S.skip_list(t), online_override=True)
    return kept.select("event_id", "pos", "course_code", "is_online")


@query
def feed_rejects(spark, d):
    """Rows with a blank e-mail (records without students) or an
    unknown course."""
    t = S.Tables(spark, d)
    kept, _ = split_skipped(_rows(t, "mixed"), S.skip_list(t))
    bad = reject_reasons(kept, S.courses(t)).where(F.col("reason").isNotNull())
    return bad.select("event_id", "pos", "course_code", "reason")


# ------------------------------------------------------------ identity ----

@query
def identity_actions(spark, d):
    """RETURNING / EMAIL_CHANGED / NEW and the account per row."""
    return _sync(spark, d).identities.select("event_id", "pos", "action", "account")


@query(name="login_changes")
def _login_changes(spark, d):
    """Login renames and the old login added back when missing."""
    return _sync(spark, d).login_changes


def _ledgers(t: S.Tables) -> dict[str, DataFrame]:
    return {"intro": S.ledger_intro(t), "covid": S.ledger_covid(t)}


@query
def letters_due(spark, d):
    """J7 exact: first row per e-mail whose lower-cased address is in no ledger."""
    return _sync(spark, d).letters


@query
def letters_due_regex(spark, d):
    """J7 regex: the reference's unescaped, case-sensitive regex test."""
    return _sync(spark, d, letter_match="regex").letters


@query
def letters_due_indexed(spark, d):
    """J7 K3 regex against ledgers whose n-gram index was kept: appended in two
    parts, looked up by the run."""
    indexes = {}
    for name, ledger in _ledgers(S.Tables(spark, d)).items():
        indexes[name] = LedgerIndex(spark, _scratch(spark, f"ledger-{name}"), buckets=16)
        for part in (0, 1):
            indexes[name].append(ledger.where(F.pmod(F.hash("Email"), F.lit(2)) == part))
    return _sync(spark, d, letter_match="regex", ledger_indexes=indexes).letters


# ---------------------------------------------------------- enrollment ----

@query
def enroll_actions(spark, d):
    """ENROLL / DROP / DROP_NOT_FOUND per row, against the prior
    roster and the earlier events of the batch."""
    return _sync(spark, d).enrollments.select("event_id", "pos", "action", "account", "course_code")


@query
def enroll_final_state(spark, d):
    """A5: last event wins per (account, course)."""
    return _sync(spark, d).final_state


# ---------------------------------------------------------------- sync ----

def _sync(spark, d, allow: bool = False, on_error: str = "quarantine", letter_match: str = "exact", lookups=None,
          ledger_indexes=None):
    """The sync of one batch on the stand-in inputs; each registered sync
    query reads one of its outputs, and only that output is planned.  What
    outputs share is written to the checkpoint folder, so nothing stays cached.
    The allow-list form has one kind of letter."""
    t = S.Tables(spark, d)
    return sync_batch(
        S.feed(t), S.users(t), S.logins(t), S.student_enrollments(t), S.courses(t),
        watermark=S.watermark_value(t),
        skip=None if allow else S.skip_list(t), allow=S.allow_list(t) if allow else None,
        ledgers={"intro": S.ledger_intro(t)} if allow else _ledgers(t), letter_match=letter_match,
        new_user_course=INTRO_COURSE, on_error=on_error, reuse="checkpoint", lookups=lookups,
        ledger_indexes=ledger_indexes)


@query(name="sync_batch")
def _sync_batch(spark, d):
    """Every planned action of the batch as one table."""
    return _sync(spark, d).actions()


@query
def sync_only_listed(spark, d):
    """Allow-list form (identity by e-mail only)."""
    return _sync(spark, d, allow=True).actions()


@query
def sync_report(spark, d):
    """A1 A4: one-row run report; the heading time is the last event's time."""
    t = S.Tables(spark, d)
    as_of = t.events.agg(F.max("ts").cast("timestamp")).scalar()
    return _sync(spark, d).report(as_of=as_of)


@query
def sync_watermark(spark, d):
    """A4 O2 O3: new watermark = max(sequence seen, old)."""
    return _sync(spark, d).watermark()


@query
def sync_messages(spark, d):
    """Message lines of the run, keyed by event."""
    return run_messages(_sync(spark, d))


@query(name="sync_stream")
def _sync_stream(spark, d):
    """T-2 K2 S13: the feed landed in two parts, each followed by a scheduled
    run of the stream on the state that the run before committed; the actions
    of all committed batches."""
    t, path = S.Tables(spark, d), _scratch(spark, "stream")
    feed, cut = S.feed(t), (t.events.agg(F.max("event_id")).first()[0] or 0) * 3 // 5
    for part in (F.col("EventEnrollmentID") <= cut, F.col("EventEnrollmentID") > cut):
        (feed.where(part).write.mode("append").option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
         .json(f"{path}/feed"))
        sync_stream(spark, f"{path}/feed", out_dir=f"{path}/out", state_dir=f"{path}/state",
                    checkpoint_location=f"{path}/checkpoint", users=S.users(t), logins=S.logins(t),
                    enrollments=S.student_enrollments(t), courses=S.courses(t), multiline=False,
                    initial_watermark=S.watermark_value(t), skip=S.skip_list(t), ledgers=_ledgers(t),
                    new_user_course=INTRO_COURSE, compact_every=1).awaitTermination()
    return read_output(spark, f"{path}/out", f"{path}/state", "actions").select(
        "event_id", "pos", "action", "account", "course_code")


# ------------------------------------------------------------- courses ----

TERM_NAME = "AMERICA"


@query(name="course_report")
def _course_report(spark, d):
    """Courses with sub-account, term, student count and
    teacher names."""
    t = S.Tables(spark, d)
    return course_report(S.courses(t), S.accounts(t), S.terms(t), S.staff_enrollments(t),
                         S.staff_users(t))


@query(name="rename_term")
def _rename_term(spark, d):
    """End-of-term rename of the courses of term T1."""
    return rename_term(S.courses(S.Tables(spark, d)), "T1", "OLD-", "-2024")


@query(name="rename_courses")
def _rename_courses(spark, d):
    """Rename by course id (last map row per id wins)."""
    t = S.Tables(spark, d)
    return rename_courses(S.courses(t), S.rename_map(t))[0]


@query(name="recode_courses")
def _recode_courses(spark, d):
    """Recode course code and external id."""
    t = S.Tables(spark, d)
    return recode_courses(S.courses(t), S.recode_map(t))[0]


@query(name="hide_until_start")
def _hide_until_start(spark, d):
    """Restrict future view for the courses of term T2."""
    return hide_until_start(S.courses(S.Tables(spark, d)), "T2")


@query
def term_lookup(spark, d):
    """Term id per name (the last, i.e. largest, of several) and how
    many terms share it, over the order-month term calendar."""
    return term_matches(S.term_calendar(S.Tables(spark, d)))


def _plan_duplicate(t):
    return plan_courses(S.duplicate_request(t), S.courses(t), resolve_term(S.terms(t), TERM_NAME),
                        new_col="NewSIS_ID", source_col="CurrentSIS_ID", name_col="CourseName",
                        account_from="source", copy_existing=True)


@query
def plan_duplicate(spark, d):
    """Create missing targets in the source's sub-account, copy all."""
    return _plan_duplicate(S.Tables(spark, d))


@query
def plan_template(spark, d):
    """Create only missing courses, in the requested sub-account."""
    t = S.Tables(spark, d)
    return plan_courses(S.template_request(t), S.courses(t), resolve_term(S.terms(t), TERM_NAME),
                        new_col="NewSIS_ID", source_col="Template", name_col="CourseName",
                        account_from="request", account_col="SubAccount", copy_existing=False)


@query
def plan_template_teachers(spark, d):
    """Teacher of each created course, found by e-mail."""
    t = S.Tables(spark, d)
    req = S.template_request(t)
    plans = plan_courses(req, S.courses(t), resolve_term(S.terms(t), TERM_NAME),
                         new_col="NewSIS_ID", source_col="Template", name_col="CourseName",
                         account_from="request", account_col="SubAccount", copy_existing=False)
    return teacher_by_email(plans, req, S.staff_users(t), S.staff_logins(t),
                            new_col="NewSIS_ID", email_col="Email", notify=False)


def _plan_classes(t):
    return plan_courses(S.class_request(t), S.courses(t), resolve_term(S.terms(t), TERM_NAME),
                        new_col="COURSECODE", source_col="TEMPLATE", name_col="CourseName",
                        account_from="source", copy_existing=True)


@query
def plan_classes(spark, d):
    """Missing made in the template's sub-account; existing copied too."""
    return _plan_classes(S.Tables(spark, d))


@query
def plan_classes_teachers(spark, d):
    """Teacher by e-mail, notified."""
    t = S.Tables(spark, d)
    return teacher_by_email(_plan_classes(t), S.class_request(t), S.staff_users(t), S.staff_logins(t),
                            new_col="COURSECODE", email_col="EMAIL", notify=True)


@query(name="propagate_staff")
def _propagate_staff(spark, d):
    """Teachers and TAs (role id 16) of each source enrolled in its target."""
    t = S.Tables(spark, d)
    pairs = _plan_duplicate(t).where(F.col("action").isin("CREATE", "COPY"))
    return propagate_staff(pairs, S.staff_enrollments(t))


@query(name="copy_content")
def _copy_content(spark, d):
    """Target content after the copy (target rows kept)."""
    t = S.Tables(spark, d)
    pairs = S.copy_request(t).select(F.col("CurrentSIS_ID").alias("source_sis"),
                                     F.col("NewSIS_ID").alias("new_sis"))
    return copy_content(pairs, S.courses(t), S.content(t), reset=False)[0]


@query
def copy_content_reset(spark, d):
    """D11 with reset: the target's rows are removed first."""
    t = S.Tables(spark, d)
    pairs = S.copy_request(t).select(F.col("CurrentSIS_ID").alias("source_sis"),
                                     F.col("NewSIS_ID").alias("new_sis"))
    return copy_content(pairs, S.courses(t), S.content(t), reset=True)[0]


# -------------------------------------------------------------- access ----

@query(name="transfer_roster")
def _transfer_roster(spark, d):
    """Students of a course enrolled in another."""
    t = S.Tables(spark, d)
    return transfer_roster(S.roster_pairs(t), S.staff_enrollments(t))


@query
def grant_one(spark, d):
    """One enrollment per request, misses reported."""
    t = S.Tables(spark, d)
    return grant(S.grant_requests(t), S.staff_users(t), S.staff_logins(t), S.courses(t))


@query(name="grant_across_term")
def _grant_across_term(spark, d):
    """A role in every course of a term."""
    t = S.Tables(spark, d)
    return grant_across_term(S.term_grant_requests(t), S.staff_users(t), S.staff_logins(t), S.courses(t))


@query(name="revoke_across_term")
def _revoke_across_term(spark, d):
    """A teacher removed from every course of a term (``removed``)."""
    t = S.Tables(spark, d)
    removed, others = revoke_across_term(S.revoke_requests(t), S.courses(t), S.staff_enrollments(t))
    return union_all(removed.withColumn("removed", F.lit(True)), others.withColumn("removed", F.lit(False)))


@query(name="last_login_report")
def _last_login_report(spark, d):
    """Last login per user, parsed from ISO text with offsets."""
    t = S.Tables(spark, d)
    as_of = t.events.agg(F.to_date(F.max("ts"))).scalar()
    return last_login_report(S.users_with_last_login(t), as_of=as_of, inactive_days=14)


@query
def roles_of_user(spark, d):
    """Every enrollment of the users named by login."""
    t = S.Tables(spark, d)
    return roles_of_users(S.role_logins(t), S.staff_users(t), S.staff_logins(t), S.staff_enrollments(t))


@query(name="roles_in_account")
def _roles_in_account(spark, d):
    """Roles of the account."""
    return roles_in_account(S.roles(S.Tables(spark, d)))


@query(name="student_list")
def _student_list(spark, d):
    """Distinct e-mails of the feed."""
    return student_list(S.feed(S.Tables(spark, d), "mixed"))


@query(name="course_staff")
def _course_staff(spark, d):
    """Teachers and TAs of every course."""
    t = S.Tables(spark, d)
    return course_staff(S.staff_enrollments(t), S.staff_users(t))


# -------------------------------------------------------------- groups ----

@query
def group_students(spark, d):
    """Students of the counselors of school 6."""
    st = S.school_tables(S.Tables(spark, d))
    return students_of_counselors(st["STU"], st["TCH"], st["ALTSCH"], 6)


@query
def group_symmetric_difference(spark, d):
    """Logins in exactly one of the two lists."""
    want, have = S.group_lists(S.Tables(spark, d))
    return group_difference(want, member_logins(have))


@query(name="group_changes")
def _group_changes(spark, d):
    """ADD / REMOVE to make the group equal the wanted list."""
    want, have = S.group_lists(S.Tables(spark, d))
    return group_changes(want, member_logins(have))


# --------------------------------------------------------------- shape ----

def _flat_mixed(spark, d):
    return flatten_feed(S.feed(S.Tables(spark, d), "mixed"))


def _underscored(df):
    return df.select(*[F.col("`" + c + "`").alias(c.replace(".", "_")) for c in df.columns])


@query
def keep_list(spark, d):
    """Keep-list projection; names that are missing are ignored."""
    flat = keep(_flat_mixed(spark, d), FEED_KEEP + ["Person.MiddleName"])
    return _underscored(flat.withColumn("CreatedDate", F.date_format("CreatedDate", "yyyy-MM-dd HH:mm:ss.SSSSSS")))


@query
def drop_list(spark, d):
    """Strict drop-list projection."""
    return _underscored(drop_strict(_flat_mixed(spark, d), ["CreatedDate", "StudentID", "Person.LastName"]))


@query(name="zip_rows")
def _zip_rows(spark, d):
    """Records and students paired by position (the reference's
    misalignment on records without or with two students)."""
    feed = S.feed(S.Tables(spark, d), "mixed")
    records = feed.select(F.col("EventEnrollmentID").alias("event_id"),
                          F.col("EnrollmentStatusCd").alias("status"))
    students = feed.select(F.col("EventEnrollmentID").alias("s_event_id"),
                           F.posexplode("Students").alias("s_pos", "s"))
    students = students.select("s_event_id", "s_pos", F.col("s.CustomerID").alias("customer_id"),
                               F.col("s.Person.Email").alias("email"))
    return zip_rows(records, students, ["event_id"], ["s_event_id", "s_pos"])


@query(name="zip_alignment")
def _zip_alignment(spark, d):
    """Records without exactly one student, and those that the
    positional zip pairs with another record's student."""
    out = zip_alignment(S.feed(S.Tables(spark, d), "mixed"), "EventEnrollmentID", "Students")
    return out.withColumnRenamed("EventEnrollmentID", "event_id")


@query
def ledger_append(spark, d):
    """The intro ledger after appending this batch's letters."""
    t = S.Tables(spark, d)
    sent = _sync(spark, d).letters.where(F.col("letter") == "intro").select(F.col("email").alias("Email"))
    return union_all(S.ledger_intro(t), sent)


# --------------------------------------------------- sources and sinks ----

def _scratch(spark, what: str) -> str:
    """A fresh path in the session's shared folder."""
    return f"{ensure_checkpoint_dir(spark)}/{what}-{uuid.uuid4().hex}"


@query
def feed_from_json(spark, d):
    """The feed written as JSON Lines, read with its fixed schema (splits
    across tasks) and flattened."""
    path = _scratch(spark, "feed")
    (S.feed(S.Tables(spark, d), "mixed").write.option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
     .json(path))
    flat = flatten_feed(read_feed(spark, path, multiline=False))
    return _underscored(flat.withColumn("CreatedDate", F.date_format("CreatedDate", "yyyy-MM-dd HH:mm:ss.SSSSSS")))


@query
def feed_from_array(spark, d):
    """The feed written as JSON array files, read by several tasks a file
    and flattened."""
    path = _scratch(spark, "feed")
    write_json_array(S.feed(S.Tables(spark, d), "mixed"), path, {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"})
    flat = flatten_feed(read_feed(spark, path))
    return _underscored(flat.withColumn("CreatedDate", F.date_format("CreatedDate", "yyyy-MM-dd HH:mm:ss.SSSSSS")))


@query
def catalogue_from_json(spark, d):
    """The catalogue written as JSON Lines, read with its fixed schema
    and flattened, one row per course and course group."""
    path = _scratch(spark, "catalogue")
    S.catalogue(S.Tables(spark, d)).write.json(path)
    return _underscored(flatten_catalogue(read_catalogue(spark, path, multiline=False)))


@query
def catalogue_from_array(spark, d):
    """The catalogue written as JSON array files, read by several tasks
    a file and flattened."""
    path = _scratch(spark, "catalogue")
    write_json_array(S.catalogue(S.Tables(spark, d)), path)
    return _underscored(flatten_catalogue(read_catalogue(spark, path)))


@query
def feed_from_manifest(spark, d):
    """The feed landed in two parts with a manifest; rows past the
    watermark and in the date window, from the files that can hold some."""
    t = S.Tables(spark, d)
    landed, feed = LandedFeed(spark, _scratch(spark, "landed")), S.feed(t)
    half = S.watermark_value(t) * 2
    landed.land(feed.where(F.col("EventEnrollmentID") <= half))
    landed.land(feed.where(F.col("EventEnrollmentID") > half))
    as_of = t.events.agg(F.date_add(F.to_date(F.min("ts")), 14).cast("string")).first()[0]
    return feed_rows(landed.read(watermark=S.watermark_value(t), as_of=as_of)).select(
        "event_id", "pos", "status", "course_code", "customer_id", "email")


@query
def identity_laid_out(spark, d):
    """J8 against a directory laid out in buckets, which isn't shuffled."""
    t, path = S.Tables(spark, d), _scratch(spark, "directory")
    lay_out_directory(path, S.users(t), S.logins(t), buckets=16)
    laid = open_directory(spark, path, buckets=16)
    return _sync(spark, d, lookups=(laid["by_login"], laid["by_external_id"])).identities.select(
        "event_id", "pos", "action", "account")


@query
def recode_from_csv(spark, d):
    """The recode map exported as CSV in several files, read back
    as text and applied in file order."""
    t, path = S.Tables(spark, d), _scratch(spark, "recode")
    export_csv(S.recode_map(t).repartitionByRange(4, "_row").sortWithinPartitions("_row").drop("_row"), path)
    return recode_courses(S.courses(t), with_file_order(read_mapping(spark, path, "recode_map")))[0]


@query
def ledger_file(spark, d):
    """The intro ledger as a CSV file, this batch's addresses appended,
    read back."""
    path = _scratch(spark, "ledger")
    append_ledger(S.ledger_intro(S.Tables(spark, d)), path)
    append_ledger(_sync(spark, d).letters.where(F.col("letter") == "intro"), path, "email")
    return read_mapping(spark, path, "ledger")


@query
def messages_file(spark, d):
    """The run's message lines exported as files that concatenate to
    event order, read back with their place in it."""
    path = _scratch(spark, "messages")
    lines = run_messages(_sync(spark, d)).withColumn("line", F.concat_ws(
        " ", "event_id", "pos", F.concat("kind", F.lit(":")), "message"))
    export_ordered(lines, path, ["event_id", "pos", "kind", "message"], "line")
    return row_index(read_ordered(spark, path), ["file", "at"]).select("row_no", "line")


@query
def watermark_state(spark, d):
    """The saved watermark read, the feed past it consumed, the next
    one saved and read back."""
    t, path = S.Tables(spark, d), _scratch(spark, "watermark")
    write_watermark(S.watermark(t), path)
    old = read_watermark(spark, path).first()[0]
    new = since(feed_rows(S.feed(t)), old).agg(F.max("event_id").alias("EventEnrollmentID"))
    write_watermark(new, path + "-next")
    return read_watermark(spark, path + "-next").select(
        F.lit(old).cast("long").alias("old_watermark"), F.col("EventEnrollmentID").alias("new_watermark"))


@query
def snapshots_read(spark, d):
    """Every LMS snapshot written with a column that its schema doesn't
    know and read by its declared columns: rows and sum of ids of each."""
    t, path = S.Tables(spark, d), _scratch(spark, "lms")
    tables = {
        "accounts": (S.accounts(t), "account_id"), "content": (S.content(t), "item_id"),
        "courses": (S.courses(t), "course_id"), "enrollments": (S.staff_enrollments(t), "id"),
        "group_members": (S.group_lists(t)[1], "id"), "logins": (S.logins(t), "user_id"),
        "roles": (S.roles(t), "id"), "terms": (S.terms(t), "enrollment_term_id"), "users": (S.users(t), "id"),
    }
    out = []
    for name, (df, key) in tables.items():
        df.withColumn("unknown_column", F.lit(1)).write.parquet(f"{path}/{name}")
        out.append(read_snapshot(spark, name, f"{path}/{name}").agg(
            F.lit(name).alias("name"), F.count(F.lit(1)).alias("n"), F.sum(key).alias("ids")))
    return union_all(*out)


@query
def roster_state(spark, d):
    """K4: the roster state (last enrollment id per account and course) after
    this batch's change set, which rewrites the buckets it falls into: dropped
    pairs go, enrolled ones hold no id yet."""
    t, path = S.Tables(spark, d), _scratch(spark, "changes")
    write_change_set(_sync(spark, d).enrollments, path, "1")
    last = last_per_key(spark.read.parquet(f"{path}/batch_id=1"), ["account", "course_code"],
                        ["event_id", "pos"], ["action"], prefix="")
    updates = last.select("account", "course_code", F.lit(None).cast("long").alias("last_id"),
                          (F.col("action") != "ENROLL").alias("gone"))
    state = KeyedState(spark, path + "-state", "roster", ["account", "course_code"],
                       "account string, course_code string, last_id long", buckets=32)
    state.upsert(S.student_enrollments(t).groupBy(
        F.col("user_id").cast("string").alias("account"), F.col("sis_course_id").alias("course_code")).agg(
        F.max("id").alias("last_id")))
    state.upsert(updates, delete_col="gone")
    return state.read()


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(REGISTRY)
