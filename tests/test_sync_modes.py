"""Sync modes: watermark (T3), replay, stop vs quarantine, intro course (T6),
report, and the streaming sync equal to one batch (SURVEY §5 (d) (e))."""

import json
import os

import pytest
from pyspark.sql import functions as F

from helpers import courses_df, enrollments_df, feed_df, feed_record, logins_df, users_df
from rollcall.plans.sync import sync_batch
from rollcall.sources.files import read_watermark, write_watermark


def _inputs(spark):
    recs = [
        feed_record(30, "7", [("c1", "a@x.org", "Ann", "Lee")]),
        feed_record(10, "7", [("c2", "b@x.org", "Bob", "Ray")]),            # unsorted ids
        feed_record(20, "8", [("c1", "a2@x.org", "Ann", "Lee")], status="DROPPED"),
        feed_record(40, "9", [("c3", "c@x.org", "Cy", "Do")]),              # unknown course
        feed_record(50, "7", [("c1", "A@x.org", "Ann", "Lee")], status="DROPPED"),
        feed_record(60, "7", [("c1", "a@x.org", "Ann", "Lee")], status="PEND"),
        feed_record(70, "8", [("c4", "", "No", "Mail")]),                    # blank e-mail
        feed_record(80, "8", [("c5", "e@x.org", "Ed", "Fu")]),
    ]
    users = users_df(spark, [(1, "b@x.org", "c2"), (2, "old@y.org", "c5")])
    logins = logins_df(spark, [(1, "b@x.org"), (2, "old@y.org")])
    enr = enrollments_df(spark, [(1, 0, "8", 2, "StudentEnrollment", "active")])
    return feed_df(spark, recs), users, logins, enr, courses_df(spark, ["7", "8"])


def _actions(res):
    return sorted((r.event_id, r.action, r.account, r.course_code) for r in res.actions().collect())


def test_watermark_is_max_and_never_goes_back(spark):
    feed, users, logins, enr, courses = _inputs(spark)
    res = sync_batch(feed, users, logins, enr, courses, watermark=25)
    assert res.watermark().first()[0] == 80
    res = sync_batch(feed, users, logins, enr, courses, watermark=500)
    assert res.watermark().first()[0] == 500
    assert res.actions().count() == 0


def test_quarantine_plans_everything_else(spark):
    feed, users, logins, enr, courses = _inputs(spark)
    res = sync_batch(feed, users, logins, enr, courses, new_user_course="INTRO")
    acts = _actions(res)
    assert (10, "ENROLL", "1", "7") in acts                      # known by e-mail
    assert (20, "CREATE_USER", "new:c1", None) in acts           # first row of c1 reaches step 4
    assert (20, "ENROLL_INTRO", "new:c1", "INTRO") in acts
    assert (20, "DROP_NOT_FOUND", "new:c1", "8") in acts
    assert (30, "CHANGE_LOGIN", "new:c1", None) in acts          # same customer, new e-mail
    assert (30, "ENROLL", "new:c1", "7") in acts
    assert (50, "DROP", "new:c1", "7") in acts                   # mixed case finds a@x.org
    assert (60, "ENROLL", "new:c1", "7") in acts                 # PEND enrolls
    assert (40, "REJECT_UNKNOWN_COURSE", "new:c3", "9") in acts
    assert (70, "REJECT_BLANK_EMAIL", None, "8") in acts
    assert (80, "CHANGE_LOGIN", "2", None) in acts and (80, "ADD_LOGIN", "2", None) in acts
    assert (80, "ENROLL", "2", "8") in acts
    final = {(r.account, r.course_code): r.active for r in res.final_state.collect()}
    assert final[("new:c1", "7")] is True and final[("new:c1", "8")] is False
    ch = {r.event_id: (r.old_login, r.new_login) for r in res.login_changes.collect()}
    assert ch == {30: ("a2@x.org", "a@x.org"), 80: ("old@y.org", "e@x.org")}
    rep = res.report().first()
    assert (rep.rows_seen, rep.rejected_blank_email, rep.rejected_unknown_course) == (8, 1, 1)
    assert (rep.new_users, rep.changed_logins, rep.returning_users) == (2, 2, 3)
    assert res.watermark().first()[0] == 80


def test_blank_intro_course_plans_nothing(spark):
    """The intro enrollment is guarded, not only its log line."""
    feed, users, logins, enr, courses = _inputs(spark)
    res = sync_batch(feed, users, logins, enr, courses, new_user_course="")
    assert res.intro_enrollments.count() == 0


def test_stop_mode_plans_rows_before_the_first_bad_one(spark):
    feed, users, logins, enr, courses = _inputs(spark)
    res = sync_batch(feed, users, logins, enr, courses, on_error="stop")
    ev = {r.event_id for r in res.enrollments.collect()}
    assert ev == {10, 20, 30}
    # the failing row's (unknown course) own user action is planned
    assert {r.event_id for r in res.user_creations.collect()} == {20, 40}
    assert res.watermark().first()[0] == 0
    assert res.skipped.count() == 0


def test_replay_is_idempotent_and_split_batches_agree(spark):
    feed, users, logins, enr, courses = _inputs(spark)
    once = _actions(sync_batch(feed, users, logins, enr, courses))
    again = _actions(sync_batch(feed, users, logins, enr, courses))
    assert once == again
    # batch split at a watermark: the second half sees no first-half row
    first = sync_batch(feed.where("EventEnrollmentID <= 30"), users, logins, enr, courses)
    wm = first.watermark().first()[0]
    second = sync_batch(feed, users, logins, enr, courses, watermark=wm)
    assert {r.event_id for r in second.rows.collect()} == {40, 50, 60, 70, 80}


def test_watermark_state_round_trip(spark, tmp_dir):
    path = os.path.join(tmp_dir, "wm")
    assert read_watermark(spark, path).first()[0] == 0
    write_watermark(spark.createDataFrame([(42,)], "EventEnrollmentID long"), path)
    assert read_watermark(spark, path).first()[0] == 42


@pytest.mark.parametrize("compact_every", [50, 1])
def test_stream_equals_batch(spark, tmp_dir, compact_every):
    feed, users, logins, enr, courses = _inputs(spark)
    feed_dir = os.path.join(tmp_dir, "feed")
    os.makedirs(feed_dir)
    rows = [json.loads(j) for j in feed.toJSON().collect()]
    rows.sort(key=lambda r: r["EventEnrollmentID"])
    # three landed files, one per micro-batch
    for i, part in enumerate([rows[:3], rows[3:5], rows[5:]]):
        with open(os.path.join(feed_dir, f"f{i}.json"), "w") as fh:
            json.dump(part, fh)
    from rollcall.streaming import sync_stream
    q = sync_stream(spark, feed_dir, out_dir=os.path.join(tmp_dir, "out"),
                    state_dir=os.path.join(tmp_dir, "state"), checkpoint_location=os.path.join(tmp_dir, "ckpt"),
                    users=users, logins=logins, enrollments=enr, courses=courses,
                    max_files_per_trigger=1, new_user_course="INTRO", compact_every=compact_every)
    q.awaitTermination(300)
    out = spark.read.parquet(os.path.join(tmp_dir, "out", "actions"))
    assert out.select("batch_id").distinct().count() == 3
    streamed = sorted((r.event_id, r.action, r.account, r.course_code) for r in out.collect())
    batch = _actions(sync_batch(feed, users, logins, enr, courses, new_user_course="INTRO"))
    assert streamed == batch
    wm = spark.read.parquet(os.path.join(tmp_dir, "state", "watermark")).agg(F.max("EventEnrollmentID"))
    assert wm.first()[0] == 80
    assert os.path.isdir(os.path.join(tmp_dir, "state", "compact", "roster")) == (compact_every == 1)
