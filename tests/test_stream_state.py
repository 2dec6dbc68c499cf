"""The committed state of scheduled and streamed runs: markers, replays,
conflicts, compaction and clean-up."""

import json
import os

import pytest

from helpers import courses_df, enrollments_df, feed_df, feed_record, logins_df, users_df
from rollcall.plans.sync import sync_batch
from rollcall.sources.commits import CommitConflict, CommitLog, _rename_if_absent, create_if_absent
from rollcall.streaming.sync_stream import StreamState, output_folders, read_output, run_micro_batch, run_sync


class Job:
    """One job's folders and snapshot."""

    def __init__(self, spark, tmp_dir):
        self.spark, self.state, self.out = spark, os.path.join(tmp_dir, "state"), os.path.join(tmp_dir, "out")
        self.snapshot = dict(users=users_df(spark, [(1, "b@x.org", "c2")]), logins=logins_df(spark, [(1, "b@x.org")]),
                             enrollments=enrollments_df(spark, [(1, 0, "8", 1, "StudentEnrollment", "active")]),
                             courses=courses_df(spark, ["7", "8"]))

    def options(self, **more):
        return dict(out_dir=self.out, state_dir=self.state, **self.snapshot, **more)

    def batch(self, batch_id, records, **more):
        run_micro_batch(feed_df(self.spark, records), batch_id, **self.options(**more))

    def actions(self):
        return sorted((r.event_id, r.action, r.account, r.course_code)
                      for r in read_output(self.spark, self.out, self.state, "actions").collect())

    def expected(self, records):
        res = sync_batch(feed_df(self.spark, records), **self.snapshot)
        return sorted((r.event_id, r.action, r.account, r.course_code) for r in res.actions().collect())


@pytest.fixture()
def job(spark, tmp_dir):
    return Job(spark, tmp_dir)


def rec(i, status="ENROLLED", code="7", mail=None, customer=None):
    return feed_record(i, code, [(customer or f"c{i}", mail or f"u{i}@x.org", "A", "B")], status=status)


def test_watermark_stays_after_each_compaction(job):
    """Unsorted ids, folded before every batch: a late file plans nothing."""
    parts = [[rec(10), rec(5)], [rec(30), rec(20)], [rec(25)], [rec(28), rec(40, "DROPPED", mail="u10@x.org")]]
    for k, part in enumerate(parts):
        job.batch(k, part, compact_every=1)
    assert job.actions() == job.expected([rec(10), rec(5), rec(30), rec(20), rec(40, "DROPPED", mail="u10@x.org")])
    assert CommitLog(job.spark, job.state).table("watermark", "EventEnrollmentID long").collect()[-1][0] == 40
    report = {r.batch_id: (r.rows_below_watermark, r.old_watermark)
              for r in read_output(job.spark, job.out, job.state, "report").collect()}
    assert report[2] == (1, 30) and report[3] == (1, 30)


def test_crash_in_the_first_state_write_is_replayed(job, spark):
    """What the crash leaves, even a folder without a readable file, is never read."""
    for name in ("logins", "roster", "watermark"):
        os.makedirs(os.path.join(job.state, name, "batch_id=0", "attempt=00000000000000000000-dead", "_temporary"))
    job.batch(0, [rec(1), rec(2)])
    job.batch(1, [rec(3)])
    assert job.actions() == job.expected([rec(1), rec(2), rec(3)])


@pytest.mark.parametrize("step", ["messages", "logins", "commit"])
def test_killed_at_any_step_and_replayed(job, monkeypatch, step):
    job.batch(0, [rec(1)])
    with monkeypatch.context() as m:
        def fail(real, what):
            def run(self, *args):
                if what is None or args[1] == what:
                    raise RuntimeError("killed")
                return real(self, *args)
            return run
        if step == "commit":
            m.setattr(CommitLog, "commit", fail(None, None))
        elif step == "messages":
            m.setattr(StreamState, "write_output", fail(StreamState.write_output, step))
        else:
            m.setattr(StreamState, "write", fail(StreamState.write, step))
        with pytest.raises(RuntimeError, match="killed"):
            job.batch(1, [rec(2), rec(1, "DROPPED")])
        assert job.actions() == job.expected([rec(1)])
    job.batch(1, [rec(2), rec(1, "DROPPED")])
    job.batch(1, [rec(2), rec(1, "DROPPED")])       # replayed after its commit: nothing happens
    job.batch(2, [rec(3)])
    assert job.actions() == job.expected([rec(1), rec(2), rec(3)])
    plain = job.spark.read.parquet(os.path.join(job.out, "actions"))    # what the crash left is gone
    assert plain.count() == len(job.actions())


def test_two_runs_on_one_state_give_one_commit(job, spark, monkeypatch):
    records = [rec(1), rec(2)]
    real = CommitLog.commit

    def overtaken(log, entry):
        monkeypatch.setattr(CommitLog, "commit", real)
        run_sync(feed_df(spark, records), **job.options())     # another run, planned and committed meanwhile
        real(log, entry)

    monkeypatch.setattr(CommitLog, "commit", overtaken)
    with pytest.raises(CommitConflict):
        run_sync(feed_df(spark, records), **job.options())
    assert CommitLog(spark, job.state).versions() == [0]
    assert job.actions() == job.expected(records)
    assert run_sync(feed_df(spark, records + [rec(9)]), **job.options()) == 1
    assert job.actions() == job.expected(records + [rec(9)])


def test_old_folders_and_markers_are_removed(job):
    records = []
    for k in range(5):
        records.append(rec(k + 1, mail=f"m{k % 3}@x.org", customer=f"c{k % 3}"))
        job.batch(k, records[-1:], compact_every=2, keep_versions=2)
    log = CommitLog(job.spark, job.state)
    assert len(log.versions()) <= 3
    held = [os.path.join(d, x) for d, sub, _ in os.walk(os.path.join(job.state, "logins")) for x in sub
            if x.startswith("attempt=")]
    assert len(held) <= 5
    assert job.actions() == job.expected(records)
    assert len(output_folders(job.spark, job.out, job.state, "actions")) == 5


def test_stopped_batch_keeps_its_outputs_until_it_is_done(job):
    bad = [rec(1), rec(2, code="9"), rec(3)]
    for _ in range(2):
        with pytest.raises(RuntimeError, match="UNKNOWN_COURSE"):
            job.batch(0, bad, on_error="stop")
        got = {(a[0], a[1]) for a in job.actions() if a[1] == "ENROLL"}
        assert got == {(1, "ENROLL")}
    job.batch(0, bad)
    assert job.actions() == job.expected(bad)


def test_state_without_a_log_is_taken_over(job, spark):
    """Folders per batch, as written before there was a commit log."""
    def old(name, batch, rows, schema):
        spark.createDataFrame(rows, schema).write.parquet(os.path.join(job.state, name, f"batch_id={batch}"))
    old("watermark", 0, [(10,)], "EventEnrollmentID long")
    old("watermark", 1, [(20,)], "EventEnrollmentID long")
    old("logins", 0, [("z@x.org", "new:z")], "e string, dir_e string")
    old("logins", 1, [("z@x.org", "new:zz")], "e string, dir_e string")
    old("ids", 1, [("z", "new:zz", "z@x.org")], "c string, dir_c string, dir_login string")
    old("roster", 1, [("new:zz", "7", True)], "account string, course_code string, active boolean")
    job.batch(2, [rec(15), rec(30, "DROPPED", mail="Z@x.org", customer="z")])
    assert job.actions() == [(30, "DROP", "new:zz", "7")]


def test_a_marker_is_created_once(spark, tmp_dir):
    path = os.path.join(tmp_dir, "log", "1.json")
    assert create_if_absent(spark, path, json.dumps({"a": "ä"}))
    assert not create_if_absent(spark, path, "other")
    assert json.load(open(path, encoding="utf-8")) == {"a": "ä"} and os.listdir(os.path.dirname(path)) == ["1.json"]


def test_rename_refuses_to_overwrite(spark, tmp_dir):
    """The form for file systems with an atomic rename."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    for n in ("a", "b"):
        with open(os.path.join(tmp_dir, n), "w") as fh:
            fh.write(n)
    target = path(f"file://{tmp_dir}/t")
    assert _rename_if_absent(spark, path(f"file://{tmp_dir}/a"), target)
    assert not _rename_if_absent(spark, path(f"file://{tmp_dir}/b"), target)
    assert open(os.path.join(tmp_dir, "t")).read() == "a"
