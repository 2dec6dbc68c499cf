"""The directory laid out for lookups, and the manifest of landed files."""

import os

import pytest

from helpers import enrollments_df, feed_df, feed_record, logins_df, rows_of, users_df
from rollcall.operators.identity import first_rows, resolve_first_rows, resolve_users
from rollcall.sources.directory import lay_out_directory, open_directory, roles_of_accounts
from rollcall.sources.landed import LandedFeed


def rows(spark, n):
    return spark.createDataFrame([(i, 0, f"c{i % 37}", f"U{i % 50}@x.org", "F", "L") for i in range(n)],
                                 "event_id long, pos int, customer_id string, email string, first_name string, "
                                 "last_name string")


@pytest.fixture()
def no_broadcast(spark):
    keep = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", keep)


def exchanges_above(df, table):
    """Exchanges and aggregates between a table's scan and the join above it."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    lines = plan.split("\n")
    at = next(i for i, line in enumerate(lines) if "FileScan" in line and table in line)
    depth = len(lines[at]) - len(lines[at].lstrip(" :+-"))
    found = []
    for line in reversed(lines[:at]):
        d = len(line) - len(line.lstrip(" :+-"))
        if d < depth:
            depth = d
            if "Join" in line:
                return found
            if "Exchange" in line or "Aggregate" in line:
                found.append(line.strip())
    return found


def test_lookups_without_moving_the_directory(spark, tmp_dir, no_broadcast):
    users = users_df(spark, [(i, f"u{i}@x.org", f"c{i}") for i in range(0, 60, 2)])
    logins = logins_df(spark, [(i, f"u{i}@x.org") for i in range(0, 60, 2)])
    enr = enrollments_df(spark, [(i, 0, "8", i % 20, "StudentEnrollment", "active") for i in range(100)])
    path = os.path.join(tmp_dir, "directory")
    lay_out_directory(path, users, logins, enr, buckets=8)
    laid = open_directory(spark, path, buckets=8)
    batch = rows(spark, 200)
    lookups = (laid["by_login"], laid["by_external_id"])
    got = resolve_first_rows(None, None, None, lookups=lookups, first=first_rows(batch))
    want = resolve_first_rows(batch, users, logins)
    cols = ("e", "first_action", "account")
    assert rows_of(got, *cols) == rows_of(want, *cols)
    assert rows_of(resolve_users(batch, None, None, firsts=got), "event_id", "action", "account") == rows_of(
        resolve_users(batch, None, None, firsts=want), "event_id", "action", "account")
    assert exchanges_above(got, "rollcall_by_login") == [] and exchanges_above(got, "rollcall_by_external_id") == []
    asked = spark.createDataFrame([("u4@x.org", 4), ("u6@x.org", 6), ("none", 99)], "login string, user_id long")
    found = roles_of_accounts(asked, laid["enrollments_by_user"])
    assert exchanges_above(found, "rollcall_enrollments_by_user") == []
    assert rows_of(found, "login", "enrollment_id") == sorted(
        (f"u{i % 20}@x.org", i) for i in range(100) if i % 20 in (4, 6))


def records(ids):
    return [feed_record(i, "7", [("c", f"u{i}@x.org", "A", "B")]) for i in ids]


def test_manifest_prunes_files_and_counts_late_rows(spark, tmp_dir, monkeypatch):
    landed = LandedFeed(spark, os.path.join(tmp_dir, "landed"))
    assert landed.read(watermark=0).count() == 0
    first = landed.land(feed_df(spark, records(range(0, 100))), files=5)
    second = landed.land(feed_df(spark, records([95, 20, 130, 120, 110])), files=2)
    opened = []
    real = LandedFeed._open

    def spy(self, files):
        opened.extend(r.file for r in files.collect())
        return real(self, files)

    monkeypatch.setattr(LandedFeed, "_open", spy)
    got = landed.read(watermark=90)
    assert sorted(r.EventEnrollmentID for r in got.collect()) == sorted([*range(91, 100), 95, 110, 120, 130])
    assert len(opened) < 7 and got.count() == 13
    del opened[:]
    assert sorted(r.EventEnrollmentID for r in landed.late(99, first).collect()) == [20, 95]
    assert landed.count_late(99, first) == 2 and all(f"{second:020d}" in f for f in opened)
    assert landed.count_late(99, second) == 0
    assert landed.manifest().count() == 7


def test_manifest_prunes_by_date(spark, tmp_dir):
    landed = LandedFeed(spark, os.path.join(tmp_dir, "landed"))
    landed.land(feed_df(spark, records([i * 1440 for i in range(60)])), files=6)     # a record a day from 2024-01-01
    got = landed.read(as_of="2024-01-20", days_back=7, days_ahead=3)
    assert sorted(r.EventEnrollmentID // 1440 for r in got.collect()) == list(range(12, 23))
