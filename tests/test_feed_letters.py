"""Feed filters (P9 P13 P15 J4-J6 J10) and letters (J7), with the traps
T2, T4 and T7 as cases."""

import datetime

from helpers import courses_df, feed_df, feed_record, rows_of
from rollcall.functions import email_key
from rollcall.operators.feed import (
    below_watermark, date_window, feed_rows, only_listed, since, split_skipped,
    split_unknown_courses, validate_email,
)
from rollcall.operators.letters import unsent


def _rows(spark):
    return feed_rows(feed_df(spark, [
        feed_record(5, "0042", [("c1", "a@x.org", "A", "B")]),
        feed_record(3, "42", [("c2", "", "C", "D")]),
        feed_record(9, "7", [("c3", None, "E", "F")], online=True),
        feed_record(1, "7", [("c4", "  ", "G", "H")]),
        feed_record(7, "8", [("c5", "Mixed@X.org", "I", "J")]),
        feed_record(8, None, [("c6", "n@x.org", "K", "L")]),
    ]))


def test_since_number_and_state(spark):
    rows = _rows(spark)
    assert rows_of(since(rows, 5), "event_id") == [(7,), (8,), (9,)]
    state = spark.createDataFrame([(5,), (3,)], "EventEnrollmentID long")
    assert rows_of(since(rows, state), "event_id") == [(7,), (8,), (9,)]
    assert rows_of(below_watermark(rows, 5), "event_id") == [(1,), (3,), (5,)]


def test_watermark_filter_reaches_parquet_scan(spark, tmp_dir):
    rows = _rows(spark)
    rows.write.parquet(tmp_dir + "/rows")
    plan = since(spark.read.parquet(tmp_dir + "/rows"), 5)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(event_id,5)" in plan


def test_skip_list_text_codes_keep_leading_zeros(spark):
    """T2: '0042' and '42' are different codes; a null code is never listed."""
    rows = _rows(spark)
    skip = spark.createDataFrame([("0042",), (None,)], "CourseCode string")
    kept, skipped = split_skipped(rows, skip)
    assert rows_of(skipped, "event_id") == [(5,)]
    assert rows_of(kept, "event_id") == [(1,), (3,), (7,), (8,), (9,)]


def test_online_override_with_real_booleans(spark):
    """A skipped course is kept when it is online."""
    rows = _rows(spark)
    skip = spark.createDataFrame([("7",)], "CourseCode string")
    kept, skipped = split_skipped(rows, skip, online_override=True)
    assert rows_of(skipped, "event_id") == [(1,)]
    assert (9,) in rows_of(kept, "event_id")


def test_allow_list(spark):
    kept, other = only_listed(_rows(spark), spark.createDataFrame([("7",)], "CourseCode string"))
    assert rows_of(kept, "event_id") == [(1,), (9,)]
    assert len(rows_of(other, "event_id")) == 4


def test_blank_and_missing_email_reject(spark):
    good, bad = validate_email(_rows(spark))
    assert rows_of(bad, "event_id") == [(1,), (3,), (9,)]
    assert {r.reason for r in bad.collect()} == {"BLANK_EMAIL"}


def test_unknown_courses(spark):
    good, bad = split_unknown_courses(_rows(spark), courses_df(spark, ["7", "42"]))
    assert rows_of(good, "event_id") == [(1,), (3,), (9,)]
    assert rows_of(bad, "event_id") == [(5,), (7,), (8,)]


def test_date_window(spark):
    rows = feed_rows(feed_df(spark, [
        feed_record(1, "7", [("c", "a@x.org", "A", "B")], created=datetime.datetime(2024, 1, 1)),
        feed_record(2, "7", [("c", "a@x.org", "A", "B")], created=datetime.datetime(2024, 1, 10)),
        feed_record(3, "7", [("c", "a@x.org", "A", "B")], created=datetime.datetime(2024, 5, 1)),
        feed_record(4, "7", [("c", "a@x.org", "A", "B")], created=datetime.datetime(2024, 5, 2)),
    ]))
    got = rows_of(date_window(rows, "2024-01-10"), "event_id")
    assert got == [(2,), (3,)]


def _resolved(spark, emails):
    return spark.createDataFrame(
        [(i, 0, e, f"acct{i}") for i, e in enumerate(emails)],
        "event_id long, pos int, email string, account string").withColumn("e", email_key("email"))


def test_letters_exact_one_per_address(spark):
    res = _resolved(spark, ["a@x.org", "A@X.org", "b+1@x.org", "ab@x.org"])
    ledger = spark.createDataFrame([("B+1@x.org",), ("xab@x.org",)], "Email string")
    got = rows_of(unsent(res, ledger, "intro"), "event_id", "email", "letter")
    assert got == [(0, "a@x.org", "intro"), (3, "ab@x.org", "intro")]


def test_letters_regex_keeps_reference_quirks(spark):
    """T4: the address is an unescaped, case-sensitive regex searched in the
    ledger: a substring suppresses, '+' breaks a self-match."""
    res = _resolved(spark, ["b+1@x.org", "ab@x.org", "a@x.org"])
    ledger = spark.createDataFrame([("b+1@x.org",), ("xab@x.org",)], "Email string")
    got = rows_of(unsent(res, ledger, "intro", match="regex"), "email")
    assert got == [("a@x.org",), ("b+1@x.org",)]
