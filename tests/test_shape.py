import pytest
from pyspark.sql import functions as F

from helpers import feed_df, feed_record, rows_of
from rollcall.operators.feed import FEED_KEEP, feed_rows, flatten_feed
from rollcall.operators.shape import drop_strict, flatten, keep, missing_columns, row_index, zip_rows


@pytest.fixture()
def feed(spark):
    return feed_df(spark, [
        feed_record(1, "0042", []),                                          # no student
        feed_record(2, "7", [("c1", "a@x.org", "A", "B")]),                  # one
        feed_record(3, "7", [("c2", "b@x.org", "C", "D"), ("c3", "c@x.org", "E", "F")]),  # two
    ])


def test_flatten_dotted_names(feed):
    flat = flatten(feed.drop("Students"))
    assert flat.columns == ["EventEnrollmentID", "EnrollmentStatusCd", "CreatedDate",
                            "ScheduledEvent.EventCd", "ScheduledEvent.Course.CourseName",
                            "ScheduledEvent.Course.IsOnline"]
    assert flatten(feed.drop("Students"), sep="_", max_level=1).columns[-1] == "ScheduledEvent_Course"


def test_explode_keeps_records_without_students(feed):
    flat = flatten_feed(feed)
    got = rows_of(flat, "EventEnrollmentID", "pos", "CustomerID")
    assert got == [(1, None, None), (2, 0, "c1"), (3, 0, "c2"), (3, 1, "c3")]
    # leading zeros of codes survive
    assert flat.where("EventEnrollmentID = 1").first()["ScheduledEvent.EventCd"] == "0042"


def test_feed_rows_canonical(feed):
    rows = feed_rows(feed)
    assert set(rows.columns) >= {"event_id", "pos", "email", "customer_id", "course_code", "status"}
    assert rows_of(rows, "event_id", "pos") == [(1, 0), (2, 0), (3, 0), (3, 1)]


def test_keep_ignores_missing_and_keeps_order(feed):
    flat = flatten_feed(feed)
    k = keep(flat, ["Person.Email", "EventEnrollmentID", "Nope"])
    assert k.columns == ["EventEnrollmentID", "Person.Email"]
    assert missing_columns(flat, FEED_KEEP) == ["pos"]


def test_drop_strict_fails_on_missing(feed):
    flat = flatten_feed(feed)
    assert "pos" not in drop_strict(flat, ["pos"]).columns
    with pytest.raises(KeyError):
        drop_strict(flat, ["pos", "Nope"])


def test_row_index_is_consecutive(spark):
    df = spark.range(0, 1000, 1, 7).select((F.col("id") * 3).alias("k"))
    idx = row_index(df, ["k"], partitions=5)
    got = sorted((r["row_no"], r["k"]) for r in idx.collect())
    assert got == [(i + 1, 3 * i) for i in range(1000)]


def test_zip_rows_misaligns_like_the_reference(feed):
    """Pairing by position is only right with one student per record."""
    records = feed.select(F.col("EventEnrollmentID").alias("event_id"))
    students = feed.select(F.col("EventEnrollmentID").alias("s_event_id"),
                           F.posexplode("Students").alias("s_pos", "s"))
    z = zip_rows(records, students.select("s_event_id", "s_pos"), ["event_id"], ["s_event_id", "s_pos"])
    got = rows_of(z, "row_no", "event_id", "s_event_id")
    assert got == [(1, 1, 2), (2, 2, 3), (3, 3, 3)]
