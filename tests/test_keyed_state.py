"""State updated in part (K4), the join of hot e-mails (W2), the alignment
report of the positional zip (T1) and ordered text files (A7)."""

import os
import random

import pytest
from pyspark.sql import functions as F

from helpers import rows_of
from rollcall.operators import ordered
from rollcall.operators.identity import first_rows, resolve_first_rows, resolve_users
from rollcall.operators.shape import running_total, zip_alignment, zip_rows
from rollcall.sources import CommitConflict, CommitLog, KeyedState, export_ordered, read_ordered

SCHEMA = "account string, course string, n long"


def state_of(spark, tmp_dir, **options):
    return KeyedState(spark, os.path.join(tmp_dir, "state"), "roster", ["account", "course"], SCHEMA, **options)


def updates(spark, rows):
    return spark.createDataFrame(rows, SCHEMA + ", gone boolean")


def files(state):
    return {b: sorted(os.listdir(os.path.join(state.log.dir, f))) for b, f in state.folders().items()}


def test_only_touched_buckets_are_written(spark, tmp_dir):
    state = state_of(spark, tmp_dir, buckets=16)
    first = [(f"a{i}", f"c{i % 7}", i) for i in range(300)]
    assert len(state.upsert(spark.createDataFrame(first, SCHEMA))) == 16
    before = files(state)
    touched = state.upsert(updates(spark, [("a1", "c1", 1000, False), ("a2", "c2", None, True), ("new", "c", 5, False),
                                           ("never", "there", 0, True)]), "gone")
    after = files(state)
    assert 1 <= len(touched) <= 4
    assert {b for b in after if after[b] != before[b]} <= set(touched)
    want = {(a, c): n for a, c, n in first}
    want[("a1", "c1")] = 1000
    want[("new", "c")] = 5
    del want[("a2", "c2")]
    assert {(r.account, r.course): r.n for r in state.read().collect()} == want
    asked = spark.createDataFrame([("a1", "c1"), ("a2", "c2"), ("a9", "c2")], "account string, course string")
    assert rows_of(state.of_keys(asked), "account", "n") == [("a1", 1000), ("a9", 9)]


def test_buckets_that_empty_and_come_back(spark, tmp_dir):
    state = state_of(spark, tmp_dir, buckets=4)
    assert state.read().count() == 0
    state.upsert(updates(spark, [("a", None, 1, False), ("b", "c", 2, False)]), "gone")
    state.upsert(updates(spark, [("b", "c", 0, True)]), "gone")
    assert rows_of(state.read(), "account", "course", "n") == [("a", None, 1)]
    state.upsert(updates(spark, [("b", "c", 3, False)]), "gone")
    state.rebucket(9)
    again = state_of(spark, tmp_dir)        # the log knows the number of buckets
    assert again.buckets == 9 and again.read().count() == 2
    with pytest.raises(ValueError, match="one key"):
        state.upsert(updates(spark, [("b", "c", 3, False), ("b", "c", 4, False)]), "gone")


def test_an_overtaken_update_changes_nothing_and_vacuum_keeps_what_is_read(spark, tmp_dir, monkeypatch):
    state, real = state_of(spark, tmp_dir, buckets=4), CommitLog.commit
    state.upsert(spark.createDataFrame([(f"a{i}", "c", i) for i in range(40)], SCHEMA))

    def overtaken(log, entry):
        monkeypatch.setattr(CommitLog, "commit", real)
        state.upsert(updates(spark, [("a1", "c", 100, False)]), "gone")
        real(log, entry)

    monkeypatch.setattr(CommitLog, "commit", overtaken)
    with pytest.raises(CommitConflict):
        state.upsert(updates(spark, [("a1", "c", 200, False)]), "gone")
    assert dict((r.account, r.n) for r in state.read().collect())["a1"] == 100
    for k in range(3):
        state.upsert(updates(spark, [(f"a{k}", "c", -k, False)]), "gone")
    assert state.vacuum(keep=1)
    assert {r.account: r.n for r in state.read().collect()} == {**{f"a{i}": i for i in range(40)}, "a1": -1, "a2": -2}
    held = [x for d, sub, _ in os.walk(os.path.join(state.log.dir, "roster")) for x in sub if x.startswith("bucket=")]
    assert len(held) == 4


def test_a_hot_email_stays_spread(spark, monkeypatch):
    """One e-mail in a third of the rows: no task of the join holds them all,
    with adaptive execution off."""
    monkeypatch.setattr(ordered, "HEAVY_ROWS", 100)
    rng = random.Random(4)
    mails = ["Hot@x.org" if i % 3 == 0 else f"u{rng.randrange(900)}@x.org" for i in range(3000)]
    rows = spark.createDataFrame([(i, 0, f"c{i % 50}", m, "F", "L") for i, m in enumerate(mails)],
                                 "event_id long, pos int, customer_id string, email string, first_name string, "
                                 "last_name string").repartition(8)
    none = (spark.createDataFrame([], "e string, dir_e string"),
            spark.createDataFrame([], "c string, dir_c string, dir_login string"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        firsts = resolve_first_rows(None, None, None, lookups=none, first=first_rows(rows))
        out = resolve_users(rows, None, None, firsts=firsts)
        assert "e_rows" not in out.columns
        per_task = [r["count"] for r in out.groupBy(F.spark_partition_id().alias("p")).count().collect()]
        accounts = out.groupBy("e").agg(F.count_distinct("account").alias("a"), F.count("*").alias("n")).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(per_task) == 3000 and max(per_task) < 700
    assert all(r.a == 1 for r in accounts) and {r.n for r in accounts if r.e == "hot@x.org"} == {1000}


def test_heavy_keys_beyond_the_broadcast_are_joined_too(spark, monkeypatch):
    monkeypatch.setattr(ordered, "HEAVY_ROWS", 2)
    monkeypatch.setattr(ordered, "HEAVY_KEYS", 2)
    rows = spark.createDataFrame([(k, i) for k in "abcde" for i in range(3)] + [(None, 9), ("z", 1)], "k string, i int")
    per_key = rows.groupBy("k").agg(F.max("i").alias("top"), F.count("*").alias("n"))
    out = ordered.join_per_key(rows, per_key, "k", "n")
    assert rows_of(out, "k", "i", "top") == sorted([(k, i, 2) for k in "abcde" for i in range(3)] + [("z", 1, 1)])


def test_alignment_report_agrees_with_the_zip(spark):
    rng = random.Random(7)
    data = [(i * 3, [f"{i}.{j}" for j in range(rng.choice([1, 1, 1, 0, 2]))] if i % 11 else None) for i in range(200)]
    df = spark.createDataFrame(data, "id long, items array<string>").repartition(5)
    got = {r.id: (r.n_elements, r.aligned) for r in zip_alignment(df, "id", "items").collect()}
    items = df.select(F.col("id").alias("owner"), F.posexplode("items").alias("p", "item"))
    zipped = {r.id: r.owner for r in zip_rows(df.select("id"), items, ["id"], ["owner", "p"]).collect()
              if r.id is not None}
    want = {i: (len(x or []), zipped[i] == i) for i, x in data if len(x or []) != 1 or zipped[i] != i}
    assert got == want
    assert zip_alignment(df.limit(0), "id", "items").count() == 0


def test_running_total_over_partitions(spark):
    data = [(i, (i * 7) % 5) for i in range(100)]
    out = running_total(spark.createDataFrame(data, "id long, v long"), ["id"], "v", partitions=6).collect()
    assert sorted((r.id, r.row_no, r.total_before) for r in out) == [
        (i, i + 1, sum(v for _, v in data[:i])) for i, _ in data]


def test_exported_files_concatenate_in_order(spark, tmp_dir):
    path = os.path.join(tmp_dir, "lines")
    ids = list(range(500))
    random.Random(1).shuffle(ids)
    export_ordered(spark.createDataFrame([(i, f"line {i:04d}") for i in ids], "id long, text string").repartition(7),
                   path, ["id"], "text", files=5)
    names = sorted(n for n in os.listdir(path) if n.startswith("part-"))
    assert len(names) == 5
    text = "".join(open(os.path.join(path, n)).read() for n in names)
    assert text.splitlines() == [f"line {i:04d}" for i in range(500)]
    back = [r.line for r in read_ordered(spark, path).orderBy("file", "at").collect()]
    assert back == text.splitlines()
