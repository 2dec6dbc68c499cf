"""Streaming sync (T-2): landed feed files -> change sets, batch by batch.

``readStream`` over the feed folder (fixed schema) + ``foreachBatch``: each
micro-batch is planned by ``sync_batch`` against the snapshot *plus* what
earlier micro-batches changed, so that N micro-batches plan the same actions
as one batch over the same rows.

State lives in ``state_dir`` under a commit log (``sources.commits``).  A batch
writes what it learnt and its outputs into folders of its own attempt:

    <state>/watermark/batch_id=k/attempt=...      EventEnrollmentID after batch k
    <state>/logins/batch_id=k/attempt=...         login -> account learnt in batch k
    <state>/ids/...                               external id -> account, primary login
    <state>/roster/...                            final (account, course_code, active) of batch k
    <state>/ledger_<name>/...                     addresses mailed in batch k
    <out>/<output>/batch_id=k/attempt=...         the change sets

and then commits one marker that names the state folders valid from now on.
The next batch reads the folders of the newest marker, with the tables' fixed
schemas, and nothing else: what a crashed or overtaken attempt left is never
read, whatever state it is in.  A micro-batch replayed after its commit
does nothing; one replayed before it plans anew on the same state.  Of two
runs on one state (scheduled runs that overlap, ``run_sync``) one commits and
the other raises ``CommitConflict``.

Before batch k, a table with ``compact_every`` deltas is folded into
``compact/<table>/upto=v/attempt=...`` (the latest row per key of what the
newest marker names), which takes their place in batch k's marker; folders
that the newest ``keep_versions`` markers don't name are then removed.  A state
written before there was a log (folders ``<table>/batch_id=k`` alone) is taken
over by the first compaction.

Rows at or below the watermark (a replayed or late file) plan nothing and are
counted in the report.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.operators.enroll import current_students
from rollcall.operators.identity import directory, directory_changes
from rollcall.plans.sync import SyncResult, run_messages, sync_batch
from rollcall.session import materialize
from rollcall.sources.commits import CommitLog, list_names, remove
from rollcall.sources.feed import feed_file_stream, read_feed, read_feed_stream
from rollcall.sources.files import path_exists


class StoppedOnBadRow(RuntimeError):
    """Stop mode met a row that can't be processed.  The batch's outputs up to
    that row are written, its state isn't: the batch stays unfinished and is
    replayed, so that no later row is lost."""


# state table -> its key columns (None: a set of rows, e.g. a ledger)
STATE_KEYS = {"logins": ["e"], "ids": ["c"], "roster": ["account", "course_code"], "watermark": None}

# state table -> the columns of its files (``version``: of the marker that first named the row)
STATE_SCHEMAS = {
    "watermark": "EventEnrollmentID long, version long",
    "logins": "e string, dir_e string, version long",
    "ids": "c string, dir_c string, dir_login string, version long",
    "roster": "account string, course_code string, active boolean, version long",
}
LEDGER_STATE = "Email string, version long"

OUTPUTS = ("actions", "user_creations", "letters", "rejects", "report", "login_changes", "enrollments", "messages")


def state_schema(name: str) -> str:
    return LEDGER_STATE if name.startswith("ledger_") else STATE_SCHEMAS[name]


def _try_read(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at ``path``, or None where nothing was written yet.  A state
    that exists but can't be read raises: it must not count as no state."""
    return spark.read.parquet(path) if path_exists(spark, path) else None


def _read_state(spark: SparkSession, state_dir: str, name: str, before: int) -> DataFrame | None:
    """A state table written before there was a commit log: the deltas of
    batches < ``before`` below the latest compaction before it, by folder."""
    deltas = _try_read(spark, os.path.join(state_dir, name))
    comp = _try_read(spark, os.path.join(state_dir, "compact", name))
    if comp is not None:
        upto = comp.where(F.col("upto") < before).agg(F.max("upto")).first()[0]
        if upto is not None:
            comp = comp.where(F.col("upto") == upto).drop("upto")
            if deltas is None:
                return comp
            return comp.unionByName(deltas.where((F.col("batch_id") > upto) & (F.col("batch_id") < before)))
    return None if deltas is None else deltas.where(F.col("batch_id") < before)


def _fold(rows: DataFrame, name: str) -> DataFrame:
    """The latest row per key (or the distinct rows of a set, or the largest
    watermark)."""
    if name == "watermark":
        return rows.agg(*[F.max(c).alias(c) for c in ("EventEnrollmentID", "version")])
    keys = STATE_KEYS.get(name)
    if not keys:
        return rows.groupBy(*[c for c in rows.columns if c != "version"]).agg(F.max("version").alias("version"))
    values = [c for c in rows.columns if c not in keys and c != "version"]
    last = rows.groupBy(*keys).agg(F.max(F.struct("version", *values)).alias("_l"))
    return last.select(*keys, *[F.col("_l." + c).alias(c) for c in values], F.col("_l.version").alias("version"))


class StreamState:
    """The state as the newest marker names it, and the attempt of one batch
    to move it on."""

    def __init__(self, spark: SparkSession, state_dir: str, out_dir: str, stream: str, batch_id: int):
        self.spark, self.out_dir = spark, out_dir.rstrip("/")
        self.log = CommitLog(spark, state_dir)
        self.entry = self.log.latest()
        self.stream, self.batch_id = stream, batch_id
        self.version = self.entry["version"] + 1
        self.attempt = self.log.attempt(self.version)
        self.tables = {n: list(f) for n, f in self.entry["tables"].items()}
        self.kept = 0

    def committed(self) -> bool:
        """Whether this batch of this stream was committed before."""
        return self.batch_id <= self.entry.get("streams", {}).get(self.stream, -1)

    def read(self, name: str) -> DataFrame | None:
        """The table's rows, or None where nothing was committed."""
        if not self.tables.get(name):
            return None
        return self.log.table(name, state_schema(name), {"tables": self.tables})

    def adopt(self, names: list[str]) -> None:
        """Take over tables that a writer without a log left behind."""
        if self.entry["version"] >= 0 or list_names(self.spark, f"{self.log.dir}/_log"):
            return
        for name in names:
            root = f"{self.log.dir}/{name}"
            inside = {b: list_names(self.spark, f"{root}/{b}") for b in list_names(self.spark, root)}
            if not any(n.startswith("part-") for held in inside.values() for n in held):
                continue
            for b, held in inside.items():      # attempts that failed before there was any marker
                for n in held:
                    if n.startswith("attempt="):
                        remove(self.spark, f"{root}/{b}/{n}")
            rows = _read_state(self.spark, self.log.dir, name, 1 << 62)
            self._write_compact(rows.withColumn("version", F.col("batch_id").cast("long") - (1 << 62))
                                .drop("batch_id"), name)

    def compact(self, every: int) -> None:
        """Fold the tables with ``every`` deltas or more."""
        for name, folders in list(self.tables.items()):
            deltas = [f for f in folders if not f.startswith("compact/")]
            if every and len(deltas) >= every:
                self._write_compact(self.read(name), name)

    def _write_compact(self, rows: DataFrame, name: str) -> None:
        folder = f"compact/{name}/upto={self.version - 1}/{self.attempt}"
        _fold(rows, name).write.parquet(f"{self.log.dir}/{folder}")
        self.tables[name] = [folder]

    def write(self, df: DataFrame, name: str) -> None:
        folder = f"{name}/batch_id={self.batch_id}/{self.attempt}"
        df.withColumn("version", F.lit(self.version).cast("long")).write.parquet(f"{self.log.dir}/{folder}")
        self.tables.setdefault(name, []).append(folder)

    def write_output(self, df: DataFrame, name: str) -> DataFrame:
        """Write an output; returned as written, so that what follows from it
        isn't planned from the feed again."""
        return materialize(df, f"{self.out_dir}/{name}/batch_id={self.batch_id}/{self.attempt}")

    def keep(self, df: DataFrame) -> DataFrame:
        """A table that several outputs share, written to the attempt's work
        folder and read back."""
        self.kept += 1
        return materialize(df, f"{self.log.dir}/_work/{self.attempt}/{self.kept}")

    def commit(self, stopped: bool = False) -> None:
        """Make this attempt the newest version.  A stopped batch commits its
        outputs, leaves the state as it was and stays to be done."""
        streams = dict(self.entry.get("streams", {}))
        if not stopped:
            streams[self.stream] = self.batch_id
        self.log.commit({"version": self.version, "attempt": self.attempt, "stream": self.stream,
                         "batch_id": self.batch_id, "stopped": stopped, "streams": streams,
                         "tables": self.entry["tables"] if stopped else self.tables})
        for n in _attempts(self.spark, f"{self.log.dir}/_work"):
            if _version_of(n) <= self.version:
                remove(self.spark, f"{self.log.dir}/_work/{n}")

    def clean_outputs(self, batch_ids) -> None:
        """Remove outputs of these batches that no marker stands for (of
        attempts that crashed, were overtaken, or stopped and were done since)."""
        versions, valid = _valid_attempts(self.log)
        for name in OUTPUTS:
            for batch_id in batch_ids:
                root = f"{self.out_dir}/{name}/batch_id={batch_id}"
                for n in _attempts(self.spark, root):
                    if _version_of(n) in versions and n not in valid:
                        remove(self.spark, f"{root}/{n}")

    def vacuum(self, names: list[str], keep: int) -> None:
        """Remove markers older than the newest ``keep`` and what only they name."""
        old = self.log.versions()[:-keep]
        self.clean_outputs({self.log.entry(v)["batch_id"] for v in old})
        self.log.vacuum([*names, *(f"compact/{n}" for n in names)], keep=keep)


def _attempts(spark: SparkSession, folder: str) -> list[str]:
    return [n for n in list_names(spark, folder) if n.startswith("attempt=")]


def _version_of(attempt: str) -> int:
    return int(attempt.split("=")[1].split("-")[0])


def _valid_attempts(log: CommitLog) -> tuple[list[int], set[str]]:
    """(versions, attempts whose outputs count): a stopped batch's count until
    the batch is done."""
    versions = log.versions()
    entries = [log.entry(v) for v in versions]
    done = {(e["stream"], e["batch_id"]) for e in entries if not e["stopped"]}
    last = {(e["stream"], e["batch_id"]): e["attempt"] for e in entries if e["stopped"]}
    return versions, ({e["attempt"] for e in entries if not e["stopped"]}
                      | {a for batch, a in last.items() if batch not in done})


def output_folders(spark: SparkSession, out_dir: str, state_dir: str, name: str) -> list[str]:
    """The committed folders of an output (``OUTPUTS``): attempts that a marker
    stands for, and those older than all markers that are left, which were
    cleaned up before their markers went."""
    versions, valid = _valid_attempts(CommitLog(spark, state_dir))
    first = versions[0] if versions else 0
    return [f"{out_dir}/{name}/{batch}/{n}" for batch in list_names(spark, f"{out_dir}/{name}")
            for n in _attempts(spark, f"{out_dir}/{name}/{batch}") if n in valid or _version_of(n) < first]


def read_output(spark: SparkSession, out_dir: str, state_dir: str, name: str) -> DataFrame:
    """The committed rows of an output, with ``batch_id``."""
    folders = output_folders(spark, out_dir, state_dir, name)
    if not folders:
        raise FileNotFoundError(f"{out_dir}/{name}: nothing committed")
    return spark.read.option("basePath", f"{out_dir}/{name}").parquet(*folders).drop("attempt")


def _plan(batch: DataFrame, state: StreamState, *, users: DataFrame, logins: DataFrame, enrollments: DataFrame,
          courses: DataFrame, initial_watermark: int, skip: DataFrame | None, allow: DataFrame | None,
          ledgers: dict[str, DataFrame], **options) -> SyncResult:
    """``sync_batch`` against the snapshot and what the state adds to it."""
    marks = state.read("watermark")
    seen = marks.agg(F.max("EventEnrollmentID")).first()[0] if marks is not None else None
    watermark = max(int(initial_watermark), int(seen or 0))

    seen_logins, seen_ids = state.read("logins"), state.read("ids")

    def lookups(emails: DataFrame, external_ids: DataFrame) -> tuple[DataFrame, DataFrame]:
        """The directory and what was learnt since, for the batch's keys only."""
        by_login, by_ext = directory(users, logins, only_logins=emails, only_ids=external_ids)
        if seen_logins is not None:
            # a login learnt in a batch wins over the snapshot's
            learnt = _fold(seen_logins.join(emails, "e", "left_semi"), "logins").drop("version")
            by_login = by_login.join(learnt.select("e"), "e", "left_anti").unionByName(learnt)
        if seen_ids is not None:
            last = _fold(seen_ids.join(external_ids, "c", "left_semi"), "ids").drop("version")
            by_ext = by_ext.join(last.select("c"), "c", "left_anti").unionByName(last)
        return by_login, by_ext

    current = current_students(enrollments)
    roster = state.read("roster")
    if roster is not None:
        last = _fold(roster, "roster")
        current = (current.join(last.select("account", "course_code"), ["account", "course_code"], "left_anti")
                   .unionByName(last.where("active").select("account", "course_code")))

    all_ledgers = {}
    for name, led in ledgers.items():
        sent = state.read(f"ledger_{name}")
        all_ledgers[name] = led if sent is None else led.select("Email").unionByName(sent.select("Email"))

    return sync_batch(batch, users, logins, enrollments, courses, watermark=watermark, skip=skip,
                      allow=allow, ledgers=all_ledgers, lookups=lookups, current=current,
                      count_late=True, **{"reuse": state.keep, **options})


def run_micro_batch(batch: DataFrame, batch_id: int, *, out_dir: str, state_dir: str,
                    users: DataFrame, logins: DataFrame, enrollments: DataFrame,
                    courses: DataFrame, initial_watermark: int = 0, skip: DataFrame | None = None,
                    allow: DataFrame | None = None, ledgers: dict[str, DataFrame] | None = None,
                    compact_every: int = 50, keep_versions: int = 10, stream: str = "stream",
                    **options) -> None:
    """Plan one micro-batch and commit its outputs and state (see module doc).
    ``stream`` names the source of the batch ids (a stream's checkpoint)."""
    ledgers = ledgers or {}
    state = StreamState(batch.sparkSession, state_dir, out_dir, stream, batch_id)
    if state.committed():
        return
    names = [*STATE_SCHEMAS, *(f"ledger_{n}" for n in ledgers)]
    state.adopt(names)
    state.compact(compact_every)
    res = _plan(batch, state, users=users, logins=logins, enrollments=enrollments, courses=courses,
                initial_watermark=initial_watermark, skip=skip, allow=allow, ledgers=ledgers, **options)

    for name in ("rejects", "user_creations", "login_changes", "letters", "enrollments"):
        setattr(res, name, state.write_output(getattr(res, name), name))
    state.write_output(res.actions(), "actions")
    state.write_output(run_messages(res), "messages")
    state.write_output(res.report(), "report")

    if options.get("on_error") == "stop":
        bad = res.rejects.orderBy("event_id", "pos").first()
        if bad is not None:
            state.commit(stopped=True)
            state.clean_outputs([batch_id])
            raise StoppedOnBadRow(f"batch {batch_id}: event {bad['event_id']}: {bad['reason']}")

    new_logins, new_ids = directory_changes(res.firsts, res.login_changes)
    state.write(new_logins, "logins")
    state.write(new_ids, "ids")
    state.write(res.final_state.select("account", "course_code", "active"), "roster")
    for name in ledgers:
        state.write(res.letters.where(F.col("letter") == name).select(F.col("email").alias("Email")), f"ledger_{name}")
    state.write(res.watermark(), "watermark")
    state.commit()
    res.release()
    state.clean_outputs([batch_id])
    if compact_every and state.version % max(1, min(compact_every, keep_versions)) == 0:
        state.vacuum(names, keep_versions)


def run_sync(feed: DataFrame, *, out_dir: str, state_dir: str, users: DataFrame, logins: DataFrame,
             enrollments: DataFrame, courses: DataFrame, **options) -> int:
    """One scheduled run over a batch feed, on the state that earlier runs
    left (K2, S13): everything past the saved watermark is planned, and change
    sets and state are committed together.  Returns the committed version; a
    run that another one overtook raises ``CommitConflict``, and running it
    again plans what is left."""
    version = CommitLog(feed.sparkSession, state_dir).latest()["version"] + 1
    run_micro_batch(feed, version, out_dir=out_dir, state_dir=state_dir, users=users, logins=logins,
                    enrollments=enrollments, courses=courses, stream="runs", **options)
    return version


def sync_stream(spark: SparkSession, feed_dir: str, *, out_dir: str, state_dir: str,
                checkpoint_location: str, users: DataFrame, logins: DataFrame,
                enrollments: DataFrame, courses: DataFrame, multiline: bool = True,
                max_files_per_trigger: int | None = None, available_now: bool = True,
                **options):
    """Start the streaming sync; returns the StreamingQuery.  With
    ``available_now`` every landed file is processed and the query stops
    (the reference's hourly/daily run); otherwise it keeps polling.  Of array
    files (``multiline``) the stream carries the names, and each micro-batch
    reads its files split across tasks."""
    if multiline:
        stream = feed_file_stream(spark, feed_dir, max_files_per_trigger)
    else:
        stream = read_feed_stream(spark, feed_dir, False, max_files_per_trigger)

    def process(batch_df: DataFrame, batch_id: int) -> None:
        if multiline:
            batch_df = read_feed(batch_df.sparkSession, [r.path for r in batch_df.collect()])
        run_micro_batch(batch_df, batch_id, out_dir=out_dir, state_dir=state_dir, users=users,
                        logins=logins, enrollments=enrollments, courses=courses,
                        stream=checkpoint_location, **options)

    writer = (stream.writeStream.foreachBatch(process)
              .option("checkpointLocation", checkpoint_location))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 hour")
    return writer.start()
