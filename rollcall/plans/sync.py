"""The enrollment sync (D1, D2, T-1) and its report.

Order of the rules: watermark (P9) -> skip / allow list (J4/J5/J6; skipped
rows never reach identity) -> required e-mail (P13) -> identity (J8) ->
letters (J7) -> known course (J10) -> enrollments (J9/W3) and final state
(A5) -> report and new watermark (A1/A4).

``on_error="quarantine"`` (default) plans every good row and returns the bad
ones as rejects; the watermark moves past all rows.  ``on_error="stop"``
mirrors the reference's abort: only rows before the first bad row are
planned (when the cause is the course, that row's own user action and
letters too) and the watermark does not move.

Every output is keyed by ``(event_id, pos)``, so re-running a batch or a
replayed file yields the same change sets (idempotent append downstream).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import cached_property

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.operators.enroll import final_enrollments, plan_enrollments
from rollcall.operators.feed import (
    below_watermark, feed_rows, only_listed, since, split_skipped,
    split_unknown_courses, validate_email,
)
from rollcall.operators.identity import (
    RETURNING, first_rows, login_changes, resolve_first_rows, resolve_users, user_creations,
)
from rollcall.operators.letters import letter_candidates, unsent
from rollcall.functions import report_time
from rollcall.operators.sets import union_all
from rollcall.session import materialize

ACTION_COLUMNS = ["event_id", "pos", "action", "account", "course_code"]


@dataclass(eq=False)
class SyncResult:
    """The outputs of one batch (see ``sync_batch`` for the inputs).  Each
    output is planned when it is first asked for, so a caller that wants the
    new watermark doesn't analyse the enrollments."""

    feed: DataFrame
    users: DataFrame
    logins: DataFrame
    roster: DataFrame
    courses: DataFrame
    mark: int | DataFrame = 0
    skip: DataFrame | None = None
    allow: DataFrame | None = None
    online_override: bool = False
    ledgers: dict[str, DataFrame] = field(default_factory=dict)
    letter_match: str = "exact"
    ledger_indexes: dict = field(default_factory=dict)
    new_user_course: str | None = None
    on_error: str = "quarantine"
    by_external_id: bool = True
    nested: bool = True
    reuse: str | Callable | None = "persist"
    lookups: tuple[DataFrame, DataFrame] | Callable | None = None
    current: DataFrame | None = None
    count_late: bool = False

    def _keep(self, df: DataFrame) -> DataFrame:
        return _reuser(self.reuse)(df)

    # ------------------------------------------------------------- rows ----

    @cached_property
    def _all_rows(self) -> DataFrame:
        return feed_rows(self.feed) if self.nested else self.feed

    @cached_property
    def _past(self) -> DataFrame:
        return since(self._all_rows, self.mark)

    @cached_property
    def rows(self) -> DataFrame:
        """Rows past the watermark."""
        return self._keep(self._past)

    @cached_property
    def late(self) -> DataFrame:
        """Rows at or below the old watermark."""
        return below_watermark(self._all_rows, self.mark)

    @cached_property
    def prev_watermark(self) -> DataFrame:
        return _as_state(self.feed.sparkSession, self.mark)

    @cached_property
    def _listed(self) -> tuple[DataFrame, DataFrame]:
        if self.allow is not None:
            return only_listed(self.rows, self.allow)
        if self.skip is not None:
            return split_skipped(self.rows, self.skip, online_override=self.online_override)
        return self.rows, self.rows.limit(0)

    @cached_property
    def _emails(self) -> tuple[DataFrame, DataFrame]:
        return validate_email(self._listed[0])

    # --------------------------------------------------------- identity ----

    @cached_property
    def _first_rows(self) -> DataFrame:
        return self._keep(first_rows(self._emails[0]))

    @cached_property
    def _firsts(self) -> DataFrame:
        return self._keep(resolve_first_rows(None, self.users, self.logins, by_external_id=self.by_external_id,
                                             lookups=self.lookups, first=self._first_rows))

    @cached_property
    def _resolved(self) -> DataFrame:
        return self._keep(resolve_users(self._emails[0], None, None, firsts=self._firsts))

    @cached_property
    def _courses(self) -> tuple[DataFrame, DataFrame]:
        return split_unknown_courses(self._resolved, self.courses)

    @cached_property
    def rejects(self) -> DataFrame:
        """Rows with a blank e-mail or an unknown course (+ reason)."""
        cols = ["event_id", "pos", "email", "course_code", "course_name", "reason"]
        return union_all(self._emails[1].select(*cols, F.lit(None).cast("string").alias("account")),
                         self._courses[1].select(*cols, "account"))

    # -------------------------------------------------------- stop mode ----

    @cached_property
    def _first_bad(self) -> tuple[Column, Column]:
        bad = self.rejects.agg(F.min(F.struct("event_id", "pos")).alias("b"),
                               F.min_by("reason", F.struct("event_id", "pos")).alias("r"))
        return bad.select("b").scalar(), bad.select("r").scalar()

    def _cut(self, df: DataFrame, with_bad_course: bool = True, prefix: str = "") -> DataFrame:
        """In stop mode the rows before the first bad one; with
        ``with_bad_course`` also that row, if its course is what is wrong."""
        if self.on_error != "stop":
            return df
        at, reason = self._first_bad
        seq = F.struct(F.col(prefix + "event_id").alias("event_id"), F.col(prefix + "pos").alias("pos"))
        take = F.coalesce(seq < at, F.lit(True))
        if with_bad_course:
            take = take | F.coalesce((seq == at) & (reason == F.lit("UNKNOWN_COURSE")), F.lit(False))
        return df.where(take)

    # ---------------------------------------------------------- outputs ----

    @cached_property
    def skipped(self) -> DataFrame:
        """Rows of skipped (or not allowed) courses."""
        return self._cut(self._listed[1], with_bad_course=False)

    @cached_property
    def identities(self) -> DataFrame:
        """Resolved rows: action RETURNING / EMAIL_CHANGED / NEW, account."""
        return self._cut(self._resolved)

    @cached_property
    def firsts(self) -> DataFrame:
        """One row per e-mail key (see identity.resolve_first_rows)."""
        return self._cut(self._firsts, prefix="f_")

    @cached_property
    def user_creations(self) -> DataFrame:
        return user_creations(self.firsts)

    @cached_property
    def login_changes(self) -> DataFrame:
        if self.by_external_id:
            return self._cut(login_changes(self._firsts, self.logins))
        return self.user_creations.limit(0).select(
            "event_id", "pos", "account", F.lit(None).cast("string").alias("new_login"),
            F.lit(None).cast("string").alias("old_login"), F.lit(False).alias("add_login"))

    @cached_property
    def intro_enrollments(self) -> DataFrame:
        made = self.user_creations
        if not self.new_user_course:  # a blank setting plans nothing (T6)
            made = made.limit(0)
        return made.select("event_id", "pos", "account",
                           F.lit(self.new_user_course or None).cast("string").alias("course_code"))

    @cached_property
    def letters(self) -> DataFrame:
        """Letters due; the allow-list form mails a user it found, that is
        from the second row of a user whom the batch creates."""
        if not self.ledgers:
            return self.feed.sparkSession.createDataFrame(
                [], "event_id long, pos int, account string, email string, letter string")
        mailed = self._resolved if self.allow is None else self._resolved.where(F.col("action") == RETURNING)
        candidates = letter_candidates(mailed)
        return self._cut(union_all(*[
            unsent(None, ledger, name, match=self.letter_match, candidates=candidates,
                   index=self.ledger_indexes.get(name)) for name, ledger in self.ledgers.items()]))

    @cached_property
    def enrollments(self) -> DataFrame:
        """ENROLL / DROP / DROP_NOT_FOUND per row."""
        return self._cut(plan_enrollments(self._courses[0], self.roster, current=self.current),
                         with_bad_course=False)

    @cached_property
    def final_state(self) -> DataFrame:
        return final_enrollments(self._cut(self._courses[0], with_bad_course=False))

    def actions(self) -> DataFrame:
        """Every planned action as one table: event_id, pos, action, account,
        course_code."""
        none = F.lit(None).cast("string")

        def tagged(df: DataFrame, action: Column | str, account="account", course=None) -> DataFrame:
            return df.select("event_id", "pos", (F.lit(action) if isinstance(action, str) else action).alias("action"),
                             (none if account is None else F.col(account)).alias("account"),
                             (none if course is None else F.col(course)).alias("course_code"))

        return union_all(
            tagged(self.user_creations, "CREATE_USER"),
            tagged(self.login_changes, "CHANGE_LOGIN"),
            tagged(self.login_changes.where("add_login"), "ADD_LOGIN"),
            tagged(self.intro_enrollments, "ENROLL_INTRO", course="course_code"),
            tagged(self.letters, F.concat(F.lit("LETTER_"), F.upper("letter"))),
            self.enrollments.select(*ACTION_COLUMNS),
            tagged(self.skipped, "SKIP", account=None, course="course_code"),
            tagged(self.rejects, F.concat(F.lit("REJECT_"), F.col("reason")), course="course_code"))

    def watermark(self) -> DataFrame:
        """The new watermark, from the bare rows unless they are kept already."""
        rows = self.__dict__.get("rows", self._past)
        return next_watermark(rows, self.prev_watermark,
                              self.rejects if self.on_error == "stop" else None, self.on_error)

    def report(self, as_of=None) -> DataFrame:
        return run_report(self, as_of)

    def release(self) -> None:
        """Drop the persisted shared inputs once every output is written."""
        if self.reuse != "persist":
            return
        for name in ("rows", "_first_rows", "_firsts", "_resolved"):
            if name in self.__dict__:
                self.__dict__[name].unpersist()


def _reuser(reuse: str | Callable | None):
    if callable(reuse):
        return reuse
    if reuse == "persist":
        return lambda df: df.persist(StorageLevel.MEMORY_AND_DISK)
    if reuse == "checkpoint":
        return materialize
    if reuse is None:
        return lambda df: df
    raise ValueError("reuse must be 'persist', 'checkpoint', a function or None")


def _as_state(spark, watermark) -> DataFrame:
    if isinstance(watermark, DataFrame):
        return watermark.agg(F.coalesce(F.max("EventEnrollmentID"), F.lit(0).cast("long"))
                             .alias("EventEnrollmentID"))
    return spark.range(1).select(F.lit(int(watermark)).cast("long").alias("EventEnrollmentID"))


def sync_batch(feed: DataFrame, users: DataFrame, logins: DataFrame, enrollments: DataFrame,
               courses: DataFrame, watermark=0, skip: DataFrame | None = None,
               allow: DataFrame | None = None, online_override: bool = False,
               ledgers: dict[str, DataFrame] | None = None, letter_match: str = "exact",
               new_user_course: str | None = None, on_error: str = "quarantine",
               by_external_id: bool | None = None, nested: bool = True,
               reuse: str | Callable | None = "persist",
               lookups: tuple[DataFrame, DataFrame] | Callable | None = None,
               current: DataFrame | None = None, count_late: bool = False,
               ledger_indexes: dict | None = None) -> SyncResult:
    """Plan one batch of the feed.  ``feed`` is the nested feed (or canonical
    rows with ``nested=False``); ``watermark`` a number or one-row state.
    With ``allow`` the allow-list form (D2) runs: only listed courses, and
    identity by e-mail only unless ``by_external_id`` says otherwise.

    The batch's flat rows, its first rows and the identity result are shared
    by the outputs: ``reuse="persist"`` (default) keeps them in executor
    memory/disk until ``release()`` (a lost executor's part is recomputed from
    lineage); ``reuse="checkpoint"`` writes them to the shared checkpoint
    folder and cuts the lineage (long runs), a function keeps them its own way
    (streaming micro-batches); ``None`` recomputes them per output.

    ``lookups`` (identity.directory shape, or a function of the batch's e-mail
    and external-id keys that returns it) and ``current`` (account,
    course_code roster) replace the snapshots when earlier batches' changes
    must be seen (the streaming sync).  ``ledger_indexes`` holds kept n-gram
    indexes of ledgers by name (regex letters).  ``count_late`` adds the rows at or
    below the watermark to the report, which reads the whole feed."""
    if on_error not in ("quarantine", "stop"):
        raise ValueError("on_error must be 'quarantine' or 'stop'")
    _reuser(reuse)
    if by_external_id is None:
        by_external_id = allow is None
    return SyncResult(feed, users, logins, enrollments, courses, mark=watermark, skip=skip, allow=allow,
                      online_override=online_override, ledgers=ledgers or {}, letter_match=letter_match,
                      new_user_course=new_user_course, on_error=on_error, by_external_id=by_external_id,
                      nested=nested, reuse=reuse, lookups=lookups, current=current, count_late=count_late,
                      ledger_indexes=ledger_indexes or {})


def next_watermark(rows: DataFrame, prev: DataFrame, rejects: DataFrame | None = None,
                   on_error: str = "quarantine") -> DataFrame:
    """New one-row state: the largest sequence number seen, never below the
    old one (A4; the reference's "last row" goes backwards on unsorted
    input).  In stop mode a batch with any reject keeps the old state."""
    prev_v = prev.agg(F.max("EventEnrollmentID")).scalar()
    seen = rows.agg(F.max("event_id").alias("m"))
    new = F.greatest(F.coalesce(F.col("m"), prev_v), prev_v)
    if on_error == "stop" and rejects is not None:
        has_bad = rejects.select(F.count(F.lit(1)) > 0).scalar()
        new = F.when(has_bad, prev_v).otherwise(new)
    return seen.select(new.cast("long").alias("EventEnrollmentID"))


def run_report(res: SyncResult, as_of=None) -> DataFrame:
    """One-row run report (A1): rows seen, late rows (where ``count_late``
    asks for them), skipped, rejected, returning / changed / new users, enrollment actions by kind, letters,
    old and new watermark, and — given the run time ``as_of`` — the heading
    time ("09:05AM on March 02, 2024").  One aggregation over the tagged
    outputs."""
    tag = lambda df, kind: df.select(F.lit(kind).alias("k"))
    late = [tag(res.late, "rows_below_watermark")] if res.count_late else []
    facts = union_all(
        tag(res.rows, "rows_seen"), *late, tag(res.skipped, "skipped"),
        res.rejects.select(F.concat(F.lit("rejected_"), F.lower("reason")).alias("k")),
        res.identities.select(F.lower("action").alias("k")),
        res.enrollments.select(F.concat(F.lit("enr_"), F.lower("action")).alias("k")),
        tag(res.letters, "letters"))
    n = lambda k: F.count_if(F.col("k") == k)
    enr = [n("enr_enroll"), n("enr_drop"), n("enr_drop_not_found")]
    agg = facts.agg(
        n("rows_seen").alias("rows_seen"),
        *([n("rows_below_watermark").alias("rows_below_watermark")] if late else []),
        n("skipped").alias("skipped"), n("rejected_blank_email").alias("rejected_blank_email"),
        n("rejected_unknown_course").alias("rejected_unknown_course"),
        n("returning").alias("returning_users"), n("email_changed").alias("changed_logins"),
        n("new").alias("new_users"), (enr[0] + enr[1] + enr[2]).alias("enrollment_events"),
        enr[0].alias("enrolled"), enr[1].alias("dropped"), enr[2].alias("drops_not_found"),
        n("letters").alias("letters"))
    wm = res.watermark()
    out = agg.select(
        "*",
        res.prev_watermark.select("EventEnrollmentID").scalar().alias("old_watermark"),
        wm.select("EventEnrollmentID").scalar().alias("new_watermark"))
    if as_of is not None:
        out = out.withColumn("heading_time", report_time(F.lit(as_of) if isinstance(as_of, str) else as_of))
    return out


# The message lines of a run report by kind ({} = field, in order).
MESSAGES = {
    "ENROLL": "{}: enrolled in {} [{}]",
    "DROP": "{}: removed from {} [{}]",
    "DROP_NOT_FOUND": "{}: no enrollment in {} [{}] to remove",
    "CREATE_USER": "{}: new account for {}",
    "ENROLL_INTRO": "{}: enrolled in the introduction {}",
    "LETTER": "{}: {} letter due",
    "SKIP": "{}: course {} is on the skip list",
    "NOT_LISTED": "{}: course {} is not on the allow list",
    "UNKNOWN_COURSE": "{}: course {} [{}] is unknown",
    "BLANK_EMAIL": "course {}: no e-mail address",
}


def _fill(kind: str, *cols) -> Column:
    """The line of ``kind`` with each {} replaced by a column (null -> '')."""
    parts = MESSAGES[kind].split("{}")
    pieces = [F.lit(parts[0])]
    for col, text in zip(cols, parts[1:]):
        pieces += [F.coalesce(F.col(col), F.lit("")), F.lit(text)]
    return F.concat(*pieces)


def run_messages(res: SyncResult) -> DataFrame:
    """Message lines of the run (A7), one row per line with its event key and
    ``kind``; concatenate them in (event_id, pos) order only when exporting."""

    def lines(df: DataFrame, *fields: str, kind: str) -> DataFrame:
        return df.select("event_id", "pos", F.lit(kind).alias("kind"), _fill(kind, *fields).alias("message"))

    def by_kind(df: DataFrame, column: str, fields: dict[str, list[str]]) -> DataFrame:
        text = F.lit(None).cast("string")
        for kind, cols in fields.items():
            text = F.when(F.col(column) == kind, _fill(kind, *cols)).otherwise(text)
        return df.select("event_id", "pos", F.col(column).alias("kind"), text.alias("message"))

    course = ["email", "course_name", "course_code"]
    return union_all(
        by_kind(res.enrollments, "action", dict.fromkeys(("ENROLL", "DROP", "DROP_NOT_FOUND"), course)),
        lines(res.user_creations, "login_id", "name", kind="CREATE_USER"),
        lines(res.intro_enrollments, "account", "course_code", kind="ENROLL_INTRO"),
        lines(res.letters, "email", "letter", kind="LETTER"),
        lines(res.skipped, "email", "course_code", kind="SKIP" if res.allow is None else "NOT_LISTED"),
        by_kind(res.rejects, "reason", {"UNKNOWN_COURSE": course, "BLANK_EMAIL": ["course_code"]}))
