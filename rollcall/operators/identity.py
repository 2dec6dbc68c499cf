"""Identity resolution (J8, W1, W2) and login changes.

The reference looks each feed row up one at a time: by e-mail login, else
by external id (``CustomerID`` = the directory's ``sis_user_id``), else it
creates the user — and a user made for row *i* is found by row *j > i*.
In set form, with ``e = lower(email)``, ``c = CustomerID``, rows in
``(event_id, pos)`` order:

1. only the first row of each ``e`` can be anything but RETURNING: later
   rows find the login the first row found, renamed or created;
2. first row, ``e`` is a directory login             -> RETURNING;
3. else ``c`` is a directory external id              -> EMAIL_CHANGED
   (login renamed to ``e``, the old login added back);
4. else the first such row of its ``c``               -> NEW (user created
   with login ``e`` and external id ``c``); later ones -> EMAIL_CHANGED
   of that new user.

The account of every row is the account of the first row of its ``e``:
directory id by ``e``, else by ``c``, else ``new:<c>``.  Two customers on
one e-mail therefore share an account, as in the reference.

Skew: every per-key step is an aggregation (partial, map-side) or a join that
keeps the rows of heavy keys where they are (``ordered.join_per_key``); one
e-mail holding a third of the feed never lands in one task whole.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.functions import email_key
from rollcall.operators.ordered import first_per_key, join_per_key, previous_value

RETURNING = "RETURNING"
EMAIL_CHANGED = "EMAIL_CHANGED"
NEW = "NEW"


def directory_by_login(users: DataFrame, logins: DataFrame, only: DataFrame | None = None) -> DataFrame:
    """``(e, dir_e)``: every login (primary and extra) -> account (the user
    id as text), one row per lower-cased login (the smallest id if two users
    share one).  ``only`` (a column ``e``) restricts the directory to the
    logins asked for before it is aggregated: a batch touches few of a large
    directory's logins, and the semi-join with the small key set is a
    broadcast, so the directory is never shuffled whole."""
    all_logins = (logins.select(email_key("unique_id").alias("e"), F.col("user_id").alias("uid"))
                  .unionByName(users.select(email_key("login_id").alias("e"), F.col("id").alias("uid")))
                  .where(F.col("e").isNotNull()))
    if only is not None:
        all_logins = all_logins.join(only.select("e").where(F.col("e").isNotNull()), "e", "left_semi")
    return all_logins.groupBy("e").agg(F.min("uid").cast("string").alias("dir_e"))


def directory_by_external_id(users: DataFrame, only: DataFrame | None = None) -> DataFrame:
    """``(c, dir_c, dir_login)``: external id -> account (user id as text)
    and its primary login; ``only`` (a column ``c``) as in
    ``directory_by_login``."""
    packed = F.struct(F.col("id").alias("id"), email_key("login_id").alias("login"))
    u = users.where(F.col("sis_user_id").isNotNull()).withColumn("c", F.col("sis_user_id"))
    if only is not None:
        u = u.join(only.select("c").where(F.col("c").isNotNull()), "c", "left_semi")
    return (u.groupBy("c").agg(F.min(packed).alias("_u"))
            .select("c", F.col("_u.id").cast("string").alias("dir_c"), F.col("_u.login").alias("dir_login")))


def directory(users: DataFrame, logins: DataFrame, only_logins: DataFrame | None = None,
              only_ids: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """The two lookups identity resolution needs: by login, by external id
    (optionally restricted to the keys a batch asks for)."""
    return (directory_by_login(users, logins, only_logins),
            directory_by_external_id(users, only_ids))


def first_rows(rows: DataFrame) -> DataFrame:
    """The first row of each e-mail key: ``e`` and its order, customer, names
    and address as ``f_`` columns, and ``e_rows``, the e-mail's number of rows."""
    return first_per_key(rows.withColumn("e", email_key("email")), ["e"], ["event_id", "pos"],
                         ["customer_id", "first_name", "last_name", "email"], prefix="f_", count="e_rows")


def resolve_first_rows(rows: DataFrame | None, users: DataFrame | None, logins: DataFrame | None,
                       by_external_id: bool = True,
                       lookups: tuple[DataFrame, DataFrame] | Callable | None = None,
                       first: DataFrame | None = None) -> DataFrame:
    """One row per e-mail key: the first row's order and customer, its action
    and the account every row of that e-mail resolves to.  ``lookups`` (see
    ``directory``; or a function of the asked e-mail keys ``e`` and external
    ids ``c``) replaces the users/logins snapshot, e.g. a snapshot plus the
    changes of earlier micro-batches.  ``first`` (``first_rows``) may be passed
    when it was kept: it is read several times here."""
    firsts = first_rows(rows) if first is None else first
    if callable(lookups):
        by_login, by_ext = lookups(firsts.select("e"), firsts.select(F.col("f_customer_id").alias("c")))
    elif lookups is not None:
        by_login, by_ext = lookups
    else:
        by_login, by_ext = directory(users, logins, only_logins=firsts.select("e"),
                                     only_ids=firsts.select(F.col("f_customer_id").alias("c")))
    f = firsts.join(by_login, "e", "left")
    c = F.col("f_customer_id")
    if by_external_id:
        f = f.join(by_ext, c == F.col("c"), "left").drop("c")
        unresolved = F.col("dir_e").isNull() & F.col("dir_c").isNull()
        cand = (f.where(unresolved & c.isNotNull())
                .groupBy(c.alias("_nc"))
                .agg(F.min(F.struct("f_event_id", "f_pos")).alias("_nseq")))
        f = f.join(cand, c == F.col("_nc"), "left").drop("_nc")
        is_new = unresolved & (c.isNull() | (F.struct("f_event_id", "f_pos") == F.col("_nseq")))
        action = (F.when(F.col("dir_e").isNotNull(), F.lit(RETURNING))
                  .when(F.col("dir_c").isNotNull(), F.lit(EMAIL_CHANGED))
                  .when(is_new, F.lit(NEW))
                  .otherwise(F.lit(EMAIL_CHANGED)))
        new_acct = F.when(c.isNull(), F.concat(F.lit("new-login:"), F.col("e"))) \
                    .otherwise(F.concat(F.lit("new:"), c))
        account = F.coalesce(F.col("dir_e"), F.col("dir_c"), new_acct)
        return f.withColumns({"first_action": action, "account": account}).drop("_nseq")
    else:
        # allow-list variant: e-mail, else a new user per e-mail
        f = (f.withColumn("dir_c", F.lit(None).cast("string"))
              .withColumn("dir_login", F.lit(None).cast("string")))
        action = F.when(F.col("dir_e").isNotNull(), F.lit(RETURNING)).otherwise(F.lit(NEW))
        account = F.coalesce(F.col("dir_e"), F.concat(F.lit("new-login:"), F.col("e")))
    return f.withColumns({"first_action": action, "account": account})


def resolve_users(rows: DataFrame, users: DataFrame | None, logins: DataFrame | None,
                  by_external_id: bool = True, firsts: DataFrame | None = None) -> DataFrame:
    """Every input row with ``e``, ``action`` (RETURNING / EMAIL_CHANGED /
    NEW) and ``account``."""
    if firsts is None:
        firsts = resolve_first_rows(rows, users, logins, by_external_id)
    r = rows.withColumn("e", email_key("email"))
    f = firsts.select("e", "f_event_id", "f_pos", "first_action", "account", "e_rows")
    out = join_per_key(r, f, "e", "e_rows")
    is_first = (F.col("event_id") == F.col("f_event_id")) & (F.col("pos") == F.col("f_pos"))
    return (out.withColumn("action", F.when(is_first, F.col("first_action")).otherwise(F.lit(RETURNING)))
               .drop("f_event_id", "f_pos", "first_action"))


def user_creations(firsts: DataFrame) -> DataFrame:
    """NEW users to create: name 'First Last', sortable 'Last, First',
    login = lower(e-mail), external id = CustomerID."""
    return (firsts.where(F.col("first_action") == NEW)
            .select(F.col("f_event_id").alias("event_id"), F.col("f_pos").alias("pos"), "account",
                    F.concat(F.col("f_first_name"), F.lit(" "), F.col("f_last_name")).alias("name"),
                    F.concat(F.col("f_last_name"), F.lit(", "), F.col("f_first_name")).alias("sortable_name"),
                    F.col("e").alias("login_id"),
                    F.col("f_customer_id").alias("sis_user_id")))


def directory_changes(firsts: DataFrame, changes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What a batch adds to the directory, in the shape of ``directory``:
    (login -> account) for created users, renamed logins and re-added old
    logins; (external id -> account, current primary login) for created
    users and for every account whose login changed (the last change wins)."""
    new = firsts.where(F.col("first_action") == NEW)
    by_login = (new.select("e", F.col("account").alias("dir_e"))
                .unionByName(changes.select(F.col("new_login").alias("e"), F.col("account").alias("dir_e")))
                .unionByName(changes.where("add_login")
                             .select(F.col("old_login").alias("e"), F.col("account").alias("dir_e"))))
    moves = (new.where(F.col("f_customer_id").isNotNull())
             .select(F.col("f_customer_id").alias("c"), F.col("account").alias("dir_c"),
                     F.col("e").alias("dir_login"), F.col("f_event_id").alias("_ev"), F.col("f_pos").alias("_pos")))
    renamed = (firsts.where(F.col("first_action") == EMAIL_CHANGED)
               .select(F.col("f_customer_id").alias("c"), F.col("account").alias("dir_c"),
                       F.col("e").alias("dir_login"), F.col("f_event_id").alias("_ev"), F.col("f_pos").alias("_pos")))
    last = (moves.unionByName(renamed).where(F.col("c").isNotNull())
            .groupBy("c").agg(F.max(F.struct("_ev", "_pos", "dir_c", "dir_login")).alias("_l"))
            .select("c", F.col("_l.dir_c").alias("dir_c"), F.col("_l.dir_login").alias("dir_login")))
    return by_login, last


def login_changes(firsts: DataFrame, logins: DataFrame) -> DataFrame:
    """EMAIL_CHANGED rows: the user's login becomes ``e``; the old login
    (the directory login, or the login an earlier row of the batch gave
    that user) is added back, unless the user already has another login
    with that text (J16).

    Columns: event_id, pos, account, new_login, old_login, add_login."""
    changes = firsts.where(F.col("first_action").isin(NEW, EMAIL_CHANGED)).select(
        "account", F.col("f_event_id").alias("event_id"), F.col("f_pos").alias("pos"),
        "e", "first_action", "dir_c", "dir_login")
    prev = previous_value(changes, ["account"], "event_id", "e", tie_col="pos", out_col="_prev")
    # logins of the changed directory users only (broadcast semi-join first)
    changed = changes.where(F.col("dir_c").isNotNull()).select(F.col("dir_c").alias("_uid")).distinct()
    counts = (logins.select(F.col("user_id").cast("string").alias("_uid"),
                            email_key("unique_id").alias("_login"))
              .join(changed, "_uid", "left_semi")
              .groupBy("_uid", "_login").agg(F.count(F.lit(1)).alias("_n")))
    ch = prev.where(F.col("first_action") == EMAIL_CHANGED)
    ch = ch.withColumn("old_login", F.coalesce(F.col("_prev.value"), F.col("dir_login")))
    ch = ch.join(counts, (F.col("dir_c") == F.col("_uid")) & (F.col("old_login") == F.col("_login")), "left")
    already = F.col("_prev").isNull() & (F.coalesce(F.col("_n"), F.lit(0)) >= 2)
    return ch.select("event_id", "pos", "account", F.col("e").alias("new_login"), "old_login",
                     (F.col("old_login").isNotNull() & ~already).alias("add_login"))
