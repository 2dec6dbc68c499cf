"""The set-based sync against a plain-Python replay of the reference's row
loop (SURVEY §5 (b)), on random batches.

Each random batch lives in its own name space (e-mails, customers, courses
and directory entries carry the batch number), so forty independent batches
run as one Spark job and are compared batch by batch.
"""

import random

from pyspark.sql import functions as F

from helpers import courses_df, enrollments_df, feed_df, feed_record, logins_df, users_df
from rollcall.plans.sync import sync_batch


def sequential(rows, users, logins, enrolled, courses, skip):
    """Row-by-row replay: users = [(id, login, sis)], logins = [(uid, login)],
    enrolled = {(account, course)}; returns {(eid, pos): (identity, account,
    enrollment action or reject)}."""
    by_login, by_sis, primary = {}, {}, {}
    for uid, lg, sis in sorted(users):
        by_login.setdefault(lg.lower(), str(uid))
        if sis is not None:
            by_sis.setdefault(sis, str(uid))
        primary[str(uid)] = lg.lower()
    for uid, lg in sorted(logins):
        by_login.setdefault(lg.lower(), str(uid))
    # a login listed for two users resolves to the smallest id
    for uid, lg in sorted(logins) + [(u, lg) for u, lg, _ in users]:
        cur = by_login[lg.lower()]
        if int(cur) > uid:
            by_login[lg.lower()] = str(uid)
    enrolled = set(enrolled)
    out = {}
    for eid, pos, code, status, cust, email in sorted(rows):
        if code in skip:
            out[(eid, pos)] = ("SKIP", None, None)
            continue
        if email is None or email.strip() == "":
            out[(eid, pos)] = ("REJECT", None, "BLANK_EMAIL")
            continue
        e = email.strip().lower()
        if e in by_login:
            ident, acct = "RETURNING", by_login[e]
        elif cust in by_sis:
            ident, acct = "EMAIL_CHANGED", by_sis[cust]
            old = primary[acct]
            by_login[e] = acct
            by_login.setdefault(old, acct)
            primary[acct] = e
        else:
            ident, acct = "NEW", "new:" + cust
            by_login[e] = acct
            by_sis[cust] = acct
            primary[acct] = e
        if code not in courses:
            out[(eid, pos)] = (ident, acct, "UNKNOWN_COURSE")
            continue
        if status != "DROPPED":
            enrolled.add((acct, code))
            out[(eid, pos)] = (ident, acct, "ENROLL")
        elif (acct, code) in enrolled:
            enrolled.discard((acct, code))
            out[(eid, pos)] = (ident, acct, "DROP")
        else:
            out[(eid, pos)] = (ident, acct, "DROP_NOT_FOUND")
    return out


def random_batch(rng, b, n_rows=30):
    ns = f"b{b}"
    emails = [f"{ns}u{i}@x.org" for i in range(8)]
    custs = [f"{ns}c{i}" for i in range(6)]
    codes = [f"{ns}k{i}" for i in range(5)]
    users = []
    uid = b * 1000
    for i in range(rng.randint(0, 5)):
        uid += 1
        users.append((uid, rng.choice(emails + [f"{ns}other{i}@y.org"]), rng.choice(custs + [None])))
    logins = [(u, rng.choice(emails)) for u, _, _ in users if rng.random() < 0.3]
    courses = set(codes[:4])
    skip = {codes[0]} if rng.random() < 0.5 else set()
    enrolled = {(str(u), rng.choice(codes)) for u, _, _ in users if rng.random() < 0.5}
    rows = []
    for j in range(n_rows):
        eid = b * 1000 + j * 2 + rng.randint(0, 1)
        em = rng.choice(emails)
        em = em.upper() if rng.random() < 0.2 else em
        if rng.random() < 0.05:
            em = rng.choice(["", "  ", None])
        rows.append((eid, 0, rng.choice(codes), rng.choice(["ENROLLED", "DROPPED", "PEND", "DROPPED"]),
                     rng.choice(custs), em))
    # unsorted feed order: the plan must not depend on it
    rng.shuffle(rows)
    rows = list({r[0]: r for r in rows}.values())
    return rows, users, logins, enrolled, courses, skip


def test_sync_matches_sequential_replay(spark):
    rng = random.Random(7)
    batches = [random_batch(rng, b) for b in range(1, 41)]
    recs, users, logins, enr, courses, skip = [], [], [], [], [], []
    eid_n = 0
    for rows, us, lg, en, cs, sk in batches:
        for eid, pos, code, status, cust, em in rows:
            recs.append(feed_record(eid, code, [(cust, em, "F", "L")], status=status))
        users += us
        logins += lg
        for a, c in en:
            eid_n += 1
            enr.append((eid_n, 0, c, int(a), "StudentEnrollment", "active"))
        courses += sorted(cs)
        skip += sorted(sk)
    res = sync_batch(feed_df(spark, recs), users_df(spark, users), logins_df(spark, logins),
                     enrollments_df(spark, enr), courses_df(spark, courses),
                     skip=spark.createDataFrame([(s,) for s in skip], "CourseCode string"))
    ident = {(r["event_id"], r["pos"]): (r["action"], r["account"]) for r in res.identities.collect()}
    enroll = {(r["event_id"], r["pos"]): r["action"] for r in res.enrollments.collect()}
    rejects = {(r["event_id"], r["pos"]): r["reason"] for r in res.rejects.collect()}
    skipped = {(r["event_id"], r["pos"]) for r in res.skipped.collect()}
    n = 0
    for rows, us, lg, en, cs, sk in batches:
        want = sequential(rows, us, lg, en, cs, sk)
        for key, (a, acct, what) in want.items():
            n += 1
            if a == "SKIP":
                assert key in skipped
            elif a == "REJECT":
                assert rejects[key] == what
            else:
                assert ident[key] == (a, acct), key
                if what == "UNKNOWN_COURSE":
                    assert rejects[key] == what
                else:
                    assert enroll[key] == what, key
    assert n == sum(len(b[0]) for b in batches)


def test_counts_on_driver_tables(spark):
    """The stand-in branch counts checked for SURVEY §7 at sf 0.01."""
    from rollcall import standins as S
    t = S.Tables(spark, "/root/testdata/sf0.01")
    res = sync_batch(S.feed(t), S.users(t), S.logins(t), S.no_enrollments(spark), S.courses(t),
                     watermark=S.watermark_value(t), skip=S.skip_list(t))
    rep = res.report().first().asDict()
    assert rep["rows_seen"] == 8000 and rep["skipped"] == 1195
    assert (rep["returning_users"], rep["changed_logins"], rep["new_users"]) == (6705, 68, 32)
    assert rep["rejected_unknown_course"] == 685
    assert (rep["enrolled"], rep["dropped"], rep["drops_not_found"]) == (4901, 327, 892)
    assert rep["new_watermark"] == 9999 and rep["old_watermark"] == 1999
    assert res.actions().where(F.col("action") == "CREATE_USER").count() == 32


def test_standin_keys_grow_with_the_tables(spark):
    """Ten times the rows bring about ten times the e-mails, courses and
    mapping keys."""
    from rollcall import standins as S
    from rollcall.operators.feed import feed_rows
    n = []
    for sf in ("sf0.01", "sf0.1"):
        t = S.Tables(spark, f"/root/testdata/{sf}")
        rows = feed_rows(S.feed(t))
        n.append([rows.select("email").distinct().count(), rows.select("course_code").distinct().count(),
                  S.student_enrollments(t).select("sis_course_id").distinct().count(),
                  S.ledger_intro(t).distinct().count(), S.rename_map(t).select("id").distinct().count(),
                  S.recode_map(t).select("currentcoursecode").distinct().count()])
        hot = rows.where(F.col("email") == "U0@x.org").count()
        assert hot >= rows.count() // 10  # the hot e-mail stays
    assert all(8 * a <= b <= 12 * a for a, b in zip(*n)), n


def test_sync_with_a_hot_email_across_many_blocks(spark, monkeypatch):
    """One e-mail holds a third of the batch and one (account, course) pair
    spans many lag blocks (block size 8): still equal to the row loop."""
    import rollcall.operators.ordered as ordered
    monkeypatch.setattr(ordered, "DEFAULT_BLOCK", 8)
    rng = random.Random(11)
    rows, users = [], [(1, "hot@x.org", "c0"), (2, "u1@x.org", "c1")]
    for j in range(300):
        eid = j * 3 + rng.randint(0, 2)
        em = "HOT@x.org" if j % 3 == 0 else f"u{rng.randint(0, 40)}@x.org"
        code = "k0" if j % 3 == 0 else f"k{rng.randint(0, 3)}"
        rows.append((eid, 0, code, rng.choice(["ENROLLED", "DROPPED", "DROPPED", "PEND"]),
                     f"c{rng.randint(0, 30)}", em))
    courses = {"k0", "k1", "k2"}
    enrolled = {("1", "k0")}
    recs = [feed_record(e, c, [(cu, em, "F", "L")], status=st) for e, _, c, st, cu, em in rows]
    res = sync_batch(feed_df(spark, recs), users_df(spark, users), logins_df(spark, []),
                     enrollments_df(spark, [(1, 0, "k0", 1, "StudentEnrollment", "active")]),
                     courses_df(spark, sorted(courses)))
    ident = {(r["event_id"], r["pos"]): (r["action"], r["account"]) for r in res.identities.collect()}
    enroll = {(r["event_id"], r["pos"]): r["action"] for r in res.enrollments.collect()}
    want = sequential(rows, users, [], enrolled, courses, set())
    for key, (a, acct, what) in want.items():
        assert ident[key] == (a, acct)
        if what != "UNKNOWN_COURSE":
            assert enroll[key] == what, key
