"""DuckDB SQL twins of the registered queries (rollcall.registry).

Written independently of the Spark code, in plain SQL with window
functions (row_number / lag), over the driver's pre-registered views.  The
stand-in inputs are re-derived here with the same rules as
rollcall.standins.
"""

from __future__ import annotations

# ---------------------------------------------------------------- inputs --

FEED_ONE = """
feed AS (
  SELECT event_id, 0::INTEGER AS pos,
         CASE WHEN event_type = 'error' THEN 'DROPPED' ELSE 'ENROLLED' END AS status,
         CAST(CAST(json_extract_string(props, '$.k') AS BIGINT) + 100 * (user_id // 150) AS VARCHAR) AS course_code,
         'Course ' || CAST(CAST(json_extract_string(props, '$.k') AS BIGINT) + 100 * (user_id // 150) AS VARCHAR) AS course_name,
         event_type = 'purchase' AS is_online,
         CAST(user_id AS VARCHAR) AS customer_id,
         'U' || CAST(CASE WHEN event_id % 10 = 3 THEN 0 ELSE user_id + (event_id % 2) * (1 - 2 * (user_id % 2)) END AS VARCHAR) || '@x.org' AS email,
         'F' || CAST(user_id AS VARCHAR) AS first_name,
         'L' || CAST(user_id AS VARCHAR) AS last_name,
         ts AS created
  FROM events)"""

# records with event_id % 20 = 0 carry no student, % 20 = 1 two students
FEED_MIXED = """
feed AS (
  SELECT e.event_id, coalesce(s.pos, 0) AS pos, s.pos AS pos_raw,
         CASE WHEN e.event_type = 'error' THEN 'DROPPED' ELSE 'ENROLLED' END AS status,
         CAST(CAST(json_extract_string(e.props, '$.k') AS BIGINT) + 100 * (e.user_id // 150) AS VARCHAR) AS course_code,
         'Course ' || CAST(CAST(json_extract_string(e.props, '$.k') AS BIGINT) + 100 * (e.user_id // 150) AS VARCHAR) AS course_name,
         e.event_type = 'purchase' AS is_online,
         CAST(s.uid AS VARCHAR) AS customer_id,
         CASE WHEN s.uid IS NOT NULL THEN
           'U' || CAST(CASE WHEN e.event_id % 10 = 3 THEN 0 ELSE s.uid + (e.event_id % 2) * (1 - 2 * (s.uid % 2)) END AS VARCHAR) || '@x.org' END AS email,
         'F' || CAST(s.uid AS VARCHAR) AS first_name,
         'L' || CAST(s.uid AS VARCHAR) AS last_name,
         e.ts AS created
  FROM events e
  JOIN (SELECT event_id, 0::INTEGER AS pos, user_id AS uid FROM events WHERE event_id % 20 <> 0
        UNION ALL
        SELECT event_id, 1::INTEGER AS pos, user_id + 1 AS uid FROM events WHERE event_id % 20 = 1
        UNION ALL
        SELECT event_id, NULL::INTEGER AS pos, NULL::BIGINT AS uid FROM events WHERE event_id % 20 = 0) s
    ON s.event_id = e.event_id)"""

WM = """
wm AS (SELECT CAST(floor(max(event_id) / 5) AS BIGINT) AS w FROM events),
past AS (SELECT * FROM feed WHERE event_id > (SELECT w FROM wm))"""

SKIP = """
skip AS (SELECT DISTINCT CAST(p_size AS VARCHAR) AS code FROM part
         WHERE p_brand = 'Brand#2' AND p_size <= 15),
allow AS (SELECT DISTINCT CAST(p_size AS VARCHAR) AS code FROM part WHERE p_brand = 'Brand#3'),
kept AS (SELECT * FROM past p WHERE NOT EXISTS (SELECT 1 FROM skip s WHERE s.code = p.course_code)),
skipped AS (SELECT * FROM past p WHERE EXISTS (SELECT 1 FROM skip s WHERE s.code = p.course_code)),
good AS (SELECT * FROM kept WHERE email IS NOT NULL AND trim(email) <> '')"""

DIRECTORY = """
users AS (
  SELECT c_custkey AS id,
         CASE WHEN c_custkey % 3 = 0 THEN 'U' || CAST(c_custkey AS VARCHAR) || '@x.org'
              ELSE 'old' || CAST(c_custkey AS VARCHAR) || '@y.org' END AS login_id,
         CAST(c_custkey AS VARCHAR) AS sis_user_id, c_name AS name
  FROM customer WHERE c_custkey % 3 <> 2),
logins AS (
  SELECT id AS user_id, login_id AS unique_id FROM users
  UNION ALL
  SELECT id, 'alt' || CAST(id AS VARCHAR) || '@x.org' FROM users WHERE id % 5 = 0),
dir_login AS (
  SELECT e, min(uid) AS dir_e FROM (
    SELECT lower(trim(unique_id)) AS e, user_id AS uid FROM logins
    UNION ALL SELECT lower(trim(login_id)), id FROM users) x
  WHERE e IS NOT NULL AND e <> '' GROUP BY e),
dir_sis AS (
  SELECT sis_user_id AS c, min(id) AS dir_c, arg_min(lower(trim(login_id)), id) AS dir_login
  FROM users WHERE sis_user_id IS NOT NULL GROUP BY sis_user_id)"""

IDENTITY = """
r AS (
  SELECT g.*, lower(trim(email)) AS e,
         row_number() OVER (PARTITION BY lower(trim(email)) ORDER BY event_id, pos) AS rn_e
  FROM good g),
f0 AS (
  SELECT r.*, d.dir_e, s.dir_c, s.dir_login,
         (d.dir_e IS NULL AND s.dir_c IS NULL) AS unresolved
  FROM r LEFT JOIN dir_login d ON d.e = r.e LEFT JOIN dir_sis s ON s.c = r.customer_id
  WHERE r.rn_e = 1),
f1 AS (
  SELECT f0.*, row_number() OVER (PARTITION BY unresolved, customer_id ORDER BY event_id, pos) AS rn_c
  FROM f0),
firsts AS (
  SELECT f1.*,
         CASE WHEN dir_e IS NOT NULL THEN 'RETURNING'
              WHEN dir_c IS NOT NULL THEN 'EMAIL_CHANGED'
              WHEN unresolved AND (customer_id IS NULL OR rn_c = 1) THEN 'NEW'
              ELSE 'EMAIL_CHANGED' END AS first_action,
         coalesce(CAST(dir_e AS VARCHAR), CAST(dir_c AS VARCHAR),
                  CASE WHEN customer_id IS NULL THEN 'new-login:' || e ELSE 'new:' || customer_id END) AS account
  FROM f1),
resolved AS (
  SELECT r.*, CASE WHEN r.rn_e = 1 THEN f.first_action ELSE 'RETURNING' END AS action, f.account
  FROM r JOIN firsts f ON f.e = r.e)"""

COURSES = """
courses AS (
  SELECT s.s_suppkey AS course_id, CAST(s.s_suppkey AS VARCHAR) AS sis_course_id,
         'Course ' || CAST(s.s_suppkey AS VARCHAR) AS name, CAST(s.s_suppkey AS VARCHAR) AS course_code,
         s.s_nationkey::BIGINT AS account_id,
         n.n_regionkey::BIGINT AS enrollment_term_id, 'T' || CAST(n.n_regionkey AS VARCHAR) AS sis_term_id,
         NULL::BIGINT AS total_students, 'available' AS workflow_state,
         false AS restrict_student_future_view
  FROM supplier s JOIN nation n ON n.n_nationkey = s.s_nationkey
  WHERE s.s_suppkey % 10 <> 7)"""

KNOWN = """
known AS (SELECT * FROM resolved x WHERE EXISTS (SELECT 1 FROM courses c WHERE c.sis_course_id = x.course_code)),
bad_course AS (SELECT * FROM resolved x WHERE NOT EXISTS (SELECT 1 FROM courses c WHERE c.sis_course_id = x.course_code))"""

STUDENT_ENR = """
enr AS (
  SELECT o_orderkey AS id, CAST(o_orderkey % 100 + 100 * (o_custkey // 150) AS VARCHAR) AS sis_course_id, o_custkey AS user_id,
         'StudentEnrollment' AS type,
         CASE o_orderstatus WHEN 'O' THEN 'active' WHEN 'P' THEN 'invited' ELSE 'completed' END AS enrollment_state
  FROM orders),
cur AS (
  SELECT DISTINCT CAST(user_id AS VARCHAR) AS account, sis_course_id AS course_code FROM enr
  WHERE type = 'StudentEnrollment' AND enrollment_state IN ('active', 'invited'))"""

ENROLL = """
seq AS (
  SELECT k.*, lag(status) OVER w AS prev_status, row_number() OVER w AS rn
  FROM known k WINDOW w AS (PARTITION BY account, course_code ORDER BY event_id, pos)),
enroll AS (
  SELECT s.event_id, s.pos,
         CASE WHEN NOT coalesce(s.status = 'DROPPED', false) THEN 'ENROLL'
              WHEN (CASE WHEN s.rn > 1 THEN NOT coalesce(s.prev_status = 'DROPPED', false)
                         ELSE c.account IS NOT NULL END) THEN 'DROP'
              ELSE 'DROP_NOT_FOUND' END AS action,
         s.account, s.course_code, s.course_name
  FROM seq s LEFT JOIN cur c ON c.account = s.account AND c.course_code = s.course_code)"""

LEDGERS = """
ledger_intro AS (SELECT 'u' || CAST(c_custkey AS VARCHAR) || '@x.org' AS Email FROM customer WHERE c_custkey % 7 = 0),
ledger_covid AS (SELECT 'AU' || CAST(c_custkey AS VARCHAR) || '@x.org' AS Email FROM customer WHERE c_custkey % 7 = 1),
cand AS (SELECT event_id, pos, account, email, e FROM resolved WHERE rn_e = 1)"""

LETTERS_EXACT = """
letters AS (
  SELECT event_id, pos, account, email, 'intro' AS letter FROM cand
  WHERE NOT EXISTS (SELECT 1 FROM ledger_intro l WHERE lower(trim(l.Email)) = cand.e)
  UNION ALL
  SELECT event_id, pos, account, email, 'covid' FROM cand
  WHERE NOT EXISTS (SELECT 1 FROM ledger_covid l WHERE lower(trim(l.Email)) = cand.e))"""

# the allow-list form mails users it found, from their first row after creation
LETTERS_LISTED = """
cand AS (SELECT event_id, pos, account, email, e FROM (
  SELECT *, row_number() OVER (PARTITION BY e ORDER BY event_id, pos) AS nth FROM resolved
  WHERE action = 'RETURNING') x WHERE nth = 1),
letters AS (
  SELECT event_id, pos, account, email, 'intro' AS letter FROM cand
  WHERE NOT EXISTS (SELECT 1 FROM ledger_intro l WHERE lower(trim(l.Email)) = cand.e))"""

LETTERS_REGEX = """
letters AS (
  SELECT event_id, pos, account, email, 'intro' AS letter FROM cand
  WHERE NOT EXISTS (SELECT 1 FROM ledger_intro l WHERE regexp_matches(l.Email, cand.email))
  UNION ALL
  SELECT event_id, pos, account, email, 'covid' FROM cand
  WHERE NOT EXISTS (SELECT 1 FROM ledger_covid l WHERE regexp_matches(l.Email, cand.email)))"""

LOGIN_CHANGES = """
ch0 AS (
  SELECT account, event_id, pos, e, first_action, dir_c, dir_login,
         lag(e) OVER (PARTITION BY account ORDER BY event_id, pos) AS prev_e,
         row_number() OVER (PARTITION BY account ORDER BY event_id, pos) AS rn_a
  FROM firsts WHERE first_action IN ('NEW', 'EMAIL_CHANGED')),
login_counts AS (
  SELECT user_id, lower(trim(unique_id)) AS login, count(*) AS n FROM logins GROUP BY 1, 2),
login_changes AS (
  SELECT c.event_id, c.pos, c.account, c.e AS new_login,
         CASE WHEN c.rn_a > 1 THEN c.prev_e ELSE c.dir_login END AS old_login,
         (CASE WHEN c.rn_a > 1 THEN c.prev_e ELSE c.dir_login END) IS NOT NULL
           AND NOT (c.rn_a = 1 AND coalesce(lc.n, 0) >= 2) AS add_login
  FROM ch0 c LEFT JOIN login_counts lc
    ON lc.user_id = c.dir_c AND lc.login = (CASE WHEN c.rn_a > 1 THEN c.prev_e ELSE c.dir_login END)
  WHERE c.first_action = 'EMAIL_CHANGED')"""


def _with(*parts: str) -> str:
    return "WITH " + ",".join(p.strip("\n") for p in parts) + "\n"


SYNC_BASE = (FEED_ONE, WM, SKIP, DIRECTORY, IDENTITY, COURSES, KNOWN, STUDENT_ENR, ENROLL,
             LEDGERS, LETTERS_EXACT, LOGIN_CHANGES)

ACTIONS = """
SELECT event_id, pos, 'CREATE_USER' AS action, account, NULL AS course_code FROM firsts WHERE first_action = 'NEW'
UNION ALL SELECT event_id, pos, 'CHANGE_LOGIN', account, NULL FROM login_changes
UNION ALL SELECT event_id, pos, 'ADD_LOGIN', account, NULL FROM login_changes WHERE add_login
UNION ALL SELECT event_id, pos, 'ENROLL_INTRO', account, 'INTRO-101' FROM firsts WHERE first_action = 'NEW'
UNION ALL SELECT event_id, pos, 'LETTER_' || upper(letter), account, NULL FROM letters
UNION ALL SELECT event_id, pos, action, account, course_code FROM enroll
UNION ALL SELECT event_id, pos, 'SKIP', NULL, course_code FROM skipped
UNION ALL SELECT event_id, pos, 'REJECT_BLANK_EMAIL', NULL, course_code FROM kept WHERE email IS NULL OR trim(email) = ''
UNION ALL SELECT event_id, pos, 'REJECT_UNKNOWN_COURSE', account, course_code FROM bad_course
"""

# allow-list form: only listed courses, identity by e-mail else a new user per e-mail
SKIP_ALLOW = """
allow AS (SELECT DISTINCT CAST(p_size AS VARCHAR) AS code FROM part WHERE p_brand = 'Brand#3'),
kept AS (SELECT * FROM past p WHERE EXISTS (SELECT 1 FROM allow s WHERE s.code = p.course_code)),
skipped AS (SELECT * FROM past p WHERE NOT EXISTS (SELECT 1 FROM allow s WHERE s.code = p.course_code)),
good AS (SELECT * FROM kept WHERE email IS NOT NULL AND trim(email) <> '')"""

IDENTITY_BY_EMAIL = """
r AS (
  SELECT g.*, lower(trim(email)) AS e,
         row_number() OVER (PARTITION BY lower(trim(email)) ORDER BY event_id, pos) AS rn_e
  FROM good g),
firsts AS (
  SELECT r.*, d.dir_e,
         CASE WHEN d.dir_e IS NOT NULL THEN 'RETURNING' ELSE 'NEW' END AS first_action,
         coalesce(CAST(d.dir_e AS VARCHAR), 'new-login:' || r.e) AS account
  FROM r LEFT JOIN dir_login d ON d.e = r.e WHERE r.rn_e = 1),
resolved AS (
  SELECT r.*, CASE WHEN r.rn_e = 1 THEN f.first_action ELSE 'RETURNING' END AS action, f.account
  FROM r JOIN firsts f ON f.e = r.e),
login_changes AS (SELECT event_id, pos, account, e AS new_login, e AS old_login, false AS add_login
                  FROM firsts WHERE false)"""

SQL: dict[str, str] = {}

SQL["feed_flatten"] = _with(FEED_MIXED) + """
SELECT e.event_id AS EventEnrollmentID, f.status AS EnrollmentStatusCd,
       strftime(f.created, '%Y-%m-%d %H:%M:%S.%f') AS CreatedDate,
       f.course_code AS ScheduledEvent_EventCd, f.course_name AS ScheduledEvent_Course_CourseName,
       f.is_online AS ScheduledEvent_Course_IsOnline, f.pos_raw AS pos,
       f.customer_id AS StudentID, f.customer_id AS CustomerID, f.email AS Person_Email,
       f.first_name AS Person_FirstName, f.last_name AS Person_LastName
FROM feed f JOIN events e ON e.event_id = f.event_id"""

SQL["feed_since_watermark"] = _with(FEED_ONE, WM) + """
SELECT event_id, pos, status, course_code, customer_id, email FROM past
WHERE CAST(created AS DATE) BETWEEN (SELECT CAST(min(ts) AS DATE) + 14 - 7 FROM events)
                                AND (SELECT CAST(min(ts) AS DATE) + 14 + 112 FROM events)"""

SQL["feed_skip_list"] = _with(FEED_ONE, WM, SKIP) + """
SELECT event_id, pos, course_code, false AS skipped FROM kept
UNION ALL SELECT event_id, pos, course_code, true FROM skipped"""

SQL["feed_allow_list"] = _with(FEED_ONE, WM, SKIP) + """
SELECT event_id, pos, course_code FROM past p WHERE EXISTS (SELECT 1 FROM allow a WHERE a.code = p.course_code)"""

SQL["feed_online_override"] = _with(FEED_ONE, WM, SKIP) + """
SELECT event_id, pos, course_code, is_online FROM past p
WHERE NOT EXISTS (SELECT 1 FROM skip s WHERE s.code = p.course_code) OR coalesce(is_online, false)"""

SQL["feed_rejects"] = _with(FEED_MIXED, WM, SKIP, COURSES) + """
SELECT event_id, pos, course_code, 'BLANK_EMAIL' AS reason FROM kept WHERE email IS NULL OR trim(email) = ''
UNION ALL
SELECT event_id, pos, course_code, 'UNKNOWN_COURSE' FROM good g
WHERE NOT EXISTS (SELECT 1 FROM courses c WHERE c.sis_course_id = g.course_code)"""

SQL["identity_actions"] = _with(FEED_ONE, WM, SKIP, DIRECTORY, IDENTITY) + """
SELECT event_id, pos, action, account FROM resolved"""

SQL["login_changes"] = _with(FEED_ONE, WM, SKIP, DIRECTORY, IDENTITY, LOGIN_CHANGES) + """
SELECT * FROM login_changes"""

SQL["letters_due"] = _with(FEED_ONE, WM, SKIP, DIRECTORY, IDENTITY, LEDGERS, LETTERS_EXACT) + """
SELECT * FROM letters"""

SQL["letters_due_regex"] = _with(FEED_ONE, WM, SKIP, DIRECTORY, IDENTITY, LEDGERS, LETTERS_REGEX) + """
SELECT * FROM letters"""

SQL["letters_due_indexed"] = SQL["letters_due_regex"]

SQL["enroll_actions"] = _with(FEED_ONE, WM, SKIP, DIRECTORY, IDENTITY, COURSES, KNOWN, STUDENT_ENR, ENROLL) + """
SELECT event_id, pos, action, account, course_code FROM enroll"""

SQL["enroll_final_state"] = _with(FEED_ONE, WM, SKIP, DIRECTORY, IDENTITY, COURSES, KNOWN) + """
SELECT account, course_code, event_id AS last_event_id, status AS last_status,
       NOT coalesce(status = 'DROPPED', false) AS active
FROM (SELECT *, row_number() OVER (PARTITION BY account, course_code ORDER BY event_id DESC, pos DESC) AS rk
      FROM known) x WHERE rk = 1"""

SQL["sync_batch"] = _with(*SYNC_BASE) + ACTIONS

SQL["sync_stream"] = SQL["sync_batch"]

SQL["sync_only_listed"] = _with(FEED_ONE, WM, SKIP_ALLOW, DIRECTORY, IDENTITY_BY_EMAIL, COURSES, KNOWN,
                                STUDENT_ENR, ENROLL, LEDGERS.rsplit(",\ncand", 1)[0], LETTERS_LISTED) + ACTIONS

SQL["sync_report"] = _with(*SYNC_BASE) + """
SELECT (SELECT count(*) FROM past) AS rows_seen,
       (SELECT count(*) FROM skipped) AS skipped,
       (SELECT count(*) FROM kept WHERE email IS NULL OR trim(email) = '') AS rejected_blank_email,
       (SELECT count(*) FROM bad_course) AS rejected_unknown_course,
       (SELECT count(*) FILTER (WHERE action = 'RETURNING') FROM resolved) AS returning_users,
       (SELECT count(*) FILTER (WHERE action = 'EMAIL_CHANGED') FROM resolved) AS changed_logins,
       (SELECT count(*) FILTER (WHERE action = 'NEW') FROM resolved) AS new_users,
       (SELECT count(*) FROM enroll) AS enrollment_events,
       (SELECT count(*) FILTER (WHERE action = 'ENROLL') FROM enroll) AS enrolled,
       (SELECT count(*) FILTER (WHERE action = 'DROP') FROM enroll) AS dropped,
       (SELECT count(*) FILTER (WHERE action = 'DROP_NOT_FOUND') FROM enroll) AS drops_not_found,
       (SELECT count(*) FROM letters) AS letters,
       (SELECT w FROM wm) AS old_watermark,
       greatest(coalesce((SELECT max(event_id) FROM past), (SELECT w FROM wm)), (SELECT w FROM wm)) AS new_watermark,
       strftime((SELECT max(ts) FROM events), '%I:%M%p on %B %d, %Y') AS heading_time"""

SQL["sync_watermark"] = _with(FEED_ONE, WM) + """
SELECT greatest(coalesce((SELECT max(event_id) FROM past), (SELECT w FROM wm)), (SELECT w FROM wm))
       AS EventEnrollmentID"""

SQL["sync_messages"] = _with(*SYNC_BASE) + """
SELECT n.event_id, n.pos, n.action AS kind,
       coalesce(k.email, '') || CASE n.action WHEN 'ENROLL' THEN ': enrolled in ' WHEN 'DROP' THEN ': removed from '
         ELSE ': no enrollment in ' END || coalesce(n.course_name, '') || ' [' || n.course_code || ']'
       || CASE n.action WHEN 'DROP_NOT_FOUND' THEN ' to remove' ELSE '' END AS message
FROM enroll n JOIN known k ON k.event_id = n.event_id AND k.pos = n.pos
UNION ALL
SELECT event_id, pos, 'CREATE_USER', e || ': new account for ' || coalesce(first_name || ' ' || last_name, '')
FROM firsts WHERE first_action = 'NEW'
UNION ALL
SELECT event_id, pos, 'ENROLL_INTRO', account || ': enrolled in the introduction INTRO-101'
FROM firsts WHERE first_action = 'NEW'
UNION ALL
SELECT event_id, pos, 'LETTER', email || ': ' || letter || ' letter due' FROM letters
UNION ALL
SELECT event_id, pos, 'SKIP', coalesce(email, '') || ': course ' || coalesce(course_code, '') || ' is on the skip list'
FROM skipped
UNION ALL
SELECT event_id, pos, 'BLANK_EMAIL', 'course ' || coalesce(course_code, '') || ': no e-mail address'
FROM kept WHERE email IS NULL OR trim(email) = ''
UNION ALL
SELECT event_id, pos, 'UNKNOWN_COURSE', email || ': course ' || coalesce(course_name, '') || ' ['
       || coalesce(course_code, '') || '] is unknown' FROM bad_course"""


# ------------------------------------------------------ maintenance side --

LMS = """
accounts AS (SELECT n_nationkey::BIGINT AS account_id, n_name AS subaccount_name FROM nation
             WHERE n_nationkey % 6 <> 5),
terms AS (SELECT r_regionkey::BIGINT AS enrollment_term_id, 'T' || CAST(r_regionkey AS VARCHAR) AS sis_term_id,
                 r_name AS enrollment_name FROM region),
staff_enr AS (
  SELECT l_orderkey * 10 + l_linenumber AS id, l_suppkey AS course_id,
         CAST(l_suppkey AS VARCHAR) AS sis_course_id, l_partkey AS user_id,
         CASE l_returnflag WHEN 'A' THEN 'TeacherEnrollment' WHEN 'R' THEN 'TaEnrollment'
              ELSE 'StudentEnrollment' END AS type,
         CASE l_returnflag WHEN 'A' THEN 'Teacher' WHEN 'R' THEN 'Ta' ELSE 'Student' END AS role,
         CASE WHEN l_returnflag = 'R' AND l_linenumber = 1 THEN 16 END::BIGINT AS role_id,
         CASE WHEN l_linestatus = 'F' THEN 'completed' ELSE 'active' END AS enrollment_state
  FROM lineitem),
staff_users AS (SELECT p_partkey AS id, p_name AS name, 'staff' || CAST(p_partkey AS VARCHAR) || '@x.org' AS login_id
                FROM part),
staff_by_login AS (
  SELECT e, min(uid) AS user_id FROM (
    SELECT lower(trim(login_id)) AS e, id AS uid FROM staff_users
    UNION ALL SELECT lower(trim(login_id)), id FROM staff_users) x
  WHERE e IS NOT NULL AND e <> '' GROUP BY e),
idx AS (SELECT sis_course_id AS sis, min(course_id) AS course_id, arg_min(account_id, course_id) AS account_id
        FROM courses WHERE sis_course_id IS NOT NULL GROUP BY sis_course_id)"""

TEMPLATE_REQ = """
treq AS (
  SELECT 'Class ' || s_name AS CourseName,
         CASE WHEN s_suppkey % 3 = 0 THEN CAST(s_suppkey + 1 AS VARCHAR)
              ELSE 'NEW-' || CAST(s_suppkey AS VARCHAR) END AS NewSIS_ID,
         'STAFF' || CAST(s_suppkey * 3 AS VARCHAR) || '@x.org' AS Email,
         CAST(s_suppkey AS VARCHAR) AS Template, CAST(s_nationkey AS VARCHAR) AS SubAccount
  FROM supplier),
term_id AS (SELECT enrollment_term_id AS tid FROM terms WHERE enrollment_name = 'AMERICA')"""


def _plan_sql(req: str, new: str, src: str, name: str, account: str, copy_existing: bool) -> str:
    exists = "COPY" if copy_existing else "EXISTS"
    needs_source = "true" if copy_existing else "t.course_id IS NULL"
    acct = "s.account_id" if account == "source" else f"CAST(r.{account} AS BIGINT)"
    return f"""
SELECT r.{new} AS new_sis, r.{src} AS source_sis, r.{name} AS name,
       CASE WHEN s.course_id IS NULL AND {needs_source} THEN 'SOURCE_NOT_FOUND'
            WHEN t.course_id IS NOT NULL THEN '{exists}' ELSE 'CREATE' END AS action,
       CASE WHEN t.course_id IS NULL THEN {acct} END AS account_id,
       CASE WHEN t.course_id IS NULL THEN (SELECT tid FROM term_id) END::BIGINT AS term_id
FROM {req} r LEFT JOIN idx t ON t.sis = r.{new} LEFT JOIN idx s ON s.sis = r.{src}"""


DUP_REQ = """
dreq AS (
  SELECT CASE WHEN s_suppkey % 3 = 0 THEN CAST(s_suppkey + 1 AS VARCHAR)
              ELSE 'NEW-' || CAST(s_suppkey AS VARCHAR) END AS NewSIS_ID,
         CAST(s_suppkey AS VARCHAR) AS CurrentSIS_ID, 'Copy of ' || s_name AS CourseName
  FROM supplier)"""

PLAN_DUP = _plan_sql("dreq", "NewSIS_ID", "CurrentSIS_ID", "CourseName", "source", True)
PLAN_TEMPLATE = _plan_sql("treq", "NewSIS_ID", "Template", "CourseName", "SubAccount", False)
PLAN_CLASSES = _plan_sql("treq", "NewSIS_ID", "Template", "CourseName", "source", True)


def _teacher_sql(plan: str, notify: bool) -> str:
    return f"""
, plans AS ({plan})
SELECT p.new_sis, b.user_id,
       CASE WHEN b.user_id IS NULL THEN 'TEACHER_NOT_FOUND' ELSE 'ENROLL' END AS action,
       'TeacherEnrollment' AS type, 'active' AS enrollment_state, {str(notify).lower()} AS notify,
       NULL::BIGINT AS role_id
FROM (SELECT DISTINCT new_sis FROM plans WHERE action IN ('CREATE', 'COPY')) p
JOIN treq r ON r.NewSIS_ID = p.new_sis
LEFT JOIN staff_by_login b ON b.e = lower(trim(r.Email))"""


CONTENT = """
content AS (SELECT l_suppkey AS course_id, l_orderkey * 10 + l_linenumber AS item_id,
                   l_returnflag || l_linestatus || CAST(l_linenumber AS VARCHAR) AS body FROM lineitem),
cpairs AS (SELECT DISTINCT CAST(s_suppkey AS VARCHAR) AS source_sis, CAST(s_suppkey + 1 AS VARCHAR) AS new_sis
           FROM supplier),
cgood AS (SELECT a.course_id AS source_course_id, b.course_id AS target_course_id
          FROM cpairs p JOIN idx a ON a.sis = p.source_sis JOIN idx b ON b.sis = p.new_sis)"""

MAINT = (COURSES, LMS)

SQL["course_report"] = _with(*MAINT) + """
, students AS (SELECT course_id, count(DISTINCT user_id) AS n FROM staff_enr
               WHERE type = 'StudentEnrollment' AND enrollment_state IN ('active', 'invited') GROUP BY 1),
teachers AS (SELECT t.course_id, string_agg(u.name, ' ' ORDER BY u.name) AS teacher
             FROM (SELECT DISTINCT course_id, user_id FROM staff_enr
                   WHERE type = 'TeacherEnrollment' AND enrollment_state IN ('active', 'invited')) t
             JOIN staff_users u ON u.id = t.user_id GROUP BY 1)
SELECT c.course_id, c.sis_course_id, c.name AS Course_Name, c.account_id, c.enrollment_term_id,
       coalesce(c.total_students, s.n, 0) AS total_students, c.workflow_state, a.subaccount_name,
       t.enrollment_name, coalesce(tt.teacher, 'No Teacher in Class') AS teacher
FROM courses c JOIN accounts a ON a.account_id = c.account_id
JOIN terms t ON t.enrollment_term_id = c.enrollment_term_id
LEFT JOIN students s ON s.course_id = c.course_id LEFT JOIN teachers tt ON tt.course_id = c.course_id"""

SQL["rename_term"] = _with(COURSES) + """
SELECT course_id, sis_course_id AS old_sis_course_id, name AS old_name,
       sis_course_id || '-2024' AS sis_course_id, sis_course_id || '-2024' AS course_code, 'OLD-' || name AS name
FROM courses WHERE sis_term_id = 'T1'"""

SQL["rename_courses"] = _with(COURSES) + """
, m AS (SELECT * FROM (
    SELECT p_partkey // 2 AS id, 'NS-' || CAST(p_partkey AS VARCHAR) AS NewShortName,
           upper(p_name) || ' v' || CAST(p_partkey AS VARCHAR) AS new_name,
           row_number() OVER (PARTITION BY p_partkey // 2 ORDER BY p_partkey DESC) AS rk
    FROM part) x WHERE rk = 1)
SELECT c.course_id, c.name AS old_name, c.course_code AS old_course_code,
       coalesce(m.new_name, c.name) AS name, coalesce(m.NewShortName, c.course_code) AS course_code
FROM m JOIN courses c ON c.course_id = m.id"""

SQL["recode_courses"] = _with(COURSES) + """
, m AS (SELECT * FROM (
    SELECT CAST(p_partkey // 3 AS VARCHAR) AS cur, 'R' || CAST(p_partkey AS VARCHAR) AS new,
           row_number() OVER (PARTITION BY p_partkey // 3 ORDER BY p_partkey DESC) AS rk
    FROM part) x WHERE rk = 1)
SELECT c.course_id, c.sis_course_id AS old_sis_course_id, m.new AS sis_course_id, m.new AS course_code
FROM m JOIN courses c ON c.sis_course_id = m.cur"""

SQL["hide_until_start"] = _with(COURSES) + """
SELECT course_id, sis_course_id, true AS restrict_student_future_view,
       NOT coalesce(restrict_student_future_view, false) AS changed
FROM courses WHERE sis_term_id = 'T2'"""

SQL["term_lookup"] = """
WITH cal AS (SELECT DISTINCT CAST(year(o_orderdate) * 100 + month(o_orderdate) AS BIGINT) AS enrollment_term_id,
                    strftime(o_orderdate, '%B') AS enrollment_name FROM orders)
SELECT enrollment_name, max(enrollment_term_id) AS enrollment_term_id, count(*) AS matches
FROM cal GROUP BY enrollment_name"""

SQL["plan_duplicate"] = _with(*MAINT, TEMPLATE_REQ, DUP_REQ) + PLAN_DUP
SQL["plan_template"] = _with(*MAINT, TEMPLATE_REQ) + PLAN_TEMPLATE
SQL["plan_classes"] = _with(*MAINT, TEMPLATE_REQ) + PLAN_CLASSES
SQL["plan_template_teachers"] = _with(*MAINT, TEMPLATE_REQ) + _teacher_sql(PLAN_TEMPLATE, False)
SQL["plan_classes_teachers"] = _with(*MAINT, TEMPLATE_REQ) + _teacher_sql(PLAN_CLASSES, True)

SQL["propagate_staff"] = _with(*MAINT, TEMPLATE_REQ, DUP_REQ) + f"""
, plans AS ({PLAN_DUP}),
pairs AS (SELECT DISTINCT source_sis, new_sis FROM plans WHERE action IN ('CREATE', 'COPY')),
staff AS (SELECT DISTINCT sis_course_id AS source_sis, user_id, type FROM staff_enr
          WHERE type IN ('TeacherEnrollment', 'TaEnrollment') AND enrollment_state IN ('active', 'invited'))
SELECT p.new_sis, s.user_id, s.type, 'active' AS enrollment_state,
       CASE WHEN s.type = 'TaEnrollment' THEN true END AS notify,
       CASE WHEN s.type = 'TaEnrollment' THEN 16 END::BIGINT AS role_id
FROM pairs p JOIN staff s ON s.source_sis = p.source_sis"""

SQL["copy_content"] = _with(*MAINT, CONTENT) + """
SELECT g.target_course_id AS course_id, c.item_id, c.body, g.source_course_id
FROM content c JOIN cgood g ON c.course_id = g.source_course_id
UNION ALL
SELECT course_id, item_id, body, NULL::BIGINT FROM content
WHERE course_id IN (SELECT target_course_id FROM cgood)"""

SQL["copy_content_reset"] = _with(*MAINT, CONTENT) + """
SELECT g.target_course_id AS course_id, c.item_id, c.body, g.source_course_id
FROM content c JOIN cgood g ON c.course_id = g.source_course_id"""

SQL["transfer_roster"] = _with(*MAINT) + """
, pairs AS (SELECT DISTINCT CAST(s_suppkey AS VARCHAR) AS from_sis, CAST(s_suppkey + 2 AS VARCHAR) AS to_sis
            FROM supplier),
studs AS (SELECT DISTINCT sis_course_id AS from_sis, user_id FROM staff_enr
          WHERE type = 'StudentEnrollment' AND enrollment_state IN ('active', 'invited'))
SELECT p.from_sis, p.to_sis, s.user_id, 'StudentEnrollment' AS type, 'active' AS enrollment_state,
       true AS notify
FROM pairs p JOIN studs s ON s.from_sis = p.from_sis"""

SQL["grant_one"] = _with(*MAINT) + """
, r AS (SELECT lower(trim('staff' || CAST(s_suppkey * 2 AS VARCHAR) || '@x.org')) AS e,
               CAST(s_suppkey AS VARCHAR) AS course_sis,
               CASE s_suppkey % 3 WHEN 0 THEN 'teacher' WHEN 1 THEN 'ta' ELSE 'transition' END AS kind
        FROM supplier),
cidx AS (SELECT sis_course_id, min(course_id) AS course_id FROM courses
         WHERE sis_course_id IS NOT NULL GROUP BY 1)
SELECT r.e AS login, r.course_sis, c.course_id, b.user_id,
       CASE WHEN c.course_id IS NULL THEN 'COURSE_NOT_FOUND' WHEN b.user_id IS NULL THEN 'USER_NOT_FOUND'
            ELSE 'ENROLL' END AS action,
       CASE lower(r.kind) WHEN 'teacher' THEN 'TeacherEnrollment' WHEN 'ta' THEN 'TaEnrollment'
            WHEN 'transition' THEN 'TaEnrollment' END AS type,
       CASE WHEN lower(r.kind) = 'transition' THEN 16 END::BIGINT AS role_id,
       'active' AS enrollment_state, true AS notify
FROM r LEFT JOIN staff_by_login b ON b.e = r.e LEFT JOIN cidx c ON c.sis_course_id = r.course_sis"""

SQL["grant_across_term"] = _with(*MAINT) + """
, r AS (SELECT lower(trim('staff' || CAST(r_regionkey AS VARCHAR) || '@x.org')) AS e,
               'T' || CAST(r_regionkey AS VARCHAR) AS sis_term_id FROM region)
SELECT r.e AS login, r.sis_term_id, c.course_id, c.sis_course_id, b.user_id, 'TaEnrollment' AS type,
       16::BIGINT AS role_id, 'active' AS enrollment_state, true AS notify
FROM r JOIN staff_by_login b ON b.e = r.e JOIN courses c ON c.sis_term_id = r.sis_term_id"""

SQL["revoke_across_term"] = _with(*MAINT) + """
, q AS (SELECT r_regionkey * 7 AS target, 'T' || CAST(r_regionkey AS VARCHAR) AS sis_term_id FROM region)
SELECT c.sis_term_id, e.course_id, e.sis_course_id, e.id AS enrollment_id, e.user_id,
       coalesce(e.user_id = q.target, false) AS removed
FROM staff_enr e JOIN courses c ON c.course_id = e.course_id JOIN q ON q.sis_term_id = c.sis_term_id
WHERE e.type = 'TeacherEnrollment'"""

SQL["last_login_report"] = _with(DIRECTORY) + """
, last AS (SELECT user_id, max(ts) AS ts FROM events GROUP BY user_id),
u AS (SELECT u.id, u.login_id, u.sis_user_id,
             strftime(l.ts, '%Y-%m-%dT%H:%M:%S') ||
             CASE WHEN u.id % 3 = 0 THEN 'Z' WHEN u.id % 3 = 1 THEN '-07:00' ELSE '-0700' END AS last_login
      FROM users u LEFT JOIN last l ON l.user_id = u.id),
p AS (SELECT u.*, timezone('UTC', try_strptime(regexp_replace(last_login, 'Z$', '+00:00'),
                                               '%Y-%m-%dT%H:%M:%S%z')) AS ts FROM u)
SELECT id, login_id, sis_user_id, last_login,
       coalesce(strftime(ts, '%Y-%m-%d %H:%M:%S'), 'no last login') AS last_login_at,
       (last_login IS NOT NULL AND ts IS NULL) AS parse_error,
       (ts IS NULL OR CAST(ts AS DATE) < (SELECT CAST(max(ts) AS DATE) FROM events) - 14) AS inactive
FROM p"""

SQL["roles_of_user"] = _with(*MAINT) + """
, r AS (SELECT DISTINCT lower(trim('STAFF' || CAST(s_suppkey AS VARCHAR) || '@x.org')) AS e FROM supplier)
SELECT r.e AS login, b.user_id, e.id AS enrollment_id, e.sis_course_id, e.role, e.type
FROM r JOIN staff_by_login b ON b.e = r.e JOIN staff_enr e ON e.user_id = b.user_id"""

SQL["roles_in_account"] = """
SELECT min(p_partkey) AS id, p_type AS label, p_type || 'Enrollment' AS role, 'StudentEnrollment' AS base_role_type
FROM part GROUP BY p_type"""

SQL["student_list"] = _with(FEED_MIXED) + """
SELECT DISTINCT email FROM feed WHERE email IS NOT NULL"""

SQL["course_staff"] = _with(*MAINT) + """
SELECT DISTINCT e.course_id, e.sis_course_id, e.user_id, u.name, e.type
FROM staff_enr e LEFT JOIN staff_users u ON u.id = e.user_id
WHERE e.type IN ('TeacherEnrollment', 'TaEnrollment')"""

SCHOOL = """
stu AS (SELECT c_nationkey AS SC, c_name AS LN, 'c' || CAST(c_custkey AS VARCHAR) || '@x.org' AS SEM,
               (9 + c_custkey % 4)::INTEGER AS GR, (c_custkey % 6)::INTEGER AS CU,
               CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END AS DEL,
               CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN 'X' ELSE '' END AS TG FROM customer),
tch AS (SELECT s_nationkey AS SC,
               (row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey))::INTEGER AS TN,
               't' || CAST(s_suppkey AS VARCHAR) || '@x.org' AS EM FROM supplier),
alt AS (SELECT n_nationkey AS SCID, n_name AS ALTSC FROM nation)"""

GROUPS = """
want AS (SELECT 'c' || CAST(o_custkey AS VARCHAR) || '.' || substr(o_orderpriority, 1, 1) || '@x.org' AS login_id
         FROM orders WHERE o_orderstatus IN ('P', 'F')),
have AS (SELECT 'c' || CAST(o_custkey AS VARCHAR) || '.' || substr(o_orderpriority, 1, 1) || '@x.org' AS login_id
         FROM orders WHERE o_orderstatus = 'O' OR (o_orderstatus = 'F' AND o_orderkey % 2 = 0))"""

SQL["group_students"] = _with(SCHOOL) + """
SELECT a.ALTSC, s.LN, s.SEM, s.GR, s.CU, t.EM
FROM stu s JOIN tch t ON s.SC = t.SC AND s.CU = t.TN JOIN alt a ON s.SC = a.SCID
WHERE s.SC = 6 AND s.DEL = 0 AND s.TG = '' AND s.CU > 0
ORDER BY a.ALTSC, s.CU, s.LN"""

SQL["group_symmetric_difference"] = _with(GROUPS) + """
(SELECT login_id FROM want EXCEPT SELECT login_id FROM have)
UNION ALL
(SELECT login_id FROM have EXCEPT SELECT login_id FROM want)"""

SQL["group_changes"] = _with(GROUPS) + """
SELECT login_id, 'ADD' AS op FROM (SELECT login_id FROM want EXCEPT SELECT login_id FROM have) a
UNION ALL
SELECT login_id, 'REMOVE' FROM (SELECT login_id FROM have EXCEPT SELECT login_id FROM want) r"""

FLAT_COLS = {
    "EventEnrollmentID": "e.event_id", "EnrollmentStatusCd": "f.status",
    "CreatedDate": "strftime(f.created, '%Y-%m-%d %H:%M:%S.%f')",
    "ScheduledEvent_EventCd": "f.course_code", "ScheduledEvent_Course_CourseName": "f.course_name",
    "ScheduledEvent_Course_IsOnline": "f.is_online", "pos": "f.pos_raw",
    "StudentID": "f.customer_id", "CustomerID": "f.customer_id", "Person_Email": "f.email",
    "Person_FirstName": "f.first_name", "Person_LastName": "f.last_name",
}


def _flat_select(drop) -> str:
    cols = [f"{expr} AS {name}" for name, expr in FLAT_COLS.items() if name not in drop]
    return _with(FEED_MIXED) + "SELECT " + ", ".join(cols) + "\nFROM feed f JOIN events e ON e.event_id = f.event_id"


SQL["keep_list"] = _flat_select({"pos"})
SQL["drop_list"] = _flat_select({"CreatedDate", "StudentID", "Person_LastName"})

SQL["zip_rows"] = _with(FEED_MIXED) + """
, rec AS (SELECT event_id, CASE WHEN event_type = 'error' THEN 'DROPPED' ELSE 'ENROLLED' END AS status,
                 row_number() OVER (ORDER BY event_id) AS row_no FROM events),
stud AS (SELECT event_id AS s_event_id, pos_raw AS s_pos, customer_id, email,
                row_number() OVER (ORDER BY event_id, pos_raw) AS row_no FROM feed WHERE pos_raw IS NOT NULL)
SELECT coalesce(a.row_no, b.row_no) AS row_no, a.event_id, a.status, b.s_event_id, b.s_pos, b.customer_id, b.email
FROM rec a FULL OUTER JOIN stud b ON a.row_no = b.row_no"""

SQL["zip_alignment"] = _with(FEED_MIXED) + """
, n AS (SELECT event_id, count(pos_raw) AS n_elements FROM feed GROUP BY event_id),
t AS (SELECT event_id, n_elements, row_number() OVER (ORDER BY event_id) AS row_no,
             coalesce(sum(n_elements) OVER (ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT
             AS elements_before FROM n)
SELECT *, elements_before <= row_no - 1 AND row_no - 1 < elements_before + n_elements AS aligned FROM t
WHERE n_elements <> 1 OR NOT (elements_before <= row_no - 1 AND row_no - 1 < elements_before + n_elements)"""

SQL["ledger_append"] = _with(FEED_ONE, WM, SKIP, DIRECTORY, IDENTITY, LEDGERS) + """
SELECT Email FROM ledger_intro
UNION ALL
SELECT email FROM cand WHERE NOT EXISTS (SELECT 1 FROM ledger_intro l WHERE lower(trim(l.Email)) = cand.e)"""


# ---------------------------------------------------- sources and sinks --

SQL["feed_from_json"] = SQL["feed_flatten"]
SQL["feed_from_array"] = SQL["feed_flatten"]

SQL["catalogue_from_json"] = """
SELECT CAST(p_partkey AS VARCHAR) AS CourseCd, p_name AS CourseName, p_size % 2 = 0 AS IsOnline, g.pos AS group_pos,
       CASE g.pos WHEN 0 THEN p_brand WHEN 1 THEN CAST(p_size AS VARCHAR) END AS GroupCd,
       CASE g.pos WHEN 0 THEN p_type WHEN 1 THEN p_name END AS GroupName
FROM part JOIN (VALUES (0, NULL::INTEGER), (1, 0), (2, 0), (2, 1)) g(n, pos) ON g.n = p_partkey % 3"""

SQL["feed_from_manifest"] = SQL["feed_since_watermark"]
SQL["identity_laid_out"] = SQL["identity_actions"]
SQL["catalogue_from_array"] = SQL["catalogue_from_json"]

SQL["recode_from_csv"] = SQL["recode_courses"]

SQL["ledger_file"] = SQL["ledger_append"]

SQL["messages_file"] = ("SELECT row_number() OVER (ORDER BY event_id, pos, kind, message) AS row_no, "
                        "event_id || ' ' || pos || ' ' || kind || ': ' || message AS line FROM (" + SQL["sync_messages"] + ") m")

SQL["watermark_state"] = """
SELECT CAST(floor(max(event_id) / 5) AS BIGINT) AS old_watermark, max(event_id) AS new_watermark FROM events"""

SQL["snapshots_read"] = _with(COURSES, DIRECTORY) + """
SELECT name, n, CAST(ids AS BIGINT) AS ids FROM (
SELECT 'accounts' AS name, count(*) AS n, sum(n_nationkey) AS ids FROM nation WHERE n_nationkey % 6 <> 5
UNION ALL SELECT 'content', count(*), sum(l_orderkey * 10 + l_linenumber) FROM lineitem
UNION ALL SELECT 'courses', count(*), sum(course_id) FROM courses
UNION ALL SELECT 'enrollments', count(*), sum(l_orderkey * 10 + l_linenumber) FROM lineitem
UNION ALL SELECT 'group_members', count(*), sum(o_orderkey) FROM orders
  WHERE o_orderstatus = 'O' OR (o_orderstatus = 'F' AND o_orderkey % 2 = 0)
UNION ALL SELECT 'logins', count(*), sum(user_id) FROM logins
UNION ALL SELECT 'roles', count(*), sum(id) FROM (SELECT min(p_partkey) AS id FROM part GROUP BY p_type) r
UNION ALL SELECT 'terms', count(*), sum(r_regionkey) FROM region
UNION ALL SELECT 'users', count(*), sum(id) FROM users) x"""

SQL["roster_state"] = _with(*SYNC_BASE) + """
, f AS (SELECT * FROM (
  SELECT account, course_code, action,
         row_number() OVER (PARTITION BY account, course_code ORDER BY event_id DESC, pos DESC) AS back
  FROM enroll) x WHERE back = 1),
st AS (SELECT account, sis_course_id AS course_code, max(id) AS last_id
       FROM (SELECT CAST(user_id AS VARCHAR) AS account, * FROM enr) y GROUP BY 1, 2)
SELECT coalesce(f.account, st.account) AS account, coalesce(f.course_code, st.course_code) AS course_code,
       CASE WHEN f.account IS NULL THEN st.last_id END AS last_id
FROM st FULL OUTER JOIN f ON f.account = st.account AND f.course_code = st.course_code
WHERE f.action IS NULL OR f.action = 'ENROLL'"""


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
