"""Stand-in inputs built from the driver's test tables.

These builders only give rows in the schemas the jobs expect (rollcall
.schemas); they do none of the jobs' work.  Values are derived with plain
column arithmetic, and rows and distinct keys grow with the tables:

feed        events: event_id = EventEnrollmentID, user_id = CustomerID,
            course code = props.k + 100 * (user_id div 150), so every 150 users
            bring 100 codes; event_type 'error' = DROPPED else ENROLLED,
            ts = CreatedDate; e-mail 'U<user_id>@x.org', that of the other
            user of the pair (2n, 2n + 1) on odd events, and the hot
            'U0@x.org' where event_id % 10 = 3
directory   customer by c_custkey % 3: 0 known by e-mail, 1 known by
            external id only, 2 unknown
roster      orders: person o_custkey, course o_orderkey % 100 +
            100 * (o_custkey div 150); status O active, P invited, F completed
skip list   distinct p_size of part where p_brand = 'Brand#2' and p_size <= 15
watermark   floor(max(event_id) / 5)
courses     supplier with s_suppkey % 10 <> 7; sub-accounts = nation (every
            sixth left out); terms = region
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.schemas import (
    ACCOUNTS, CATALOGUE, CONTENT, COURSES, ENROLLMENTS, FEED, LOGINS, ROLES, TERMS, USERS,
)


class Tables:
    """Lazy parquet tables of one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir.rstrip("/")
        self._cache: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._cache:
            self._cache[name] = self.spark.read.parquet(f"{self.dir}/{name}.parquet")
        return self._cache[name]


def _conform(df: DataFrame, schema) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def feed_email(user_id, event_id):
    pair = user_id + (event_id % 2) * (F.lit(1) - F.lit(2) * (user_id % 2))
    who = F.when(event_id % 10 == 3, F.lit(0)).otherwise(pair)
    return F.when(user_id.isNotNull(), F.concat(F.lit("U"), who.cast("string"), F.lit("@x.org")))


def course_code(number, person):
    """Course code: ``number`` (0-99) in the block of 100 codes that 150
    people share."""
    return (number + F.lit(100) * F.floor(person / 150)).cast("string")


def _student(uid, eid):
    return F.struct(
        uid.cast("string").alias("StudentID"),
        uid.cast("string").alias("CustomerID"),
        F.struct(feed_email(uid, eid).alias("Email"),
                 F.concat(F.lit("F"), uid.cast("string")).alias("FirstName"),
                 F.concat(F.lit("L"), uid.cast("string")).alias("LastName")).alias("Person"))


def feed(t: Tables, students: str = "one") -> DataFrame:
    """Nested enrollment feed from ``events``.  ``students="one"``: one
    student per record.  ``students="mixed"``: records with event_id % 20 = 0
    carry no student and with event_id % 20 = 1 two (the second is
    customer user_id + 1)."""
    ev = t.events
    uid, eid = F.col("user_id"), F.col("event_id")
    code = course_code(F.get_json_object(F.col("props"), "$.k").cast("long"), uid)
    one = F.array(_student(uid, eid))
    if students == "mixed":
        studs = (F.when(eid % 20 == 0, F.array_remove(F.array(F.lit(None).cast(FEED["Students"].dataType.elementType)), None))
                 .when(eid % 20 == 1, F.array(_student(uid, eid), _student(uid + 1, eid)))
                 .otherwise(one))
    else:
        studs = one
    out = ev.select(
        eid.alias("EventEnrollmentID"),
        F.when(F.col("event_type") == "error", F.lit("DROPPED")).otherwise(F.lit("ENROLLED"))
        .alias("EnrollmentStatusCd"),
        F.col("ts").cast("timestamp").alias("CreatedDate"),
        F.struct(code.alias("EventCd"),
                 F.struct(F.concat(F.lit("Course "), code).alias("CourseName"),
                          (F.col("event_type") == "purchase").alias("IsOnline")).alias("Course"))
        .alias("ScheduledEvent"),
        studs.alias("Students"))
    return _conform(out, FEED)


def users(t: Tables) -> DataFrame:
    c = t.customer.where(F.col("c_custkey") % 3 != 2)
    k = F.col("c_custkey")
    login = F.when(k % 3 == 0, F.concat(F.lit("U"), k.cast("string"), F.lit("@x.org"))) \
             .otherwise(F.concat(F.lit("old"), k.cast("string"), F.lit("@y.org")))
    out = c.select(k.alias("id"), F.col("c_name").alias("name"), F.col("c_name").alias("short_name"),
                   F.col("c_name").alias("sortable_name"), login.alias("login_id"),
                   k.cast("string").alias("sis_user_id"), F.lit(None).cast("string").alias("last_login"),
                   login.alias("primary_email"))
    return _conform(out, USERS)


def logins(t: Tables) -> DataFrame:
    """Every login of a directory user: the primary, plus a second login
    for every fifth user."""
    u = users(t)
    extra = u.where(F.col("id") % 5 == 0).select(
        F.col("id").alias("user_id"),
        F.concat(F.lit("alt"), F.col("id").cast("string"), F.lit("@x.org")).alias("unique_id"))
    out = u.select(F.col("id").alias("user_id"), F.col("login_id").alias("unique_id")).unionByName(extra)
    return _conform(out, LOGINS)


def skip_list(t: Tables) -> DataFrame:
    return (t.part.where((F.col("p_brand") == "Brand#2") & (F.col("p_size") <= 15))
            .select(F.col("p_size").cast("string").alias("CourseCode")).distinct())


def allow_list(t: Tables) -> DataFrame:
    """Allow list: the course codes of part sizes of brand 'Brand#3'."""
    return (t.part.where(F.col("p_brand") == "Brand#3")
            .select(F.col("p_size").cast("string").alias("CourseCode")).distinct())


def watermark(t: Tables) -> DataFrame:
    return t.events.agg(F.floor(F.max("event_id") / 5).cast("long").alias("EventEnrollmentID"))


def watermark_value(t: Tables) -> int:
    """The stand-in watermark as a number (a one-row state read on the
    driver, so the filter is a literal that reaches the parquet scan)."""
    return int(watermark(t).first()[0])


def terms(t: Tables) -> DataFrame:
    r = t.region
    out = r.select(F.col("r_regionkey").cast("long").alias("enrollment_term_id"),
                   F.concat(F.lit("T"), F.col("r_regionkey").cast("string")).alias("sis_term_id"),
                   F.col("r_name").alias("enrollment_name"))
    return _conform(out, TERMS)


def term_calendar(t: Tables) -> DataFrame:
    """Terms from ``orders``: one per month of o_orderdate, id yyyymm, named
    by the month alone — so every year repeats each name."""
    d = F.col("o_orderdate")
    m = t.orders.select((F.year(d) * 100 + F.month(d)).cast("long").alias("enrollment_term_id"),
                        F.date_format(d, "MMMM").alias("enrollment_name")).distinct()
    out = m.select("enrollment_term_id",
                   F.concat(F.lit("T"), F.col("enrollment_term_id").cast("string")).alias("sis_term_id"),
                   "enrollment_name")
    return _conform(out, TERMS)


def accounts(t: Tables) -> DataFrame:
    n = t.nation.where(F.col("n_nationkey") % 6 != 5)
    out = n.select(F.col("n_nationkey").cast("long").alias("account_id"),
                   F.col("n_name").alias("subaccount_name"))
    return _conform(out, ACCOUNTS)


def courses(t: Tables) -> DataFrame:
    s = t.supplier.where(F.col("s_suppkey") % 10 != 7)
    s = s.join(t.nation.select("n_nationkey", "n_regionkey"), s["s_nationkey"] == F.col("n_nationkey"))
    k = F.col("s_suppkey")
    out = s.select(
        k.alias("course_id"), k.cast("string").alias("sis_course_id"),
        F.concat(F.lit("Course "), k.cast("string")).alias("name"),
        k.cast("string").alias("course_code"), F.col("s_nationkey").alias("account_id"),
        F.col("n_regionkey").alias("enrollment_term_id"),
        F.lit(None).cast("long").alias("total_students"),
        F.lit("available").alias("workflow_state"),
        F.lit(False).alias("restrict_student_future_view"),
        F.struct(F.concat(F.lit("T"), F.col("n_regionkey").cast("string")).alias("sis_term_id")).alias("term"))
    return _conform(out, COURSES)


def staff_enrollments(t: Tables) -> DataFrame:
    """Enrollments from ``lineitem``: course = supplier key of the line
    (so courses exist), person = l_partkey, role by l_returnflag; state
    'active' unless the line status is 'F' ('completed')."""
    li = t.lineitem
    typ = (F.when(F.col("l_returnflag") == "A", F.lit("TeacherEnrollment"))
           .when(F.col("l_returnflag") == "R", F.lit("TaEnrollment"))
           .otherwise(F.lit("StudentEnrollment")))
    role = F.regexp_replace(typ, "Enrollment$", "")
    out = li.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
        F.col("l_suppkey").alias("course_id"),
        F.col("l_suppkey").cast("string").alias("sis_course_id"),
        F.col("l_partkey").alias("user_id"),
        typ.alias("type"), role.alias("role"),
        F.when(typ == "TaEnrollment", F.when(F.col("l_linenumber") == 1, F.lit(16))).cast("long").alias("role_id"),
        F.when(F.col("l_linestatus") == "F", F.lit("completed")).otherwise(F.lit("active")).alias("enrollment_state"))
    return _conform(out, ENROLLMENTS)


def student_enrollments(t: Tables) -> DataFrame:
    """Prior student roster for the sync: one enrollment per order, person =
    o_custkey, state by o_orderstatus."""
    code = course_code(F.col("o_orderkey") % 100, F.col("o_custkey"))
    state = (F.when(F.col("o_orderstatus") == "O", F.lit("active"))
             .when(F.col("o_orderstatus") == "P", F.lit("invited")).otherwise(F.lit("completed")))
    out = t.orders.select(
                   F.col("o_orderkey").alias("id"), code.cast("long").alias("course_id"),
                   code.alias("sis_course_id"),
                   F.col("o_custkey").alias("user_id"), F.lit("StudentEnrollment").alias("type"),
                   F.lit("StudentEnrollment").alias("role"), F.lit(None).cast("long").alias("role_id"),
                   state.alias("enrollment_state"))
    return _conform(out, ENROLLMENTS)


def no_enrollments(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], ENROLLMENTS)


def ledger_intro(t: Tables) -> DataFrame:
    k = F.col("c_custkey")
    return (t.customer.where(k % 7 == 0)
            .select(F.concat(F.lit("u"), k.cast("string"), F.lit("@x.org")).alias("Email")))


def ledger_covid(t: Tables) -> DataFrame:
    k = F.col("c_custkey")
    return (t.customer.where(k % 7 == 1)
            .select(F.concat(F.lit("AU"), k.cast("string"), F.lit("@x.org")).alias("Email")))


def roles(t: Tables) -> DataFrame:
    """Account roles: one per part type (id = its smallest part key)."""
    p = t.part.groupBy("p_type").agg(F.min("p_partkey").alias("id"))
    out = p.select("id", F.col("p_type").alias("label"),
                   F.concat(F.col("p_type"), F.lit("Enrollment")).alias("role"),
                   F.lit("StudentEnrollment").alias("base_role_type"))
    return _conform(out, ROLES)


# ------------------------------------------------------------ staff side --

def staff_users(t: Tables) -> DataFrame:
    """LMS staff directory from ``part``: login 'staff<p_partkey>@x.org'."""
    k = F.col("p_partkey")
    login = F.concat(F.lit("staff"), k.cast("string"), F.lit("@x.org"))
    out = t.part.select(k.alias("id"), F.col("p_name").alias("name"), F.col("p_name").alias("short_name"),
                        F.col("p_name").alias("sortable_name"), login.alias("login_id"),
                        F.concat(F.lit("S"), k.cast("string")).alias("sis_user_id"),
                        F.lit(None).cast("string").alias("last_login"), login.alias("primary_email"))
    return _conform(out, USERS)


def staff_logins(t: Tables) -> DataFrame:
    u = staff_users(t)
    return _conform(u.select(F.col("id").alias("user_id"), F.col("login_id").alias("unique_id")), LOGINS)


def content(t: Tables) -> DataFrame:
    """Course content items from ``lineitem`` (course = l_suppkey)."""
    li = t.lineitem
    out = li.select(F.col("l_suppkey").alias("course_id"),
                    (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("item_id"),
                    F.concat(F.col("l_returnflag"), F.col("l_linestatus"),
                             F.col("l_linenumber").cast("string")).alias("body"))
    return _conform(out, CONTENT)


def users_with_last_login(t: Tables) -> DataFrame:
    """Directory users whose last login is the latest event of the customer,
    written as ISO text with offset 'Z', '-07:00' or '-0700' (by id % 3)."""
    last = t.events.groupBy("user_id").agg(F.max("ts").alias("_ts"))
    u = users(t).drop("last_login").join(last, F.col("id") == F.col("user_id"), "left")
    off = (F.when(F.col("id") % 3 == 0, F.lit("Z")).when(F.col("id") % 3 == 1, F.lit("-07:00"))
           .otherwise(F.lit("-0700")))
    text = F.concat(F.date_format(F.col("_ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss"), off)
    return _conform(u.withColumn("last_login", text), USERS)


def duplicate_request(t: Tables) -> DataFrame:
    """Course duplication requests from ``supplier``: source = the supplier's
    course; target = the next course for every third supplier (mostly
    existing), else a new code."""
    k = F.col("s_suppkey")
    new = F.when(k % 3 == 0, (k + 1).cast("string")).otherwise(F.concat(F.lit("NEW-"), k.cast("string")))
    return t.supplier.select(new.alias("NewSIS_ID"), k.cast("string").alias("CurrentSIS_ID"),
                             F.concat(F.lit("Copy of "), F.col("s_name")).alias("CourseName"))


def template_request(t: Tables) -> DataFrame:
    k = F.col("s_suppkey")
    new = F.when(k % 3 == 0, (k + 1).cast("string")).otherwise(F.concat(F.lit("NEW-"), k.cast("string")))
    return t.supplier.select(
        F.concat(F.lit("Class "), F.col("s_name")).alias("CourseName"), new.alias("NewSIS_ID"),
        F.concat(F.lit("STAFF"), (k * 3).cast("string"), F.lit("@x.org")).alias("Email"),
        k.cast("string").alias("Template"), F.col("s_nationkey").cast("string").alias("SubAccount"))


def class_request(t: Tables) -> DataFrame:
    r = template_request(t)
    return r.select(F.col("Email").alias("EMAIL"), "CourseName", F.col("NewSIS_ID").alias("COURSECODE"),
                    F.col("Template").alias("TEMPLATE"))


def copy_request(t: Tables) -> DataFrame:
    """Content copy pairs: every supplier's course into the next one."""
    k = F.col("s_suppkey")
    return (t.supplier
            .select((k + 1).cast("string").alias("NewSIS_ID"), k.cast("string").alias("CurrentSIS_ID"),
                    F.col("s_nationkey").cast("string").alias("SubAccount")))


def roster_pairs(t: Tables) -> DataFrame:
    k = F.col("s_suppkey")
    return t.supplier.select(k.cast("string").alias("from_sis"), (k + 2).cast("string").alias("to_sis"))


# Grant kinds of the stand-in requests, by s_suppkey % 3.
def grant_requests(t: Tables) -> DataFrame:
    k = F.col("s_suppkey")
    kind = F.when(k % 3 == 0, F.lit("teacher")).when(k % 3 == 1, F.lit("ta")).otherwise(F.lit("transition"))
    return t.supplier.select(F.concat(F.lit("staff"), (k * 2).cast("string"), F.lit("@x.org")).alias("login"),
                             k.cast("string").alias("course_sis"), kind.alias("kind"))


def term_grant_requests(t: Tables) -> DataFrame:
    r = F.col("r_regionkey")
    return t.region.select(F.concat(F.lit("staff"), r.cast("string"), F.lit("@x.org")).alias("login"),
                           F.concat(F.lit("T"), r.cast("string")).alias("sis_term_id"),
                           F.lit("transition").alias("kind"))


def revoke_requests(t: Tables) -> DataFrame:
    """Per term, revoke the teacher whose part key is 7 times the region key."""
    r = F.col("r_regionkey")
    return t.region.select((r * 7).cast("long").alias("user_id"),
                           F.concat(F.lit("T"), r.cast("string")).alias("sis_term_id"))


def rename_map(t: Tables) -> DataFrame:
    """Rename map from ``part``: two parts name the course id p_partkey div 2,
    the later row (larger p_partkey) wins."""
    k = F.col("p_partkey")
    return t.part.select(F.floor(k / 2).alias("id"), F.concat(F.lit("NS-"), k.cast("string")).alias("NewShortName"),
                         F.concat(F.upper(F.col("p_name")), F.lit(" v"), k.cast("string")).alias("New name"),
                         k.alias("_row"))


def recode_map(t: Tables) -> DataFrame:
    """Recode map from ``part``: three parts name the code p_partkey div 3."""
    k = F.col("p_partkey")
    return t.part.select(F.floor(k / 3).cast("string").alias("currentcoursecode"),
                         F.concat(F.lit("R"), k.cast("string")).alias("coursecodenew"), k.alias("_row"))


def catalogue(t: Tables) -> DataFrame:
    """Course catalogue from ``part``: p_partkey % 3 course groups (none, one
    or two) per course."""
    k = F.col("p_partkey")
    group = lambda cd, name: F.struct(cd.alias("GroupCd"), name.alias("GroupName"))
    both = F.array(group(F.col("p_brand"), F.col("p_type")), group(F.col("p_size").cast("string"), F.col("p_name")))
    return _conform(t.part.select(k.cast("string").alias("CourseCd"), F.col("p_name").alias("CourseName"),
                                  (F.col("p_size") % 2 == 0).alias("IsOnline"),
                                  F.slice(both, 1, (k % 3).cast("int")).alias("CourseGroups")), CATALOGUE)


def role_logins(t: Tables) -> DataFrame:
    return t.supplier.select(F.concat(F.lit("STAFF"), F.col("s_suppkey").cast("string"),
                                      F.lit("@x.org")).alias("login"))


# ------------------------------------------------------ school database --

def school_tables(t: Tables) -> dict[str, DataFrame]:
    """STU from customer, TCH from supplier, ALTSCH from nation.  A teacher
    number is unique within its school (the supplier's rank in its nation),
    as a teacher key is; a student's counselor number is c_custkey % 6
    (0 = none)."""
    from pyspark.sql import Window
    c, k = t.customer, F.col("c_custkey")
    stu = c.select(F.col("c_nationkey").alias("SC"), F.col("c_name").alias("LN"),
                   F.concat(F.lit("c"), k.cast("string"), F.lit("@x.org")).alias("SEM"),
                   (F.lit(9) + k % 4).cast("int").alias("GR"), (k % 6).cast("int").alias("CU"),
                   F.when(F.col("c_acctbal") < 0, F.lit(1)).otherwise(F.lit(0)).alias("DEL"),
                   F.when(F.col("c_mktsegment") == "AUTOMOBILE", F.lit("X")).otherwise(F.lit("")).alias("TG"))
    s = F.col("s_suppkey")
    rank = F.row_number().over(Window.partitionBy("s_nationkey").orderBy("s_suppkey"))
    tch = t.supplier.select(F.col("s_nationkey").alias("SC"), rank.cast("int").alias("TN"),
                            F.concat(F.lit("t"), s.cast("string"), F.lit("@x.org")).alias("EM"))
    alt = t.nation.select(F.col("n_nationkey").alias("SCID"), F.col("n_name").alias("ALTSC"))
    return {"STU": stu, "TCH": tch, "ALTSCH": alt}


def group_lists(t: Tables) -> tuple[DataFrame, DataFrame]:
    """(wanted logins, group members) from ``orders``, one login per customer
    and order priority: wanted by orders in status 'P' or 'F', members by
    orders in status 'O' or 'F' with an even order key."""
    even = F.col("o_orderkey") % 2 == 0
    status = F.col("o_orderstatus")
    login = F.concat(F.lit("c"), F.col("o_custkey").cast("string"), F.lit("."),
                     F.substring("o_orderpriority", 1, 1), F.lit("@x.org")).alias("login_id")
    want = t.orders.where((status == "P") | (status == "F")).select(login)
    have = t.orders.where((status == "O") | ((status == "F") & even)).select(
        F.col("o_orderkey").alias("id"), F.lit(None).cast("string").alias("name"), login)
    return want, have
