"""Group reconciliation (D4): students of the counselors from the school
database (J3 P14 O1) against the members of an LMS group (U2 U3)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.operators.sets import directed_difference, symmetric_difference


def students_of_counselors(stu: DataFrame, tch: DataFrame, altsch: DataFrame,
                           school: int) -> DataFrame:
    """Students of one school that are not deleted, carry no tag and have a
    counselor, with the counselor's e-mail and the alternate school name,
    ordered by alternate school, counselor and last name.

    STU(SC, LN, SEM, GR, CU, DEL, TG) ⋈ TCH(SC, TN, EM) on SC and CU = TN
    ⋈ ALTSCH(SCID, ALTSC) on SC = SCID."""
    s = stu.where((F.col("SC") == school) & (F.col("DEL") == 0) & (F.col("TG") == "") & (F.col("CU") > 0))
    t = tch.select(F.col("SC").alias("_tsc"), "TN", "EM")
    a = altsch.select("SCID", "ALTSC")
    j = (s.join(t, (s["SC"] == t["_tsc"]) & (s["CU"] == t["TN"]))
          .join(a, s["SC"] == a["SCID"]))
    return j.select("ALTSC", "LN", "SEM", "GR", "CU", "EM").orderBy("ALTSC", "CU", "LN")


def member_logins(members: DataFrame, column: str = "login_id") -> DataFrame:
    return members.select(F.col(column).alias("login_id"))


def group_difference(want: DataFrame, have: DataFrame) -> DataFrame:
    """Logins in exactly one of the two lists (U2, set semantics)."""
    return symmetric_difference(want.select("login_id"), have.select("login_id"))


def group_changes(want: DataFrame, have: DataFrame) -> DataFrame:
    """ADD the wanted logins missing from the group, REMOVE the members not
    wanted (U3)."""
    return directed_difference(want.select("login_id"), have.select("login_id"))
