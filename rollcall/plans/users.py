"""User report (D17): last login per user."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.functions import NO_LAST_LOGIN, parse_iso, utc_text


def last_login_report(users: DataFrame, as_of=None, inactive_days: int | None = None) -> DataFrame:
    """login_id, sis_user_id, the last login as text, the parsed time as
    'yyyy-MM-dd HH:mm:ss' in UTC or 'no last login', and —
    with ``as_of`` and ``inactive_days`` — whether the user is inactive (no
    login, or none within the last ``inactive_days`` days).  Malformed text
    parses to null and is reported as such (``parse_error``)."""
    ts = parse_iso("last_login")
    out = users.select(
        "id", "login_id", "sis_user_id", "last_login",
        F.coalesce(utc_text(ts), F.lit(NO_LAST_LOGIN)).alias("last_login_at"),
        (F.col("last_login").isNotNull() & ts.isNull()).alias("parse_error"))
    if inactive_days is not None and as_of is not None:
        cutoff = F.date_sub(F.to_date(F.lit(as_of) if isinstance(as_of, str) else as_of), inactive_days)
        out = out.withColumn("inactive", ts.isNull() | (F.to_date(utc_text(ts)) < cutoff))
    return out
