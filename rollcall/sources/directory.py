"""A directory laid out for lookups.

The lookups of identity resolution (login -> account, external id -> account)
and the enrollments by user are written once, bucketed and sorted by their key.
A job that joins a batch with them shuffles the batch's keys to the buckets:
the directory itself is neither shuffled nor aggregated again (Spark sorts each
bucket before the merge, on files that are in order already).

Bucketing is a property of a catalog table; ``open_directory`` registers the
files of a layout under names of its own in any session.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.operators.identity import directory

# table -> (bucketing key, columns)
LAYOUT = {
    "by_login": ("e", "e STRING, dir_e STRING"),
    "by_external_id": ("c", "c STRING, dir_c STRING, dir_login STRING"),
    "enrollments_by_user": ("user_id", "id BIGINT, course_id BIGINT, sis_course_id STRING, user_id BIGINT, type STRING, "
                                       "role STRING, role_id BIGINT, enrollment_state STRING"),
}


def _create(spark: SparkSession, name: str, path: str, buckets: int) -> str:
    key, columns = LAYOUT[name]
    table = f"rollcall_{name}_{uuid.uuid4().hex}"
    spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet CLUSTERED BY ({key}) SORTED BY ({key}) "
              f"INTO {buckets} BUCKETS LOCATION '{path}/{name}'")
    return table


def lay_out_directory(path: str, users: DataFrame, logins: DataFrame, enrollments: DataFrame | None = None,
                      buckets: int = 64) -> None:
    """Write the layout below ``path`` (which must not hold one yet)."""
    by_login, by_external_id = directory(users, logins)
    tables = {"by_login": by_login, "by_external_id": by_external_id}
    if enrollments is not None:
        tables["enrollments_by_user"] = enrollments
    spark = users.sparkSession
    for name, df in tables.items():
        key, _ = LAYOUT[name]
        table = _create(spark, name, path, buckets)
        # one file per bucket: dealt as the buckets are, then sorted in them
        columns = spark.table(table).columns
        df.select(*columns).repartition(buckets, key).sortWithinPartitions(key).write.insertInto(table)
        spark.sql(f"DROP TABLE {table}")      # the files stay


def open_directory(spark: SparkSession, path: str, buckets: int = 64) -> dict[str, DataFrame]:
    """The laid-out tables that exist below ``path``: ``by_login`` and
    ``by_external_id`` are ``sync_batch``'s ``lookups``."""
    from rollcall.sources.files import path_exists
    return {name: spark.table(_create(spark, name, path, buckets)) for name in LAYOUT
            if path_exists(spark, f"{path}/{name}")}


def roles_of_accounts(users: DataFrame, enrollments_by_user: DataFrame) -> DataFrame:
    """Enrollments of users (login, user_id) from the laid-out table."""
    return users.select("login", F.col("user_id").cast("long").alias("user_id")).join(
        enrollments_by_user, "user_id").select(
        "login", "user_id", F.col("id").alias("enrollment_id"), "sis_course_id", "role", "type")
