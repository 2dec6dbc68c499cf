"""LMS snapshot tables (S6-S12) and the school database.

Snapshots are exported tables (parquet or a catalog table); the jobs only
ever see DataFrames, so the format is the caller's choice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rollcall.schemas import SNAPSHOTS


def read_snapshot(spark: SparkSession, name: str, path: str | None = None,
                  fmt: str = "parquet") -> DataFrame:
    """Read snapshot ``name`` (courses, accounts, terms, users, logins,
    enrollments, roles, group_members, content).  With no path the catalog
    table of that name is used.  The declared columns are selected so the
    scan reads only those."""
    schema = SNAPSHOTS[name]
    df = spark.table(name) if path is None else spark.read.format(fmt).load(path)
    return df.select(*[df[f.name].cast(f.dataType).alias(f.name) for f in schema.fields])


def read_students(spark: SparkSession, url: str, properties: dict | None = None,
                  tables=("STU", "TCH", "ALTSCH")) -> dict[str, DataFrame]:
    """The three school-database tables over JDBC.  Filters and column
    pruning in the caller's plan are pushed into the database query."""
    props = dict(properties or {})
    return {t: spark.read.jdbc(url, t, properties=props) for t in tables}
