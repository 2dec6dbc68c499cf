"""Mapping CSVs, ledgers, the watermark state, and CSV export (S3, S4, S13,
K1, K2, K3)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rollcall.schemas import MAPPINGS, WATERMARK


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists in its file system; a denied or broken look-up
    raises."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def read_mapping(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """CSV with a header and an explicit schema.  Types are never inferred:
    an all-digit course code such as ``0042`` must stay text."""
    if isinstance(schema, str):
        schema = MAPPINGS[schema]
    return (spark.read.schema(schema).option("header", True)
            .option("mode", "FAILFAST").csv(path))


def read_watermark(spark: SparkSession, path: str | None) -> DataFrame:
    """One-row state table ``EventEnrollmentID``.  A missing or empty state
    starts from 0.  If several rows were appended, the largest wins."""
    if path is None:
        return spark.range(1).select(F.lit(0).cast("long").alias("EventEnrollmentID"))
    if path_exists(spark, path):  # any other failure to read the state is an error
        state = read_mapping(spark, path, WATERMARK)
    else:
        state = spark.createDataFrame([], WATERMARK)
    return state.agg(F.coalesce(F.max("EventEnrollmentID"), F.lit(0).cast("long"))
                     .alias("EventEnrollmentID"))


def write_watermark(watermark: DataFrame, path: str) -> None:
    """Overwrite the state with the new one-row watermark.  Callers write it
    last, after every change set, so a failed run is safely re-run."""
    (watermark.select("EventEnrollmentID").coalesce(1)
     .write.mode("overwrite").option("header", True).csv(path))


def append_ledger(rows: DataFrame, path: str, column: str = "Email") -> None:
    """Append sent addresses to a letter ledger."""
    rows.select(F.col(column).alias("Email")).write.mode("append").option("header", True).csv(path)


def export_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with header; partitions are written in parallel (no index column)."""
    df.write.mode(mode).option("header", True).csv(path)


def export_ordered(df: DataFrame, path: str, order_cols, column: str, files: int | None = None) -> None:
    """Text lines of ``column`` as numbered files that concatenate, in the
    order of their names, to ``order_cols`` order (A7, K1): ranges of the order
    are written in parallel, one file each.  The order should be total."""
    n = files or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col(c) if isinstance(c, str) else c for c in order_cols]
    (df.repartitionByRange(n, *order).sortWithinPartitions(*order)
     .select(F.col(column).cast("string").alias("value")).write.mode("overwrite").text(path))


def read_ordered(spark: SparkSession, path: str, column: str = "line") -> DataFrame:
    """Exported lines with ``file`` and ``at`` (byte block and row), which sort
    as the concatenated files do."""
    return spark.read.text(path).select(
        F.col("value").alias(column), F.col("_metadata.file_name").alias("file"),
        F.struct(F.col("_metadata.file_block_start").alias("block"),
                 F.monotonically_increasing_id().alias("row")).alias("at"))
