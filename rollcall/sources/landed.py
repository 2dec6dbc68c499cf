"""Landed feed files with a manifest.

Each landing writes its files into a folder of its own and commits, in the
feed's log (``sources.commits``), a manifest with a row per file: its rows, its
smallest and largest ``EventEnrollmentID`` and ``CreatedDate``.  A reader asks the
manifest first: only files that can hold rows past the watermark, and inside
the date window, are opened or even listed.  Rows that arrive below the
watermark are counted from the files landed since the last run, not from the
history.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.operators.feed import date_window
from rollcall.schemas import FEED
from rollcall.sources.commits import CommitLog

MANIFEST = ("file string, version long, n_rows long, min_id long, max_id long, min_created timestamp, "
            "max_created timestamp")


class LandedFeed:
    """The landed feed below ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.log = spark, CommitLog(spark, path)

    def land(self, feed: DataFrame, files: int | None = None) -> int:
        """Write a parsed feed as Parquet, files holding ranges of ids, and
        commit it with its manifest; returns the version."""
        entry = self.log.latest()
        version = entry["version"] + 1
        attempt = self.log.attempt(version)
        n = files or int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        (feed.select(*[f.name for f in FEED.fields]).repartitionByRange(n, "EventEnrollmentID")
         .sortWithinPartitions("EventEnrollmentID").write.parquet(f"{self.log.dir}/data/landed/{attempt}"))
        written = self.spark.read.schema(FEED).parquet(f"{self.log.dir}/data/landed/{attempt}")
        facts = written.groupBy(F.col("_metadata.file_name").alias("name")).agg(
            F.count(F.lit(1)).alias("n_rows"), F.min("EventEnrollmentID").alias("min_id"),
            F.max("EventEnrollmentID").alias("max_id"), F.min("CreatedDate").alias("min_created"),
            F.max("CreatedDate").alias("max_created"))
        facts.select(F.concat(F.lit(f"data/landed/{attempt}/"), "name").alias("file"),
                     F.lit(version).cast("long").alias("version"), "n_rows", "min_id", "max_id", "min_created",
                     "max_created").coalesce(1).write.parquet(f"{self.log.dir}/manifest/landed/{attempt}")
        folder = f"manifest/landed/{attempt}"
        tables = {"manifest": [*entry["tables"].get("manifest", []), folder],
                  "data": [*entry["tables"].get("data", []), f"data/landed/{attempt}"]}
        self.log.commit({"version": version, "tables": tables})
        return version

    def manifest(self) -> DataFrame:
        return self.log.table("manifest", MANIFEST)

    def _open(self, files: DataFrame) -> DataFrame:
        """The rows of the files that a selection of the manifest names."""
        names = [f"{self.log.dir}/{r.file}" for r in files.select("file").collect()]
        return self.spark.read.schema(FEED).parquet(*names) if names else self.spark.createDataFrame([], FEED)

    def read(self, watermark: int | None = None, as_of=None, days_back: int = 7, days_ahead: int = 112) -> DataFrame:
        """The nested feed past the watermark and, with ``as_of`` (a date as
        text), created in its window.  Files the manifest rules out aren't
        listed."""
        files, rows = self.manifest(), []
        if watermark is not None:
            files = files.where(F.col("max_id") > F.lit(int(watermark)))
            rows.append(F.col("EventEnrollmentID") > F.lit(int(watermark)))
        if as_of is not None:
            lo = F.date_sub(F.lit(as_of).cast("date"), days_back).cast("timestamp")
            hi = F.date_add(F.lit(as_of).cast("date"), days_ahead + 1).cast("timestamp")
            files = files.where((F.col("max_created") >= lo) & (F.col("min_created") < hi))
        feed = self._open(files)
        for keep in rows:
            feed = feed.where(keep)
        if as_of is not None:
            feed = date_window(feed, F.lit(as_of).cast("date"), "CreatedDate", days_back, days_ahead)
        return feed

    def late(self, watermark: int, since_version: int) -> DataFrame:
        """Records at or below the watermark among files landed after
        ``since_version`` (the version the last run had read)."""
        fresh = self.manifest().where(F.col("version") > since_version)
        return self._open(fresh.where(F.col("min_id") <= F.lit(int(watermark)))).where(
            F.col("EventEnrollmentID") <= F.lit(int(watermark)))

    def count_late(self, watermark: int, since_version: int) -> int:
        """Number of late records; files wholly below the watermark are counted
        by the manifest alone."""
        fresh = self.manifest().where(F.col("version") > since_version)
        whole = fresh.where(F.col("max_id") <= F.lit(int(watermark))).agg(F.sum("n_rows")).first()[0] or 0
        cut = self._open(fresh.where((F.col("min_id") <= F.lit(int(watermark)))
                                     & (F.col("max_id") > F.lit(int(watermark)))))
        return whole + cut.where(F.col("EventEnrollmentID") <= F.lit(int(watermark))).count()
