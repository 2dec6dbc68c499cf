"""A letter ledger with a kept n-gram index.

The regex test of a ledger needs the entries that hold some text.  The index
keeps, for every entry, its n-grams of the lengths ``GRAMS``, dealt by a hash of
the gram to bucket folders; an append cuts only the new entries, and a run
opens only the buckets of the grams it asks for.  Entries and grams of an
append are committed together (``sources.commits``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.operators.letters import GRAMS, grams_of
from rollcall.sources.commits import CommitLog, list_names

ENTRIES = "sent string"
INDEX = "gram string, sent string"


class LedgerIndex:
    """The ledger below ``path``."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64):
        self.spark, self.log = spark, CommitLog(spark, path)
        self.buckets = self.log.latest().get("buckets", buckets)

    def _bucket(self):
        return F.pmod(F.xxhash64("gram"), F.lit(self.buckets)).cast("int")

    def append(self, ledger: DataFrame, column: str = "Email") -> int:
        """Add sent addresses and their n-grams; returns the version."""
        entry = self.log.latest()
        version = entry["version"] + 1
        attempt = self.log.attempt(version)
        sent = ledger.select(F.col(column).alias("sent")).where(F.col("sent").isNotNull()).distinct()
        sent.write.parquet(f"{self.log.dir}/entries/data/{attempt}")
        written = self.spark.read.schema(ENTRIES).parquet(f"{self.log.dir}/entries/data/{attempt}")
        cut = written.select(F.explode(F.array_distinct(F.concat(*[grams_of(F.col("sent"), n) for n in GRAMS])))
                             .alias("gram"), "sent")
        (cut.withColumn("bucket", self._bucket()).repartition("bucket").sortWithinPartitions("bucket", "gram")
         .write.partitionBy("bucket").parquet(f"{self.log.dir}/grams/data/{attempt}"))
        folders = [f"grams/data/{attempt}/{n}" for n in list_names(self.spark, f"{self.log.dir}/grams/data/{attempt}")
                   if n.startswith("bucket=")]
        tables = {"entries": [*entry["tables"].get("entries", []), f"entries/data/{attempt}"],
                  "grams": [*entry["tables"].get("grams", []), *folders]}
        self.log.commit({"version": version, "tables": tables, "buckets": self.buckets})
        return version

    def entries(self) -> DataFrame:
        """Every sent address."""
        return self.log.table("entries", ENTRIES).distinct()

    def holding(self, grams: DataFrame) -> DataFrame:
        """(gram, sent) of the asked grams (a column ``gram``): only their
        buckets are opened."""
        asked = {r[0] for r in grams.select(self._bucket()).distinct().collect()}    # at most ``buckets``
        entry = self.log.latest()
        folders = [f for f in entry["tables"].get("grams", []) if int(f.rsplit("bucket=", 1)[1]) in asked]
        return self.log.table("grams", INDEX, {"tables": {"grams": folders}}).join(
            grams.select("gram").distinct(), "gram", "left_semi").distinct()
