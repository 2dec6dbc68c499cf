"""Nested JSON documents: the enrollment feed (S1) and the course catalogue.

The feed service returns a JSON array; landed files are read with a fixed
schema, so no schema is inferred and course codes stay text.  Array files are
split across tasks (``sources.json_array``), JSON Lines by the reader itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.schemas import CATALOGUE, FEED
from rollcall.sources.json_array import read_json_array


def read_feed(spark: SparkSession, path: str | list[str], multiline: bool = True) -> DataFrame:
    """The nested feed of array files, or of JSON Lines with ``multiline=False``."""
    return read_json_array(spark, path, FEED) if multiline else spark.read.schema(FEED).json(path)


def read_feed_stream(spark: SparkSession, path: str, multiline: bool = True,
                     max_files_per_trigger: int | None = None) -> DataFrame:
    """The feed as a stream of records, an array file read by one task."""
    reader = spark.readStream.schema(FEED).option("multiLine", multiline)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.json(path)


def feed_file_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """The landed files themselves as a stream (``path`` of each; contents
    aren't read), for a micro-batch that reads them with ``read_feed``."""
    reader = spark.readStream.format("binaryFile").schema(
        "path string, modificationTime timestamp, length long, content binary")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path).select("path")


ID_BLOCK = 1_000_000


def land_feed(feed: DataFrame, path: str, block: int = ID_BLOCK, mode: str = "append") -> None:
    """Land a parsed feed as parquet, partitioned by ``id_block`` =
    EventEnrollmentID // ``block`` and sorted by id inside each file.  JSON
    is parsed anew by every reader; the landed table is read with the watermark pruning whole partitions (directory
    level) and row groups (min/max statistics)."""
    (feed.withColumn("id_block", F.floor(F.col("EventEnrollmentID") / F.lit(block)).cast("long"))
     .repartition("id_block").sortWithinPartitions("EventEnrollmentID")
     .write.mode(mode).partitionBy("id_block").parquet(path))


def read_landed_feed(spark: SparkSession, path: str, watermark: int | None = None,
                     block: int = ID_BLOCK) -> DataFrame:
    """The landed feed in the FEED schema; with ``watermark`` only the
    partitions that can hold later ids are listed and read."""
    df = spark.read.parquet(path)
    if watermark is not None:
        df = df.where((F.col("id_block") >= F.lit(int(watermark) // block))
                      & (F.col("EventEnrollmentID") > F.lit(int(watermark))))
    return df.select(*[F.col(f.name) for f in FEED.fields])


def read_catalogue(spark: SparkSession, path: str | list[str], multiline: bool = True) -> DataFrame:
    return read_json_array(spark, path, CATALOGUE) if multiline else spark.read.schema(CATALOGUE).json(path)
