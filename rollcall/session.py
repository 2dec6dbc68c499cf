"""Session construction and lineage cutting.

On a cluster the session is created by the platform; ``get_session`` only
builds one for local runs and tests.  ``materialize`` cuts lineage with a
table written to the shared folder named by ``spark.checkpoint.dir`` (never a
local checkpoint: executors can be lost at any time).
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the jobs rely on.  AQE re-plans joins from runtime sizes (so a
# side is only broadcast after Spark has measured it) and splits skewed
# shuffle partitions of sort-merge joins.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str = "local[8]", shuffle_partitions: int = 8,
                app_name: str = "rollcall", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = "16g"
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def scale_conf(input_bytes: int, executors: int, cores_per_executor: int = 4,
               target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Settings for a cluster run sized from the input: scan splits and
    shuffle partitions of about ``target_partition_bytes`` (so one task's
    share fits executor memory and spills rarely), at least two waves of
    tasks, AQE coalescing towards the same size, and skew splitting for
    partitions five times the median or 1 GiB.  E.g. 100 TB on 1000
    executors x 4 cores -> ~373k shuffle partitions of ~256 MiB.  Apply with
    ``SparkSession.builder.config(map=scale_conf(...))`` or ``spark.conf.set``."""
    slots = executors * cores_per_executor
    partitions = max(2 * slots, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(1 << 30),
        # broadcast only what AQE measured to be small
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
    }


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint folder the cluster names, if any."""
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if conf_dir:
        return conf_dir
    return spark.sparkContext.getCheckpointDir()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's checkpoint folder (``spark.checkpoint.dir``).  Only
    a local-mode session without one (tests, local runs) gets a fresh scratch
    folder; on a cluster a machine-local folder would be wrong, so a missing
    setting is an error there."""
    d = checkpoint_dir(spark)
    if d:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(d)
        return d
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    d = tempfile.mkdtemp(prefix="rollcall-ckpt-")
    spark.sparkContext.setCheckpointDir(d)
    return d


def materialize(df: DataFrame, path: str | None = None) -> DataFrame:
    """Write ``df`` once as Parquet and read it back: its lineage is cut, so a
    lost executor costs unfinished tasks only, and later plans know its size.
    By default the table goes to the shared checkpoint folder and is removed
    when the driver's JVM ends; a caller that names ``path`` removes it."""
    spark = df.sparkSession
    if path is None:
        path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/kept-{uuid.uuid4().hex}"
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(p)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
