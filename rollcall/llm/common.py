"""Shared plumbing of the corpus operators: table access, shared-folder
stashes, text keys and Arrow batch handling.

A *stash* is an intermediate table written as Parquet below the shared folder
that the cluster names in ``spark.checkpoint.dir``.  It cuts the lineage, so
that a lost executor only costs its unfinished tasks, and it is read back as
an ordinary table.  Stashes are removed when the driver's JVM ends.
"""

from __future__ import annotations

import gc
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.session import ensure_checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the corpus tables of ``sf_dir``."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared checkpoint folder, removed at JVM exit."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/corpus-{name}-{uuid.uuid4().hex}"
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(p)
    return path


def stash(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back."""
    path = shared_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of steps that are stashed.  It does so
    when the driver's JVM finds that nothing refers to them, which on a large heap
    is long after."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def free_name(taken, name: str) -> str:
    """``name``, with underscores before it until no column has it."""
    taken = {t.lower() for t in taken}
    while name.lower() in taken:
        name = "_" + name
    return name


def text_key(text: Column) -> Column:
    """32-byte key of a whole text (null and empty texts share one)."""
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None],
                schema: str) -> DataFrame:
    """``mapInArrow`` with a function from one record batch to one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                out = fn(batch)
                if out is not None and out.num_rows:
                    yield out

    return df.mapInArrow(run, schema)


def bitmap(hashes: DataFrame, column: str, bits: int):
    """Bitmap of 2**bits bits over the top bits of 64-bit hashes, as uint64
    words.  What is collected are its non-zero words: at most 2**(bits - 6)
    rows, whatever the number of hashes."""
    import numpy as np

    slot = F.shiftrightunsigned(column, 64 - bits)
    words = (hashes.select(F.shiftrightunsigned(slot, 6).cast("int").alias("word"),
                           F.pmod(slot, F.lit(64)).cast("int").alias("at"))
             .select("word", F.expr("shiftleft(1L, at)").alias("bit"))
             .groupBy("word").agg(F.bit_or("bit").alias("bits")).toPandas())
    out = np.zeros(1 << (bits - 6), np.uint64)
    out[words["word"].to_numpy(np.int64)] = words["bits"].to_numpy(np.int64).view(np.uint64)
    return out


def in_bitmap(words, hashes):
    """Which uint64 ``hashes`` may be in the bitmap."""
    import numpy as np

    bits = 6 + len(words).bit_length() - 1
    slot = hashes >> np.uint64(64 - bits)
    return (words[slot >> np.uint64(6)] >> (slot & np.uint64(63))) & np.uint64(1) == 1


def fixed_binary(rows) -> pa.Array:
    """Binary column from a 2-d uint8 array, one row per value."""
    import numpy as np

    n, width = rows.shape
    offsets = np.arange(0, (n + 1) * width, width, dtype=np.int32) if n else np.zeros(1, np.int32)
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(offsets),
                                                  pa.py_buffer(np.ascontiguousarray(rows).tobytes())])


def list_column(values, counts, kind: pa.DataType) -> pa.Array:
    """List column from flat values and the number of values per row."""
    import numpy as np

    offsets = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, type=kind))
