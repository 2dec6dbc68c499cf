"""A keyed state table that an update rewrites in part (K4).

Rows are dealt by a hash of their key to a fixed number of folders, and the
state's commit log (``sources.commits``) names the folder of each bucket.  An
update reads the old rows of the buckets that its keys fall into, merges them,
writes those buckets anew and commits a marker in which all other buckets keep
their folders: untouched files are neither read nor written, a reader sees
either the old or the new state, and of two updates at once one aborts with
``CommitConflict``.

A bucket should hold what one task merges well (a few hundred MB); the number
is fixed when the table is created, ``rebucket`` changes it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rollcall.session import materialize
from rollcall.sources.commits import CommitLog, list_names
from rollcall.sources.sinks import upsert_state


class KeyedState:
    """Table ``name`` below ``state_dir`` with one row per ``keys``."""

    def __init__(self, spark: SparkSession, state_dir: str, name: str, keys: list[str], schema: StructType | str,
                 buckets: int = 64):
        self.spark, self.name, self.keys = spark, name, list(keys)
        self.schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
        self.log = CommitLog(spark, state_dir)
        self.buckets = self.log.latest().get("buckets", {}).get(name, buckets)

    def _bucket(self, buckets: int | None = None) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(buckets or self.buckets)).cast("int")

    def folders(self, entry: dict | None = None) -> dict[int, str]:
        """The folder of each bucket that holds rows."""
        entry = self.log.latest() if entry is None else entry
        return {int(f.rsplit("bucket=", 1)[1]): f for f in entry["tables"].get(self.name, [])}

    def read(self, entry: dict | None = None) -> DataFrame:
        return self._rows(self.folders(entry).values())

    def of_keys(self, wanted: DataFrame) -> DataFrame:
        """Rows of the wanted keys: only their buckets are read."""
        numbers = [r[0] for r in wanted.select(self._bucket()).distinct().collect()]     # at most ``buckets``
        held = self.folders()
        return self._rows([held[b] for b in numbers if b in held]).join(
            wanted.select(*self.keys).distinct(), self.keys, "left_semi")

    def _rows(self, folders) -> DataFrame:
        paths = [f"{self.log.dir}/{f}" for f in folders]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    def upsert(self, updates: DataFrame, delete_col: str | None = None) -> list[int]:
        """Apply updates, one row per key (with ``delete_col``: true removes
        the key), and commit.  Returns the buckets that were written."""
        entry = self.log.latest()
        columns = [f.name for f in self.schema.fields]
        updates = materialize(updates.select(*columns, *([delete_col] if delete_col else [])))
        if not updates.groupBy(*self.keys).count().where("count > 1").isEmpty():
            raise ValueError(f"{self.name}: several updates for one key")
        touched = [r[0] for r in updates.select(self._bucket()).distinct().collect()]    # at most ``buckets``
        held = self.folders(entry)
        old = self._rows([held[b] for b in touched if b in held])
        merged = upsert_state(old, updates, self.keys, delete_col).select(*columns)
        self._commit(entry, merged, {b: f for b, f in held.items() if b not in touched}, self.buckets)
        return sorted(touched)

    def rebucket(self, buckets: int) -> None:
        """Deal all rows to another number of buckets."""
        entry = self.log.latest()
        self._commit(entry, self.read(entry), {}, buckets)
        self.buckets = buckets

    def _commit(self, entry: dict, rows: DataFrame, kept: dict[int, str], buckets: int) -> None:
        version = entry["version"] + 1
        root = f"{self.name}/data/{self.log.attempt(version)}"
        columns = rows.columns
        rows = rows.withColumn("bucket", self._bucket(buckets))
        rows.repartition("bucket").select(*columns, "bucket").write.partitionBy("bucket").parquet(
            f"{self.log.dir}/{root}")
        made = [f"{root}/{n}" for n in list_names(self.spark, f"{self.log.dir}/{root}") if n.startswith("bucket=")]
        tables = {**entry["tables"], self.name: sorted([*kept.values(), *made])}
        self.log.commit({**entry, "version": version, "tables": tables,
                         "buckets": {**entry.get("buckets", {}), self.name: buckets}})

    def vacuum(self, keep: int = 10) -> list[str]:
        return self.log.vacuum([self.name], keep)
