"""Exact duplicates through a cuckoo-filter index (operator 12).

Two texts are equal when they are identical after every character of
``[\\x20\\x09-\\x0D]`` is deleted.  A normalised text is named by its SHA-256
and its length in bytes; that pair is the *content* an index stores and a hit
is verified against, so that texts themselves are never shuffled.

1. Scan: each text is normalised and digested; (doc_id, digest, code points of
   the original, a row number) is written to the shared folder.
2. Index: ``CuckooIndex`` holds the live digests of a task.  A 16-bit tag sits
   in one of two buckets of four slots; a tag hit is verified against the
   content stored beside it; an insertion that finds no slot after
   ``MAX_KICKS`` moves doubles the buckets from the stored digests.  Each task
   folds its rows into entries of its own first (handed on whenever
   ``FOLD_ROWS`` of them are live), then entries are shuffled by digest and
   folded again by the same index.  A group of copies of any size therefore
   costs one entry per task.
3. Members: every row looks up its group.  Groups larger than a share of the
   table (at most ``HEAVY_GROUPS`` by construction) are broadcast, the others
   joined by digest, so no key of the shuffled join is large.

``update_live`` applies insertions and deletions to a stored table of live
digests in the same way.

Defined results: null counts as empty; all empty texts are one group.  Of
equal texts the row with the most code points stays, then the smallest id
(null ids last), then the first row read; exactly one row per group is kept,
also where rows are repeated.  Further columns are ignored by ``duplicates``
and kept by ``drop_duplicates``.  An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollcall.llm.common import free_name, map_batches, stash

BLANKS = b" \t\n\x0b\x0c\r"
SLOTS = 4
MAX_KICKS = 200
FOLD_ROWS = 100_000      # live entries a scanning task holds
SHARD_ROWS = 200_000     # rows per shard of the shuffled index
HEAVY_GROUPS = 10_000    # at most as many groups are broadcast
HEAVY_ROWS = 10_000      # and none smaller than this


class CuckooIndex:
    """Live digests with a payload each; digests are bytes of 32 or more."""

    def __init__(self, buckets: int = 1 << 10):
        self.entries: list = []     # [digest, payload], None after a deletion
        self.free: list[int] = []
        self.live = 0
        self._clear(buckets)

    def _clear(self, buckets: int) -> None:
        self.mask = buckets - 1
        self.tags = array("H", bytes(2 * SLOTS * buckets))       # 0: an empty slot
        self.refs = array("q", bytes(8 * SLOTS * buckets))       # the entry of each slot

    def _places(self, digest: bytes) -> tuple[int, int, int]:
        tag = int.from_bytes(digest[:2], "big") or 1
        one = int.from_bytes(digest[2:10], "big") & self.mask
        return tag, one, self._other(one, tag)

    def _other(self, bucket: int, tag: int) -> int:
        return bucket ^ ((tag * 0x9E3779B1 >> 7) & self.mask)

    def _slot(self, digest: bytes) -> int:
        """The slot whose tag and stored content match, or -1."""
        tag, one, two = self._places(digest)
        for bucket in (one, two):
            for slot in range(SLOTS * bucket, SLOTS * bucket + SLOTS):
                if self.tags[slot] == tag and self.entries[self.refs[slot]][0] == digest:
                    return slot
        return -1

    def find(self, digest: bytes):
        """The live entry [digest, payload] of ``digest``, or None."""
        slot = self._slot(digest)
        return self.entries[self.refs[slot]] if slot >= 0 else None

    def insert(self, digest: bytes, payload) -> None:
        """Add a digest that isn't live."""
        if self.free:
            ref = self.free.pop()
            self.entries[ref] = [digest, payload]
        else:
            ref = len(self.entries)
            self.entries.append([digest, payload])
        self.live += 1
        if not self._place(digest, ref):
            self._resize()

    def delete(self, digest: bytes) -> bool:
        """Take a live digest out; False where it isn't live."""
        slot = self._slot(digest)
        if slot < 0:
            return False
        self.entries[self.refs[slot]] = None
        self.free.append(self.refs[slot])
        self.tags[slot] = 0
        self.live -= 1
        return True

    def _place(self, digest: bytes, ref: int) -> bool:
        tag, one, two = self._places(digest)
        for kick in range(MAX_KICKS):
            for bucket in (one, two):
                for slot in range(SLOTS * bucket, SLOTS * bucket + SLOTS):
                    if not self.tags[slot]:
                        self.tags[slot], self.refs[slot] = tag, ref
                        return True
            # move an inhabitant of the second bucket to its other bucket
            slot = SLOTS * two + (kick * 7 + ref) % SLOTS
            self.tags[slot], tag = tag, self.tags[slot]
            self.refs[slot], ref = ref, self.refs[slot]
            one = two = self._other(two, tag)
        return False

    def _resize(self) -> None:
        buckets = self.mask + 1
        while True:
            buckets *= 2
            self._clear(buckets)
            if all(self._place(e[0], ref) for ref, e in enumerate(self.entries) if e is not None):
                return

    def drain(self) -> list:
        """All live entries; the index is empty afterwards."""
        out = [e for e in self.entries if e is not None]
        self.entries, self.free, self.live = [], [], 0
        self._clear(self.mask + 1)
        return out


def digest_of(text: bytes) -> bytes:
    """SHA-256 of the normalised text, then its length in eight bytes."""
    plain = text.translate(None, BLANKS)
    return hashlib.sha256(plain).digest() + len(plain).to_bytes(8, "big")


def digests(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", row: str | None = None) -> DataFrame:
    """Per row: doc_id, row (a number of its own, or the column that holds
    one), n_chars and digest."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [digest_of(t or b"") for t in batch.column(3).to_pylist()]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), batch.column(2), pa.array(found, pa.binary())],
            names=["doc_id", "row", "n_chars", "digest"])

    number = F.col(row) if row else F.monotonically_increasing_id()
    src = docs.select(F.col(doc_id).alias("doc_id"), number.alias("row"),
                      F.coalesce(F.char_length(text), F.lit(0)).cast("long").alias("n_chars"),
                      F.col(text).cast("string").cast("binary").alias("text"))
    schema = T.StructType([src.schema["doc_id"], src.schema["row"], src.schema["n_chars"],
                           T.StructField("digest", T.BinaryType())])
    return map_batches(src, run, schema)


def _fold(rows: DataFrame, limit: int | None) -> DataFrame:
    """Rows (digest, n_chars, doc_id, row, copies) folded by one index per
    task into one entry per live digest: its best row and its copies.  With
    ``limit`` a task hands its entries on whenever that many are live."""
    schema = rows.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = CuckooIndex()
        kind = None

        def out() -> pa.RecordBatch:
            live = index.drain()
            best = [e[1] for e in live]
            return pa.RecordBatch.from_arrays(
                [pa.array([e[0] for e in live], pa.binary()), pa.array([-b[0] for b in best], pa.int64()),
                 pa.array([b[2] for b in best], kind), pa.array([b[3] for b in best], pa.int64()),
                 pa.array([b[4] for b in best], pa.int64())],
                names=["digest", "n_chars", "doc_id", "row", "copies"])

        for batch in batches:
            kind = batch.column(2).type
            for digest, n_chars, doc, row, copies in zip(*(c.to_pylist() for c in batch.columns)):
                # null ids come last: compared by the flag before them
                rank = (-n_chars, doc is None, doc, row)
                entry = index.find(digest)
                if entry is None:
                    index.insert(digest, (*rank, copies))
                    continue
                old = entry[1]
                if rank[:2] < old[:2] or (rank[:2] == old[:2] and
                                          ((row < old[3]) if doc == old[2] else (doc < old[2]))):
                    entry[1] = (*rank, copies + old[4])
                else:
                    entry[1] = (*old[:4], copies + old[4])
            if limit and index.live >= limit:
                yield out()
        if index.live:
            yield out()

    return rows.mapInArrow(run, schema)


def _entries(seen: DataFrame, n_rows: int) -> DataFrame:
    """One row per digest: digest, n_chars, doc_id, row and copies."""
    rows = seen.select("digest", "n_chars", "doc_id", "row", F.lit(1).cast("long").alias("copies"))
    return _fold(_fold(rows, FOLD_ROWS).repartition(_shards(seen, n_rows), "digest"), None)


def _shards(df: DataFrame, n_rows: int) -> int:
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-n_rows // SHARD_ROWS))


def duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, keep_id, group_size, kept, text_sha256."""
    seen = stash(digests(docs, doc_id, text), "digests")
    n_rows = seen.count()
    groups = stash(_entries(seen, n_rows).where("copies > 1").select(
        "digest", F.col("doc_id").alias("keep_id"), F.col("row").alias("keep_row"),
        F.col("copies").alias("group_size")), "copy-groups")
    # sizes add up to n_rows at most, so that at most HEAVY_GROUPS are heavy
    bound = max(HEAVY_ROWS, -(-n_rows // HEAVY_GROUPS))
    heavy = F.broadcast(groups.where(F.col("group_size") > bound))
    light = groups.where(F.col("group_size") <= bound)
    rest = seen.join(heavy.select("digest"), "digest", "left_anti").join(light, "digest", "left")
    both = seen.join(heavy, "digest").unionByName(rest)
    alone = F.col("group_size").isNull()
    return both.select(
        "doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        (alone | (F.col("row") == F.col("keep_row"))).alias("kept"),
        F.lower(F.hex(F.substring("digest", 1, 32))).alias("text_sha256"))


def drop_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, one per group, with all their columns."""
    row = free_name(docs.columns, "row")
    numbered = stash(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    seen = stash(digests(numbered, doc_id, text, row), "digests")
    stay = _entries(seen, seen.count()).select(F.col("row").alias(row))
    return numbered.join(stay, row, "left_semi").drop(row)


def update_live(live: DataFrame, inserted: DataFrame, deleted: DataFrame) -> DataFrame:
    """A table of live digests (digest, copies) after documents came and went.

    ``inserted`` and ``deleted`` have a ``digest`` per document, as
    ``digests`` gives.  Changes are summed per digest before the shuffle, so
    that a digest takes one row per task.  Returned per digest: digest, copies
    (0 where it died, a row of its own so that a caller can drop its documents)
    and status: ``kept``, ``added``, ``changed``, ``died`` or ``unknown`` (a
    deletion beyond the live copies, which counts as if they were none)."""
    delta = (inserted.select("digest", F.lit(1).cast("long").alias("copies"))
             .unionByName(deleted.select("digest", F.lit(-1).cast("long").alias("copies")))
             .groupBy("digest").agg(F.sum("copies").alias("copies")))
    rows = live.select("digest", "copies", F.lit(0).alias("step")).unionByName(
        delta.select("digest", "copies", F.lit(1).alias("step")))
    shards = _shards(live, live.count() + delta.count())
    rows = rows.repartition(shards, "digest").sortWithinPartitions("step")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, gone = CuckooIndex(), []
        for batch in batches:
            for digest, copies, step in zip(*(c.to_pylist() for c in batch.columns)):
                digest, entry = bytes(digest), index.find(bytes(digest))
                if step == 0:
                    index.insert(digest, (copies, "kept"))
                elif entry is not None and entry[1][0] + copies > 0:
                    entry[1] = (entry[1][0] + copies, "changed" if copies else "kept")
                elif entry is not None:
                    gone.append((digest, 0, "died" if entry[1][0] + copies == 0 else "unknown"))
                    index.delete(digest)
                elif copies > 0:
                    index.insert(digest, (copies, "added"))
                elif copies < 0:
                    gone.append((digest, 0, "unknown"))
        out = [(e[0], *e[1]) for e in index.drain()] + gone
        if out:
            yield pa.RecordBatch.from_arrays(
                [pa.array([o[0] for o in out], pa.binary()), pa.array([o[1] for o in out], pa.int64()),
                 pa.array([o[2] for o in out], pa.string())], names=["digest", "copies", "status"])

    return rows.mapInArrow(run, "digest binary, copies bigint, status string")
