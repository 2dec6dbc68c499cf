"""Large JSON array files read by several tasks.

A service's answer is one JSON array, often one line.  Spark's multi-line
reader gives such a file to one task, however large it is.  Here the file goes
through the text source with ``}`` as its line separator, which splits at any
block border on every file system, and record borders are found from the state
of the JSON text at each block's start:

1. Every block counts its unescaped quotes, and the change of nesting depth for
   either case: that it begins inside a string or outside.
2. Prefix sums over a file's blocks (one small row each) tell which case holds
   and the depth each block begins at.
3. With that state every block cuts out the records (objects at depth 1) that
   lie in it whole; what a block border cuts through leaves pieces, one or two
   a block, that are put together by file.
4. ``from_json`` parses the records with the declared schema in the JVM.

Strings, escapes and any nesting are followed exactly; nothing is guessed from
the look of a border.  Records in a file keep no order (nor do they with any
parallel reader).  A file that isn't an array of objects is an error; elements
that aren't objects are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

from rollcall.session import materialize

WHOLE, BEGINS, GOES_ON = 0, 1, 2

_STEP = np.zeros(256, np.int8)
_STEP[[ord("{"), ord("[")]] = 1
_STEP[[ord("}"), ord("]")]] = -1


def _structure(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(depth steps of brackets, whether each byte lies behind an odd number
    of unescaped quotes) of some bytes that begin with no open escape."""
    quote = text == ord('"')
    slash = text == ord("\\")
    if slash.any():
        place = np.arange(len(text))
        plain = np.maximum.accumulate(np.where(slash, -1, place))  # last byte that is no backslash
        run = np.zeros(len(text), np.int64)
        run[1:] = place[:-1] - plain[:-1]                          # backslashes right before each byte
        quote &= run % 2 == 0
    return _STEP[text], (np.cumsum(quote) & 1).astype(bool)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, pa.RecordBatch, np.ndarray]]:
    """((file, block), its rows in this batch, their bytes) in order; the
    separators are put back."""
    for batch in batches:
        if not batch.num_rows:
            continue
        file, block = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        edges = np.flatnonzero((file[1:] != file[:-1]) | (block[1:] != block[:-1])) + 1
        for lo, hi in zip([0, *edges.tolist()], [*edges.tolist(), len(file)]):
            part = batch.slice(lo, hi - lo)
            text = "}".join(part.column(2).to_pylist()) + "}"
            yield (int(file[lo]), int(block[lo])), part, np.frombuffer(text.encode(), np.uint8)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per block: quotes, and the depth change if it begins outside (d0) or
    inside (d1) a string."""
    found: dict[tuple, tuple[int, int, int]] = {}
    for key, _, text in _blocks(batches):
        step, inside = _structure(text)
        total, within = int(step.sum(dtype=np.int64)), int(step[inside].sum(dtype=np.int64))
        odd, d0, d1 = found.get(key, (0, 0, 0))
        new0, new1 = total - within, within
        found[key] = (odd ^ int(inside[-1]), d0 + (new1 if odd else new0), d1 + (new0 if odd else new1))
    if found:
        columns = [[k[0] for k in found], [k[1] for k in found], *([v[i] for v in found.values()] for i in range(3))]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns],
                                         names=["file", "block", "odd", "d0", "d1"])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole records, and the pieces at block borders."""
    now, inside_at, depth_at, open_parts, kind = None, False, 0, [], GOES_ON

    def out(key, rows: list[tuple[int, str]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([key[0]] * len(rows), pa.int64()), pa.array([key[1]] * len(rows), pa.int64()),
             pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.string())],
            names=["file", "block", "kind", "text"])

    for key, part, raw in _blocks(batches):
        rows: list[tuple[int, str]] = []
        if key != now:
            if open_parts:
                yield out(now, [(kind, "".join(open_parts))])
            now, open_parts, kind = key, [], GOES_ON
            inside_at, depth_at = bool(part.column(3)[0].as_py()), int(part.column(4)[0].as_py())
            if depth_at == 0 and not inside_at and raw.tobytes().strip()[:1] not in (b"[", b"}", b"]", b""):
                raise ValueError("not a JSON array of objects")
        step, inside = _structure(raw)
        inside = inside ^ inside_at
        depth = depth_at + np.cumsum(np.where(inside, 0, step), dtype=np.int64)
        first = np.flatnonzero((raw == ord("{")) & ~inside & (depth == 2))
        last = np.flatnonzero((raw == ord("}")) & ~inside & (depth == 1)) + 1
        if inside_at or depth_at >= 2:          # a record is open
            to = int(last[0]) if len(last) else len(raw)
            open_parts.append(raw[:to].tobytes().decode())
            if len(last):
                rows.append((WHOLE if kind == BEGINS else GOES_ON, "".join(open_parts)))
                open_parts, last = [], last[1:]
        for a, b in zip(first.tolist(), last.tolist()):
            rows.append((WHOLE, raw[a:b].tobytes().decode()))
        if len(first) > len(last):
            open_parts, kind = [raw[int(first[-1]):].tobytes().decode()], BEGINS
        inside_at, depth_at = bool(inside[-1]), int(depth[-1])
        if rows:
            yield out(key, rows)
    if open_parts:
        yield out(now, [(kind, "".join(open_parts))])


def read_json_array(spark: SparkSession, path: str | list[str], schema: StructType,
                    options: dict[str, str] | None = None) -> DataFrame:
    """The records of JSON array files in ``schema``; ``options`` are those of
    ``from_json``.  The texts are read twice here, and the records written once
    to the shared checkpoint folder."""
    text = spark.read.option("lineSep", "}").text(path)
    parts = text.select(F.xxhash64("_metadata.file_path").alias("file"),
                        F.col("_metadata.file_block_start").alias("block"), "value")
    counted = parts.mapInArrow(_count, "file bigint, block bigint, odd bigint, d0 bigint, d1 bigint")
    counted = counted.groupBy("file", "block").agg(*[F.first(c).alias(c) for c in ("odd", "d0", "d1")])
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    state = counted.withColumn("inside", F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2 == 1)
    state = state.withColumn("depth", F.coalesce(
        F.sum(F.when(F.col("inside"), F.col("d1")).otherwise(F.col("d0"))).over(before), F.lit(0)))
    # a row per block, as many as the splits that the scan itself lists
    state = F.broadcast(materialize(state.select("file", "block", "inside", "depth")))
    cut = parts.join(state, ["file", "block"]).select("file", "block", "value", "inside", "depth").mapInArrow(
        _cut, "file bigint, block bigint, kind int, text string")
    cut = materialize(cut)
    along = Window.partitionBy("file").orderBy("block", F.col("kind").desc())
    pieces = cut.where(F.col("kind") != WHOLE).withColumn(
        "record", F.sum(F.when(F.col("kind") == BEGINS, 1).otherwise(0)).over(along))
    joined = pieces.groupBy("file", "record").agg(F.concat_ws("", F.transform(
        F.array_sort(F.collect_list(F.struct("block", (-F.col("kind")).alias("order"), "text"))),
        lambda x: x["text"])).alias("text"))
    records = cut.where(F.col("kind") == WHOLE).select("text").unionByName(joined.select("text"))
    return records.select(F.from_json("text", schema, options or {}).alias("r")).select("r.*")


def write_json_array(df: DataFrame, path: str, options: dict[str, str] | None = None) -> None:
    """``df`` as JSON array files, one for each partition, a record a line;
    ``options`` are those of ``to_json``."""

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = "["
        for batch in batches:
            texts = batch.column(0).to_pylist()
            if texts:
                first, before = before + texts[0], ","
                yield pa.RecordBatch.from_arrays([pa.array([first, *("," + t for t in texts[1:])])], names=["value"])
        yield pa.RecordBatch.from_arrays([pa.array(["[]" if before == "[" else "]"])], names=["value"])

    records = df.select(F.to_json(F.struct(*df.columns), options or {}).alias("value"))
    records.mapInArrow(lines, "value string").write.text(path)
