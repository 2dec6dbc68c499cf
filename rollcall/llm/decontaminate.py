"""Benchmark decontamination by winnowing (operator 6).

Texts are lower-cased (A-Z) and cut into words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``.
A benchmark item's windows are its runs of ``window`` words; an item with fewer
words, but not none, is one window of its own length.

Winnowing keeps, of every ``w`` consecutive k-gram hashes, the smallest (the
leftmost of equals).  With k + w - 1 = ``window`` any shared window yields the
same kept k-gram on both sides, so no shared window is missed.  Short items of
m words use k = m, w = 1, a family of fingerprints per length that occurs.

Fingerprints travel with the words around them that a window through them can
reach, so that after the join a hit is extended to its left and right and
checked on the words themselves, without fetching a text again.

Scale: the training side is filtered by a bitmap of the benchmark's
fingerprints (``2**BITMAP_BITS`` bits, 8 MB at every size) before anything is
shuffled; the join behind it is exact.  Equal texts are handled once.

Defined results: null and empty texts have no words and no hits; repeated rows
each get a row; null ids are carried; an empty benchmark hits nothing; columns
other than the id and text are ignored by ``contamination`` and kept by
``decontaminate``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollcall.llm import textvec as V
from rollcall.llm.common import bitmap, free_name, in_bitmap, map_batches, stash, text_key

WINDOW = 10
K = 6
BITMAP_BITS = 26

FINGERPRINT = T.StructType([
    T.StructField("family", T.IntegerType()),   # 0, or the length of a short item
    T.StructField("hash", T.LongType()),
    T.StructField("pos", T.LongType()),         # of the seed's first word
    T.StructField("before", T.ArrayType(T.StringType())),  # nearest first
    T.StructField("seed", T.ArrayType(T.StringType())),
    T.StructField("after", T.ArrayType(T.StringType())),
])
_FP_ARROW = pa.struct([("family", pa.int32()), ("hash", pa.int64()), ("pos", pa.int64()),
                       ("before", pa.list_(pa.string())), ("seed", pa.list_(pa.string())),
                       ("after", pa.list_(pa.string()))])


def winnow(hashes: np.ndarray, at: np.ndarray, text: np.ndarray, w: int) -> np.ndarray:
    """Indices into ``hashes`` kept by winnowing runs of ``w`` within a text.
    ``at`` is each k-gram's word index (consecutive within a text)."""
    n = len(hashes) - w + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    runs = np.flatnonzero(text[at[:n]] == text[at[w - 1:]])
    best = np.lib.stride_tricks.sliding_window_view(hashes, w)[runs].argmin(axis=1)
    return np.unique(runs + best)


def _families(lengths: list[int], window: int, k: int) -> list[tuple[int, int, int]]:
    """(family, k, w) for whole windows and for each short item length."""
    return [(0, k, window - k + 1)] + [(m, m, 1) for m in lengths]


def _kept(words: V.Words, hashes: np.ndarray, families, only=None):
    """(family, k, hash, word index) of the kept k-grams of a chunk."""
    for family, k, w in families:
        h, at = V.shingles(hashes, words.text, k, salt=family)
        if only is not None:
            own = only(words.counts[words.text[at]], family)
            h, at = h[own], at[own]
        keep = winnow(h, at, words.text, w) if w > 1 else np.arange(len(h))
        yield family, k, h[keep], at[keep]


def _fingerprint(words: V.Words, family: int, k: int, h: int, i: int, window: int) -> dict:
    row = words.text[i]
    lo, hi = words.first[row], words.first[row + 1]
    reach = (window if family == 0 else family) - k
    return {"family": family, "hash": int(h.view(np.int64)), "pos": int(i - lo),
            "before": [words.word(j) for j in range(i - 1, max(lo, i - reach) - 1, -1)],
            "seed": [words.word(j) for j in range(i, i + k)],
            "after": [words.word(j) for j in range(i + k, min(hi, i + k + reach))]}


def _scan(text: pa.Array, families, window: int, wanted, only=None):
    """Word counts and fingerprints (where ``wanted(hash)``) of each text."""
    counts = np.zeros(len(text), np.int64)
    found: list[list[dict]] = [[] for _ in range(len(text))]
    for lo, hi, data, offsets in V.chunks(text):
        words = V.Words(data, offsets, V.WORD)
        counts[lo:hi] = words.counts
        hashes = words.hashes()
        for family, k, h, at in _kept(words, hashes, families, only):
            sel = wanted(h)
            for x, i in zip(h[sel], at[sel]):
                found[lo + words.text[i]].append(_fingerprint(words, family, k, x, i, window))
    return counts, found


def benchmark_fingerprints(benchmark: DataFrame, item_id: str = "item_id", text: str = "text",
                           window: int = WINDOW, k: int = K) -> DataFrame:
    """(item_id, n_words, fp) per kept fingerprint of every item."""
    families = _families(list(range(1, window)), window, k)

    def owns(count, family):
        return count >= window if family == 0 else count == family

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts, found = _scan(batch.column(1), families, window, lambda h: np.ones(len(h), bool), owns)
        at = np.repeat(np.arange(len(found)), [len(x) for x in found])
        flat = pa.array([x for f in found for x in f], type=_FP_ARROW)
        return pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at)), pa.array(counts[at]), flat],
                                          names=["item_id", "item_words", "fp"])

    src = benchmark.select(F.col(item_id).alias("item_id"), F.col(text).cast("string").alias("text"))
    schema = T.StructType([src.schema["item_id"], T.StructField("item_words", T.LongType()),
                           T.StructField("fp", FINGERPRINT)])
    return map_batches(src, run, schema)


def text_hits(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text",
              item_id: str = "item_id", item_text: str = "text", window: int = WINDOW,
              k: int = K) -> tuple[DataFrame, DataFrame]:
    """(scanned, spans): ``scanned`` has a row (doc_id, key, n_words) per
    document; ``spans`` one row (key, item_id, start, end) per stretch of
    words of a text that benchmark windows cover around one fingerprint
    (word positions, end exclusive); ``key`` identifies the text."""
    spark = docs.sparkSession
    fps = stash(benchmark_fingerprints(benchmark, item_id, item_text, window, k), "benchmark-fps")
    lengths = sorted(r[0] for r in fps.select("fp.family").distinct().collect() if r[0])  # < window values
    families = _families(lengths, window, k)
    shared = spark.sparkContext.broadcast(bitmap(fps, "fp.hash", BITMAP_BITS))

    def wanted(h: np.ndarray) -> np.ndarray:
        return in_bitmap(shared.value, h)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts, found = _scan(batch.column(2), families, window, wanted)
        return pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(counts),
             pa.array(found, type=pa.list_(_FP_ARROW))], names=["doc_id", "key", "n_words", "fps"])

    src = docs.select(F.col(doc_id).alias("doc_id"), text_key(F.col(text)).alias("key"),
                      F.col(text).cast("string").alias("text"))
    schema = T.StructType([src.schema["doc_id"], T.StructField("key", T.BinaryType()),
                           T.StructField("n_words", T.LongType()),
                           T.StructField("fps", T.ArrayType(FINGERPRINT))])
    scanned = stash(map_batches(src, run, schema), "document-fps")

    ours = (scanned.where(F.size("fps") > 0).select("key", F.explode("fps").alias("d"))
            .select("key", "d.*").distinct())
    theirs = fps.select("item_id", "item_words", *[F.col("fp." + f.name).alias("i_" + f.name)
                                                    for f in FINGERPRINT.fields])
    both = ours.join(theirs, (F.col("hash") == F.col("i_hash")) & (F.col("family") == F.col("i_family"))
                     & (F.col("seed") == F.col("i_seed")))

    def same(a: str, b: str):
        """Number of leading words that agree."""
        first = F.array_position(F.zip_with(a, b, lambda x, y: ~x.eqNullSafe(y)), True)
        return F.when(first == 0, F.size(a)).otherwise(first - 1)

    spans = (both.select("key", "item_id", "item_words", "pos", F.size("seed").alias("k"),
                         same("before", "i_before").alias("left"), same("after", "i_after").alias("right"))
             .where(F.col("left") + F.col("k") + F.col("right") >= F.least(F.lit(window), F.col("item_words")))
             .select("key", "item_id", (F.col("pos") - F.col("left")).alias("start"),
                     (F.col("pos") + F.col("k") + F.col("right")).alias("end")))
    return scanned.drop("fps"), spans


def _per_text(spans: DataFrame) -> DataFrame:
    hit = (spans.select("key", "start", "end").distinct()
           .select("key", F.explode(F.sequence("start", F.col("end") - 1)).alias("word"))
           .distinct().groupBy("key").agg(F.count("*").alias("n_hit")))
    items = (spans.select("key", F.col("item_id").cast("string").alias("item")).distinct()
             .groupBy("key").agg(F.count("*").alias("n_items"),
                                 F.array_join(F.sort_array(F.collect_list("item")), ",").alias("items")))
    return hit.join(items, "key")


def contamination(docs: DataFrame, benchmark: DataFrame, **names) -> DataFrame:
    """Per document: doc_id, key, n_words, n_hit, n_items, items (ids sorted
    as strings, comma-joined), contaminated."""
    scanned, spans = text_hits(docs, benchmark, **names)
    found = _per_text(stash(spans.distinct(), "hits"))
    zero = F.lit(0).cast("long")
    return scanned.join(found, "key", "left").select(
        "doc_id", "key", "n_words", F.coalesce("n_hit", zero).alias("n_hit"),
        F.coalesce("n_items", zero).alias("n_items"), F.coalesce("items", F.lit("")).alias("items"),
        F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, **names) -> DataFrame:
    """The rows of ``docs`` whose text holds no benchmark window."""
    _, spans = text_hits(docs, benchmark, **names)
    key = free_name(docs.columns, "text_key")
    bad = spans.select(F.col("key").alias(key)).distinct()
    return docs.join(bad, text_key(docs[names.get("text", "text")]) == bad[key], "left_anti")
