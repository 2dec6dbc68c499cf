"""Source divergence audit by length-bucketed packing (operator 11).

Terms are ``[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+`` of the whole text, A-Z
lower-cased.  Each language keeps the V terms that at least ``MIN_DOCS`` of its
documents hold.  Every (language, source) group and every language gives each
kept term, with count occurrences there, the weight p = 1 + floor(SCALE *
(count + 5) / (N + 5 * V)), N being the count's sum over kept terms.  All
arithmetic is exact (longs and decimals).

1. Counting (in the scan): terms of up to 8 bytes are packed into one uint64,
   up to 16 bytes into two, big-endian.  They are radix-sorted by 16-bit
   digits, with their document, and counted as runs; longer terms are sorted as
   bytes in a bucket for each length.  Per task this leaves occurrences and
   documents of each (group, term); tables above ``MAX_ENTRIES`` are handed on.
2. Sums by (language, source, term), then by (language, term) in a window over
   the at most S sources of a term, give the kept terms (``kept_counts``).
3. ``top_terms``: the terms a group holds above its language's weight, the 50
   with the largest difference.
4. ``source_pairs``: the sum of |p - q| over all kept terms for each two
   sources of a language.  Kept terms are dealt to buckets of about
   ``BUCKET_ENTRIES`` counts; a task fills dense blocks (sources x terms, absent
   terms at their source's weight for count 0) and adds up the differences of
   ``TILE`` sources to all others.  Pairs are made only as the S * (S - 1) rows
   that are the result.

No step groups by language alone: joins on a language or a group are salted by
the term, as one of them may hold most rows.

Defined results: null text, language and source count as ''.  A language
without kept terms has pairs of value 0 and no terms; a lone source has no
pairs.  Repeated rows count as documents of their own.  Further columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rollcall.llm import textvec as V
from rollcall.llm.common import stash

MIN_DOCS = 30
SCALE = 1_000_000_000
SMOOTH = 5
TOP = 50
MAX_ENTRIES = 1 << 20       # entries of a task's tables
BUCKET_ENTRIES = 500_000    # counts in a task that compares sources
TILE = 256                  # sources compared with all others by one task
DENSE = 1 << 21             # cells of a dense block
SALTS = 32

LETTER = np.zeros(256, bool)  # [^\x00-\x40\x5B-\x60\x7B-\x7F]
LETTER[0x41:0x5B] = True
LETTER[0x61:0x7B] = True
LETTER[0x80:] = True


# ------------------------------------------------- packing and counting ----

def radix_order(keys: list[np.ndarray]) -> np.ndarray:
    """Stable order by several unsigned keys, the last one the most
    significant: one counting pass per 16-bit digit that isn't constant."""
    order = np.arange(len(keys[0]))
    for key in keys:
        if not len(key):
            break
        differ = int(np.bitwise_or.reduce(key ^ key[0]))
        shift = 0
        while differ >> shift:
            if (differ >> shift) & 0xFFFF:
                digit = (key >> key.dtype.type(shift)).astype(np.uint16)
                order = order[np.argsort(digit[order], kind="stable")]
            shift += 16
    return order


def starts_of_runs(columns: list[np.ndarray]) -> np.ndarray:
    """Where a sorted table's rows differ from the row before."""
    new = np.zeros(len(columns[0]), bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


class Bucket:
    """Counts of terms of one length class: one uint64, two, or the bytes of a
    fixed length.  ``keys`` are a term's columns, the most significant first."""

    def __init__(self):
        self.parts: list[tuple] = []
        self.size = 0

    def add(self, keys: list[np.ndarray], group: np.ndarray, seen: np.ndarray, docs: np.ndarray) -> None:
        self.parts.append((keys, group, seen, docs))
        self.size += len(group)

    def fold(self) -> tuple | None:
        """One entry per (term, group), sorted; or None."""
        if not self.parts:
            return None
        keys = [np.concatenate(k) for k in zip(*(p[0] for p in self.parts))]
        group, seen, docs = (np.concatenate([p[i] for p in self.parts]) for i in (1, 2, 3))
        if len(self.parts) > 1:
            order = term_order(keys, group)
            keys, group, seen, docs = [k[order] for k in keys], group[order], seen[order], docs[order]
            at = starts_of_runs([*keys, group])
            keys, group = [k[at] for k in keys], group[at]
            seen, docs = np.add.reduceat(seen, at), np.add.reduceat(docs, at)
        self.parts = [(keys, group, seen, docs)]
        self.size = len(group)
        return self.parts[0]


def term_order(keys: list[np.ndarray], least: np.ndarray) -> np.ndarray:
    """Order by term, then by ``least``: radix passes for packed terms, a byte
    sort for long ones."""
    if keys[0].dtype.kind == "S":
        order = radix_order([least])
        return order[np.argsort(keys[0][order], kind="stable")]
    return radix_order([least, *keys[::-1]])


def count_terms(data: np.ndarray, offsets: np.ndarray, groups: np.ndarray, buckets: dict[int, Bucket]) -> None:
    """Add the terms of some texts (UTF-8 bytes) to the buckets.  ``groups``
    numbers each text's group; a bucket's name is 1, 2 or a length above 16."""
    mask = np.zeros(len(data) + 1, bool)
    mask[:-1] = LETTER[data]
    before = np.zeros(len(data) + 1, bool)
    before[1:] = mask[:-1]
    cut = np.zeros(len(data) + 1, bool)
    cut[offsets] = True
    start = np.flatnonzero(mask & (~before | cut))
    length = np.flatnonzero(before & (~mask | cut)) - start
    if not len(start):
        return
    # texts renumbered by group, so that a term's documents lie group by group
    by_group = np.argsort(groups, kind="stable")
    place = np.empty(len(groups), np.uint32)
    place[by_group] = np.arange(len(groups), dtype=np.uint32)
    text = np.repeat(place, np.diff(np.searchsorted(start, offsets)))
    group_of = groups[by_group]
    padded = np.zeros(len(data) + 16, np.uint8)
    padded[:len(data)] = V.LOWER[data]

    def packed(at: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Eight bytes from ``at`` on, those beyond ``size`` cleared."""
        word = np.lib.stride_tricks.sliding_window_view(padded, 8)[at].view(">u8").ravel().astype(np.uint64)
        gone = (8 * (8 - np.minimum(size, 8))).astype(np.uint64)
        return word >> gone << gone

    def add(name: int, keys: list[np.ndarray], doc: np.ndarray) -> None:
        order = term_order(keys, doc)
        keys, doc = [k[order] for k in keys], doc[order]
        at = starts_of_runs([*keys, doc])       # runs of a term in a document
        seen = np.diff(np.append(at, len(doc)))
        keys, group = [k[at] for k in keys], group_of[doc[at]]
        at = starts_of_runs([*keys, group])     # documents of a group
        buckets.setdefault(name, Bucket()).add(
            [k[at] for k in keys], group[at], np.add.reduceat(seen, at), np.diff(np.append(at, len(group))))

    one, two = np.flatnonzero(length <= 8), np.flatnonzero((length > 8) & (length <= 16))
    if len(one):
        add(1, [packed(start[one], length[one])], text[one])
    if len(two):
        add(2, [packed(start[two], np.full(len(two), 8)), packed(start[two] + 8, length[two] - 8)], text[two])
    long = np.flatnonzero(length > 16)
    for size in np.unique(length[long]).tolist():
        at = long[length[long] == size]
        rows = np.stack([padded[s:s + size] for s in start[at]])
        add(size, [rows.view(f"S{size}").ravel()], text[at])


def count_long_text(data: np.ndarray, group: int, buckets: dict[int, Bucket]) -> None:
    """``count_terms`` for one very long text, in pieces cut between terms; it
    counts as one document."""
    own: dict[int, Bucket] = {}
    at = 0
    while at < len(data):
        to = min(len(data), at + V.CHUNK_BYTES)
        while to < len(data) and LETTER[data[to]]:
            step = np.flatnonzero(~LETTER[data[to:to + V.CHUNK_BYTES]])
            to = to + int(step[0]) if len(step) else min(len(data), to + V.CHUNK_BYTES)
        count_terms(data[at:to], np.array([0, to - at]), np.array([group], np.uint32), own)
        for b in own.values():
            b.fold()
        at = to
    for name, b in own.items():
        keys, groups, seen, docs = b.fold()
        buckets.setdefault(name, Bucket()).add(keys, groups, seen, np.ones_like(docs))


def unpacked(keys: list[np.ndarray]) -> pa.Array:
    """The terms as strings."""
    n = len(keys[0])
    if keys[0].dtype.kind == "S":
        size = keys[0].dtype.itemsize
        flat, ends = keys[0].view(np.uint8), np.arange(1, n + 1) * size
    else:
        rows = np.concatenate([k.astype(">u8").view(np.uint8).reshape(n, 8) for k in keys], axis=1)
        flat, ends = rows[rows != 0], np.cumsum((rows != 0).sum(axis=1))
    offsets = np.zeros(n + 1, np.int64)
    offsets[1:] = ends
    return pa.Array.from_buffers(pa.large_string(), n, [None, pa.py_buffer(offsets),
                                                        pa.py_buffer(np.ascontiguousarray(flat).tobytes())]
                                 ).cast(pa.string())


def term_counts(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """(lang, source, term, seen, docs) of each task's part of the table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names: dict[tuple[str, str], int] = {}
        buckets: dict[int, Bucket] = {}

        def out() -> Iterator[pa.RecordBatch]:
            langs, sources = (pa.array([n[i] for n in names], pa.string()) for i in (0, 1))
            for b in buckets.values():
                folded = b.fold()
                for lo in range(0, b.size, 1 << 16):
                    keys, group, seen, found = [k[lo:lo + (1 << 16)] for k in folded[0]], *(
                        c[lo:lo + (1 << 16)] for c in folded[1:])
                    at = pa.array(group.astype(np.int64))
                    yield pa.RecordBatch.from_arrays(
                        [langs.take(at), sources.take(at), unpacked(keys), pa.array(seen.astype(np.int64)),
                         pa.array(found.astype(np.int64))], names=["lang", "source", "term", "seen", "docs"])
            buckets.clear()

        for batch in batches:
            pairs = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            groups = np.array([names.setdefault(p, len(names)) for p in pairs], np.uint32)
            for lo, hi, data, offsets in V.chunks(batch.column(2), V.CHUNK_BYTES):
                if hi - lo == 1 and len(data) > V.CHUNK_BYTES:
                    count_long_text(data, int(groups[lo]), buckets)
                else:
                    count_terms(data, offsets, groups[lo:hi], buckets)
            if sum(b.size for b in buckets.values()) > MAX_ENTRIES:
                for b in buckets.values():
                    b.fold()
                if sum(b.size for b in buckets.values()) > MAX_ENTRIES // 2:
                    yield from out()
        yield from out()

    src = docs.select(_text(lang).alias("lang"), _text(source).alias("source"), F.col(text).cast("string").alias("text"))
    return src.mapInArrow(run, "lang string, source string, term string, seen bigint, docs bigint")


# -------------------------------------------------------------- tables ----

def _text(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def _weight(count: str, total: str, terms: str) -> Column:
    """1 + floor(SCALE * (count + 5) / (total + 5 * terms)), exactly; null for
    a language without kept terms."""
    return F.expr(f"CASE WHEN {terms} > 0 THEN 1 + (cast({SCALE} as decimal(10,0)) * cast({count} + {SMOOTH} as "
                  f"decimal(19,0))) div cast({total} + {SMOOTH} * {terms} as decimal(19,0)) END")


def kept_counts(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """(lang, source, term, seen, all_seen, lead) of every kept term in every
    source that holds it; ``lead`` marks one row per (lang, term)."""
    counts = term_counts(docs, text, lang, source).groupBy("lang", "source", "term").agg(
        F.sum("seen").alias("seen"), F.sum("docs").alias("docs"))
    same = Window.partitionBy("lang", "term")
    return (counts.withColumn("in_docs", F.sum("docs").over(same)).withColumn("all_seen", F.sum("seen").over(same))
            .withColumn("lead", F.row_number().over(same.orderBy("source")) == 1).where(F.col("in_docs") >= MIN_DOCS)
            .select("lang", "source", "term", "seen", "all_seen", "lead"))


def group_stats(docs: DataFrame, kept: DataFrame, lang: str = "lang", source: str = "source") -> DataFrame:
    """Per (lang, source) that occurs: total (its count of kept terms), terms
    and all_total (of its language), base (its weight for count 0), place (its
    number within the language) and sources (the language's number of them)."""
    groups = docs.select(_text(lang).alias("lang"), _text(source).alias("source")).distinct()
    totals = kept.groupBy("lang", "source").agg(F.sum("seen").alias("total"), F.count_if("lead").alias("lead"))
    rows = groups.join(totals, ["lang", "source"], "left")
    whole = Window.partitionBy("lang")      # a row per source
    rows = (rows.withColumn("terms", F.coalesce(F.sum("lead").over(whole), F.lit(0).cast("long")))
            .withColumn("all_total", F.coalesce(F.sum("total").over(whole), F.lit(0).cast("long")))
            .withColumn("place", F.row_number().over(whole.orderBy("source")) - 1)
            .withColumn("sources", F.count("*").over(whole))
            .withColumn("total", F.coalesce("total", F.lit(0).cast("long"))).drop("lead"))
    return rows.withColumn("base", _weight("0", "total", "terms"))


def _with_stats(kept: DataFrame, stats: DataFrame) -> DataFrame:
    """Kept counts beside their group's row, joined in salted parts."""
    salted = stats.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salt = F.pmod(F.xxhash64("term"), F.lit(SALTS)).cast("int")
    return kept.withColumn("salt", salt).join(salted, ["lang", "source", "salt"]).withColumn(
        "p", _weight("seen", "total", "terms"))


def top_terms(kept: DataFrame, stats: DataFrame) -> DataFrame:
    """(lang, source, item, value, rank): the terms that a group holds above
    its language's weight, the TOP with the largest difference."""
    rows = _with_stats(kept, stats).withColumn("value", F.col("p") - _weight("all_seen", "all_total", "terms"))
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "term")
    return (rows.where("value > 0").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= TOP)
            .select("lang", "source", F.col("term").alias("item"), "value", "rank"))


def _tile_differences(key: tuple, counts: pa.Table, sources: pa.Table) -> pa.Table:
    """Sums of |p - q| over a bucket's terms, of the TILE sources of one tile
    to all sources after them."""
    place, base = (sources.column(c).to_numpy() for c in ("at", "weight"))
    by_place = np.argsort(place)
    base = base[by_place]
    n, lo = len(base), int(key[2].as_py()) * TILE
    hi = min(n, lo + TILE)
    total = np.zeros((hi - lo, n), np.int64)
    if counts.num_rows:
        where, p = counts.column("place").to_numpy(), counts.column("p").to_numpy()
        term = np.unique(counts.column("term").to_numpy(zero_copy_only=False), return_inverse=True)[1]
        order = np.argsort(term, kind="stable")
        where, p, term = where[order], p[order], term[order]
        width = max(1, DENSE // n)
        for first in range(0, int(term[-1]) + 1, width):
            a, b = np.searchsorted(term, [first, first + width])
            terms = min(width, int(term[-1]) + 1 - first)
            block = np.repeat(base[:, None], terms, axis=1)
            block[where[a:b], term[a:b] - first] = p[a:b]
            for x in range(lo, hi):
                total[x - lo, x + 1:] += np.abs(block[x + 1:] - block[x]).sum(axis=1)
    one, two = np.nonzero(np.arange(n)[None, :] > np.arange(lo, hi)[:, None])
    return pa.table({"lang": pa.array([key[0].as_py()] * len(one), pa.string()), "one": pa.array(one + lo),
                     "two": pa.array(two), "value": pa.array(total[one, two])})


def source_pairs(kept: DataFrame, stats: DataFrame) -> DataFrame:
    """(lang, source, item, value, rank): every two sources of a language, in
    both directions, by the sum of |p - q| over its kept terms."""
    sizes = kept.groupBy("lang").agg(F.count("*").alias("entries"))
    some = stats.join(sizes, "lang").where("sources > 1").withColumn(
        "buckets", F.ceil(F.col("entries") / BUCKET_ENTRIES).cast("int"))
    counts = _with_stats(kept, some).select(
        "lang", F.pmod(F.xxhash64("term"), F.col("buckets")).cast("int").alias("bucket"),
        F.explode(F.sequence(F.lit(0), F.ceil(F.col("sources") / TILE).cast("int") - 1)).alias("tile"),
        "place", "term", "p")
    sources = some.withColumn("bucket", F.explode(F.sequence(F.lit(0), F.col("buckets") - 1))).select(
        "lang", "bucket", F.explode(F.sequence(F.lit(0), F.ceil(F.col("sources") / TILE).cast("int") - 1)).alias("tile"),
        F.col("place").alias("at"), F.col("base").alias("weight"))
    parts = sources.groupBy("lang", "bucket", "tile").cogroup(counts.groupBy("lang", "bucket", "tile")).applyInArrow(
        lambda key, right, left: _tile_differences(key, left, right),
        "lang string, one bigint, two bigint, value bigint")
    sums = parts.groupBy("lang", "one", "two").agg(F.sum("value").alias("value"))
    both = sums.unionByName(sums.select("lang", F.col("two").alias("one"), F.col("one").alias("two"), "value"))
    names = stats.select("lang", "source", "place")
    rows = (both.join(names.select("lang", "source", F.col("place").alias("one")), ["lang", "one"])
            .join(names.select("lang", F.col("source").alias("item"), F.col("place").alias("two")), ["lang", "two"]))
    bare = stats.where("sources > 1 AND terms = 0")     # languages without kept terms
    none = bare.select("lang", "source").join(bare.select("lang", F.col("source").alias("item")), "lang").where(
        "source != item").withColumn("value", F.lit(0).cast("long"))
    rows = rows.select("lang", "source", "item", "value").unionByName(none)
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    return rows.withColumn("rank", F.row_number().over(order))


def divergence(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """Both parts: lang, source, part (``pair`` or ``term``), item, value, rank."""
    kept = stash(kept_counts(docs, text, lang, source), "kept-terms")
    stats = stash(group_stats(docs, kept, lang, source), "group-stats")
    pairs = source_pairs(kept, stats).withColumn("part", F.lit("pair"))
    terms = top_terms(kept, stats).withColumn("part", F.lit("term"))
    return pairs.unionByName(terms).select("lang", "source", "part", "item", "value", "rank")
