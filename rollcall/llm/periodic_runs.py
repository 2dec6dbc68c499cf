"""Maximal periodic runs of words in documents (operator 13).

A document's words are ``[^\\x20\\x09-\\x0D]+`` of its whole text.  A run is a
stretch with smallest period q (words q apart are identical), at least
``MIN_WORDS`` words and ``MIN_PERIODS`` periods long, that no neighbouring word
extends.  Texts that pass ``repeat_tail`` (the query's planted repetitions) are
changed before they are searched.

1. ``stretches``: in a run of length L and period q every 8-word shingle from
   the second period on occurs within q words before, at L - q - 7 consecutive
   places.  Only stretches of consecutive places with such an earlier
   occurrence, near enough for the stretch's own length, can hold a run; all
   others are left out.  The condition is necessary, so that no run is lost.
2. ``repetitions``: Ukkonen's suffix tree of the stretch and of its reversal,
   an Euler tour of each, and range minima over the tour's string depths give
   longest common extensions in constant time (the depth of the lowest common
   ancestor).  The tree's leaf order, for the alphabet as it is and reversed,
   gives the longest Lyndon word at each place (up to the next smaller
   suffix); each is a candidate root and is extended in both directions.  By
   the runs theorem these are all maximal repetitions of two or more periods.
3. Repetitions that touch the stretch's border are extended on the whole text;
   those that reach the limits are the document's runs.

A word is dropped if a run contains it after that run's first q words.

Documents are independent, so the work is one pass over the table without a
shuffle.  A text is cut into words in pieces of ``PIECE`` bytes and kept as
word numbers; a stretch takes about 1 kB a word while its trees exist.

Defined results: null, empty and blank texts have no words and no runs, and
hash as empty; a null id is never changed by ``repeat_tail``; repeated rows
give a row each; further columns are ignored; an empty table gives an empty
result.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollcall.llm.common import map_batches

MIN_WORDS = 24
MIN_PERIODS = 3
GRAM = 8
PIECE = 1 << 23
MAX_SPLITS = 64
_BLANK = re.compile(rb"[\x20\x09-\x0D]")


# ------------------------------------------------------- suffix tree ----

def suffix_tree(s: list[int]) -> tuple[list[int], list[int], list[dict | None]]:
    """Ukkonen's tree of ``s``, whose last symbol must be unique: (start, end,
    children) of every node; node 0 is the root, leaves have no children."""
    n = len(s)
    start, end, link, kids = [0], [0], [0], [{}]
    node = edge = length = rest = 0
    for i, c in enumerate(s):
        rest += 1
        last = 0
        while rest:
            if not length:
                edge = i
            branch = kids[node]
            k = branch.get(s[edge])
            if k is None:
                branch[c] = len(start)
                start.append(i)
                end.append(n)
                link.append(0)
                kids.append(None)
                target = node
            else:
                a = start[k]
                stop = end[k]
                span = (stop if stop <= i else i + 1) - a
                if length >= span:
                    node = k
                    edge += span
                    length -= span
                    continue
                if s[a + length] == c:
                    length += 1
                    if last:
                        link[last] = node
                    break
                target = len(start)
                branch[s[edge]] = target
                start += (a, i)
                end += (a + length, n)
                link += (0, 0)
                kids.append({c: target + 1, s[a + length]: k})
                kids.append(None)
                start[k] = a + length
            if last:
                link[last] = target
            last = target
            rest -= 1
            if node:
                node = link[node]
            elif length:
                length -= 1
                edge = i - rest + 1
    return start, end, kids


class Extensions:
    """Longest common extensions of the suffixes of ``s`` (a list of numbers
    >= 0), to which a unique end of -1 is added."""

    def __init__(self, s: list[int]):
        self.n = len(s) + 1
        self.start, self.end, self.kids = suffix_tree([*s, -1])
        n, start, end, kids = self.n, self.start, self.end, self.kids
        depth = [0] * len(start)
        first = [0] * n
        tour, order = [], []
        stack = [0]
        while stack:
            v = stack.pop()
            if v < 0:
                tour.append(depth[~v])
                continue
            d = depth[v]
            branch = kids[v]
            if branch is None:
                first[n - d] = len(tour)
                order.append(n - d)
            else:
                for c in sorted(branch, reverse=True):
                    w = branch[c]
                    depth[w] = d + end[w] - start[w]
                    stack += (~v, w)
            tour.append(d)
        self.first, self.tour, self.order = np.array(first), np.array(tour, np.int32), order
        self.depth = depth

    def reversed_order(self) -> list[int]:
        """Suffixes in order of the reversed alphabet; the end stays smallest."""
        n, kids, depth = self.n, self.kids, self.depth
        out, stack = [], [0]
        while stack:
            v = stack.pop()
            branch = kids[v]
            if branch is None:
                out.append(n - depth[v])
                continue
            stack += [branch[c] for c in sorted(branch) if c >= 0]
            if -1 in branch:
                stack.append(branch[-1])
        return out

    def lce(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Common prefix lengths of the suffixes at ``i`` and ``j`` (i != j):
        minima of the tour between their leaves, one level of the sparse table
        at a time."""
        a, b = self.first[i], self.first[j]
        lo, hi = np.minimum(a, b), np.maximum(a, b)
        level = np.frexp((hi - lo + 1).astype(np.float64))[1] - 1
        out = np.zeros(len(lo), np.int64)
        row, k = self.tour, 0
        for k in range(int(level.max()) + 1 if len(level) else 0):
            if k:
                half = 1 << (k - 1)
                row = np.minimum(row[:-half], row[half:])
            at = np.flatnonzero(level == k)
            out[at] = np.minimum(row[lo[at]], row[hi[at] - (1 << k) + 1])
        return out


def next_smaller(order: list[int]) -> np.ndarray:
    """For each place the next place whose suffix is smaller, given the
    suffixes in order; the last place holds the end."""
    n = len(order)
    rank = [0] * n
    for r, i in enumerate(order):
        rank[i] = r
    out = np.zeros(n, np.int64)
    stack: list[int] = []
    for i, r in enumerate(rank):
        while stack and rank[stack[-1]] > r:
            out[stack.pop()] = i
        stack.append(i)
    return out


def repetitions(s: list[int]) -> np.ndarray:
    """All maximal repetitions of ``s`` with at least two periods, as rows
    (start, end, period) in order."""
    n = len(s)
    ahead, back = Extensions(s), Extensions(s[::-1])
    found = []
    for order in (ahead.order, ahead.reversed_order()):
        i = np.arange(n)
        p = next_smaller(order)[:n] - i
        some = 2 * p <= n
        i, p = i[some], p[some]
        right = ahead.lce(i, i + p)
        left = back.lce(n - i, n - i - p)
        root = left + right >= p
        found.append(np.stack([i - left, i + p + right, p], axis=1)[root])
    return np.unique(np.concatenate(found), axis=0)


# ------------------------------------------------------------ documents ----

def stretches(ids: np.ndarray) -> list[tuple[int, int]]:
    """[start, end) of the parts of a text in which its runs are seen from
    their second period on, with the word after them."""
    n = len(ids) - GRAM + 1
    if len(ids) < MIN_WORDS:
        return []
    words = ids.astype(np.uint64) + np.uint64(1)
    grams = np.zeros(n, np.uint64)
    for j in range(GRAM):
        grams = grams * np.uint64(0x9E3779B97F4A7C15) + words[j:j + n]
    order = np.argsort(grams, kind="stable")
    again = np.flatnonzero(grams[order[1:]] == grams[order[:-1]])
    if not len(again):
        return []
    back = np.full(n, n + len(ids))
    back[order[again + 1]] = order[again + 1] - order[again]
    # places of a shortest run: MIN_WORDS - q - 7 or 2q - 7, whichever is more
    least = min(max(MIN_WORDS - q, (MIN_PERIODS - 1) * q) for q in range(1, MIN_WORDS)) - GRAM + 1
    out, todo = [], [(0, n, 0)]
    while todo:
        x, y, round_ = todo.pop()
        far = back[x:y] > min(n, (y - x + GRAM - 1) // (MIN_PERIODS - 1))
        if not far.any() or round_ > MAX_SPLITS:
            out.append((x, min(len(ids), y + GRAM)))
            continue
        edges = np.flatnonzero(np.diff(np.concatenate([[True], far, [True]]).astype(np.int8)))
        for lo, hi in edges.reshape(-1, 2).tolist():
            if hi - lo >= least:
                todo.append((x + lo, x + hi, round_ + 1))
    return sorted(out)


def _same(ids: np.ndarray, i: int, j: int, step: int) -> int:
    """How many words from ``i`` and ``j`` on (i < j), walking by ``step``,
    are the same before a text's end or a difference."""
    room = len(ids) - j if step > 0 else i + 1
    done, size = 0, 64
    while done < room:
        m = min(size, room - done)
        if step > 0:
            a, b = ids[i + done:i + done + m], ids[j + done:j + done + m]
        else:
            a, b = ids[i - done - m + 1:i - done + 1][::-1], ids[j - done - m + 1:j - done + 1][::-1]
        differ = np.flatnonzero(a != b)
        if len(differ):
            return done + int(differ[0])
        done, size = done + m, size * 2
    return done


def text_runs(ids: np.ndarray) -> list[tuple[int, int, int]]:
    """Runs (start, length, period) of a text of word numbers, by start and
    period."""
    runs = set()
    for x, y in stretches(ids):
        part = ids[x:y]
        for lo, hi, p in repetitions(np.unique(part, return_inverse=True)[1].tolist()).tolist():
            border = (lo == 0 and x > 0) or (hi == y - x and y < len(ids))
            if not border and hi - lo < max(MIN_WORDS, MIN_PERIODS * p):
                continue
            lo, hi = lo + x, hi + x
            if border:
                hi += _same(ids, hi - p, hi, 1) if hi < len(ids) else 0
                lo -= _same(ids, lo - 1, lo - 1 + p, -1) if lo else 0
            if hi - lo >= max(MIN_WORDS, MIN_PERIODS * p):
                runs.add((lo, hi - lo, p))
    return sorted(runs, key=lambda r: (r[0], r[2]))


def word_numbers(text: bytes) -> tuple[np.ndarray, list[bytes]]:
    """(number of every word, the word of each number)."""
    table: dict[bytes, int] = {}
    parts, at = [], 0
    while at < len(text):
        cut = _BLANK.search(text, at + PIECE) if len(text) - at > PIECE else None
        to = cut.end() if cut else len(text)
        parts.append(np.array([table.setdefault(w, len(table)) for w in text[at:to].split()], np.int32))
        at = to
    return (np.concatenate(parts) if parts else np.zeros(0, np.int32)), list(table)


def repeat_tail(doc_id, ids: np.ndarray) -> np.ndarray:
    """The words of one document in ten, chosen by its id's CRC-32, with the
    words from a place on repeated with a period."""
    if doc_id is None or not len(ids):
        return ids
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return ids
    g, n = h // 10, len(ids)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return np.concatenate([ids[:a], np.resize(ids[a:a + p], n - a)])


def joined_sha256(ids: np.ndarray, words: list[bytes]) -> str:
    """Digest of the words joined by one space each."""
    sha = hashlib.sha256()
    for lo in range(0, len(ids), 1 << 16):
        if lo:
            sha.update(b" ")
        sha.update(b" ".join([words[i] for i in ids[lo:lo + (1 << 16)].tolist()]))
    return sha.hexdigest()


def runs_of(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
            change: Callable[[object, np.ndarray], np.ndarray] | None = None) -> DataFrame:
    """Per document: doc_id, n_words, runs (start, length, period each) and
    collapsed_sha256, the digest of the words that aren't dropped.  ``change``
    turns a document's id and word numbers into the word numbers to search."""
    kind = T.ArrayType(T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")]))

    def one(doc, raw: bytes | None):
        ids, words = word_numbers(raw or b"")
        if change is not None:
            ids = change(doc, ids)
        runs = text_runs(ids)
        keep = ids
        if runs:
            stays = np.ones(len(ids), bool)
            for start, length, period in runs:
                stays[start + period:start + length] = False
            keep = ids[stays]
        return len(ids), [dict(zip(("start", "length", "period"), r)) for r in runs], joined_sha256(keep, words)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = [one(d.as_py(), t.as_py()) for d, t in zip(batch.column(0), batch.column(1))]
        struct = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], struct),
             pa.array([r[2] for r in rows], pa.string())], names=["doc_id", "n_words", "runs", "collapsed_sha256"])

    src = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").cast("binary").alias("text"))
    schema = T.StructType([src.schema["doc_id"], T.StructField("n_words", T.LongType()),
                           T.StructField("runs", kind), T.StructField("collapsed_sha256", T.StringType())])
    return map_batches(src, run, schema)


def collapse(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with each run cut back to its first period.  Texts with a run
    become their remaining words joined by one space; the others stay as they
    are."""

    def shorter(raw: bytes | None) -> bytes | None:
        ids, words = word_numbers(raw or b"")
        runs = text_runs(ids)
        if not runs:
            return raw
        stays = np.ones(len(ids), bool)
        for start, length, period in runs:
            stays[start + period:start + length] = False
        return b" ".join([words[i] for i in ids[stays].tolist()])

    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(at)
            short = pa.array([shorter(t.as_py()) for t in column.cast(pa.binary())], pa.binary()).cast(column.type)
            yield batch.set_column(at, batch.schema.field(at), short)

    return docs.mapInArrow(run, docs.schema)


def report(found: DataFrame) -> DataFrame:
    """The digest columns of ``runs_of``: the run with the greatest exponent
    (ties: smallest start, then period), and hashes of all runs and of the
    remaining words."""
    # length / period compared exactly, by cross-multiplication
    better = ("CASE WHEN a IS NULL THEN x "
              "WHEN cast(x.length as decimal(20,0)) * a.period > cast(a.length as decimal(20,0)) * x.period THEN x "
              "ELSE a END")
    best = F.expr(f"aggregate(runs, cast(null as struct<start:bigint,length:bigint,period:bigint>), (a, x) -> {better})")
    lines = F.expr("concat_ws('', transform(runs, x -> concat(x.start, ',', x.length, ',', x.period, '\\n')))")
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"),
        F.col("best.length").alias("length"), F.col("best.period").alias("period"),
        F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), "collapsed_sha256")
