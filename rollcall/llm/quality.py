"""Quality classifier: histogram gradient-boosted trees (operator 3).

Every whole text becomes a vector of document statistics (``STATISTICS``).
Boosting fits logistic loss by Newton steps: features are cut into at most
``BINS`` quantile bins, a node's gradient and Hessian histograms over the bins
give its best split, and trees of a fixed depth are grown level by level.
The ensemble is flattened into arrays (feature, threshold, left child, value),
which numpy walks for a whole batch of texts at once.

Statistics are computed once for all documents and stashed; the fit uses the
labelled rows' statistics, bounded by ``MAX_LABELLED`` rows (those with the
smallest hash of the id): 50,000 rows of 24 numbers.  Scoring covers all
documents.

Held out: crc32 of the id's text modulo 5 equals 0 (a null id counts as
empty text, so it is held out).  Labels of held-out rows, and lang, source and
id, are never inputs.

Defined results: null and empty texts have all statistics 0 and a score like
any other; repeated rows each get a row; labels that disagree for one id count
by their majority (a tie as 1); without labels of both kinds the score is the
labelled share of 1 (0.5 without labels).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollcall.llm import textvec as V
from rollcall.llm.common import list_column, map_batches, stash

MAX_LABELLED = 50_000
HELD_OUT_MOD = 5
THRESHOLD = 0.3
BINS = 64
TREES, DEPTH, RATE, MIN_HESSIAN, L2 = 60, 4, 0.15, 1.0, 1.0

STATISTICS = (
    "log_bytes", "log_words", "log_lines", "bytes_per_word", "longest_word", "words_per_line",
    "upper", "lower", "digit", "space", "newline", "symbol", "pipe", "bang", "comma", "period",
    "non_ascii", "other_punct", "distinct_words", "top_word", "repeated_lines", "capitalised",
    "ends_in_punct", "distinct_shingles",
)
_CLASSES = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "lower": b"abcdefghijklmnopqrstuvwxyz", "digit": b"0123456789",
    "space": b" \t", "newline": b"\n", "symbol": b"#$%&*@^~=+<>\\/", "pipe": b"|", "bang": b"!?",
    "comma": b",;:", "period": b".", "other_punct": b"\"'()[]{}-_`",
}
_CLASS_OF = np.full(256, len(_CLASSES), np.uint8)  # all others, control bytes included
for _i, _chars in enumerate(_CLASSES.values()):
    _CLASS_OF[list(_chars)] = _i
_CLASS_OF[128:] = len(_CLASSES) + 1


def _per_text(owner: np.ndarray, n: int, weights=None) -> np.ndarray:
    return np.bincount(owner, weights, n).astype(float)


def _distinct(values: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Per text: number of distinct values, and of the most frequent one."""
    order = np.lexsort((values, owner))
    v, o = values[order], owner[order]
    new = np.ones(len(v), bool)
    new[1:] = (v[1:] != v[:-1]) | (o[1:] != o[:-1])
    at = np.flatnonzero(new)
    runs = np.diff(np.append(at, len(v)))
    top = np.zeros(n)
    np.maximum.at(top, o[at], runs)
    return _per_text(o[at], n), top


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """float[text, statistic] of a chunk of whole texts."""
    n = len(offsets) - 1
    size = np.diff(offsets).astype(float)
    out = dict.fromkeys(STATISTICS, np.zeros(n))
    if not len(data):
        return np.zeros((n, len(STATISTICS)))
    owner = np.repeat(np.arange(n), np.diff(offsets))
    kinds = len(_CLASSES) + 2
    shares = np.bincount(owner * kinds + _CLASS_OF[data], minlength=n * kinds).reshape(n, kinds) / np.maximum(
        1, size)[:, None]
    for i, name in enumerate(_CLASSES):
        out[name] = shares[:, i]
    out["non_ascii"] = shares[:, -1]

    words = V.Words(data, offsets, V.NONSPACE)
    count = words.counts.astype(float)
    some = np.maximum(1, count)
    length = words.end - words.start
    longest = np.zeros(n)
    np.maximum.at(longest, words.text, length)
    lines = shares[:, list(_CLASSES).index("newline")] * size + (size > 0)
    out |= {"log_bytes": np.log1p(size), "log_words": np.log1p(count), "log_lines": np.log1p(lines),
            "bytes_per_word": size / some, "longest_word": np.log1p(longest),
            "words_per_line": count / np.maximum(1, lines)}
    if len(words):
        hashes = words.hashes()
        distinct, top = _distinct(hashes, words.text, n)
        out["distinct_words"], out["top_word"] = distinct / some, top / some
        first = data[words.start]
        last = data[words.end - 1]
        out["capitalised"] = _per_text(words.text, n, (first >= 65) & (first <= 90)) / some
        out["ends_in_punct"] = _per_text(words.text, n, np.isin(last, np.frombuffer(b".,;:!?#$%&*|", np.uint8))) / some
        h, at = V.shingles(hashes, words.text, 3)
        if len(h):
            out["distinct_shingles"] = _distinct(h, words.text[at], n)[0] / np.maximum(1, count - 2)
    line_table = np.ones(256, bool)
    line_table[10] = False
    whole = V.Words(data, offsets, line_table)
    if len(whole):
        distinct, _ = _distinct(whole.hashes(), whole.text, n)
        out["repeated_lines"] = 1 - distinct / np.maximum(1, whole.counts)
    return np.stack([out[s] for s in STATISTICS], axis=1)


@dataclass
class Trees:
    """An ensemble as flat arrays; node i's children are left[i], left[i]+1,
    and a leaf points to itself with an infinite threshold."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    base: float
    depth: int

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Probabilities of label 1 for rows of statistics."""
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for root in self.roots:
            node = np.full(len(x), root)
            for _ in range(self.depth):
                go_right = x[rows, self.feature[node]] > self.threshold[node]
                node = self.left[node] + go_right
            total += self.value[node]
        return 1 / (1 + np.exp(-total))


def fit_trees(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH) -> Trees:
    """Histogram boosting of logistic loss."""
    share = (y.sum() + 0.5) / (len(y) + 1) if len(y) else 0.5
    base = float(np.log(share / (1 - share)))
    nodes: list[list] = []  # [feature, threshold, left, value]
    roots: list[int] = []
    if 0 < y.sum() < len(y):
        cuts = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
        bins = np.stack([np.searchsorted(c, v, "left") for c, v in zip(cuts, x.T)], axis=1)
        score = np.full(len(y), base)
        features = x.shape[1]
        flat = bins + np.arange(features) * BINS
        for _ in range(trees):
            p = 1 / (1 + np.exp(-score))
            g, h = y - p, p * (1 - p)
            where = np.zeros(len(y), np.int64)  # node of each row
            roots.append(len(nodes))
            nodes.append([0, np.inf, len(nodes), 0.0])
            where[:] = roots[-1]
            level = [roots[-1]]
            for _ in range(depth):
                grown = []
                for node in level:
                    rows = np.flatnonzero(where == node)
                    cells = flat[rows].ravel()
                    hg = np.bincount(cells, np.repeat(g[rows], features), features * BINS).reshape(features, BINS)
                    hh = np.bincount(cells, np.repeat(h[rows], features), features * BINS).reshape(features, BINS)
                    lg, lh = hg.cumsum(axis=1)[:, :-1], hh.cumsum(axis=1)[:, :-1]
                    tg, th = g[rows].sum(), h[rows].sum()
                    rg, rh = tg - lg, th - lh
                    gain = lg ** 2 / (lh + L2) + rg ** 2 / (rh + L2) - tg ** 2 / (th + L2)
                    gain[(lh < MIN_HESSIAN) | (rh < MIN_HESSIAN)] = -np.inf
                    f, b = divmod(int(gain.argmax()), BINS - 1)
                    if gain[f, b] <= 1e-6 or b >= len(cuts[f]):
                        continue
                    left = len(nodes)
                    nodes.append([0, np.inf, left, 0.0])
                    nodes.append([0, np.inf, left + 1, 0.0])
                    nodes[node][:3] = [f, float(cuts[f][b]), left]
                    where[rows] = left + (bins[rows, f] > b)
                    grown += [left, left + 1]
                level = grown
            sums_g, sums_h = np.bincount(where, g, len(nodes)), np.bincount(where, h, len(nodes))
            for node in range(roots[-1], len(nodes)):
                if nodes[node][2] == node:
                    nodes[node][3] = RATE * float(sums_g[node] / (sums_h[node] + L2))
            values = np.array([v[3] for v in nodes])
            score += values[where]
    # a leaf that is a left child stays at itself: threshold is infinite
    feature, threshold, left, value = (np.array([v[i] for v in nodes]) for i in range(4)) if nodes else (
        np.zeros(0, int), np.zeros(0), np.zeros(0, int), np.zeros(0))
    return Trees(feature.astype(np.int64), threshold, left.astype(np.int64), value,
                 np.array(roots, np.int64), base, depth)


def document_statistics(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, x): the statistics of every whole text."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = np.concatenate([statistics(d, o) for _, _, d, o in V.chunks(batch.column(1))])
        return pa.RecordBatch.from_arrays(
            [batch.column(0), list_column(x.ravel(), np.full(len(x), x.shape[1]), pa.float64())],
            names=["doc_id", "x"])

    src = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    return map_batches(src, run, f"doc_id {src.schema['doc_id'].dataType.simpleString()}, x array<double>")


def held_out(doc_id):
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % HELD_OUT_MOD == 0


def score(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
          label: str = "quality") -> DataFrame:
    """Per document: doc_id, held_out, score, predicted."""
    stats = stash(document_statistics(docs, doc_id, text), "statistics")
    known = (labels.where(F.col(label).isNotNull() & F.col(doc_id).isNotNull()).where(~held_out(doc_id))
             .groupBy(F.col(doc_id).alias("_id")).agg((F.avg(label) >= 0.5).cast("int").alias("y"))
             .orderBy(F.xxhash64("_id"), "_id").limit(MAX_LABELLED))
    sample = (stats.join(known, stats["doc_id"] == known["_id"]).select("y", "x", F.xxhash64("_id", "x").alias("o"))
              .orderBy("o").limit(MAX_LABELLED).toPandas())  # bounded rows
    sample = sample.sort_values("o", kind="stable")
    x = np.stack(sample["x"].to_list()) if len(sample) else np.zeros((0, len(STATISTICS)))
    trees = fit_trees(x, sample["y"].to_numpy(float))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = batch.column(1).flatten().to_numpy().reshape(-1, len(STATISTICS))
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(trees.predict(rows))],
                                          names=["doc_id", "score"])

    schema = T.StructType([stats.schema["doc_id"], T.StructField("score", T.DoubleType())])
    return map_batches(stats, run, schema).select(
        "doc_id", held_out("doc_id").alias("held_out"), "score",
        F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"))
