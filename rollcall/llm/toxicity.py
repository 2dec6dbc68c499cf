"""Toxicity by cumulative-link ordinal regression (operator 8).

Severity grades 0..K-1 follow P(grade > j | x) = sigmoid(w . x - c_j) with one
weight vector w for all ordered thresholds c_0 <= c_1 <= ...; the score is the
expected severity, the sum of these probabilities.

Features are sparse: the distinct words of the lower-cased whole text and the
words' beginnings of ``PREFIXES`` bytes, by 64-bit hash.  Those that are
significantly more frequent among toxic than among other labelled texts
(z >= ``MIN_Z`` of the log-odds ratio, at least ``MIN_TEXTS`` toxic texts) are
kept, at most ``MAX_FEATURES``.

``labels`` marks a text toxic or not.  Grade 0 is not toxic; toxic texts are
graded 1 .. GRADES-1 by equal shares of the density of kept features in them
(the labels hold no finer judgement).

Fitting uses a sample of the labelled rows bounded by ``MAX_LABELLED`` (those
with the smallest hash of the id, whatever the input's size); choosing
features and fitting take a bounded amount of memory.  Scoring covers every
document.

Defined results: null and empty texts have no features; repeated rows each
get a row; labels that disagree for one id count as toxic; without any toxic
label the expected severity is 0 for every text; columns other than the id and
text are ignored by ``score`` and kept by ``drop_toxic``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollcall.llm import textvec as V
from rollcall.llm.common import free_name, list_column, map_batches, stash

PREFIXES = tuple(range(3, 13))
MAX_LABELLED = 20_000
MAX_FEATURES = 4096
MIN_TEXTS = 2
MIN_Z = 2.5
GRADES = 4
REJECT = 0.4   # smallest P(grade > 0) of a rejected text
L2 = 1.0


def features(data: np.ndarray, offsets: np.ndarray, keep: np.ndarray | None = None):
    """(hashes, texts, n_words): distinct features of each text, restricted to
    the sorted ``keep`` if given, with the number of times each occurs."""
    words = V.Words(data, offsets, V.WORD)
    parts, owners = [], []
    if len(words):
        sums = words.prefix_sums()
        back = V.powers(pow(V._P, -1, V._M), len(words.data))[words.start]
        base, length = sums[words.start], words.end - words.start
        bits = _bits(keep) if keep is not None else None
        for p in (0, *PREFIXES):
            long = np.flatnonzero(length > p) if p else np.arange(len(words))
            end = words.start[long] + p if p else words.end
            h = V.mix((sums[end] - base[long]) * back[long] + np.uint64((p + 1) * V._Q % V._M))
            if bits is not None:
                near = bits[(h >> np.uint64(44)).astype(np.int64)]
                h, long = h[near], long[near]
                if len(h):
                    at = np.minimum(np.searchsorted(keep, h), len(keep) - 1)
                    hit = keep[at] == h
                    h, long = h[hit], long[hit]
            parts.append(h)
            owners.append(words.text[long])
    h = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
    owner = np.concatenate(owners) if owners else np.zeros(0, np.int64)
    order = np.lexsort((h, owner))
    h, owner = h[order], owner[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
    at = np.flatnonzero(new)
    return h[at], owner[at], np.diff(np.append(at, len(h))), words.counts


def _bits(keep: np.ndarray) -> np.ndarray:
    """Which of 2**20 top-bit values occur in ``keep``: a quick first test."""
    bits = np.zeros(1 << 20, bool)
    bits[(keep >> np.uint64(44)).astype(np.int64)] = True
    return bits


@dataclass
class OrdinalModel:
    """Cumulative-link model: feature hashes (sorted), their shared weights
    and the ordered cuts."""

    keep: np.ndarray
    weights: np.ndarray
    cuts: np.ndarray

    def severity(self, z: np.ndarray) -> np.ndarray:
        """P(grade > j) for every linear score: array [text, j]."""
        return 1 / (1 + np.exp(-np.clip(z[:, None] - self.cuts[None, :], -40, 40)))

    def linear(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        z = np.zeros(len(offsets) - 1)
        if len(self.keep):
            h, owner, _, _ = features(data, offsets, self.keep)
            np.add.at(z, owner, self.weights[np.searchsorted(self.keep, h)])
        return z


def fit_ordinal(indptr: np.ndarray, indices: np.ndarray, grades: np.ndarray, n_features: int,
                n_grades: int, steps: int = 400, rate: float = 0.1, l2: float = L2):
    """Weights and cuts by Adam on the mean negative log-likelihood of
    P(y = j) = s(c_j - z) - s(c_{j-1} - z) with an L2 penalty.  Cuts are the
    first cut plus positive gaps, so that they stay ordered."""
    n = len(grades)
    owner = np.repeat(np.arange(n), np.diff(indptr))
    w, first, gaps = np.zeros(n_features), 2.0, np.zeros(n_grades - 2)
    params = np.concatenate([w, [first], gaps])
    m, v = np.zeros_like(params), np.zeros_like(params)
    for t in range(1, steps + 1):
        w, first, gaps = params[:n_features], params[n_features], params[n_features + 1:]
        cuts = first + np.concatenate([[0.0], np.cumsum(np.exp(gaps))])
        z = np.bincount(owner, w[indices], n)
        above = 1 / (1 + np.exp(-np.clip(z[:, None] - cuts[None, :], -40, 40)))
        bounds = np.concatenate([np.ones((n, 1)), above, np.zeros((n, 1))], axis=1)
        rows = np.arange(n)
        upper, lower = bounds[rows, grades], bounds[rows, grades + 1]
        p = np.maximum(upper - lower, 1e-12)
        # d(upper)/dz = upper(1-upper), d(upper)/dcut = -that
        du, dl = upper * (1 - upper) / p, lower * (1 - lower) / p
        dz = -(du - dl) / n
        dcut = np.zeros(n_grades + 1)
        np.add.at(dcut, grades, du / n)
        np.add.at(dcut, grades + 1, -dl / n)
        dcut = dcut[1:-1]
        grad = np.concatenate([np.bincount(indices, dz[owner], n_features) + l2 * w / n_features,
                               [dcut.sum()], np.exp(gaps) * np.cumsum(dcut[::-1])[::-1][1:]])
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        params = params - rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    cuts = params[n_features] + np.concatenate([[0.0], np.cumsum(np.exp(params[n_features + 1:]))])
    return params[:n_features], cuts


def labelled_sample(docs: DataFrame, labels: DataFrame, doc_id: str, text: str, label: str) -> DataFrame:
    """(_id, toxic, text) of at most ``MAX_LABELLED`` labelled documents; of a
    repeated id one text, the smallest."""
    known = labels.where(F.col(label).isNotNull() & F.col(doc_id).isNotNull()).groupBy(
        F.col(doc_id).alias("_id")).agg(F.max(F.col(label).cast("int")).alias("toxic"))
    known = known.orderBy(F.xxhash64("_id"), "_id").limit(MAX_LABELLED)
    rows = docs.select(F.col(doc_id).alias("_id"), F.col(text).cast("string").alias("text"))
    rows = rows.join(F.broadcast(known), "_id")  # at most MAX_LABELLED rows
    return rows.groupBy("_id", "toxic").agg(F.min("text").alias("text"))


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
        label: str = "toxic") -> OrdinalModel:
    """Choose features and fit the model on the bounded labelled sample."""
    sample = stash(labelled_sample(docs, labels, doc_id, text, label).repartition(
        int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))), "toxicity-sample")

    def counts(keep: np.ndarray | None):
        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = [features(d, o, keep)[0] for _, _, d, o in V.chunks(batch.column(0))]
            h, n = np.unique(np.concatenate(found), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n)], names=["h", "n"])
        return run

    def texts_with(part: DataFrame, keep, least: int) -> dict[int, int]:
        got = (map_batches(part.select("text"), counts(keep), "h bigint, n bigint")
               .groupBy("h").agg(F.sum("n").alias("n")).where(F.col("n") >= least).toPandas())
        return dict(zip(got["h"].to_numpy(np.int64).view(np.uint64).tolist(), got["n"].tolist()))

    totals = {r["toxic"] > 0: r["n"] for r in sample.groupBy((F.col("toxic") > 0).cast("int").alias("toxic"))
              .agg(F.count("*").alias("n")).collect()}
    bad, good = totals.get(True, 0), totals.get(False, 0)
    in_bad = texts_with(sample.where("toxic > 0"), None, MIN_TEXTS)
    known = np.array(sorted(in_bad), np.uint64)
    in_good = texts_with(sample.where("toxic = 0"), known, 1) if len(known) else {}
    a = np.array([in_bad[x] for x in known.tolist()], float)
    b = np.array([in_good.get(x, 0) for x in known.tolist()], float)
    z = (np.log((a + 0.5) / (bad - a + 0.5)) - np.log((b + 0.5) / (good - b + 0.5))) / np.sqrt(
        1 / (a + 0.5) + 1 / (b + 0.5))
    best = np.lexsort((known, -z))[:MAX_FEATURES]
    keep = np.sort(known[best[z[best] >= MIN_Z]])
    if not len(keep):
        return OrdinalModel(keep, np.zeros(0), np.full(GRADES - 1, 40.0))

    def encode(batch: pa.RecordBatch) -> pa.RecordBatch:
        at, per, density = [], [], []
        for _, _, d, o in V.chunks(batch.column(1)):
            h, owner, times, n_words = features(d, o, keep)
            at.append(np.searchsorted(keep, h))
            per.append(np.bincount(owner, minlength=len(n_words)))
            density.append(np.bincount(owner, times, len(n_words)) / np.maximum(1, n_words))
        return pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(2), list_column(np.concatenate(at), np.concatenate(per), pa.int32()),
             pa.array(np.concatenate(density))], names=["toxic", "id_hash", "at", "density"])

    rows = map_batches(sample.select("toxic", "text", F.xxhash64("_id").alias("id_hash")), encode,
                       "toxic int, id_hash bigint, at array<int>, density double")
    rows = rows.toPandas().sort_values(["id_hash", "density"], kind="stable")  # at most MAX_LABELLED rows
    toxic = rows["toxic"].to_numpy() > 0
    edges = np.quantile(rows["density"].to_numpy()[toxic], np.arange(1, GRADES - 1) / (GRADES - 1))
    grades = np.where(toxic, 1 + np.searchsorted(edges, rows["density"].to_numpy(), "right"), 0)
    indptr = np.concatenate([[0], np.cumsum([len(x) for x in rows["at"]])])
    weights, cuts = fit_ordinal(indptr, np.concatenate(rows["at"].tolist()).astype(np.int64), grades,
                                len(keep), GRADES)
    return OrdinalModel(keep, weights, cuts)


def with_severity(docs: DataFrame, model: OrdinalModel, text: str = "text", severity: str = "severity",
                  toxic_p: str = "toxic_p") -> DataFrame:
    """``docs`` with the expected severity and P(grade > 0) of each text."""
    at = docs.columns.index(text)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        z = np.concatenate([model.linear(d, o) for _, _, d, o in V.chunks(batch.column(at))])
        p = model.severity(z)
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(p.sum(axis=1)), pa.array(p[:, 0])],
                                          names=[*batch.schema.names, severity, toxic_p])

    schema = T.StructType([*docs.schema.fields, T.StructField(severity, T.DoubleType()),
                           T.StructField(toxic_p, T.DoubleType())])
    return map_batches(docs, run, schema)


def score(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
          label: str = "toxic") -> DataFrame:
    """Per document: doc_id, severity (expected grade), toxic_p, rejected."""
    model = fit(docs, labels, doc_id, text, label)
    out = with_severity(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), model)
    return out.select("doc_id", "severity", "toxic_p", (F.col("toxic_p") >= REJECT).alias("rejected"))


def drop_toxic(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
               label: str = "toxic") -> DataFrame:
    """The rows of ``docs`` that aren't rejected."""
    model = fit(docs, labels, doc_id, text, label)
    severity, toxic_p = (free_name(docs.columns, n) for n in ("severity", "toxic_p"))
    scored = with_severity(docs, model, text, severity, toxic_p)
    return scored.where(F.col(toxic_p) < REJECT).select(*docs.columns)
