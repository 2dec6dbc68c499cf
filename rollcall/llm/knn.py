"""Exact top-k inner-product search with KD-trees per shard (operator 2).

Vectors become integer vectors floor(64 * x).  Candidates are dealt to shards:
the leaf of a small KD-tree whose median splits come from a bounded hash
sample (``CELL_SAMPLE`` rows and ``CELL_VALUES`` components, as float32), salted where a leaf holds more than
``SHARD_ROWS`` rows (many equal vectors, say).  The sample decides where rows
lie, never which take part.  Each shard is one row holding a KD-tree over its
vectors: median splits on the widest side, tight bounding boxes per node.

Queries travel in blocks of ``BLOCK`` queries that share a home shard:

1. Home round: a block searches its own shard only, which gives each query a
   kth score at once.
2. All other shards: the block arrives with these kth scores.  A node is
   entered only if its box can hold a score that reaches the kth best so far,
   sum_j max(q_j * lo_j, q_j * hi_j) >= kth, best nodes first, and every leaf
   raises the kth score.

A tie with the kth score may still win by its smaller id, so that bounds equal
to it are entered.  Blocks are joined with shards by shard number (a stated
query set against all rows, in blocks); memory per task is one shard and one
block.

Defined results: a vector that is null or has null or non-finite components,
or a null id, takes no part; shorter vectors count as padded with zeros; with
fewer than k candidates all are returned; rows with the same id are never each
other's results; repeated rows are candidates of their own, and the query of a
repeated id is asked once (its first row by components); an empty table gives
no rows; further columns are ignored.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollcall.llm.common import fixed_binary, list_column, map_batches, stash

SCALE = 64
SHARD_ROWS = 8192
CELL_SAMPLE = 100_000
CELL_VALUES = 2_000_000  # components that the sample holds at most, about
LEAF_ROWS = 256
BLOCK = 256


def quantised(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """(vec_id, v): the integer vectors that take part."""
    x = F.col(embedding).cast("array<double>")
    ok = (F.col(vec_id).isNotNull() & F.col(embedding).isNotNull()
          & ~F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))))
    return vectors.where(ok).select(F.col(vec_id).cast("bigint").alias("vec_id"),
                                    F.transform(x, lambda c: F.floor(SCALE * c)).alias("v"))


def _matrix(column: pa.Array, dim: int, kind: type = np.int64) -> np.ndarray:
    """Rows of a list column as ``kind``, padded with zeros to ``dim``."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if len(lengths) and (lengths == dim).all():
        return flat.reshape(-1, dim).astype(kind, copy=False)
    out = np.zeros((len(lengths), dim), kind)
    rows = np.repeat(np.arange(len(lengths)), lengths)
    out[rows, np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return out


class KDTree:
    """Median splits on the widest side with tight boxes; node i's children
    are child[i], child[i] + 1 (0 marks a leaf), its rows lo[i]:hi[i]."""

    def __init__(self, ids: np.ndarray, points: np.ndarray, leaf: int = LEAF_ROWS):
        order = np.lexsort((ids,))
        self.ids, self.points = ids[order].copy(), points[order].copy()
        self.lo, self.hi, self.child = [0], [len(ids)], [0]
        at = 0
        while at < len(self.lo):
            lo, hi = self.lo[at], self.hi[at]
            part = self.points[lo:hi]
            if hi - lo > leaf:
                side = int((part.max(axis=0) - part.min(axis=0)).argmax())
                if part[:, side].max() > part[:, side].min():
                    mid = (hi - lo) // 2
                    split = np.argpartition(part[:, side], mid, kind="introselect")
                    self.points[lo:hi], self.ids[lo:hi] = part[split], self.ids[lo:hi][split]
                    self.child[at] = len(self.lo)
                    self.lo += [lo, lo + mid]
                    self.hi += [lo + mid, hi]
                    self.child += [0, 0]
            at += 1
        self.low = np.stack([self.points[a:b].min(axis=0) for a, b in zip(self.lo, self.hi)])
        self.high = np.stack([self.points[a:b].max(axis=0) for a, b in zip(self.lo, self.hi)])

    def bounds(self, q: np.ndarray) -> np.ndarray:
        """Largest possible score of each node's box: array [node, query]."""
        return self.high @ np.maximum(q, 0).T + self.low @ np.minimum(q, 0).T

    def search(self, queries: np.ndarray, own: np.ndarray, k: int, kth: np.ndarray):
        """(query, id, score) of every query's k best rows that can still
        reach ``kth`` (ties to smaller ids), rows with the query's id left out.

        The box bounds of all nodes are one matrix product; each query then
        walks the tree from its best node down."""
        exact = len(self.points) and self._fits(queries)
        points = self.points.astype(np.float64) if exact else self.points
        asked = queries.astype(np.float64) if exact else queries
        if exact:
            limit = self.high.astype(np.float64) @ np.maximum(asked, 0).T + self.low.astype(
                np.float64) @ np.minimum(asked, 0).T
        else:
            limit = self.bounds(queries)
        out = []
        for i in range(len(queries)):
            best, best_ids, least = np.zeros(0, np.int64), np.zeros(0, np.int64), kth[i]
            heap = [(-limit[0, i], 0)]
            while heap and -heap[0][0] >= least:
                node = heapq.heappop(heap)[1]
                if self.child[node]:
                    for c in (self.child[node], self.child[node] + 1):
                        if limit[c, i] >= least:
                            heapq.heappush(heap, (-limit[c, i], c))
                    continue
                a, b = self.lo[node], self.hi[node]
                score = points[a:b] @ asked[i]
                near = np.flatnonzero((score >= least) & (self.ids[a:b] != own[i]))
                if not len(near):
                    continue
                best = np.concatenate([best, score[near].astype(np.int64)])
                best_ids = np.concatenate([best_ids, self.ids[a:b][near]])
                if len(best) > k:
                    top = np.lexsort((best_ids, -best))[:k]
                    best, best_ids = best[top], best_ids[top]
                if len(best) == k:
                    least = max(least, int(best.min()))
            out.append((np.full(len(best), i), best_ids, best))
        return tuple(np.concatenate(c) if out else np.zeros(0, np.int64) for c in zip(*out))

    def _fits(self, queries: np.ndarray) -> bool:
        """Whether float64 sums of products are exact."""
        top = float(np.abs(self.points).max(initial=0)) * float(np.abs(queries).max(initial=0))
        return top * self.points.shape[1] < 2.0 ** 53

    def arrays(self) -> list[np.ndarray]:
        return [self.ids, self.points, np.array(self.lo), np.array(self.hi), np.array(self.child),
                self.low, self.high]

    @classmethod
    def of(cls, blob: bytes, dim: int) -> KDTree:
        n, nodes = np.frombuffer(blob, np.int64, 2)
        flat, at, parts = np.frombuffer(blob, np.int64, offset=16), 0, []
        for size in (n, n * dim, nodes, nodes, nodes, nodes * dim, nodes * dim):
            parts.append(flat[at:at + size])
            at += size
        tree = cls.__new__(cls)
        tree.ids, tree.points, tree.lo, tree.hi, tree.child = (
            parts[0], parts[1].reshape(n, dim), parts[2], parts[3], parts[4])
        tree.low, tree.high = parts[5].reshape(nodes, dim), parts[6].reshape(nodes, dim)
        return tree

    def blob(self) -> bytes:
        parts = self.arrays()
        return b"".join([np.array([len(self.ids), len(self.lo)]).tobytes()]
                        + [np.ascontiguousarray(p, np.int64).tobytes() for p in parts])


def _cells(sample: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(side, split) of a complete KD-tree of ``depth`` levels of medians."""
    side, split = np.zeros(1 << depth, np.int64), np.zeros(1 << depth)
    parts = {1: sample}
    for node in range(1, 1 << depth):
        part = parts.pop(node)
        if len(part):
            side[node] = int((part.max(axis=0) - part.min(axis=0)).argmax())
            split[node] = np.median(part[:, side[node]])
        right = part[:, side[node]] > split[node]
        parts[2 * node], parts[2 * node + 1] = part[~right], part[right]
    return side, split


def top_k(vectors: DataFrame, k: int, query_mod: int, vec_id: str = "vec_id",
          embedding: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score) for the queries whose id is divisible
    by ``query_mod``."""
    spark = vectors.sparkSession
    rows = stash(quantised(vectors, vec_id, embedding), "vectors")
    n, dim = rows.agg(F.count("*"), F.coalesce(F.max(F.size("v")), F.lit(0))).first()
    dim = max(1, dim)

    most = max(1, min(CELL_SAMPLE, CELL_VALUES // dim))
    share = int((1 << 62) * min(1.0, most / max(1, n)))
    sample = rows.where(F.shiftrightunsigned(F.xxhash64("vec_id", "v"), 2) < share).select(
        F.col("v").cast("array<float>").alias("v")).limit(2 * most).toArrow()["v"]
    sample = _matrix(sample.combine_chunks(), dim, np.float32) if len(sample) else np.zeros((0, dim), np.float32)
    depth = max(0, int(np.ceil(np.log2(max(1, n / (SHARD_ROWS / 2))))))
    depth = min(depth, max(0, int(np.log2(max(1, len(sample) / 4)))))
    side, split = _cells(sample, depth)

    def place(batch: pa.RecordBatch) -> pa.RecordBatch:
        v = _matrix(batch.column(1), dim)
        node = np.ones(len(v), np.int64)
        for _ in range(depth):
            node = 2 * node + (v[np.arange(len(v)), side[node]] > split[node])
        return pa.RecordBatch.from_arrays(
            [batch.column(0), list_column(v.ravel(), np.full(len(v), dim), pa.int64()),
             pa.array(node - (1 << depth))], names=["vec_id", "v", "cell"])

    placed = map_batches(rows, place, "vec_id bigint, v array<bigint>, cell bigint")
    # A cell with more than SHARD_ROWS rows is salted into several shards.
    salts = F.greatest(F.lit(1), F.ceil(F.col("rows") / SHARD_ROWS))
    counts = placed.groupBy("cell").agg(F.count("*").alias("rows")).select("cell", salts.alias("salts"))
    counts = {r["cell"]: r["salts"] for r in counts.where("salts > 1").collect()}  # cells: bounded by the sample
    many = F.lit(1)
    if counts:
        known = F.map_from_arrays(F.split(F.lit(",".join(map(str, counts))), ",").cast("array<bigint>"),
                                  F.split(F.lit(",".join(map(str, counts.values()))), ",").cast("array<bigint>"))
        many = F.coalesce(known[F.col("cell")], F.lit(1))
    shard = F.concat_ws("-", F.col("cell").cast("string"), F.pmod(F.xxhash64("vec_id", "v"), many).cast("string"))
    placed = stash(placed.select("vec_id", "v", shard.alias("shard")), "placed")

    def build(part: pa.Table) -> pa.Table:
        v = _matrix(part["v"].combine_chunks(), dim)
        tree = KDTree(part["vec_id"].to_numpy(), v)
        return pa.table({"shard": part["shard"].slice(0, 1), "tree": pa.array([tree.blob()], pa.binary())})

    # Vectors compress well, so that Spark would take tables of them for small and
    # broadcast them through the driver.
    trees = stash(placed.groupBy("shard").applyInArrow(build, "shard string, tree binary"), "trees").hint("merge")

    # Blocks of queries that share a home shard.
    asked = placed.where(F.pmod("vec_id", F.lit(query_mod)) == 0)
    asked = asked.groupBy("vec_id").agg(F.min(F.struct("v", "shard")).alias("x")).select(
        "vec_id", "x.v", F.col("x.shard").alias("home"))
    per_home = F.ceil(F.count("*").over(Window.partitionBy("home")) / BLOCK)
    asked = asked.withColumn("block", F.concat_ws("/", "home", F.pmod(F.xxhash64("vec_id"), per_home).cast("string")))

    def gather(part: pa.Table) -> pa.Table:
        ids, v = part["vec_id"].to_numpy(), _matrix(part["v"].combine_chunks(), dim)
        return pa.table({"home": part["home"].slice(0, 1), "ids": pa.array([ids.tobytes()], pa.binary()),
                         "queries": pa.array([v.tobytes()], pa.binary())})

    blocks = stash(asked.groupBy("block").applyInArrow(gather, "home string, ids binary, queries binary"), "blocks")
    floor = -(1 << 62)

    def search(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = []
        for tree, ids, queries, kth in zip(*(c.to_pylist() for c in batch.columns)):
            own = np.frombuffer(ids, np.int64)
            q = np.frombuffer(queries, np.int64).reshape(-1, dim)
            least = np.frombuffer(kth, np.int64) if kth else np.full(len(own), floor)
            at, vec, score = KDTree.of(tree, dim).search(q, own, k, least)
            found.append((own[at], vec, score))
        q, vec, score = (np.concatenate(c) for c in zip(*found))
        return pa.RecordBatch.from_arrays([pa.array(q), pa.array(vec), pa.array(score)],
                                          names=["query_id", "vec_id", "score"])

    result = "query_id bigint, vec_id bigint, score bigint"
    no_bound = F.lit(None).cast("binary")
    home = stash(map_batches(blocks.join(trees, blocks["home"] == trees["shard"]).select(
        "tree", "ids", "queries", no_bound.alias("kth")), search, result), "home-results")

    bound = home.groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").alias("kth")).select(
        "query_id", F.when(F.col("n") >= k, F.col("kth")).otherwise(floor).alias("kth")).hint("merge")
    bounded = asked.select("vec_id", "v", "home", "block").join(
        bound, F.col("vec_id") == F.col("query_id"), "left").select(
        "vec_id", "v", "home", "block", F.coalesce("kth", F.lit(floor)).alias("kth"))

    def gather_bounded(part: pa.Table) -> pa.Table:
        return gather(part).append_column("kth", pa.array([part["kth"].to_numpy().tobytes()], pa.binary()))

    armed = stash(bounded.groupBy("block").applyInArrow(
        gather_bounded, "home string, ids binary, queries binary, kth binary"), "armed-blocks")
    # every block meets every other shard: numbers of shards, not rows, are multiplied
    shards = [r["shard"] for r in trees.select("shard").collect()] if n else []
    everywhere = armed.withColumn("shard", F.explode(F.split(F.lit(",".join(sorted(shards))), ","))).where("shard != home")
    away = map_batches(everywhere.join(trees, "shard").select("tree", "ids", "queries", "kth"), search, result)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (home.unionByName(away).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
