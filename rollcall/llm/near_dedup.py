"""Near-duplicate groups by HyperMinHash (operator 10).

A document's set holds the distinct five-word shingles of its lower-cased
(A-Z) whole text, words being ``[^\\x20\\x09-\\x0D]+``; with fewer words the
whole sequence is its only shingle; without words the set is empty and links
with nothing.  Two documents are linked when 100 * |A & B| >= 75 * |A | B|.

1. Sketch: a shingle's 64-bit hash picks one of 512 buckets by its top bits;
   each bucket keeps its smallest remainder, compressed to a register of the
   leading-zero count and ten mantissa bits.
2. Equal sets collapse into one class (by a 128-bit sum over the set).
3. Bands: registers of a coarser sketch of the same hashes (128 buckets);
   empty ones borrow from a non-empty bucket in a fixed order per bucket, then
   32 bands of 4 registers are hashed.  A pair at the threshold shares no band
   with a probability of (1 - 0.75**4)**32 < 6e-6, a closer pair with less.
4. First round: within a bucket of equal bands each class is paired only with
   the smallest class of it (a star, linear in the bucket).  The registers give
   a Jaccard estimate, corrected for expected register collisions; pairs more
   than ``Z`` standard errors below the threshold are dropped, and each class's
   best pair is verified on the full sets.
5. The verified links are contracted to components.  What is left are pairs of
   one bucket in different components.  They are estimated inside the bucket's
   task (a bucket above ``BLOCK`` classes is cut into blocks, whose pairs are
   tasks of their own), each class hands on the best ``PARTNERS`` of those that
   may be links, and these are verified and contracted: rows grow with the
   classes, not with their pairs.
6. The buckets in which a class had more candidates than that get the full
   sets of their classes, and their tasks verify all remaining pairs of
   different components themselves.  A link joins two components at once, so
   that a task returns at most a row per class.  No pair is left out; pairs
   within a component can't change the result and are never made.

Defined results: null and empty texts have an empty set and are their own
component; repeated rows fall into one class; an id that is null never names a
component unless all of its ids are null; further columns are ignored by
``near_duplicates`` and kept by ``drop_near_duplicates``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from rollcall.llm import textvec as V
from rollcall.llm.common import bitmap, fixed_binary, free_name, in_bitmap, list_column, map_batches, stash, text_key
from rollcall.llm.components import connected_components

SHINGLE = 5
BUCKET_BITS = 9             # of the registers that estimate
BUCKETS = 1 << BUCKET_BITS
BAND_BITS = 7               # of the coarser registers that are banded
MANTISSA_BITS = 10
BANDS, ROWS = 32, 4
THRESHOLD = 75  # per cent
REP_BITS = 26   # bitmap of class representatives: 2**26 bits, 8 MB
Z = 4.5
BLOCK = 4096
BLOCK_ITEMS = 1 << 22    # shingles of a block of full sets
PARTNERS = 4    # candidates that a class hands on


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, sizes): the sorted distinct shingle hashes of each text."""
    words = V.Words(data, offsets, V.NONSPACE)
    hashes = words.hashes()
    h, at = V.shingles(hashes, words.text, SHINGLE)
    owner = words.text[at]
    short = np.flatnonzero((words.counts > 0) & (words.counts < SHINGLE))
    if len(short):
        h = np.concatenate([h, V.whole(hashes, words.first, short)])
        owner = np.concatenate([owner, short])
    order = np.lexsort((h, owner))
    h, owner = h[order], owner[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
    h, owner = h[new], owner[new]
    return h, np.bincount(owner, minlength=len(offsets) - 1)


def registers(h: np.ndarray, sizes: np.ndarray, bits: int = BUCKET_BITS) -> np.ndarray:
    """Compressed registers, uint16[text, bucket]; 0 marks an empty bucket.
    ``h`` is sorted within each text, so that the first hash of a bucket is
    its smallest."""
    out = np.zeros((len(sizes), 1 << bits), np.uint16)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    slot = (owner << bits) + (h >> np.uint64(64 - bits)).astype(np.int64)
    first = np.ones(len(h), bool)
    first[1:] = slot[1:] != slot[:-1]
    rest = (h[first] << np.uint64(bits)) | np.uint64(1)
    fraction, exponent = np.frexp(rest.astype(np.float64))
    zeros = np.clip(64 - exponent, 0, 62)
    mantissa = ((fraction - 0.5) * (2 << MANTISSA_BITS)).astype(np.int64)
    out.reshape(-1)[slot[first]] = ((zeros << MANTISSA_BITS) | mantissa) + 1
    return out


def _borrow_order(n: int) -> np.ndarray:
    """For each bucket, the fixed order in which it looks for a register."""
    keys = V.mix(np.arange(n * n, dtype=np.uint64) + np.uint64(0x5851F42D4C957F2D))
    return np.argsort(keys.reshape(n, n), axis=1)


_ORDER = _borrow_order(1 << BAND_BITS)


def densify(regs: np.ndarray) -> np.ndarray:
    """Fill empty registers from non-empty ones, in each bucket's own order."""
    out = regs.copy()
    rows = np.flatnonzero((regs == 0).any(axis=1) & (regs != 0).any(axis=1))
    for lo in range(0, len(rows), 256):
        part = rows[lo:lo + 256]
        full = regs[part] != 0
        pick = full[:, _ORDER].argmax(axis=2)
        source = _ORDER[np.arange(len(_ORDER))[None, :], pick]
        borrowed = np.take_along_axis(regs[part], source, axis=1)
        out[part] = np.where(full, regs[part], borrowed)
    return out


def band_keys(regs: np.ndarray) -> np.ndarray:
    """int64[text, band]."""
    full = densify(regs).astype(np.uint64).reshape(-1, BANDS, ROWS)
    packed = full[:, :, 0]
    for i in range(1, ROWS):
        packed = packed | (full[:, :, i] << np.uint64(16 * i))
    salt = V.mix(np.arange(1, BANDS + 1, dtype=np.uint64))
    return V.mix(packed ^ salt[None, :]).view(np.int64)


def may_link(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(estimate, whether a link isn't ruled out) for rows of registers.

    The expected number of accidental register collisions of sets of n and m
    elements in 2**p buckets with r mantissa bits is about 0.16992 * 2**(p - r)
    * 4q / (1 + q)**2, q = n / m (Yu and Weber, HyperMinHash).  The filled
    buckets sample the union without replacement, so that the standard error
    at the threshold t is that of N filled buckets among U = (n + m) / (1 + t)
    elements with the finite-population correction."""
    filled = ((a != 0) | (b != 0)).sum(axis=1)
    equal = ((a == b) & (a != 0)).sum(axis=1)
    q = np.maximum(na, nb) / np.maximum(1, np.minimum(na, nb))
    chance = 0.169919487159739 * 2.0 ** (BUCKET_BITS - MANTISSA_BITS) * 4 * q / (1 + q) ** 2
    some = np.maximum(1, filled)
    est = np.maximum(0.0, equal - chance) / some
    t = THRESHOLD / 100
    rest = np.clip(1 - filled / ((na + nb) / (1 + t)), 0.02, 1)
    slack = Z * np.sqrt(t * (1 - t) / some * rest) + 2 / some
    sizes = 100 * np.minimum(na, nb) >= THRESHOLD * np.maximum(na, nb)
    return est, sizes & (est >= t - slack)


def sketch(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: doc_id, rep (hash of id and text), n, node (16 bytes
    that name the set), regs (the registers' bytes) and bands (hashes)."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        n = np.zeros(batch.num_rows, np.int64)
        node = np.zeros((batch.num_rows, 2), np.uint64)
        regs = np.zeros((batch.num_rows, BUCKETS), np.uint16)
        bands = np.zeros((batch.num_rows, BANDS), np.int64)
        for lo, hi, data, offsets in V.chunks(batch.column(2)):
            h, sizes = shingle_sets(data, offsets)
            n[lo:hi] = sizes
            regs[lo:hi] = registers(h, sizes)
            bands[lo:hi] = band_keys(registers(h, sizes, BAND_BITS))
            ends = np.cumsum(sizes)
            for j, salt in enumerate((0x2545F4914F6CDD1D, 0x9E6C63D0876A9A35)):
                sums = np.zeros(len(h) + 1, np.uint64)
                np.cumsum(V.mix(h ^ np.uint64(salt)), out=sums[1:])
                node[lo:hi, j] = V.mix(sums[ends] - sums[ends - sizes] + sizes.astype(np.uint64))
        return pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(n), fixed_binary(node.view(np.uint8)),
             fixed_binary(regs.view(np.uint8)),
             list_column(bands.ravel(), np.full(len(bands), BANDS), pa.int64())],
            names=["doc_id", "rep", "n", "node", "regs", "bands"])

    src = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(doc_id, text).alias("rep"),
                      F.col(text).cast("string").alias("text"))
    schema = T.StructType([src.schema["doc_id"], T.StructField("rep", T.LongType()),
                           T.StructField("n", T.LongType()), T.StructField("node", T.BinaryType()),
                           T.StructField("regs", T.BinaryType()),
                           T.StructField("bands", T.ArrayType(T.LongType()))])
    return map_batches(src, run, schema)


def _rows_of(column: pa.Array, kind, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, width)


def _promising(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs (a, b, est) whose estimate doesn't rule a link out."""
    side = classes.select("node", "n", "regs")
    both = (pairs.join(side.toDF("a", "na", "ra"), "a").join(side.toDF("b", "nb", "rb"), "b")
            # sets whose sizes differ too much can't reach the threshold
            .where(100 * F.least("na", "nb") >= THRESHOLD * F.greatest("na", "nb"))
            .select("a", "b", "na", "nb", "ra", "rb"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        ra, rb = (_rows_of(batch.column(i), np.uint16, BUCKETS) for i in (4, 5))
        est, keep = may_link(ra, rb, batch.column(2).to_numpy(), batch.column(3).to_numpy())
        out = pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(est)],
                                         names=["a", "b", "est"])
        return out.filter(pa.array(keep))

    return map_batches(both, run, "a binary, b binary, est double")


def _tiles(placed: DataFrame, blocks) -> DataFrame:
    """The rows of a bucket (band, slot, node, component) dealt to ``blocks``
    blocks; each is repeated for the pairs i <= j of blocks that it takes part
    in (just (0, 0) for most)."""
    rows = placed.withColumn("_blocks", blocks).withColumn("_own", F.pmod(F.xxhash64("node"), F.col("_blocks")))
    other = F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)).alias("_other")
    return rows.select("band", "slot", "node", "component", "_own", other).select(
        "band", "slot", F.least("_own", "_other").alias("i"), F.greatest("_own", "_other").alias("j"), "_own",
        "node", "component")


def _by_tile(rows: DataFrame, fn, schema: str) -> DataFrame:
    """``fn`` (a table of one (band, i, j) -> a batch or None) over all tiles.
    The first columns are band, i and j."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = pa.concat_tables([held, table]) if held is not None else table
            key = np.stack([table.column(c).to_numpy() for c in (0, 1, 2)], axis=1)
            edges = [0, *(np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1).tolist()]
            for lo, hi in zip(edges, edges[1:]):
                out = fn(table.slice(lo, hi - lo)) if hi - lo > 1 else None
                if out is not None:
                    yield out
            held = table.slice(edges[-1])
        out = fn(held) if held is not None and held.num_rows > 1 else None
        if out is not None:
            yield out

    return rows.repartition("band", "i", "j").sortWithinPartitions("band", "i", "j").mapInArrow(run, schema)


class _Tile:
    """The classes of one tile, and which of them may be linked."""

    def __init__(self, group: pa.Table, regs: np.ndarray, bands: np.ndarray, n: np.ndarray):
        self.i, self.j, self.slot = (group.column(c)[0].as_py() for c in (1, 2, 3))
        self.own = group.column(4).to_numpy()
        self.component = np.unique(np.array(group.column(6).to_pylist(), object), return_inverse=True)[1]
        self.regs, self.bands, self.n = regs, bands, n

    def partners(self, x: int, lo: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """(classes from ``lo`` on, estimates) that aren't ruled out as links
        of ``x``, lie in another component and share no earlier band with it."""
        apart = self.component[lo:] != self.component[x]
        if self.i != self.j:
            apart &= self.own[lo:] != self.own[x]
        y = lo + np.flatnonzero(apart)
        n, bands = self.n, self.bands
        y = y[(100 * np.minimum(n[y], n[x]) >= THRESHOLD * np.maximum(n[y], n[x]))
              & ~(bands[y, :self.slot] == bands[x, :self.slot]).any(axis=1)]
        if not len(y):
            return y, np.zeros(0)
        est, keep = may_link(self.regs[y], np.broadcast_to(self.regs[x], (len(y), BUCKETS)), n[y], np.full(len(y), n[x]))
        return y[keep], est[keep]


def _best_partners(placed: DataFrame, classes: DataFrame, top: int) -> DataFrame:
    """(a, b, est, band, cut): for each class a and bucket the ``top`` best
    classes b that share the band, lie in another component and may be links,
    each pair in the first band that it shares; ``cut`` marks rows of a class
    that had more there.  ``placed`` has band, slot (the band's number), size
    (of the bucket), node and component."""
    rows = _tiles(placed, F.ceil(F.col("size") / BLOCK).cast("int"))
    rows = rows.join(classes.select("node", "n", "regs", "bands"), "node").select(
        "band", "i", "j", "slot", "_own", "node", "component", "n", "regs", "bands")

    def best_of(group: pa.Table) -> pa.RecordBatch | None:
        tile = _Tile(group, _rows_of(group.column(8), np.uint16, BUCKETS),
                     group.column(9).combine_chunks().flatten().to_numpy().reshape(-1, BANDS),
                     group.column(7).to_numpy())
        found = []
        if tile.component.max():
            for x in range(group.num_rows):
                y, est = tile.partners(x)
                if len(y):
                    best = np.argsort(-est, kind="stable")[:top]
                    found.append((x, y[best], est[best], len(y) > top))
        if not found:
            return None
        node = group.column(5).combine_chunks()
        a = np.concatenate([np.full(len(y), x) for x, y, _, _ in found])
        return pa.RecordBatch.from_arrays(
            [node.take(pa.array(a)), node.take(pa.array(np.concatenate([f[1] for f in found]))),
             pa.array(np.concatenate([f[2] for f in found])), group.column(0).combine_chunks().take(pa.array(a)),
             pa.array(np.concatenate([np.full(len(f[1]), f[3]) for f in found]))],
            names=["a", "b", "est", "band", "cut"])

    return _by_tile(rows, best_of, "a binary, b binary, est double, band bigint, cut boolean")


def _exact_links(placed: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b): links that join the components of each bucket's classes,
    verified on their full sets inside the bucket's task."""
    weight = placed.join(sets.select("node", F.size("items").alias("_n")), "node").groupBy("band").agg(
        F.count("*").alias("size"), F.sum("_n").alias("_items"))
    blocks = F.ceil(F.greatest(F.col("size") / BLOCK, F.col("_items") / BLOCK_ITEMS)).cast("int")
    rows = _tiles(placed.drop("size").join(weight, "band"), blocks).join(sets, "node").select(
        "band", "i", "j", "slot", "_own", "node", "component", "items")

    def links_of(group: pa.Table) -> pa.RecordBatch | None:
        lists = group.column(7).combine_chunks()
        n = np.diff(lists.offsets.to_numpy()).astype(np.int64)
        items = lists.flatten().to_numpy().view(np.uint64)
        edges = np.concatenate([[0], np.cumsum(n)])
        tile = _Tile(group, registers(items, n), band_keys(registers(items, n, BAND_BITS)), n)
        a, b = [], []
        for x in range(group.num_rows - 1):
            mine = items[edges[x]:edges[x + 1]]
            for y in tile.partners(x, x + 1)[0].tolist():
                if tile.component[y] == tile.component[x]:
                    continue        # joined since
                common = len(np.intersect1d(mine, items[edges[y]:edges[y + 1]], assume_unique=True))
                if 100 * common >= THRESHOLD * (n[x] + n[y] - common):
                    tile.component[tile.component == tile.component[y]] = tile.component[x]
                    a.append(x)
                    b.append(y)
        if not a:
            return None
        node = group.column(5).combine_chunks()
        return pa.RecordBatch.from_arrays([node.take(pa.array(a)), node.take(pa.array(b))], names=["a", "b"])

    return _by_tile(rows, links_of, "a binary, b binary")


def _sets(docs: DataFrame, reps: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(rep, items): the sorted full sets of the documents named in ``reps``,
    from a second pass over the texts.  A bitmap of fixed size over the wanted
    documents decides in the scan which texts are cut into shingles."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(bitmap(reps, "rep", REP_BITS))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        wanted = in_bitmap(shared.value, batch.column(0).to_numpy().view(np.uint64))
        batch = batch.filter(pa.array(wanted))
        if not batch.num_rows:
            return None
        parts = [shingle_sets(data, offsets) for _, _, data, offsets in V.chunks(batch.column(1))]
        h = np.concatenate([p[0] for p in parts]).view(np.int64)
        return pa.RecordBatch.from_arrays(
            [batch.column(0), list_column(h, np.concatenate([p[1] for p in parts]), pa.int64())],
            names=["rep", "items"])

    src = docs.select(F.xxhash64(doc_id, text).alias("rep"), F.col(text).cast("string").alias("text"))
    return map_batches(src, run, "rep bigint, items array<bigint>")


def _verify(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) that are links, counted on the full sets."""
    a, b = sets.toDF("a", "sa"), sets.toDF("b", "sb")
    common = F.size(F.array_intersect("sa", "sb"))
    return (pairs.select("a", "b").join(a, "a").join(b, "b")
            .where(100 * common >= THRESHOLD * (F.size("sa") + F.size("sb") - common)).select("a", "b"))


def _mixed(shared: DataFrame, comps: DataFrame) -> DataFrame:
    """The bands (with slot, size and node) whose classes lie in several
    components, and each class's component."""
    placed = shared.join(comps, "node", "left").select(
        "band", "slot", "size", "node", F.coalesce("component", "node").alias("component"))
    several = placed.groupBy("band").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
    return stash(placed.join(several.where("lo != hi").select("band"), "band", "left_semi"), "mixed-bands")


def _groups(docs: DataFrame, doc_id: str, text: str) -> tuple[DataFrame, DataFrame]:
    """(doc_id, rep, n, node, ...) of every document and (node, doc_id, rep,
    component) of every class, with the class's first document."""
    seen = stash(sketch(docs, doc_id, text), "sketches")
    classes = stash(seen.where("n > 0").groupBy("node").agg(
        F.max("n").alias("n"), F.max("regs").alias("regs"), F.max("bands").alias("bands"),
        F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "rep")).alias("first"))
        .select("node", "n", "regs", "bands", "first.doc_id", "first.rep"), "classes")

    bands = classes.select("node", F.posexplode("bands").alias("slot", "band"))
    hubs = bands.groupBy("band").agg(F.count("*").alias("size"), F.min("node").alias("hub")).where("size > 1")
    shared = stash(bands.join(hubs, "band"), "shared-bands")

    # Round 1: stars, the best partner of each class.
    stars = shared.where("node != hub").select(F.col("node").alias("a"), F.col("hub").alias("b")).distinct()
    stars = _promising(stars, classes)
    best = stash(stars.groupBy("a").agg(F.max(F.struct("est", "b")).alias("x")).select("a", "x.b"), "best-pairs")
    involved = shared.select("node").distinct()
    members = classes.join(involved, "node", "left_semi").select("node", "rep")
    sets = stash(_sets(docs, members, doc_id, text).join(members, "rep").dropDuplicates(["node"])
                 .select("node", "items"), "full-sets")
    links = stash(_verify(best, sets), "links")
    comps = stash(connected_components(links, "a", "b"), "components")

    # Round 2: the best pairs of one band in different components.
    found = stash(_best_partners(_mixed(shared, comps), classes, PARTNERS), "best-partners")
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("a").orderBy(F.col("est").desc(), "b")))
    ranked = stash(ranked.withColumn("left", F.col("cut") | (F.col("rank") > PARTNERS)), "ranked-partners")
    pairs = ranked.where(F.col("rank") <= PARTNERS).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    links = links.unionByName(stash(_verify(pairs.distinct(), sets), "cross-links"))
    comps = stash(connected_components(links, "a", "b"), "components")

    # Round 3: all other pairs of the bands that had more.
    rest = _mixed(shared.join(ranked.where("left").select("band").distinct(), "band", "left_semi"), comps)
    if not rest.isEmpty():
        links = links.unionByName(stash(_exact_links(rest, sets), "last-links"))
        comps = connected_components(links, "a", "b")

    named = classes.join(comps, "node", "left").select(
        "node", "doc_id", "rep", F.coalesce("component", "node").alias("component"))
    return seen, named


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: doc_id, n_shingles, component_id, kept."""
    seen, named = _groups(docs, doc_id, text)
    smallest = named.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    groups = named.join(smallest, "component").select("node", "component_id")
    out = seen.select("doc_id", "n", "node").join(groups, "node", "left")
    component_id = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component_id.alias("component_id")).select(
        "*", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def drop_near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that are kept: one per group (a row of its smallest
    id, null only where all are), whatever ids groups share, and all without
    words."""
    _, named = _groups(docs, doc_id, text)
    kept = named.groupBy("component").agg(F.min(F.struct(
        F.col("doc_id").isNull().alias("no_id"), "doc_id", "rep")).alias("first"))
    kept_id, kept_rep = free_name(docs.columns, "kept_id"), free_name(docs.columns, "kept_rep")
    kept = kept.select(F.col("first.doc_id").alias(kept_id), F.col("first.rep").alias(kept_rep))
    some = F.coalesce(F.col(text), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    with_words = docs.where(some)
    rep = free_name(docs.columns, "rep")
    with_words = with_words.withColumn(rep, F.xxhash64(doc_id, text))
    rows = with_words.join(kept, with_words[doc_id].eqNullSafe(kept[kept_id])
                           & (with_words[rep] == kept[kept_rep]), "left_semi")
    # repeated rows of a group's first document: one of them
    key = free_name(rows.columns, "text_key")
    rows = rows.withColumn(key, text_key(F.col(text))).dropDuplicates([doc_id, key]).drop(key, rep)
    return rows.unionByName(docs.where(~some))
