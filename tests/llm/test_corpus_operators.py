"""Corpus operators against brute force, round trips and held-out labels."""

import collections
import glob
import gzip
import hashlib
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rollcall.llm import (
    chat_format, common, decontaminate, knn, mixing, near_dedup, quality, secrets_scan, substring_dedup, textvec, toxicity,
    warc,
)
from rollcall.llm.common import shared_path, table
from rollcall.llm.components import connected_components
from rollcall.llm.queries import queries

SMALL = "/root/testdata/sf0.001"
DOC_SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, key string, hash long, "
              "found string, copy int, spans string, node string, size long, _found string")
PASSAGE = " ".join(f"word{i}" for i in range(60))


def docs_of(spark, rows):
    """Documents with extra columns whose names clash with the operators' own."""
    return spark.createDataFrame([(i, t, "en", s, len(t or ""), "k", 1, "f", 2, "s", "n", 3, "g")
                                  for i, t, s in rows], DOC_SCHEMA)


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty, short, repeated and very long texts."""
    long = " ".join(f"l{i % 977}x{i % 1009}" for i in range(60_000))
    return docs_of(spark, [
        (1, None, "a"), (2, "", "a"), (3, " \n", None), (4, "one", "b"), (5, "one", "b"), (5, "one", "b"),
        (None, "null id text", "c"), (6, long, "c"), (7, long + " tail", "c"), (8, PASSAGE, "a"),
        (9, "before it " + PASSAGE + " after it", "a"), (10, "ÄÖ ß日本 " * 30, None)])


@pytest.fixture(scope="module")
def none(spark):
    return docs_of(spark, [])


def words10(text):
    return re.findall(r"[^\x20\x09-\x0D]+", lower(text))


def words6(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def rows(df):
    return [r.asDict() for r in df.collect()]


# ------------------------------------------------------------- words ----

def test_words_and_shingles_match_regex():
    texts = ["", "a", "Äb c-d  E1\tf", "x" * 5000 + " y", "ß\x85日 本\x0bq", None, "  lead"]
    column = pa.array(texts, pa.string())
    for tab, rule in ((textvec.NONSPACE, words10), (textvec.WORD, words6)):
        for limit in (1, 1 << 20):
            got = [[] for _ in texts]
            for lo, hi, data, offsets in textvec.chunks(column, limit):
                w = textvec.Words(data, offsets, tab)
                for i in range(len(w)):
                    got[lo + w.text[i]].append(w.word(i))
            assert got == [rule(t) for t in texts]
    data = np.frombuffer(b"a b c a b c", np.uint8)
    w = textvec.Words(data, np.array([0, 11]), textvec.NONSPACE)
    h, at = textvec.shingles(w.hashes(), w.text, 3)
    assert len(at) == 4 and h[0] == h[3] and len(set(h.tolist())) == 3


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7)]
    got = dict(connected_components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect())
    assert got == {**{i: 1 for i in range(1, 41)}, **{i: 100 for i in range(100, 130)}}
    assert connected_components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


# -------------------------------------------------------------- WARC ----

def test_warc_round_trip_revisits_and_bytes(spark):
    big = "<p>" + "x" * 200
    pages = spark.createDataFrame(
        [(3, "u3", big), (1, "u\r\n1%", big), (2, None, None), (4, "u4", "s"), (5, "u5", "s"), (3, "u3", big),
         (None, "n", big), (6, "é", "é" * 99 + "\r\n\r\nWARC/1.1\r\n")], "page_id long, url string, html string")
    outs = []
    for parts in (1, 5):
        folder = shared_path(spark, "warc-test")
        manifest = warc.write(pages.repartition(parts), folder, roll_bytes=900)
        back = rows(warc.read(manifest, folder, payloads=True))
        files = sorted(glob.glob(folder.removeprefix("file:") + "/part-*.warc.gz"))
        outs.append({f.rsplit("/")[-1]: hashlib.sha256(open(f, "rb").read()).hexdigest() for f in files})
        assert not glob.glob(folder.removeprefix("file:") + "/_temporary*")
    assert outs[0] == outs[1] and len(outs[0]) > 1  # the same bytes, rolled
    assert gzip.open(files[0]).read().startswith(b"WARC/1.1\r\n")
    digest = hashlib.sha256(big.encode()).hexdigest()
    got = sorted((r["record_id"] or "", r["record_type"], r["refers_to"] or "") for r in back
                 if r["payload_digest"] == digest)
    assert got == [("", "revisit", "1"), ("1", "response", ""), ("3", "revisit", "1"), ("3", "revisit", "1")]
    rest = {r["record_id"]: r for r in back}
    assert rest["2"]["payload_bytes"] == 0 and rest["2"]["url"] is None and rest["1"]["url"] == "u\r\n1%"
    assert rest["5"]["record_type"] == "response" and rest["6"]["payload"].decode().endswith("WARC/1.1\r\n")
    empty = warc.round_trip(pages.where("false"))
    assert empty.count() == 0


# ------------------------------------------------------------- top-k ----

def test_top_k_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(knn, "SHARD_ROWS", 60)
    monkeypatch.setattr(knn, "BLOCK", 7)
    rng = np.random.default_rng(1)
    data = [(i, [float(x) for x in rng.normal(size=6)]) for i in range(300)]
    data += [(i, [0.5] * 6) for i in range(300, 420)] + [(420, None), (440, [1.0, float("nan")]), (441, [None, 1.0]),
                                                         (None, [9.0] * 6), (442, [1.0]), (460, [])]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    use = {}
    for i, e in data:
        if i is not None and e is not None and not any(x is None or x != x for x in e):
            use[i] = [int(np.floor(64 * x)) for x in e] + [0] * (6 - len(e))
    expect = set()
    for q in (i for i in use if i % 20 == 0):
        score = sorted(((-sum(a * b for a, b in zip(use[q], v)), i) for i, v in use.items() if i != q))[:5]
        expect |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(score)}
    assert {tuple(r) for r in knn.top_k(df, 5, 20).collect()} == expect
    assert knn.top_k(df.where("false"), 5, 20).count() == 0
    assert knn.top_k(df.where("vec_id in (0, 1)"), 5, 20).count() == 1


def test_top_k_takes_a_bounded_sample_to_the_driver(spark, monkeypatch):
    sizes, cells = [], knn._cells
    monkeypatch.setattr(knn, "_cells", lambda sample, depth: sizes.append(sample.nbytes) or cells(sample, depth))
    wide = "transform(sequence(1, 2500), i -> cast(pmod(hash(id, i), 1000) / 500.0 - 1 as float))"
    df = spark.range(2000).selectExpr("id as vec_id", f"{wide} as embedding")
    got = knn.top_k(df, 3, 500)
    v = np.floor(64 * np.array(df.orderBy("vec_id").toPandas()["embedding"].tolist(), np.float32).astype(float))
    expect = set()
    for q in range(0, 2000, 500):
        score = v @ v[q]
        best = sorted((c for c in range(2000) if c != q), key=lambda c: (-score[c], c))[:3]
        expect |= {(q, i + 1, c, int(score[c])) for i, c in enumerate(best)}
    assert {tuple(r) for r in got.collect()} == expect
    assert 0 < sizes[0] <= 10_000_000  # 40 MB as whole rows
    # one id in many rows is spread over the sample's share as other rows are
    same = spark.range(400_000).selectExpr("20 as vec_id", "array(cast(id % 977 as float), cast(id as float)) as embedding")
    knn.top_k(same, 3, 20)
    assert 0 < sizes[1] <= 1_000_000


def test_top_k_broadcasts_no_vectors(spark, monkeypatch):
    df = spark.range(3000).selectExpr("id as vec_id", "array(cast(id % 7 as float), cast(id % 11 as float)) as embedding")
    plans = []

    def stash(rows, name):
        plans.append(rows._jdf.queryExecution().executedPlan().toString())
        return common.stash(rows, name)

    monkeypatch.setattr(knn, "SHARD_ROWS", 500)
    monkeypatch.setattr(knn, "stash", stash)
    plans.append(knn.top_k(df, 3, 20)._jdf.queryExecution().executedPlan().toString())
    assert "SortMergeJoin" in "".join(plans) and "Broadcast" not in "".join(plans)


def test_kd_tree_boxes_are_tight():
    rng = np.random.default_rng(2)
    tree = knn.KDTree(np.arange(500), rng.integers(-50, 50, (500, 4)), leaf=16)
    for i, c in enumerate(tree.child):
        part = tree.points[tree.lo[i]:tree.hi[i]]
        assert (tree.low[i] == part.min(axis=0)).all() and (tree.high[i] == part.max(axis=0)).all()
        assert c or len(part) <= 16
    back = knn.KDTree.of(tree.blob(), 4)
    assert (back.points == tree.points).all() and list(back.child) == list(tree.child)


# ----------------------------------------------------------- quality ----

def test_quality_learns_and_ignores_held_out_labels(spark):
    docs, labels = table(spark, "/root/testdata/sf0.01", "documents"), table(spark, "/root/testdata/sf0.01", "labels")
    out = quality.score(docs, labels).join(labels, "doc_id").toPandas()
    held = out[out.held_out]
    assert len(held) > 30 and (held.predicted == held.quality).mean() > 0.9
    flipped = labels.withColumn("quality", F.when(quality.held_out("doc_id"), 1 - F.col("quality")).otherwise(
        F.col("quality")))
    again = quality.score(docs, flipped).toPandas().set_index("doc_id").score
    assert np.allclose(out.set_index("doc_id").score, again[out.doc_id])


def test_quality_edges(spark, odd, none):
    labels = spark.createDataFrame([(4, 1), (8, 0), (8, 0), (None, 1), (9, None)], "doc_id long, quality int")
    out = rows(quality.score(odd, labels))
    assert len(out) == 12 and all(0 <= r["score"] <= 1 for r in out)
    assert quality.score(none, labels).count() == 0
    assert {r["score"] for r in rows(quality.score(odd, labels.where("false")))} == {0.5}


def test_flat_trees_equal_a_walk():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 5))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.3)).astype(float)
    t = quality.fit_trees(x, y, trees=20, depth=3)
    assert ((t.predict(x) > 0.5) == (y > 0)).mean() > 0.95
    for row, p in zip(x[:20], t.predict(x[:20])):
        total = t.base
        for node in t.roots:
            while t.threshold[node] != np.inf:
                node = t.left[node] + (row[t.feature[node]] > t.threshold[node])
            total += t.value[node]
        assert abs(1 / (1 + np.exp(-total)) - p) < 1e-12


# ---------------------------------------------------------- passages ----

def test_chains_and_alignment():
    anchors = [(i, i + 100) for i in range(0, 60, 5)] + [(12, 7), (400, 10), (405, 15)]
    best = substring_dedup.chains(anchors)
    assert best[0] == [(i, i + 100) for i in range(0, 60, 5)]
    assert sorted(a for c in best for a in c) == sorted(set(anchors))
    tree = substring_dedup.Fenwick(8)
    values = [3.0, 1.0, 7.0, 2.0]
    for i, v in enumerate(values):
        tree.add(2 * i, v, i)
    assert tree.below(4) == (3.0, 0) and tree.below(5) == (7.0, 2) and tree.below(0)[1] == -1
    a = [f"w{i}" for i in range(80)]
    b = ["x", "y", *a[:30], "new", *a[30:50], *a[52:], "z"]
    got = substring_dedup.align(a, b, [(5, 7), (40, 43), (60, 61)])
    assert got == (0, 80, 2, 81, 78)


def test_passages_found_and_clean_documents_left(spark, odd, none):
    rng = np.random.default_rng(5)

    def noise(n):
        return " ".join(f"r{x}" for x in rng.integers(0, 10**9, n))

    edited = PASSAGE.split()
    edited[20] = "changed"
    del edited[40]
    data = [(i, noise(200), "s") for i in range(20)]
    data += [(100 + i, noise(50) + " " + PASSAGE + " " + noise(30), "s") for i in range(6)]
    data += [(200, noise(40) + " " + " ".join(edited) + " " + noise(10), "s"), (300, noise(90), "s")]
    data += [(301, data[-1][1], "s"), (302, data[-1][1], "s")]
    out = rows(substring_dedup.passages(docs_of(spark, data)))
    ids = {r["doc_id"] for r in out} | {r["other_id"] for r in out}
    assert ids == {100, 101, 102, 103, 104, 105, 200, 300, 301, 302}
    fuzzy = [r for r in out if 200 in (r["doc_id"], r["other_id"]) and r["kind"] == "passage"]
    assert fuzzy and all(r["n_equal"] >= 57 for r in fuzzy)
    out = rows(substring_dedup.passages(odd))
    assert {frozenset((r["doc_id"], r["other_id"])) for r in out} == {frozenset((6, 7)), frozenset((8, 9))}
    assert substring_dedup.passages(none).count() == 0


def test_passages_close_together_stay_apart(spark):
    a = [f"w{i}" for i in range(60)] + [f"new{i}" for i in range(45)] + [f"w{i}" for i in range(60, 120)]
    b = ["x", *[f"w{i}" for i in range(120)]]
    anchors = [(i, i + 1) for i in range(0, 51, 5)] + [(i + 45, i + 1) for i in range(60, 111, 5)]
    assert substring_dedup.passages_of(a, b, anchors) == [(0, 60, 1, 61, 60), (105, 165, 61, 121, 60)]
    assert substring_dedup.passages_of(a[:60] + a[105:], b, [(i, i + 1) for i in range(0, 111, 5)]) == [
        (0, 120, 1, 121, 120)]
    assert substring_dedup.passages_of(a[11:154], b, [(p - 11, h) for p, h in anchors if 11 <= p < 150]) == []
    data = []
    for n in range(31, 50, 2):  # ids n and 100 + n
        p1, p2, new = ([f"{c}{n}v{i}" for i in range(60)] for c in "pqn")
        data += [(n, " ".join(p1 + new[:n] + p2), "s"), (100 + n, " ".join(p1 + p2), "s")]
    out = rows(substring_dedup.passages(docs_of(spark, data)))
    held = collections.defaultdict(set)
    for r in out:
        s, e = (r["start"], r["end"]) if r["doc_id"] < 100 else (r["other_start"], r["other_end"])
        held[min(r["doc_id"], r["other_id"])] |= set(range(s, e))
    assert all(set(range(60)) | set(range(60 + n, 120 + n)) <= held[n] for n in range(31, 50, 2))


def test_edited_passages_share_seeds_down_to_the_identity(spark):
    rng = np.random.default_rng(19)
    data, n = [], 0
    for every in (5, 6, 7, 8, 10):
        for _ in range(20):
            w = [f"p{n}v{i}" for i in range(60)]
            edited = [f"e{n}v{i}" if i % every == every - 1 else x for i, x in enumerate(w)]
            noise = [[f"r{x}" for x in rng.integers(0, 10**9, 40)] for _ in range(4)]
            data += [(n, " ".join(noise[0] + w + noise[1]), "s"),
                     (1000 + n, " ".join(noise[2] + edited + noise[3]), "s")]
            n += 1
    out = rows(substring_dedup.passages(docs_of(spark, data)))
    assert all(r["n_equal"] >= 0.8 * max(r["end"] - r["start"], r["other_end"] - r["other_start"]) for r in out)
    assert {(min(r["doc_id"], r["other_id"]), max(r["doc_id"], r["other_id"])) for r in out} == {
        (i, 1000 + i) for i in range(n)}
    p, h = np.array([3, 4, 5, 6, 7, 8, 20, 5]), np.array([13, 14, 15, 16, 17, 18, 30, 40])
    assert sorted(substring_dedup.thin(p, h)) == [(3, 13), (5, 40), (7, 17), (8, 18), (20, 30)]


def test_passages_of_common_lines_are_found(spark):
    rng = np.random.default_rng(23)

    def noise(n):
        return [f"r{x}" for x in rng.integers(0, 10**9, n)]

    data = []
    for g in range(10):  # ids g and 100 + g share 60 words, and other texts hold any two lines in a row of them
        lines = [[f"g{g}l{i}w{j}" for j in range(10)] for i in range(6)]
        data += [(i + g, " ".join(noise(30) + sum(lines, []) + noise(30)), "s") for i in (0, 100)]
        data += [(1000 + 100 * g + 10 * i + j, " ".join(noise(20) + lines[i] + lines[i + 1] + noise(20)), "s")
                 for i in range(5) for j in range(8)]
    # a hub that holds the lines in a list as well as in full
    lines = [[f"tl{i}w{j}" for j in range(10)] for i in range(6)]
    toc = sum([x + noise(80) for x in lines], [])
    data += [(50, " ".join(toc + noise(70) + sum(lines, []) + toc), "s"),
             (51, " ".join(noise(30) + sum(lines, []) + noise(5)), "s")]
    out = rows(substring_dedup.passages(docs_of(spark, data)))
    assert {frozenset((r["doc_id"], r["other_id"])) for r in out} == {
        *(frozenset((g, 100 + g)) for g in range(10)), frozenset((50, 51))}
    assert all(r["n_equal"] == 60 for r in out)


def test_edited_passages_of_common_lines_link_classes(spark):
    rng = np.random.default_rng(29)

    def noise(n):
        return [f"r{x}" for x in rng.integers(0, 10**9, n)]

    def changed(words, tag):  # no run of 50 words is left
        return [f"{tag}{i}" if i % 8 == 7 else w for i, w in enumerate(words)]

    data = []
    for g in range(6):  # ids g and 100 + g share an edited passage whose lines are held by smaller and larger ids
        lines = [[f"g{g}l{i}w{j}" for j in range(10)] for i in range(6)]
        whole = sum(lines, [])
        data += [(g, " ".join(noise(30) + whole + noise(30)), "s"),
                 (100 + g, " ".join(noise(30) + changed(whole, f"e{g}x") + noise(30)), "s")]
        data += [(1000 + 1000 * g + 100 * i + j, " ".join(noise(20) + lines[i] + noise(20)), "s")
                 for i in range(6) for j in range(25)]
    # edits that shift the rest, outside the outermost runs of four words
    word = [f"v{i}" for i in range(50)]
    put_in = [w for i, v in enumerate(word) for w in ([v, f"n{i}"] if i % 5 == 2 else [v])]
    data += [(50, " ".join(noise(20) + word + noise(20)), "s"), (51, " ".join(noise(9) + put_in + noise(9)), "s")]
    out = rows(substring_dedup.passages(docs_of(spark, data)))
    assert {frozenset((r["doc_id"], r["other_id"])) for r in out} == {
        *(frozenset((g, 100 + g)) for g in range(6)), frozenset((50, 51))}
    assert all(r["class_id"] == min(r["doc_id"], r["other_id"]) for r in out)


def test_passages_within_a_class_are_all_listed(spark, monkeypatch):
    monkeypatch.setattr(substring_dedup, "LISTED", 16)
    rng = np.random.default_rng(41)

    def noise(n):
        return [f"r{x}" for x in rng.integers(0, 10**9, n)]

    data = []
    for g in range(6):  # 100 + g and 200 + g are linked by g, and share a passage whose lines many others hold
        lines = [[f"g{g}l{i}w{j}" for j in range(10)] for i in range(6)]
        whole = sum(lines, [])
        other = [f"e{g}x{i}" if i % 8 == 7 else w for i, w in enumerate(whole)]
        one, two = noise(60), noise(60)
        data += [(g, " ".join(one + noise(90) + two), "s"), (100 + g, " ".join(one + noise(90) + whole), "s"),
                 (200 + g, " ".join(noise(30) + other + noise(90) + two), "s")]
        data += [(1000 + 1000 * g + 100 * i + j, " ".join(noise(20) + lines[i] + noise(20)), "s")
                 for i in range(6) for j in range(25)]
    out = rows(substring_dedup.passages(docs_of(spark, data)))
    assert {frozenset((r["doc_id"], r["other_id"])) for r in out} == {
        frozenset(p) for g in range(6) for p in ((g, 100 + g), (g, 200 + g), (100 + g, 200 + g))}
    # all pairs that share a seed with few holders
    shared = noise(60)
    data = [(i, " ".join(noise(9) + shared + noise(9)), "s") for i in range(8)]
    out = rows(substring_dedup.passages(docs_of(spark, data)))
    assert {frozenset((r["doc_id"], r["other_id"])) for r in out} == {
        frozenset((i, j)) for i in range(8) for j in range(i)}


def test_all_passages_of_a_pair_are_listed(spark):
    one, two, three = ([f"p{n}w{i}" for i in range(60)] for n in range(3))
    gaps = [[f"n{n}w{i}" for i in range(100)] for n in range(6)]
    data = [(1, " ".join(one + gaps[0] + two + gaps[1] + three + gaps[2] + three), "s"),  # each holds one of them twice
            (2, " ".join(one + gaps[3] + two + gaps[4] + two + gaps[5] + three), "s")]
    begun = set()
    for r in rows(substring_dedup.passages(docs_of(spark, data))):
        begun |= {(r["doc_id"], r["start"]), (r["other_id"], r["other_start"])}
    assert begun == {(i, s) for i in (1, 2) for s in (0, 160, 320, 480)}


def test_seeds_travel_packed():
    rng = np.random.default_rng(43)
    text = np.sort(rng.integers(0, 30, 500))
    place = np.concatenate([np.sort(rng.choice(4000, n, replace=False)) for n in np.bincount(text, minlength=30)])
    key = rng.integers(0, 7 << 32, 500)
    uid = rng.integers(-2**62, 2**62, 30)
    packed = pa.Table.from_batches([substring_dedup._packed(9, uid, text, place, key)])
    row, t, p, h = substring_dedup._unpacked(packed)
    back = sorted(zip(t, p, (packed["bucket"].to_numpy().astype(np.int64)[row] << 32) | h))
    assert back == sorted(zip(text, place, key))
    assert [x for x in packed["uids"].to_pylist() if x] == [uid.tobytes()]


def test_edit_distance_of_windows():
    rng = np.random.default_rng(31)
    a = [f"w{i}" for i in range(70)]
    b = [f"x{i}" for i in range(30)] + a[10:60] + [f"y{i}" for i in range(30)]
    for i in rng.choice(np.arange(30, 80), 10, replace=False):
        b[i] = f"z{i}"
    (s, e, hs, he, n), = substring_dedup.edited(a, b)
    assert e - s == 50 and n >= 40 and abs(he - hs - 50) <= 10
    b[40:44] = [f"q{i}" for i in range(4)]
    b[60:70] = [f"p{i}" for i in range(10)]
    assert substring_dedup.edited(a, b) == []
    at = np.unique(rng.integers(0, 400, 150))
    rank = rng.permutation(len(at))
    inside = [[(at >= w) & (at < w + 58) for w in range(x - 57, x + 1)] for x in at]
    assert substring_dedup.dense(at).tolist() == [any(w.sum() >= 18 for w in ws) for ws in inside]
    assert substring_dedup.rare(at, rank).tolist() == [
        any((w & (rank > r)).sum() >= 17 for w in ws) for r, ws in zip(rank, inside)]


def test_runs_of_one_word_meet_by_what_is_beside_them(spark, monkeypatch):
    met, found = [], substring_dedup._found
    monkeypatch.setattr(substring_dedup, "_found", lambda pairs, regions: met.append(pairs.count()) or found(pairs, regions))

    def text(*runs):
        return " ".join(" ".join([w] * n) for w, n in runs)

    # all hold 30 of one word, but beside other words: no two are linked
    data = [(i, text((f"a{i}", 30), ("common", 30), (f"b{i}", 30)), "s") for i in range(40)]
    data += [(100, text(("p", 45), ("q", 30)), "s"), (101, text(("r", 20), ("p", 41), ("s", 9)), "s"),  # 40 of a word
             (200, text(("u", 25), ("x", 1), ("v", 20), ("y", 30)), "s"),  # no seed but runs of one word is shared
             (201, text(("z", 30), ("u", 24), ("o", 2), ("v", 19), ("l", 30)), "s"),
             (202, text(("v", 20), ("u", 24), ("k", 30)), "s")]  # the other way round
    out = rows(substring_dedup.passages(docs_of(spark, data)))
    assert {frozenset((r["doc_id"], r["other_id"])) for r in out} == {frozenset((100, 101)), frozenset((200, 201))}
    assert sum(met) < 20


def test_word_pairs_are_shared_by_all_links_of_runs_of_one_word():
    rng = np.random.default_rng(37)

    def mono(x):
        m = np.zeros(len(x), bool)
        m[:-2] = (x[2:] == x[1:-1]) & (x[1:-1] == x[:-2])
        return m

    checked = 0
    for _ in range(3000):
        a = np.repeat(rng.permutation(12), rng.integers(2, 2 + rng.integers(8, 45), 12))
        lo = int(rng.integers(0, max(1, len(a) - 50)))
        b = a[lo:lo + 50].tolist()
        for _ in range(10):
            at = int(rng.integers(0, len(b)))
            kind = int(rng.integers(0, 3))  # left out, changed or put in
            b[at:at + (kind < 2)] = [int(rng.integers(100, 10**6))] * (kind > 0)
        b = np.array([*rng.integers(100, 10**6, 30), *b, *rng.integers(100, 10**6, 30)])
        runs = [{tuple(x[i:i + 3].tolist()) for i in range(len(x) - 2)} for x in (a, b)]
        if len(a) < 50 or any(len(set(r)) > 1 for r in runs[0] & runs[1]):
            continue  # other seeds are shared
        own, other = ({frozenset(p) for p in zip(*(c.tolist() for c in substring_dedup.word_pairs(x, mono(x))))}
                      for x in (a, b))
        assert own & other
        checked += 1
    assert checked > 20


# -------------------------------------------------------------- chat ----

def expected_chat(turns):
    out = {}
    convs = collections.defaultdict(list)
    for c, t, r, x in turns:
        convs[c].append(((t is not None, t or 0), r or "", x or ""))
    for c, ts in convs.items():
        ts.sort()
        loss = "".join(x for _, r, x in ts if r == "assistant")
        out[c] = (len(ts), hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in ts).encode()).hexdigest(), len(loss),
                  hashlib.sha256(loss.encode()).hexdigest(), sum(len(chat_format.format_turn(r, x)) for _, r, x in ts))
    return out


@pytest.mark.parametrize("vocabulary", [None, "/opt/tokenizers/byte_bpe_50k.tiktoken"])
def test_chat_round_trip_and_shared_prefixes(spark, vocabulary):
    bad = ["<|end|>", "\\", "<", "a<\\|b", "<|turn|>user<|text|>", "\\### Assistant: </turn> ok", "", None, "日本\n<|"]
    turns = [(c, t, "user" if t % 2 == 0 else "assistant", "same start" if t < 2 else bad[(c + t) % len(bad)])
             for c in range(30) for t in range(2 + c % 30)]
    turns += [(99, 0, None, "x"), (99, 0, None, "x"), (None, None, "assistant", "null id"), (98, None, "user", "first"),
              (98, 0, "assistant", "b")]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").withColumn("node", F.lit(1))
    packed = chat_format.pack(df.repartition(3), vocabulary, pack_tokens=400)
    packed.cache()
    got = {r["conv_id"]: tuple(r)[1:] for r in chat_format.read_back(packed, vocabulary).collect()}
    assert got == expected_chat(turns)
    nodes = rows(packed.where(F.size("tokens") > 0))
    per_pack = collections.Counter((r["part"], r["pack"], tuple(r["tokens"]), r["position"], str(r["ancestors"]))
                                   for r in nodes)
    assert max(per_pack.values()) == 1  # shared turns once per pack
    for r in nodes:  # positions follow the ancestors, which lie before
        assert r["position"] == sum(a["end"] - a["start"] for a in r["ancestors"])
        assert all(a["end"] <= r["start"] for a in r["ancestors"]) and len(r["ancestors"]) == r["depth"]
    packed.unpersist()
    assert chat_format.read_back(chat_format.pack(df.where("false")), None).count() == 0


# --------------------------------------------------- decontamination ----

def brute_hits(texts, items):
    grams = collections.defaultdict(set)
    for i, t in items:
        w = words6(t)
        m = min(10, len(w))
        for p in range(len(w) - m + 1) if m else ():
            grams[tuple(w[p:p + m])].add(str(i))
    out = []
    for t in texts:
        w, hit, found = words6(t), set(), set()
        for g, ids in grams.items():
            for p in range(len(w) - len(g) + 1):
                if tuple(w[p:p + len(g)]) == g:
                    hit |= set(range(p, p + len(g)))
                    found |= ids
        out.append((len(w), len(hit), len(found), ",".join(sorted(found))))
    return out


def test_contamination_against_brute_force(spark, odd, none):
    long = [f"b{i}" for i in range(25)]
    items = [(1, " ".join(long)), (2, "Short ITEM here"), (3, "solo"), (4, None), (5, ""), (10, "Short ITEM here"),
             (6, "a a a a a a a a a a a a"), (None, " ".join(long[3:15]))]
    texts = [" ".join(long[4:13]), " ".join(long[4:14]), "x " + " ".join(long[:12]) + " y " + " ".join(long[10:]),
             "a " * 30, "this short item, here. SOLO!", None, "", " ".join(long[::-1]), "a " * 9]
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = docs_of(spark, [(i, t, "s") for i, t in enumerate(texts)])
    out = {r["doc_id"]: (r["n_words"], r["n_hit"], r["n_items"], r["items"]) for r in rows(
        decontaminate.contamination(docs, bench.where("item_id is not null")))}
    assert [out[i] for i in range(len(texts))] == brute_hits(texts, [x for x in items if x[0] is not None])
    assert {r["doc_id"] for r in rows(decontaminate.decontaminate(docs, bench))} == {0, 5, 6, 7, 8}
    assert decontaminate.contamination(odd, bench).count() == 12
    assert decontaminate.contamination(none, bench).count() == 0
    assert decontaminate.contamination(odd, bench.where("false")).where("contaminated").count() == 0


# ------------------------------------------------------------ mixing ----

def brute_targets(source_sizes):
    order = sorted(source_sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, target, free = 1.5 * sum(source_sizes.values()), {}, set(order)
    while free:
        left = total - sum(target.values())
        share = {s: left * weight[s] / sum(weight[f] for f in free) for s in free}
        over = [s for s in free if share[s] > 2 * source_sizes[s]]
        if not over:
            return target | share
        for s in over:
            target[s] = 2 * source_sizes[s]
            free.remove(s)
    return target


def test_mixture_meets_targets(spark, odd, none):
    docs = table(spark, "/root/testdata/sf0.01", "documents").withColumn(
        "source", F.when(F.col("source") == "src3", None).otherwise(F.col("source")))
    out = mixing.mixture(docs).toPandas()
    text = dict(docs.select("doc_id", "text").toPandas().itertuples(index=False, name=None))
    assert all(n == len(words10(text[d])) for d, n in zip(out.doc_id, out["size"]))
    out["source"] = out.source.where(out.source.notna(), None)
    sums = out.groupby("source", dropna=False).agg(size=("size", "sum"), target=("target", "first"),
                                                   taken=("taken", "sum"), least=("size", "min"))
    expect = brute_targets({None if s != s else s: n for s, n in sums["size"].items()})
    for s, r in sums.iterrows():
        assert abs(r.target - expect[None if s != s else s]) < 1e-6 * r.target
        assert abs(r.taken - r.target) <= max(50, 0.02 * r.target)
    assert (out.taken <= 2 * out["size"]).all()
    again = mixing.mixture(docs.repartition(7)).toPandas().set_index("doc_id").taken
    assert (again[out.doc_id].to_numpy() == out.taken.to_numpy()).all()
    assert mixing.mix(docs).count() == out.copies.sum()
    assert mixing.mixture(odd).count() == 12 and mixing.mixture(none).count() == 0
    assert "_copy" in mixing.mix(odd).columns and mixing.mix(none).count() == 0


def test_entropy_balance_of_two_families(spark):
    cells = spark.createDataFrame([("a", "x", 10.0), ("a", "y", 30.0), ("b", "x", 20.0), ("b", "y", 40.0)],
                                  "s string, l string, w double")
    wanted = {"s": spark.createDataFrame([("a", 50.0), ("b", 50.0)], "s string, target double"),
              "l": spark.createDataFrame([("x", 40.0), ("y", 60.0)], "l string, target double")}
    got = mixing.entropy_balance(cells, "w", wanted).toPandas()
    taken = got.w * got.rate
    assert np.allclose(taken.groupby(got.s).sum(), [50, 50]) and np.allclose(taken.groupby(got.l).sum(), [40, 60])
    r = got.set_index(["s", "l"]).rate  # rates are products of group factors
    assert abs(r["a", "x"] * r["b", "y"] / (r["a", "y"] * r["b", "x"]) - 1) < 1e-6


# ---------------------------------------------------------- toxicity ----

def test_ordinal_regression_orders_cuts_and_grades():
    rng = np.random.default_rng(7)
    grades = rng.integers(0, 4, 600)
    hits = [sorted(rng.choice(30, size=g * 3, replace=False)) for g in grades]
    indptr = np.concatenate([[0], np.cumsum([len(h) for h in hits])])
    w, cuts = toxicity.fit_ordinal(indptr, np.concatenate(hits).astype(int), grades, 30, 4)
    assert (np.diff(cuts) > 0).all()
    z = np.array([w[h].sum() for h in hits])
    expected = (1 / (1 + np.exp(-(z[:, None] - cuts)))).sum(axis=1)
    assert np.corrcoef(expected, grades)[0, 1] > 0.9


def test_toxicity_catches_held_out_documents(spark, odd, none):
    docs, labels = table(spark, "/root/testdata/sf0.1", "documents"), table(spark, "/root/testdata/sf0.1", "labels")
    out = toxicity.score(docs, labels.where("doc_id % 3 != 0")).join(
        labels.where("doc_id % 3 = 0"), "doc_id").toPandas()
    bad, good = out[out.toxic == 1], out[out.toxic == 0]
    assert bad.rejected.mean() > 0.8 and good.rejected.mean() < 0.02
    assert out.severity.between(0, 3).all()
    few = labels.limit(30)
    assert toxicity.score(odd, few).count() == 12 and toxicity.score(none, few).count() == 0
    assert toxicity.drop_toxic(odd, few.where("false")).columns == odd.columns


# ----------------------------------------------------------- secrets ----

def test_base_spans_equal_the_plain_patterns():
    texts = ['Password = "abcdefgh1" api-key', "token=secret=abcdefgh", "secret=token:abcdefghij", "API_KEY: 'short'",
             "AKIA" + "A" * 11, "AKIA" + "A" * 12 + "AKIA0000", "f" * 31 + " " + "0" * 32, "x" + "a" * 40, "ſecret=abcdefghij",
             "toKen=abcdefghij", "apikey  :  abc.def-ghi"]
    for t in texts:
        expect = [(m.start(), 0, m.end()) for m in re.finditer(
            r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", t, re.I | re.A)
            if len(m[2]) >= 8]
        expect += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 16]
        expect += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 32]
        assert secrets_scan.base_spans(t) == sorted(expect), t


def test_random_tokens_are_added_and_structured_ones_not(spark, odd, none):
    rng = np.random.default_rng(11)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    keys = ["".join(rng.choice(list(letters), 40)) for _ in range(50)]
    plain = [f"{c * 10}{i % 10}{c * 14}" for i, c in enumerate("abcdefghij" * 5)] + ["a1" * 15] * 20
    data = [(i, f"é {x} end", "s") for i, x in enumerate(keys + plain)]
    out = {r["doc_id"]: r for r in rows(secrets_scan.scan(docs_of(spark, data)))}
    caught = sum(out[i]["spans"] == "random:2:42" for i in range(50))
    assert caught >= 45 and all(out[i]["spans"] == "" for i in range(50, 120))
    assert out[119]["base_sha256"] == hashlib.sha256(b"").hexdigest()
    masked = {r["doc_id"]: r for r in rows(secrets_scan.mask(docs_of(spark, [
        (1, "a token=abcdefgh1 b", "s"), (2, None, "s"), (3, "clean", "s")])))}
    assert masked[1]["text"] == "a [SECRET] b" and masked[1]["n_chars"] == 12 and masked[2]["text"] is None
    assert masked[3]["n_chars"] == 5 and masked[1]["found"] == "f"
    assert secrets_scan.scan(odd).count() == 12 and secrets_scan.mask(none).count() == 0


def test_random_values_of_unlisted_names_are_found_and_masked(spark):
    rng = np.random.default_rng(17)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    keys = ["".join(rng.choice(list(letters), 40)) for _ in range(80)]
    names = ["client_key=", "auth=", "https://h/x?a=1&sig=", "a_name_that_is_as_long_as_a_token_1="]
    data = [(i, names[i % 4] + x + ("", "=", "==", "&b=2")[i // 4 % 4], "s") for i, x in enumerate(keys)]
    data += [(100 + i, f"auth={c * 10}{i}{c * 14}", "s") for i, c in enumerate("abcdefghij")]
    docs = docs_of(spark, data)
    out = {r["doc_id"]: r["spans"] for r in rows(secrets_scan.scan(docs))}
    masked = {r["doc_id"]: r["text"] for r in rows(secrets_scan.mask(docs))}
    caught = 0
    for i, x in enumerate(keys):
        name, pad = names[i % 4], ("", "=", "==", "")[i // 4 % 4]
        start = len(name)
        if out[i] == f"random:{start}:{start + 40 + len(pad)}":
            caught += 1
            assert masked[i] == name + "[SECRET]" + ("&b=2" if i // 4 % 4 == 3 else "")
    assert caught >= 70
    assert all(out[100 + i] == "" and masked[100 + i] == data[80 + i][1] for i in range(10))


# --------------------------------------------------- near-duplicates ----

def brute_components(data):
    sets = []
    for _, t in data:
        w = words10(t)
        sets.append({tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    root = list(range(len(data)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(data)):
        for j in range(i):
            c = len(sets[i] & sets[j])
            if c and 100 * c >= 75 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(data):
        low[find(i)] = min(low.get(find(i), d), d)
    return {d: (len(sets[i]), low[find(i)] if sets[i] else d) for i, (d, _) in enumerate(data)}


@pytest.mark.parametrize("block", [4096, 3])
def test_near_duplicates_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(near_dedup, "BLOCK", block)
    rng = np.random.default_rng(13)
    base = [f"v{x}" for x in rng.integers(0, 10**6, 120)]
    data = []
    for i in range(60):  # copies with more and more edits
        w = list(base)
        for p in rng.choice(120, i // 6, replace=False):
            w[p] = f"e{i}{p}"
        data.append((i + 10, " ".join(w)))
    data += [(100 + i, t) for i, t in enumerate(["", None, "a b", "A B", "a b c", "one two three four five",
                                                 "one two three four five six", " ".join(base).upper()])]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows(
        near_dedup.near_duplicates(docs_of(spark, [(d, t, "s") for d, t in data])))}
    assert got == brute_components(data)


def test_near_duplicate_edges(spark, odd, none):
    out = rows(near_dedup.near_duplicates(odd))
    assert len(out) == 12 and {(r["doc_id"], r["component_id"]) for r in out} >= {(5, 4), (7, 6), (9, 8), (1, 1)}
    kept = near_dedup.drop_near_duplicates(odd)
    assert kept.columns == odd.columns
    assert sorted(r["doc_id"] or 0 for r in rows(kept)) == [0, 1, 2, 3, 4, 6, 8, 10]
    assert near_dedup.near_duplicates(none).count() == 0 and near_dedup.drop_near_duplicates(none).count() == 0


def test_unlinked_texts_with_null_or_equal_ids_stay(spark):
    texts = [" ".join(f"t{i}w{j}" for j in range(30)) for i in range(6)]
    near = texts[5] + " tail"
    docs = docs_of(spark, [(None, t, "s") for t in texts[:3]] + [(None, texts[0], "s"), (7, texts[3], "s"),
                           (7, texts[4], "s"), (7, texts[4], "s"), (8, texts[5], "s"), (9, near, "s"),
                           (None, near, "s"), (None, "", "s"), (None, None, "s"), (7, near, "s"), (7, near, "s")])
    kept = rows(near_dedup.drop_near_duplicates(docs))
    assert sorted((r["doc_id"] or 0, r["text"] or "") for r in kept) == sorted(
        [(0, t) for t in texts[:3]] + [(7, texts[3]), (7, texts[4]), (7, near), (0, ""), (0, "")])


# ---------------------------------------------------------- pipeline ----

def test_pipeline_stages(spark):
    import corpus_pipeline

    docs = table(spark, SMALL, "documents")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_dedup", "decontamination", "secrets", "mixing"]
    before = docs
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, before, SMALL).cache()
        if name != "mixing":
            assert after.columns == docs.columns and 0.5 * before.count() < after.count() <= before.count()
        if name == "decontamination":
            assert not decontaminate.contamination(after, table(spark, SMALL, "benchmark")).where("contaminated").count()
        if name == "near_dedup":
            assert near_dedup.near_duplicates(after).where("not kept").count() == 0
        before = after
    assert after.columns == [*docs.columns, "copy"] and set(queries()) >= {"pipeline", "op10_near_dedup"}
