"""Operator 12 against brute force, and its cuckoo-filter index."""

import hashlib
import random
import re

import pyarrow as pa

from rollcall.llm import exact_dedup as X

SCHEMA = "doc_id long, text string, lang string, digest string, row int, n_chars string, copies string, group_size int"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, "en", "d", 1, "n", "c", 2) for i, t in rows], SCHEMA)


def brute(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t or ""), []).append((i, t or ""))
    out = []
    for plain, members in groups.items():
        ranked = sorted(members, key=lambda m: (-len(m[1]), m[0] is None, m[0] or 0))
        for n, (i, _) in enumerate(ranked):
            out.append((i, ranked[0][0], len(ranked), n == 0, hashlib.sha256(plain.encode()).hexdigest()))
    return sorted(out, key=str)


def got(df):
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in df.collect()), key=str)


ODD = ([(1, None), (2, ""), (3, " \n\t\x0b\x0c\r"), (None, "a b"), (4, "ab"), (5, "a  b"), (6, "a b"), (7, "AB"),
        (5, "a  b"), (None, "zz"), (8, "日 本"), (9, "日本 "), (10, "x" * 300_000), (11, "x" * 300_000 + "\n")]
       + [(100 + i, "common copy") for i in range(400)] + [(900, "common  copy")])


def test_groups_match_brute_force(spark):
    assert got(X.duplicates(docs_of(spark, ODD).repartition(5))) == brute(ODD)
    assert X.duplicates(docs_of(spark, [])).count() == 0


def test_heavy_groups_and_small_folds(spark, monkeypatch):
    """The broadcast part, and tasks that hand entries on early."""
    monkeypatch.setattr(X, "HEAVY_ROWS", 3)
    monkeypatch.setattr(X, "HEAVY_GROUPS", 10 ** 9)
    monkeypatch.setattr(X, "FOLD_ROWS", 4)
    assert got(X.duplicates(docs_of(spark, ODD).repartition(7))) == brute(ODD)


def test_drop_duplicates_keeps_one_row_and_all_columns(spark):
    docs = docs_of(spark, ODD)
    kept = X.drop_duplicates(docs)
    assert kept.columns == docs.columns
    want = sorted((str(i) for i, _, _, k, _ in brute(ODD) if k))
    assert sorted(str(r.doc_id) for r in kept.collect()) == want
    assert X.drop_duplicates(docs_of(spark, [])).count() == 0


def test_index_inserts_deletes_and_resizes():
    rng = random.Random(5)
    index, live = X.CuckooIndex(buckets=1), {}
    start = index.mask
    for step in range(20_000):
        digest = X.digest_of(str(rng.randrange(3000)).encode())
        entry = index.find(digest)
        assert (entry and entry[1]) == live.get(digest)
        if entry is None:
            index.insert(digest, step)
            live[digest] = step
        elif rng.random() < 0.4:
            assert index.delete(digest)
            del live[digest]
    assert not index.delete(X.digest_of(b"never there"))
    assert index.mask > start and index.live == len(live)
    assert {e[0]: e[1] for e in index.drain()} == live and index.live == 0


def test_equal_tags_and_buckets_are_told_apart_by_content():
    """Digests that agree in tag and bucket fill both buckets, then resize."""
    index = X.CuckooIndex(buckets=2)
    many = [b"\x01\x01" + bytes(7) + bytes([i]) + bytes(30) for i in range(40)]
    for i, digest in enumerate(many):
        assert index.find(digest) is None
        index.insert(digest, i)
    assert [index.find(d)[1] for d in many] == list(range(40))


def test_live_digests_after_insertions_and_deletions(spark):
    def digest(*texts):
        return spark.createDataFrame([(bytearray(X.digest_of(t.encode())),) for t in texts], "digest binary")

    def table(df):
        return {bytes(r.digest): (r.copies, r.status) for r in df.collect()}

    d = {t: X.digest_of(t.encode()) for t in "abcdef"}
    none = digest("a").limit(0)
    live = X.update_live(spark.createDataFrame([], "digest binary, copies long"), digest("a", "a", "b", "c"), none)
    assert table(live) == {d["a"]: (2, "added"), d["b"]: (1, "added"), d["c"]: (1, "added")}
    after = X.update_live(live, digest("d", "c", "e"), digest("a", "b", "f", "e"))
    assert table(after) == {d["a"]: (1, "changed"), d["b"]: (0, "died"), d["c"]: (2, "changed"),
                            d["d"]: (1, "added"), d["f"]: (0, "unknown")}
    again = X.update_live(after.where("copies > 0"), none, digest("a", "a"))
    assert table(again)[d["a"]] == (0, "unknown")


def test_digest_is_of_the_plain_text():
    column = pa.array(["a b\tc"]).cast(pa.binary())
    assert X.digest_of(column[0].as_py())[:32] == hashlib.sha256(b"abc").digest()
