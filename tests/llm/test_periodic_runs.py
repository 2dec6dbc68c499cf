"""Operator 13 against brute force over all periods."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from rollcall.llm import periodic_runs as P

SCHEMA = "doc_id long, text string, runs string, start int, n_words string, best int, period string, row int"


def brute(s, least=24, periods=3):
    n, out = len(s), {}
    for p in range(1, n // 2 + 1):
        i = 0
        while i + p < n:
            if s[i] == s[i + p]:
                j = i
                while j + p < n and s[j] == s[j + p]:
                    j += 1
                if j - i + p >= max(least, periods * p):
                    out.setdefault((i, j + p), p)
                i = j
            i += 1
    return sorted(((a, b - a, p) for (a, b), p in out.items()), key=lambda r: (r[0], r[2]))


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def report(doc_id, text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(w)
    if doc_id is not None and n and zlib.crc32(str(doc_id).encode()) % 10 == 0:
        g = zlib.crc32(str(doc_id).encode()) // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = brute(w)
    dropped = {i for s, length, p in runs for i in range(s + p, s + length)}
    best = None
    for r in sorted(runs, key=lambda r: (r[0], r[2])):
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    return (doc_id, len(runs), *(best or (None, None, None)), best and 1000 * best[1] // best[2],
            sha("".join(f"{s},{length},{p}\n" for s, length, p in runs)),
            sha(" ".join(x for i, x in enumerate(w) if i not in dropped)))


def test_repetitions_of_small_alphabets():
    rng = random.Random(1)
    for _ in range(1500):
        s = [rng.randrange(rng.choice([1, 2, 3])) for _ in range(rng.randrange(1, 60))]
        got = sorted(tuple(r) for r in P.repetitions(s).tolist())
        assert got == sorted((a, a + length, p) for a, length, p in brute(s, 2, 2)), s


def test_extensions_match_direct_comparison():
    rng = random.Random(2)
    s = [rng.randrange(2) for _ in range(80)]
    e = P.Extensions(s)
    i, j = (a.ravel() for a in np.meshgrid(np.arange(81), np.arange(81)))
    i, j = i[i != j], j[i != j]
    want = []
    for a, b in zip(i.tolist(), j.tolist()):
        k = 0
        while max(a, b) + k < 80 and s[a + k] == s[b + k]:
            k += 1
        want.append(k)
    assert e.lce(i, j).tolist() == want


@pytest.mark.parametrize("seed", range(4))
def test_text_runs_match_brute_force(seed):
    rng = random.Random(seed)
    for _ in range(400):
        s, n = [], rng.randrange(400)
        while len(s) < n:
            if rng.random() < .5:
                s += [rng.randrange(3, 50) for _ in range(rng.randrange(30))]
            else:
                q = rng.randrange(1, 30)
                s += ([rng.randrange(rng.choice([2, 60])) for _ in range(q)] * 12)[:int(q * rng.uniform(1.5, 6))]
        assert P.text_runs(np.array(s, np.int32)) == brute(s), s


def test_splitting_early_and_late_gives_the_same(monkeypatch):
    rng = random.Random(9)
    s = np.array(([rng.randrange(9) for _ in range(40)] * 4 + list(range(20, 300)) + [7, 8] * 30) * 2, np.int32)
    want = P.text_runs(s)
    assert want == brute(s.tolist())
    monkeypatch.setattr(P, "MAX_SPLITS", 0)
    assert P.text_runs(s) == want


def test_words_in_pieces(monkeypatch):
    text = " lead a\tbb  ccc\x0bä 日本\x85x " + "w" * 50 + "\n"
    whole = P.word_numbers(text.encode())
    for piece in (1, 2, 7):
        monkeypatch.setattr(P, "PIECE", piece)
        ids, words = P.word_numbers(text.encode())
        assert ids.tolist() == whole[0].tolist() and words == whole[1]
    assert [words[i].decode() for i in ids] == re.findall(r"[^\x20\x09-\x0D]+", text)


def rows_of(n):
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(300)]
    tied = " ".join(["x", "y"] * 15) + " mid " + " ".join(["p", "q"] * 15)
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "one"), (None, "a " * 100), (5, "a " * 100), (5, "a " * 100),
            (6, tied), (7, " ".join(f"l{i % 997}" for i in range(30_000))), (8, "ä日 b " * 24)]
    for i in range(n):
        words = [rng.choice(vocabulary) for _ in range(rng.randrange(200))]
        if i % 3 == 0 and words:
            at = rng.randrange(len(words))
            words[at:at] = words[at:at + rng.randrange(1, 12)] * rng.randrange(2, 30)
        rows.append((100 + i, "  ".join(words)))
    return rows


def test_report_matches_brute_force(spark):
    rows = rows_of(150)
    docs = spark.createDataFrame([(i, t, "r", 1, "n", 2, "p", 3) for i, t in rows], SCHEMA)
    got = sorted((tuple(r) for r in P.report(P.runs_of(docs, change=P.repeat_tail)).collect()), key=str)
    want = sorted((report(i, t) if len(t or "") < 50_000 else long_report(i, t) for i, t in rows), key=str)
    assert got == want
    assert P.report(P.runs_of(docs.limit(0))).count() == 0


def long_report(doc_id, text):
    """The long text's only run, known by construction (its id isn't changed)."""
    assert zlib.crc32(str(doc_id).encode()) % 10
    words = text.split()
    return (doc_id, 1, 0, 30_000, 997, 1000 * 30_000 // 997, sha("0,30000,997\n"), sha(" ".join(words[:997])))


def test_collapse_keeps_columns_and_first_periods(spark):
    docs = spark.createDataFrame([(1, "head " + "a b " * 40 + "tail", "r", 1, "n", 2, "p", 3),
                                  (2, "no  run\nhere", "r", 1, "n", 2, "p", 3), (3, None, "r", 1, "n", 2, "p", 3)],
                                 SCHEMA)
    out = P.collapse(docs)
    assert out.schema == docs.schema
    assert {r.doc_id: r.text for r in out.collect()} == {1: "head a b tail", 2: "no  run\nhere", 3: None}
