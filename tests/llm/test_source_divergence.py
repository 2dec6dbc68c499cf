"""Operator 11 against brute force over dense tables."""

import collections
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from rollcall.llm import source_divergence as S
from rollcall.llm import textvec as V

SCHEMA = "doc_id long, text string, lang string, source string, term string, place int, p int, value string, docs int"


def terms(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lower)


def brute(rows, min_docs=30):
    seen, docs, groups = collections.Counter(), collections.Counter(), {}
    for _, text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups.setdefault(lang, set()).add(source)
        t = terms(text)
        seen.update((lang, source, x) for x in t)
        docs.update((lang, x) for x in set(t))
    out = []
    for lang, sources in groups.items():
        kept = sorted(x for (at, x), n in docs.items() if at == lang and n >= min_docs)

        def weights(names):
            count = {x: sum(seen[lang, s, x] for s in names) for x in kept}
            n = sum(count.values())
            return {x: 1 + 1000000000 * (c + 5) // (n + 5 * len(kept)) for x, c in count.items()}

        whole, own = weights(sources), {s: weights([s]) for s in sources}
        for s in sources:
            pairs = [(o, sum(abs(own[s][x] - own[o][x]) for x in kept)) for o in sources if o != s]
            top = [(x, own[s][x] - whole[x]) for x in kept if seen[lang, s, x] and own[s][x] > whole[x]]
            for part, items, limit in (("pair", pairs, len(pairs)), ("term", top, 50)):
                items.sort(key=lambda i: (-i[1], i[0].encode()))
                out += [(lang, s, part, x, f, r) for r, (x, f) in enumerate(items[:limit], 1)]
    return sorted(out)


def rows_of(seed, n=700):
    rng = random.Random(seed)
    short = [f"w{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(150)]
    words = short + ["Ünder", "日本語の長い言葉です", "abcdefgh", "abcdefghi", "abcdefghijklmnop", "abcdefghijklmnopq",
                     "x" * 40, "y" * 40, "A", "a", "ß"]
    out = [(1, None, "en", "s0"), (2, "", None, None), (3, "one", None, "s1"), (3, "one", None, "s1"),
           (4, "tail2tail x-y", "xx", "alone"), (5, " 12 ", "en", "bare")]
    for i in range(n):
        lang = rng.choice(["en", "en", "de", None])
        source = rng.choice(["s0", "s0", "s1", "s2", "é", None])
        lean = words[:40] if source == "s1" else words
        out.append((10 + i, " ".join(rng.choice(lean) for _ in range(rng.randrange(60))), lang, source))
    out.append((9, " ".join(rng.choice(words) for _ in range(40_000)), "en", "s2"))
    return out


def table_of(spark, rows):
    return spark.createDataFrame([(*r, "t", 1, 2, "v", 3) for r in rows], SCHEMA)


def got(df):
    return sorted(tuple(r) for r in df.collect())


def test_matches_brute_force(spark):
    rows = rows_of(1)
    df = S.divergence(table_of(spark, rows).repartition(5))
    assert df.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert got(df) == brute(rows)


def test_small_tables_buckets_and_tiles(spark, monkeypatch):
    """Tasks that hand their tables on, pieces of a long text, several buckets,
    tiles of two sources and narrow blocks."""
    monkeypatch.setattr(S, "MAX_ENTRIES", 200)
    monkeypatch.setattr(S, "BUCKET_ENTRIES", 100)
    monkeypatch.setattr(S, "TILE", 2)
    monkeypatch.setattr(S, "DENSE", 20)
    monkeypatch.setattr(V, "CHUNK_BYTES", 5_000)
    rows = rows_of(2)
    assert got(S.divergence(table_of(spark, rows).repartition(3))) == brute(rows)


def test_no_kept_terms_and_no_rows(spark):
    rows = [(1, "a b", "en", "x"), (2, "c", "en", "y"), (3, "d", "de", "x")]
    assert got(S.divergence(table_of(spark, rows))) == [("en", "x", "pair", "y", 0, 1), ("en", "y", "pair", "x", 0, 1)]
    assert S.divergence(table_of(spark, [])).count() == 0


def test_radix_order_is_a_stable_sort():
    rng = np.random.default_rng(4)
    a = rng.integers(0, 1 << 63, 5000, dtype=np.uint64) >> rng.integers(0, 63, 5000).astype(np.uint64)
    b = rng.integers(0, 5, 5000).astype(np.uint32)
    assert S.radix_order([a]).tolist() == np.argsort(a, kind="stable").tolist()
    assert S.radix_order([a, b]).tolist() == np.lexsort((a, b)).tolist()
    assert S.radix_order([np.zeros(0, np.uint64)]).tolist() == []


@pytest.mark.parametrize("seed", range(3))
def test_packing_counts_and_comes_back(seed):
    rng = random.Random(seed)
    letters = "abzAZé日ß"
    texts = [" ".join("".join(rng.choice(letters) for _ in range(rng.randrange(1, 30))) for _ in range(50))
             for _ in range(40)] * 2
    groups = np.array([i % 3 for i in range(len(texts))], np.uint32)
    buckets = {}
    for lo, hi, data, offsets in V.chunks(pa.array(texts), 4000):
        S.count_terms(data, offsets, groups[lo:hi], buckets)
    found = {}
    for b in buckets.values():
        keys, group, seen, docs = b.fold()
        for t, g, s, d in zip(S.unpacked(keys).to_pylist(), group.tolist(), seen.tolist(), docs.tolist()):
            assert (t, g) not in found
            found[t, g] = (s, d)
    want = {}
    for g, text in zip(groups.tolist(), texts):
        for t, c in collections.Counter(terms(text)).items():
            s, d = want.get((t, g), (0, 0))
            want[t, g] = (s + c, d + 1)
    assert found == want
