"""Literals that regular expressions require, and the ledger's kept index."""

import os
import random
import re

import pytest

from rollcall.operators.letters import required_literals, unsent
from rollcall.sources.ledger_index import LedgerIndex

LEDGER = ["annxleee1@school.org", "xx bob@school.org yy", "aXb", "d@x", "nobody@school.org", "long.nam@school.org",
          "zoe@yz", "ann.lee+1@school.org", "cc@school.net", "c@school.net", "tab\tname@school.org", "ANN@SCHOOL.ORG"]
PATTERNS = ["(ann|bob)@school[.]org", "nobody@(school|college)\\.org", "c{2}@school.net", "c{0,1}@school.net", "^ann.*1@school",
            "zoe@(y|z)+", "(x|y)?bob@school.org$", "[a-c]nn\\.lee", "long\\.nam@\\w+", "q(a|b)c", "(?i)ann@school.org",
            "tab\\tname", "\\Qann.lee+1\\E", "(bob|)@school.org", "a|d@x", "(unclosed", "plain@school.org"]


def test_literals_are_required():
    want = {"(ann|bob)@school[.]org": ["@school.org"], "c{2}@school.net": ["@school"], "(?i)ann@school.org": [],
            "(unclosed": [], "\\Qann\\E": [], "nobody@(school|college)x": ["nobody@"], "(abcd|efghi)[0-9]": ["abcd", "efghi"],
            "(abcd)*": [], "(abcd|)x?": [], "ab(cdef){2,3}": ["cdef"], "[x]yz1": ["xyz1"]}
    assert {p: required_literals(p) for p in want} == want


def test_literals_hold_in_every_match():
    rng = random.Random(6)

    def make(depth):
        kind = rng.randrange(6 if depth else 2)
        if kind < 2:
            return "".join(rng.choice("abc.") for _ in range(rng.randrange(1, 4)))
        if kind == 2:
            return "(" + "|".join(make(depth - 1) for _ in range(rng.randrange(1, 4))) + ")"
        if kind == 3:
            return "(" + make(depth - 1) + ")" + rng.choice(["*", "+", "?", "{2}", "{0,2}"])
        if kind == 4:
            return "[abc]" + make(depth - 1)
        return make(depth - 1) + make(depth - 1)

    for _ in range(3000):
        pattern = make(3)
        need = required_literals(pattern)
        for _ in range(10):
            text = "".join(rng.choice("abcd") for _ in range(rng.randrange(12)))
            if need and re.search(pattern, text):
                found = re.search(pattern, text).group()
                assert any(n in found for n in need), (pattern, need, text)


@pytest.fixture()
def candidates(spark):
    return spark.createDataFrame([(i, 0, a, "acc", a.lower()) for i, a in enumerate(PATTERNS) if a != "(unclosed"],
                                 "event_id long, pos int, email string, account string, e string")


def java_matches(pattern):
    if pattern.startswith("\\Q"):
        pattern = re.escape(pattern[2:-2])
    return any(re.search(pattern, x) for x in LEDGER)


@pytest.mark.parametrize("kept", [False, True])
def test_general_patterns_against_the_ledger(spark, tmp_dir, candidates, kept):
    ledger = spark.createDataFrame([(x,) for x in LEDGER], "Email string")
    index = None
    if kept:
        index = LedgerIndex(spark, os.path.join(tmp_dir, "ledger"), buckets=8)
        for part in (LEDGER[:5], LEDGER[5:] + LEDGER[:1], []):
            index.append(spark.createDataFrame([(x,) for x in part], "Email string"))
        assert index.entries().count() == len(LEDGER)
    due = unsent(None, None if kept else ledger, "intro", match="regex", candidates=candidates, index=index)
    want = {p for p in PATTERNS if p != "(unclosed" and not java_matches(p)}
    assert {r.email for r in due.collect()} == want


def test_only_asked_buckets_are_opened(spark, tmp_dir):
    index = LedgerIndex(spark, os.path.join(tmp_dir, "ledger"), buckets=16)
    index.append(spark.createDataFrame([(f"user{i:03d}@school.org",) for i in range(200)], "Email string"))
    found = index.holding(spark.createDataFrame([("user017@",)], "gram string"))
    assert [r.sent for r in found.collect()] == ["user017@school.org"]
    assert {f.split("bucket=")[1].split("/")[0] for f in found.inputFiles() if "bucket=" in f} == {
        next(f for f in index.log.latest()["tables"]["grams"] if f"/bucket={b}" in f).split("bucket=")[1]
        for b in [r[0] for r in spark.createDataFrame([("user017@",)], "gram string").select(index._bucket()).collect()]}
