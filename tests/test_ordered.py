"""Exactness of the skew-safe ordered operators against plain Python."""

import random

from pyspark.sql import Row

from rollcall.operators.ordered import first_per_key, last_per_key, previous_value


def _data(n=600, seed=3):
    rng = random.Random(seed)
    # one hot key holding about a third of the rows, many small ones
    rows = []
    for i in range(n):
        k = "hot" if rng.random() < 0.35 else f"k{rng.randint(0, 40)}"
        rows.append(Row(k=k, g=rng.randint(0, 2), o=rng.randint(0, 5000), t=rng.randint(0, 3),
                        v=rng.choice(["a", "b", None])))
    # unique (o, t) order within a key
    seen, out = set(), []
    for r in rows:
        if (r.k, r.g, r.o, r.t) not in seen:
            seen.add((r.k, r.g, r.o, r.t))
            out.append(r)
    return out


def test_previous_value_matches_lag_across_blocks(spark):
    data = _data()
    df = spark.createDataFrame(data)
    got = previous_value(df, ["k", "g"], "o", "v", tie_col="t", block=64).collect()
    by_key = {}
    for r in sorted(data, key=lambda r: (r.k, r.g, r.o, r.t)):
        by_key.setdefault((r.k, r.g), []).append(r)
    want = {}
    for rows in by_key.values():
        for i, r in enumerate(rows):
            want[(r.k, r.g, r.o, r.t)] = None if i == 0 else (rows[i - 1].v,)
    assert len(got) == len(data)
    for r in got:
        p = r["prev_v"]
        assert (None if p is None else (p["value"],)) == want[(r.k, r.g, r.o, r.t)]


def test_previous_value_null_keys(spark):
    df = spark.createDataFrame([(None, 1, "x"), (None, 2, "y"), ("a", 1, "z")], "k string, o long, v string")
    got = {(r.k, r.o): r.prev_v for r in previous_value(df, ["k"], "o", "v", block=1).collect()}
    assert got[(None, 1)] is None and got[(None, 2)]["value"] == "x" and got[("a", 1)] is None


def test_first_and_last_per_key(spark):
    data = _data()
    df = spark.createDataFrame(data)
    first = {r.k: (r.first_o, r.first_t, r.first_v)
             for r in first_per_key(df, ["k"], ["o", "t"], ["v"]).collect()}
    last = {r.k: (r.last_o, r.last_t, r.last_v)
            for r in last_per_key(df, ["k"], ["o", "t"], ["v"]).collect()}
    for k in {r.k for r in data}:
        rows = sorted((r.o, r.t, r.v) for r in data if r.k == k)
        assert first[k] == rows[0][:2] + (rows[0][2],)
        assert last[k] == rows[-1]


def test_previous_value_initial_state(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 5, "z"), ("c", 9, "w")],
                               "k string, o long, v string")
    init = spark.createDataFrame([("a", "A0"), ("c", "C0")], "k string, value string")
    got = {(r.k, r.o): (r.prev_v["value"] if r.prev_v else None)
           for r in previous_value(df, ["k"], "o", "v", block=1, initial=init).collect()}
    assert got == {("a", 1): "A0", ("a", 2): "x", ("b", 5): None, ("c", 9): "C0"}


def test_previous_value_sparse_ids_of_one_key(spark):
    """Time-like ids: every block holds one row, and the blocks of blocks are
    exact too."""
    rng = random.Random(5)
    ids = sorted(rng.sample(range(1 << 50), 200))
    df = spark.createDataFrame([("k", i, str(i)) for i in ids], "k string, o long, v string")
    got = {r.o: r.prev_v["value"] if r.prev_v else None
           for r in previous_value(df, ["k"], "o", "v", block=1 << 12).collect()}
    assert got == {i: (str(ids[n - 1]) if n else None) for n, i in enumerate(ids)}
