"""Columns named like the operators' own, repeated labelled rows, and the work
spent on a large group of near copies."""

import sys
from pathlib import Path

import numpy as np
import pytest

from rollcall.llm import decontaminate, near_dedup, toxicity

sys.path.insert(0, str(Path(__file__).parent))
from test_corpus_operators import brute_components  # noqa: E402

WORDS = " ".join(f"word{i}" for i in range(40))


def clashing(spark, rows):
    """Documents with extra columns that operators might name theirs."""
    names = ("toxic", "_id", "_kept_id", "_kept_rep", "kept_id", "kept_rep", "_text_key", "text_key", "rep", "key",
             "severity", "toxic_p", "node", "component", "slot", "band")
    schema = "doc_id long, text string, " + ", ".join(f"`{n}` int" for n in names)
    return spark.createDataFrame([(i, t, *range(len(names))) for i, t in rows], schema)


def test_filters_keep_clashing_columns(spark):
    docs = clashing(spark, [(1, WORDS), (2, WORDS + " tail"), (3, "clean words here"), (4, None)])
    kept = near_dedup.drop_near_duplicates(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [1, 3, 4]
    bench = spark.createDataFrame([(7, " ".join(WORDS.split()[5:20]))], "item_id long, text string")
    clean = decontaminate.decontaminate(docs, bench)
    assert clean.columns == docs.columns and sorted(r.doc_id for r in clean.collect()) == [3, 4]


def labelled(spark):
    rng = np.random.default_rng(3)
    texts = [" ".join(rng.choice([f"w{k}" for k in range(60)], 30)) + (" badword uglyword" if i % 3 == 0 else "")
             for i in range(150)]
    docs = clashing(spark, list(enumerate(texts)))
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(150)], "doc_id long, toxic int")
    return docs, labels


def test_toxicity_with_clashing_columns(spark):
    docs, labels = labelled(spark)
    left = toxicity.drop_toxic(docs, labels)
    assert left.columns == docs.columns
    assert {r.doc_id for r in left.collect()} == {i for i in range(150) if i % 3}
    assert toxicity.score(docs, labels).count() == 150


def test_a_repeated_labelled_id_is_one_row(spark):
    docs, labels = labelled(spark)
    many = docs.unionByName(docs.where("doc_id = 3").crossJoin(spark.range(300)).drop("id"))
    sample = toxicity.labelled_sample(many, labels, "doc_id", "text", "toxic")
    assert sample.count() == 150


@pytest.mark.parametrize("copies", [60, 240])
def test_verified_pairs_grow_with_a_group_not_with_its_square(spark, monkeypatch, copies):
    """Copies that are all near one text and mostly not near each other."""
    counted, real = [], near_dedup._verify

    def verify(pairs, sets):
        counted.append(pairs.count())
        return real(pairs, sets)

    monkeypatch.setattr(near_dedup, "_verify", verify)
    rng = np.random.default_rng(copies)
    base = [f"b{i}" for i in range(400)]
    rows = [(0, " ".join(base))]
    for i in range(1, copies):
        w = list(base)
        for at in rng.choice(400, 9, replace=False):
            w[at] = f"e{i}x{at}"
        rows.append((i, " ".join(w)))
    out = near_dedup.near_duplicates(clashing(spark, rows)).collect()
    assert {r.component_id for r in out} == {0} and sum(r.kept for r in out) == 1
    assert sum(counted) <= 5 * copies


@pytest.mark.parametrize("block_items", [1 << 22, 900])
def test_last_round_against_brute_force(spark, monkeypatch, block_items):
    """One partner a class in the second round, so that the rest is verified in
    the buckets' tasks, whole and in blocks."""
    monkeypatch.setattr(near_dedup, "PARTNERS", 1)
    monkeypatch.setattr(near_dedup, "BLOCK_ITEMS", block_items)
    ran, real = [], near_dedup._exact_links

    def exact(rest, sets):
        ran.append(rest.count())
        return real(rest, sets)

    monkeypatch.setattr(near_dedup, "_exact_links", exact)
    rng = np.random.default_rng(17)
    data = []
    for g in range(3):
        base = [f"g{g}v{x}" for x in range(110)]
        for i in range(30):
            w = list(base)
            for at in rng.choice(110, 2 + i % 4, replace=False):
                w[at] = f"e{g}x{i}x{at}"
            data.append((100 * g + i, " ".join(w)))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in
           near_dedup.near_duplicates(clashing(spark, data)).collect()}
    assert got == brute_components(data) and ran
