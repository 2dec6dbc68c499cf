"""JSON array files read by several tasks."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from helpers import feed_df, feed_record
from rollcall.schemas import CATALOGUE, FEED
from rollcall.sources import read_catalogue, read_feed
from rollcall.sources.json_array import read_json_array

SCHEMA = "id long, s string, n struct<a: array<struct<b: string>>>"


@pytest.fixture()
def small_splits(spark):
    """Blocks of a few bytes, so that borders fall everywhere."""
    keep = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}

    def use(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield use
    for k, v in keep.items():
        spark.conf.set(k, v)


def awkward(rng, i):
    text = "".join(rng.choice(['"', "\\", "}", "{", "[", "]", ",", "a", "é", "日", "\n", "},{", '"}', "\\\""])
                   for _ in range(rng.randrange(25)))
    return {"id": i, "s": text, "n": {"a": [{"b": text[::-1]} for _ in range(rng.randrange(3))]}}


@pytest.mark.parametrize("size", [23, 300, 1 << 20])
def test_every_border_is_found(spark, tmp_dir, small_splits, size):
    from pyspark.sql.types import StructType
    rng = random.Random(size)
    want = []
    for f in range(3):
        rows = [awkward(rng, f * 1000 + i) for i in range([40, 1, 0][f])]
        want += rows
        with open(os.path.join(tmp_dir, f"{f}.json"), "w", encoding="utf-8") as fh:
            json.dump(rows, fh, ensure_ascii=f == 0, indent=[None, 2, None][f])
    small_splits(size)
    got = read_json_array(spark, tmp_dir, StructType.fromDDL(SCHEMA)).collect()
    assert sorted((r.id, r.s, tuple(x.b for x in r.n.a)) for r in got) == sorted(
        (r["id"], r["s"], tuple(x["b"] for x in r["n"]["a"])) for r in want)


def test_one_file_is_read_by_several_tasks(spark, tmp_dir, small_splits):
    rows = [json.loads(j) for j in feed_df(spark, [feed_record(i, "7", [("c", "a@x.org", "A", "B")] * (i % 3))
                                                   for i in range(400)]).toJSON().collect()]
    path = os.path.join(tmp_dir, "feed.json")
    with open(path, "w") as fh:
        json.dump(rows, fh)
    small_splits(os.path.getsize(path) // 8)
    assert spark.read.option("lineSep", "}").text(path).rdd.getNumPartitions() >= 8
    got = read_feed(spark, path)
    assert got.schema == FEED and got.count() == 400
    whole = spark.read.schema(FEED).option("multiLine", True).json(path)
    assert sorted(map(str, got.collect())) == sorted(map(str, whole.collect()))


def test_catalogue_array_and_wrong_files(spark, tmp_dir):
    path = os.path.join(tmp_dir, "cat.json")
    with open(path, "w") as fh:
        fh.write('\n [ {"CourseCd": "007", "CourseName": "a}{", "CourseGroups": []}\n,\n{"CourseCd": "8"} ]\n')
    got = read_catalogue(spark, path)
    assert got.schema == CATALOGUE
    assert sorted((r.CourseCd, r.CourseName) for r in got.collect()) == [("007", "a}{"), ("8", None)]
    for bad in ('{"CourseCd": "1"}', '"text"'):
        wrong = os.path.join(tmp_dir, "wrong.json")
        with open(wrong, "w") as fh:
            fh.write(bad)
        with pytest.raises(Exception, match="not a JSON array"):
            read_catalogue(spark, wrong).select(F.count("*")).collect()
    with open(wrong, "w") as fh:
        fh.write("[]")
    assert read_catalogue(spark, wrong).count() == 0
