"""Connected components of an undirected edge table (alternating large-star
and small-star contraction), all in DataFrame joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.llm.common import stash

MAX_ROUNDS = 60


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star operation on directed pairs (u, v) with u > v."""
    if large:
        hood = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        hood = edges
    low = hood.groupBy("u").agg(F.min("v").alias("m")).select(
        F.col("u").alias("c"), F.least("u", "m").alias("m"))
    near = hood.join(low, hood["u"] == low["c"]).select("u", "v", "m")
    if large:
        out = near.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = (near.select(F.col("v").alias("u"), F.col("m").alias("v"))
               .unionByName(near.select("u", F.col("m").alias("v"))))
    return out.where(F.col("u") != F.col("v")).distinct()


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component): ``component`` is the smallest node of each
    component; only nodes with an edge to another node appear."""
    e = stash(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
              .where(F.col("u") != F.col("v")).distinct(), "edges")
    state = None
    for _ in range(MAX_ROUNDS):
        e = stash(_star(_star(e, True), False), "edges")
        now = tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())
        if now == state:
            return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                e.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()
        state = now
    raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
